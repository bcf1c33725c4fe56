"""Media columns in GIF: writing and reading of animations, timed frames and colour histograms.

A payload is stored one sample a byte. The palette gives each byte a colour of its own, so the composed picture gives the bytes back.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches

#: A payload animation's frames have so many columns, which is what payloads are padded to, and rows at most.
UNIT, ROWS = 576, 16
#: Hundredths of a second that a frame is shown.
DELAY = 4
#: Bins of the histograms, by channel.
BINS = 8
MOST_CODES = 4096
#: Fixed rule: three bits of a byte are red, three green, two blue.
COLOURS = np.array([(36 * (k >> 5), 36 * (k >> 2 & 7), 85 * (k & 3)) for k in range(256)], np.uint8)


@cache
def _schedule(size: int, most: int = 3 * MOST_CODES) -> np.ndarray:
    """The bit at which each code starts, the clear code first. A code's width depends on its place
    alone: each code after it but the first adds a string to the table, until that is full."""
    nexts = (1 << size) + 2 + np.maximum(0, np.arange(most) - 1)
    widths = np.minimum(12, np.floor(np.log2(nexts)).astype(np.int64) + 1)
    return np.concatenate(([0, size + 1], size + 1 + np.cumsum(widths)))


def lzw_encode(data: bytes, size: int = 8) -> bytes:
    """The LZW code stream of samples below 2**size. The table is cleared when it is full."""
    clear = 1 << size
    runs: list[list[int]] = []
    codes: list[int] = []
    table: dict[int, int] = {}
    free = clear + 2
    rest = iter(data)
    prefix = next(rest, None)
    for b in rest:
        key = prefix << 8 | b
        code = table.setdefault(key, free)
        if code != free:
            prefix = code
            continue
        codes.append(prefix)
        prefix = b
        if free < MOST_CODES - 1:
            free += 1
        else:
            runs.append(codes)
            codes, table, free = [], {}, clear + 2
    if prefix is not None:
        codes.append(prefix)
    runs.append(codes)

    starts = _schedule(size)
    values, offsets, base = [], [], 0
    for k, codes in enumerate(runs):
        # A clear code has the width of the place where it stands, so it belongs to the run that it ends.
        own = [*([clear] if k == 0 else []), *codes, clear + 1 if k == len(runs) - 1 else clear]
        at = starts[: len(own) + 1] if k == 0 else starts[1 : len(own) + 2] - starts[1]
        values.append(np.array(own, np.int64))
        offsets.append(at[:-1] + base)
        base += int(at[-1])
    value, offset = np.concatenate(values), np.concatenate(offsets)
    value <<= offset & 7
    at = offset >> 3
    out = np.bincount(np.concatenate((at, at + 1, at + 2)), np.concatenate((value & 255, value >> 8 & 255, value >> 16)))
    return out[: (base + 7) // 8].astype(np.uint8).tobytes()


def _run(codes: np.ndarray, clear: int) -> np.ndarray:
    """The samples of the codes between two clear codes.

    The string that a code adds to the table is what the code before it gave and the sample after that, so it stands in the output
    already: each sample is one sample itself or the copy of one before it. Copies of copies are followed in steps that double.
    """
    n = len(codes)
    places = np.arange(n)
    single = codes < clear
    # The code that the string of a code was added after; a code that is not there yet is the one just to be added.
    origin = np.where(single, places, np.minimum(codes - clear - 2, places - 1))
    if n and (origin.min() < 0 or not single[0]):
        raise ValueError("bad code")
    length, at = (~single).astype(np.int64), origin
    while (length[at] > 0).any():
        length, at = length + length[at], at[at]
    length += 1
    begin = np.cumsum(length) - length
    source = np.arange(int(length.sum())) + np.repeat(np.where(single, 0, begin[origin] - begin), length)
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    samples = np.zeros(len(source), np.uint8)
    samples[begin[single]] = codes[single]
    return samples[source]


def lzw_decode(data: bytes, size: int) -> bytes:
    """The samples of an LZW code stream; a stream that ends early gives what it holds. Raises ValueError for codes that no table can have."""
    clear, end = 1 << size, (1 << size) + 1
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.int64)
    total, out = 8 * len(data), []
    starts = _schedule(size, max(3 * MOST_CODES, total // 12 + MOST_CODES) if total > 24 * MOST_CODES else 3 * MOST_CODES)
    begin, width = starts[1:] - starts[1], np.diff(starts[1:])
    base = size + 1 if total and int(raw[0] | raw[1] << 8) & (2 * clear - 1) == clear else 0
    while base < total:
        # The codes up to the next clear code, read as if there were none.
        n = int(np.searchsorted(begin[1:], total - base, "right"))
        offset = begin[:n] + base
        at = offset >> 3
        codes = (raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16) >> (offset & 7) & ((1 << width[:n]) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        used = int(stops[0]) if len(stops) else n
        if used:
            out.append(_run(codes[:used], clear).tobytes())
        if not len(stops) or codes[used] == end:
            break
        base += int(begin[used + 1])
    return b"".join(out)


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes((len(p),)) + p for p in (data[k : k + 255] for k in range(0, len(data), 255))) + b"\0"


def write_gif(payload: bytes, width: int = UNIT, rows: int = ROWS, delay: int = DELAY) -> bytes:
    """An animation of frames of up to rows lines, one sample a byte; payload is a positive multiple of width bytes.

    Samples that are as before in their place are transparent where the frame has a value to spare for that. Frames stay for the next
    ones, but each third, of which the canvas is put back to what it was.
    """
    lines = np.frombuffer(payload, np.uint8).reshape(-1, width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, len(lines)), 0xF7, 0, 0), COLOURS.tobytes()]
    canvas = np.zeros((min(rows, len(lines)), width), np.int16) - 1  # nothing painted yet
    for n, at in enumerate(range(0, len(lines), rows)):
        part = lines[at : at + rows]
        below = canvas[: len(part)]
        spare = np.flatnonzero(np.bincount(part.ravel(), minlength=256) == 0)
        same = below == part
        clear = int(spare[0]) if len(spare) and same.any() else None
        shown = part if clear is None else np.where(same, np.uint8(clear), part)
        disposal = 3 if n % 3 == 2 else 1
        out += [b"\x21\xf9\x04", struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0), b"\0\x2c", struct.pack("<HHHHB", 0, 0, width, len(part), 0), b"\x08", _blocks(lzw_encode(shown.tobytes()))]
        if disposal == 1:
            canvas = canvas.copy()
            canvas[: len(part)] = part
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    at: int  # hundredths of a second since the start
    delay: int
    rgb: np.ndarray  # the whole picture: height x width x 3
    box: tuple[int, int, int, int]  # left, top, width and height of what this frame painted


def read_gif(data: bytes) -> Iterator[Frame]:
    """The composed frames of a GIF, one after the other: code streams decoded, interlacing undone, palettes, transparency and
    disposal applied. Raises ValueError on other data."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack("<HHBBB", data[6:13])
    pos = 13
    palette = None
    if flags & 0x80:
        n = 2 << (flags & 7)
        palette = np.frombuffer(data, np.uint8, 3 * n, pos).reshape(n, 3)
        pos += 3 * n
    canvas = np.zeros((height, width, 3), np.uint8)
    clock, delay, disposal, transparent = 0, 0, 0, None

    def blocks() -> bytes:
        nonlocal pos
        parts = []
        while pos < len(data) and (n := data[pos]):
            parts.append(data[pos + 1 : pos + 1 + n])
            pos += 1 + n
        pos += 1
        return b"".join(parts)

    while pos < len(data) and data[pos] != 0x3B:
        kind = data[pos]
        pos += 1
        if kind == 0x21:
            label = data[pos]
            pos += 1
            body = blocks()
            if label == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                transparent = body[3] if body[0] & 1 else None
        elif kind == 0x2C:
            left, top, w, h, local = struct.unpack("<HHHHB", data[pos : pos + 9])
            pos += 9
            colours = palette
            if local & 0x80:
                n = 2 << (local & 7)
                colours = np.frombuffer(data, np.uint8, 3 * n, pos).reshape(n, 3)
                pos += 3 * n
            if colours is None:
                raise ValueError("no palette")
            size = data[pos]
            pos += 1
            if not 2 <= size <= 8:
                raise ValueError("bad code size")
            samples = lzw_decode(blocks(), size)[: w * h].ljust(w * h, b"\0")
            pixels = np.frombuffer(samples, np.uint8).reshape(h, w)
            if local & 0x40:
                rows = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
                straight = np.empty_like(pixels)
                straight[rows] = pixels
                pixels = straight
            before = canvas.copy() if disposal == 3 else None
            painted = colours[np.minimum(pixels, len(colours) - 1)]
            if transparent is None and (left, top, w, h) == (0, 0, width, height):
                canvas = painted
            else:
                canvas = canvas.copy()
                part = canvas[top : top + h, left : left + w]
                seen = np.ones(pixels.shape, bool) if transparent is None else pixels != transparent
                seen = seen[: part.shape[0], : part.shape[1]]
                part[seen] = painted[: part.shape[0], : part.shape[1]][seen]
            yield Frame(clock, delay, canvas, (left, top, w, h))
            clock += delay
            if disposal == 2:
                canvas = canvas.copy()
                canvas[top : top + h, left : left + w] = palette[background] if palette is not None and background < len(palette) else 0
            elif disposal == 3:
                canvas = before
            delay, disposal, transparent = 0, 0, None
        else:
            raise ValueError("bad block")


def stored(text: Column) -> Column:
    """text -> the GIF that holds its UTF-8 bytes, padded with 255 to whole frames. Null text is empty."""

    def write(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                raw = (t or "").encode("utf-8", "surrogatepass")
                out.append(write_gif(raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)))
            yield pd.Series(out)

    return F.pandas_udf(write, "binary")(text)


MEASURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames array<struct<at_ms: long, delay_ms: long, red: array<long>, green: array<long>, blue: array<long>>>"
NAMES = [c.split()[0] for c in MEASURES.split(", ")[:7]] + ["frames"]


def _bytes_of(rgb: np.ndarray) -> np.ndarray:
    """The bytes that a picture's colours stand for."""
    return (rgb[..., 0] // 36 << 5) | (rgb[..., 1] // 36 << 2) | (rgb[..., 2] // 85)


def histograms(rgb: np.ndarray) -> list[np.ndarray]:
    """How many pixels have each eighth of red, of green and of blue."""
    return [np.bincount(rgb[..., c].ravel() >> 5, minlength=BINS) for c in range(3)]


def measured(media: Column) -> Column:
    """A stored GIF -> what its bytes hold: lengths, digests, timed frames with their colour histograms, and the feature, which names frames,
    duration and the histograms of all frames. A frame is held at a time."""

    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in batches:
            rows = []
            for data in some:
                data = bytes(data)
                payload, frames, total, end = bytearray(), [], np.zeros((3, BINS), np.int64), 0
                for f in read_gif(data):
                    own = f.rgb[: f.box[3]]
                    payload += _bytes_of(own).tobytes()
                    bins = histograms(own)
                    total += bins
                    end = f.at + f.delay
                    frames.append({"at_ms": 10 * f.at, "delay_ms": 10 * f.delay, "red": bins[0], "green": bins[1], "blue": bins[2]})
                feature = f"frames={len(frames)};centiseconds={end};" + ";".join(f"{name}={','.join(map(str, x))}" for name, x in zip(("red", "green", "blue"), total.tolist(), strict=True))
                rows.append((len(payload.rstrip(b"\xff")), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, frames))
            yield pd.DataFrame(rows, columns=NAMES)

    return F.pandas_udf(read, MEASURES)(media)


def media_columns(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Adds the column media (binary) and the measures to every row; columns of docs with these names are replaced.

    Equal texts, so repeated rows too, give equal values. Null and empty texts are one frame of 255. Texts of any length are stored whole, a
    frame at a time; a task holds the text and its GIF. An empty table gives no rows.
    """
    docs = small_batches(docs).drop("media", *NAMES)
    got = fresh(docs, "got")
    out = docs.withColumn("media", stored(F.col(f"`{text_col}`"))).withColumn(got, measured(F.col("media")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "media", *[F.col(f"{got}.{n}").alias(n) for n in NAMES])


def frames(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row per timed frame: (id_col, frame, at_ms, delay_ms, red, green, blue), the last three being histograms. Rows
    whose media is null or not a GIF give one row with null frame columns; a broken GIF gives the frames before the break."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, data in zip(batch["i"], batch["m"], strict=True):
                n = len(rows)
                try:
                    for k, f in enumerate(read_gif(bytes(data)) if data is not None else ()):
                        rows.append((i, k, 10 * f.at, 10 * f.delay, *[x.tolist() for x in histograms(f.rgb)]))
                except (ValueError, struct.error, IndexError):
                    pass
                if len(rows) == n:
                    rows.append((i, None, None, None, None, None, None))
            frame = pd.DataFrame(rows, columns=["i", "frame", "at_ms", "delay_ms", "red", "green", "blue"])
            yield frame.astype({"frame": "Int32", "at_ms": "Int64", "delay_ms": "Int64"})

    own = small_batches(media).select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{media_col}`").alias("m"))
    made = own.mapInPandas(read, "i string, frame int, at_ms long, delay_ms long, red array<long>, green array<long>, blue array<long>")
    return made.select(F.col("i").cast(media.schema[id_col].dataType).alias(id_col), *made.columns[1:])
