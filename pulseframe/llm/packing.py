"""Best-fit packing with exact complements."""

from __future__ import annotations

import json
import re
import string
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import product
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH, fresh, small_batches, written

CAPACITY = 4096
END = 1
#: Pieces of one length are ranked in groups, so that a frequent length is not one task's work: of a MOST_GROUPS-th of all pieces, LEAST_GROUP
#: at least. So there are no more groups than MOST_GROUPS and one for each length.
MOST_GROUPS, LEAST_GROUP = 10_000, 100
#: Words whose ids a worker remembers, and characters of them: twice as many at most.
REMEMBERED, REMEMBERED_CHARS = 300_000, 6_000_000

#: The settings of a tokenizer whose texts can be split into words here.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITTERS = [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
#: Which characters stand for bytes that have none of their own.
_WORD = regex.compile(_SPLIT)
_BYTES = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}

_ID = attrgetter("id")

#: Texts with other characters go to the tokenizer whole: for these, normalising in Python is the same for sure.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\u024f]|<\\|")


class Encoder:
    """Token ids by the `tokenizers` library. Where the tokenizer's settings are those above, no token crosses white space, and
    texts are encoded word by word: of some texts at once the different words are found by Arrow, and their ids are asked for once and remembered
    while they are in use. Any other tokenizer gets whole texts."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        t = self.tokenizer
        normal, split = (json.loads(x.__getstate__()) if x else {} for x in (t.normalizer, t.pre_tokenizer))
        plain = t.post_processor is None and t.truncation is None and t.padding is None and all(x.content.startswith("<|") for x in t.get_added_tokens_decoder().values())
        self.by_words = plain and normal.get("normalizers") == _NORMALIZERS and split.get("pretokenizers") == _SPLITTERS
        self.chars = 0
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of what is one word for the tokenizer too, which words with other signs around it share. Its model reads bytes as characters."""
        known = self.known
        found = known.get(part)
        if found is None:
            found = self.before.get(part) or self._ids(part)
            if len(known) < REMEMBERED and self.chars < REMEMBERED_CHARS:
                known[part] = found
                self.chars += len(part)
        return found

    def _ids(self, part: str) -> bytes:
        found = self.model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(_BYTES))
        return array("I", map(_ID, found)).tobytes()

    def _learn(self, word: str) -> bytes:
        if word.isalpha():
            return self._ids(word)
        stem = word.rstrip(string.punctuation)
        return b"".join(map(self._part, (stem, word[len(stem) :]) if stem.isalpha() else _WORD.findall(word)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if not self.by_words:
            return [self.whole(t) for t in texts]
        plain = [None if _OTHER.search(t) else unicodedata.normalize("NFC", t).lower() for t in texts]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        words = split.values.dictionary_encode()
        found = pa.array(self._of(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(words.indices)
        _, offsets, data = found.buffers()
        ids = data.to_pybytes() if data else b""
        ends = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()].tolist() if len(found) else [0] * (len(texts) + 1)
        return [self.whole(t) if p is None else ids[a:b] for t, p, a, b in zip(texts, plain, ends, ends[1:], strict=False)]

    def _of(self, words: list[str]) -> list[bytes]:
        """The ids of each of some different words."""
        found = list(map(self.known.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        if len(self.known) + len(new) > REMEMBERED or self.chars + sum(len(words[k]) for k in new) > REMEMBERED_CHARS:
            self.before, self.known = self.known, {w: ids for w, ids in zip(words, found, strict=True) if ids is not None}
            self.chars = sum(map(len, self.known))
        known, before = self.known, self.before
        for k in new:
            w = words[k]
            ids = known.get(w)
            if ids is None:
                known[w] = ids = before.get(w) or self._learn(w)
                self.chars += len(w)
            found[k] = ids
        return found


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """docs -> (id_col, piece, start, length, ids_crc32): each document's ids and the id 1, cut only where
    longer than capacity. Null text is empty, so it is the id 1 alone. Ids of any type are kept; texts of any length are encoded whole."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer), np.array([END], "<u4").tobytes()
        for batch in batches:
            out = []
            texts = ["" if t is None else t for t in batch["t"]]
            for at in range(0, len(texts), BATCH):
                for i, ids in zip(batch["i"].iloc[at : at + BATCH], encode(texts[at : at + BATCH]), strict=True):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a : a + 4 * capacity]
                        out.append((i, k, a // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(out, columns=["i", "piece", "start", "length", "ids_crc32"])

    ident = F.col(f"`{id_col}`")
    made = small_batches(docs).select(ident.cast("string").alias("i"), F.col(f"`{text_col}`").alias("t")).mapInPandas(cut, "i string, piece int, start long, length long, ids_crc32 long")
    return made.select(F.col("i").cast(docs.schema[id_col].dataType).alias(id_col), "piece", "start", "length", "ids_crc32")


@dataclass
class Plan:
    """Which places the pieces of each length take: the j-th of a length is in the run with first <= j, counted from there."""

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]
    sequences: int


#: The ways to plan, in order: the pieces that may fill a gap together at most; and whether single pieces go first for all gaps, then pairs, then triples, and of
#: these the most even, which spares the short pieces, or each gap takes what there is, the most uneven first.
WAYS = [(3, False), (3, True), (2, True), (2, False), (1, True), (0, True)]


def bins_of(counts: dict[int, int], capacity: int, most: int, even: bool) -> list[tuple[tuple[int, ...], int]]:
    """One way to pack so many pieces of each length -> lengths of a sequence, and how many sequences are made so.

    Lengths descend; the gap that a piece leaves is filled exactly by one piece, a pair or a triple (of most pieces) while there are any, as many at
    once as their counts allow. What is left is placed by best fit: into the smallest gap that holds it, else a new sequence.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    bins: list[tuple[tuple[int, ...], int]] = []  # lengths, and how many sequences are made so

    def use(lengths: tuple[int, ...]) -> None:
        kinds, each = np.unique(lengths, return_counts=True)
        n = int((left[kinds] // each).min())
        left[kinds] -= n * each
        bins.append((lengths, n))

    def pair(total: int, spare: dict[int, int]) -> tuple[int, int] | None:
        """Two lengths with this sum of which pieces are left beside spare; the most even or uneven first."""
        if total < 2:
            return None
        a = np.arange(1, total // 2 + 1)[:: -1 if even else 1]
        have = left[: total + 1]
        for x in a[(have[a] > 0) & (have[total - a] > 0)]:
            y = total - int(x)
            if all(left[z] - spare.get(z, 0) >= (1 + (x == y)) for z in (int(x), y)):
                return int(x), y
        return None

    for level, length in product(range(1, most + 1) if even else [most], range(capacity, 0, -1)):
        while left[length] > 0:
            gap = capacity - length
            own = {length: 1}
            if gap == 0:
                use((length,))
            elif left[gap] - own.get(gap, 0) > 0:
                use((length, gap))
            elif level > 1 and (two := pair(gap, own)):
                use((length, *two))
            else:
                third = None
                have = np.flatnonzero(left[: gap - 1] > 0) if gap > 2 and level > 2 else []
                if len(have):
                    some = (left[: gap + 1] > 0).astype(np.float64)
                    size = 1 << (2 * len(some)).bit_length()
                    sums = np.fft.irfft(np.fft.rfft(some, size) ** 2, size)[: gap + 1] > 0.5  # the sums of two
                    for x in have[::-1]:
                        spare = {length: 1}
                        spare[int(x)] = spare.get(int(x), 0) + 1
                        if sums[gap - x] and left[x] - (x == length) > 0 and (two := pair(gap - int(x), spare)):
                            third = (int(x), *two)
                            break
                if not third:
                    break
                use((length, *third))

    gaps: list[int] = []
    opened: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(lengths)
        if gap and gap not in opened:
            insort(gaps, gap)
        opened.setdefault(gap, []).append((lengths, n))

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                lengths, m = opened[gap].pop()
                if not opened[gap]:
                    del opened[gap]
                    gaps.pop(at)
                took = min(n, m)
                if m > took:
                    put(lengths, m - took)
                put((*lengths, length), took)
                n -= took
            else:
                each = min(capacity // length, n)
                put((length,) * each, n // each)
                n -= n // each * each
    return bins + [x for some in opened.values() for x in some]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs so many pieces of each length into few sequences.

    Works on counts by length alone, so its size depends on capacity and not on the number of pieces. Of several ways (WAYS) to choose what
    fills gaps exactly, the last of which is best fit alone, the one with the fewest sequences is taken, the first of these if equal; once
    one has no more sequences than the tokens could fill, or than there are pieces above half a sequence, no other is tried.
    """
    fewest = max(-(-sum(length * n for length, n in counts.items()) // capacity), sum(n for length, n in counts.items() if 2 * length > capacity))
    bins: list[tuple[tuple[int, ...], int]] = []
    best = None
    for most, even in WAYS:
        made = bins_of(counts, capacity, most, even)
        number = sum(n for _, n in made)
        if best is None or number < best:
            bins, best = made, number
        if best == fewest:
            break

    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, n in bins:
        offset = 0
        for length in lengths:
            runs.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    columns = {k: np.array(v, np.int64).T for k, v in runs.items()}
    return Plan({k: v[0] for k, v in columns.items()}, {k: v[1] for k, v in columns.items()}, {k: v[2] for k, v in columns.items()}, sequence)


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, least_group: int = LEAST_GROUP) -> DataFrame:
    """Packs all documents into few sequences of at most capacity tokens: (id_col, piece, start, length, ids_crc32,
    sequence_id, offset), a row per piece.

    The pieces are written once, numbered. Counts by length (capacity of them) decide the plan. A frequent length is dealt to groups by the
    pieces' numbers, so no id or length is one task's work; counts by length and group (at most capacity and MOST_GROUPS) say
    where a group's ranks start, and each piece finds its place by its rank. Null texts are
    empty documents; rows repeated or with null ids are documents of their own; ids keep their type; other columns, of any name, are
    not looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity)
    ident, number, group, rank = (fresh(cut, x) for x in ("ident", "number", "group", "rank"))
    cut = written(cut.withColumn(number, F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # bounded by capacity
    part = max(least_group, -(-sum(counts.values()) // MOST_GROUPS))
    many = {length: -(-n // part) for length, n in counts.items() if n > part}
    groups = fresh(cut, "groups")
    dealt = spark.createDataFrame(sorted(many.items()), f"length long, {groups} int")  # capacity rows at most
    salted = cut.join(F.broadcast(dealt), "length", "left").withColumn(group, F.pmod(F.xxhash64(number), F.coalesce(groups, F.lit(1))).cast("int"))
    starts: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    for length, g, n in sorted(map(tuple, salted.groupBy("length", group).count().collect())):  # bounded, see above
        starts[length, g] = total.get(length, 0)
        total[length] = starts[length, g] + n
    first = {length: np.array([starts.get((length, g), 0) for g in range(many.get(length, 1))], np.int64) for length in counts}
    shared = spark.sparkContext.broadcast((first, plan(counts, capacity)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, found = shared.value
        for batch in batches:
            length, rank_ = batch["length"].to_numpy(), batch[rank].to_numpy() - 1
            groups_ = batch[group].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for k in np.unique(length):
                own = length == k
                place = first[k][groups_[own]] + rank_[own]
                at = np.searchsorted(found.first[k], place, "right") - 1
                sequence[own] = found.sequence[k][at] + place - found.first[k][at]
                offset[own] = found.offset[k][at]
            out = batch.drop(columns=[group, rank])
            out["sequence_id"], out["offset"] = sequence, offset
            yield out

    ranks = salted.withColumn(rank, F.row_number().over(Window.partitionBy("length", group).orderBy(number)))
    own = ranks.select(F.col(f"`{id_col}`").cast("string").alias(ident), "piece", "start", "length", "ids_crc32", group, rank)
    made = own.mapInPandas(placed, f"{ident} string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return made.select(F.col(ident).cast(docs.schema[id_col].dataType).alias(id_col), *made.columns[1:])
