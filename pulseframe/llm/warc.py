"""WARC archives with a two-level capture index.

Archives, index shards and directories are files in the shared folder, written and range-read through
pyarrow's file systems, or what open_folder is set to; what goes through Spark is a row of places for each record.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined, scratch, small_batches, written

#: Payloads of fewer bytes are never revisits.
LEAST = 100
#: Lines of an index block, and bytes after which a task starts another archive.
BLOCK, ROLL = 256, 1 << 30
#: Most archives and index blocks that a task keeps at hand.
OPEN = 8
#: Bytes of archives, and rows of an index, that a task reads: more tasks than shuffle partitions where there is more.
READ_BYTES, READ_ROWS = 256 << 20, 2_000_000
#: A task is not worth its start for less.
LEAST_BYTES, LEAST_ROWS = 2 << 20, 4_096

PLACE = "key string, page_id long, file string, offset long, length long"
_URL = re.compile(r"^([a-zA-Z][\w+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)", re.S)


def _files(uri: str):
    """The file system of a folder and the folder's path there. Hadoop's names of S3 are pyarrow's `s3`; pyarrow finds credentials where its
    clients do (environment or role), not in Spark's settings. For stores that pyarrow does not know, set open_folder."""
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    if scheme in ("s3a", "s3n"):
        uri = f"s3://{rest}"
    elif rest and scheme not in ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss"):
        raise ValueError(f"pyarrow has no file system for {scheme}://; set pulseframe.llm.warc.open_folder")
    return fs.FileSystem.from_uri(uri)


#: (uri) -> (a pyarrow file system, the path there). It is called in tasks, so it must be a function that pickles.
open_folder = _files


def url_key(url: str | None) -> str:
    """The URL with its host reversed and without scheme and fragment; line breaks, tabs and spaces are escaped."""
    m = _URL.match(url or "")
    key = ",".join(reversed(m[2].lower().split("."))) + (m[3] or "") + ")" + (m[4] or "/") if m else (url or "")
    return re.sub(r"[\s\x00-\x1f]", lambda c: f"%{ord(c[0]):02X}", key)


def capture_key(url: str | None, page_id: int | None) -> str:
    """The key of a capture: captures of one URL differ, so that a popular one is dealt to many blocks."""
    return f"{url_key(url)} {'-' if page_id is None else format(page_id, '020d')}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None, revisit: bool) -> bytes:
    """A WARC record, compressed on its own. The HTTP headers of a revisit are those of the response; its payload is not there."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:capture:{page_id}>", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {re.sub(r'[\r\n]', '', url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:capture:{response}>"]
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Rows as a frame whose ids are whole numbers or null; pandas would make floats of them, which are exact only up to 2**53."""
    data = dict(zip(columns, zip(*rows, strict=True), strict=True)) if rows else {c: [] for c in columns}
    return pd.DataFrame({c: pd.array(v, dtype="Int64") if c in ("page_id", "refers_to") else list(v) for c, v in data.items()})


@dataclass
class Read:
    page_id: int | None
    kind: str
    digest: str
    refers_to: int | None
    n_bytes: int
    payload: bytes | None


def parse(data: bytes) -> Read:
    raw = gzip.decompress(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    number = lambda x: None if x == "None" else int(x)
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and len(payload) != n:
        raise ValueError("a payload of another length")
    refers = number(fields["WARC-Refers-To"][13:-1]) if revisit else None
    return Read(number(fields["WARC-Record-ID"][13:-1]), fields["WARC-Type"], fields["WARC-Payload-Digest"][7:], refers, n, None if revisit else payload)


def _tasks(df: DataFrame, size: int, least: int, most: int) -> int:
    """To how many tasks size bytes or rows are dealt: to the session's shuffle partitions, to fewer of at least `least` where there is little,
    to more of `most` where there is much."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, size // least), -(-size // most))


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, url, html) -> the same with digest and response, the smallest page_id with an equal payload
    of least bytes or more where there are several, else null.

    Only digests meet; the list of payloads that occur more than once is written, and the join leaves the
    html where it is when that list is small, and that of frequent payloads always.
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    marked = own.withColumn("digest", F.sha2("html", 256))
    several = marked.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("response"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return joined(marked, written(several, "several"), "digest", "left")


def write_archives(plan: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Writes the records of planned() to gzip archives in folder -> their places. Each task writes files of its own, under
    names that no other attempt uses, so a task that runs again leaves at most files that no place names."""

    opener = open_folder

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opener(folder)
        files.create_dir(base, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, digest, response in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "response")), strict=True):
                page_id, response = (None if pd.isna(x) else int(x) for x in (page_id, response))
                url = None if pd.isna(url) else url
                data = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, response, response is not None and response != page_id)
                if out is None or offset >= roll:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                out.write(data)
                rows.append((capture_key(url, page_id), page_id, name, offset, len(data)))
                offset += len(data)
            yield _frame(rows, ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    # Integers with nulls reach pandas as floats: ids go as text.
    text = plan.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest", F.col("response").cast("string").alias("response"))
    return text.mapInPandas(write, PLACE)


def write_index(places: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Sorts places by key into shards of compressed blocks, each shard with a sparse directory of its blocks' first
    keys behind them -> (first, file, offset, length), a row for each shard: where its directory is. places should be a written table."""

    opener = open_folder

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opener(folder)
        files.create_dir(base, recursive=True)
        out, name, offset, lines, directory = None, "", 0, [], []

        def flush() -> None:
            nonlocal offset, lines
            data = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"))
            directory.append(f"{lines[0].partition('\t')[0]}\t{offset}\t{len(data)}")
            out.write(data)
            offset += len(data)
            lines = []

        for batch in batches:
            for key, page_id, file, at, length in zip(*(batch[c] for c in ("key", "page_id", "file", "offset", "length")), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.index"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(f"{key}\t{'' if pd.isna(page_id) else page_id}\t{file}\t{at}\t{length}")
                if len(lines) == block:
                    flush()
        if out is not None:
            if lines:
                flush()
            data = zlib.compress("\n".join(directory).encode("utf-8", "surrogatepass"))
            out.write(data)
            out.close()
            yield pd.DataFrame([(directory[0].partition("\t")[0], name, offset, len(data))], columns=["first", "file", "offset", "length"])

    text = places.withColumn("page_id", F.col("page_id").cast("string"))
    tasks = _tasks(places, places.count(), LEAST_ROWS, READ_ROWS)
    return text.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInPandas(write, "first string, file string, offset long, length long")


class _Ranges:
    """Range reads from the files of a folder, a few of them open at a time."""

    def __init__(self, folder: str, opener: Callable) -> None:
        self.files, self.base = opener(folder)
        self.open: dict[str, object] = {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= OPEN:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.files.open_input_file(f"{self.base}/{name}")
        file = self.open[name]
        file.seek(offset)
        return file.read(length)


def lookup(keys: DataFrame, shards: list[tuple[str, str, int, int]], folder: str) -> DataFrame:
    """keys (key) -> the places of all captures with one of them.

    shards: the rows of write_index() in order of their first keys, one for each partition it wrote. A key's shard is found by binary
    search over these, its block by binary search over the shard's directory, and only that block is read. Keys are
    sorted first, so that a directory and a block are read once for all keys in them.
    """
    shards, opener = sorted(tuple(s) for s in shards), open_folder

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges, firsts = _Ranges(folder, opener), [s[0] for s in shards]
        directories: dict[int, list[tuple[str, int, int]]] = {}
        blocks: dict[tuple[int, int], list[list[str]]] = {}

        def directory(s: int) -> list[tuple[str, int, int]]:
            if s not in directories:
                directories.clear()
                raw = zlib.decompress(ranges.read(*shards[s][1:])).decode("utf-8", "surrogatepass").split("\n")
                directories[s] = [(k, int(a), int(n)) for k, a, n in (x.split("\t") for x in raw)]
            return directories[s]

        def lines(s: int, b: int) -> list[list[str]]:
            if (s, b) not in blocks:
                if len(blocks) >= OPEN:
                    blocks.pop(next(iter(blocks)))
                _, offset, length = directory(s)[b]
                blocks[s, b] = [x.split("\t") for x in zlib.decompress(ranges.read(shards[s][1], offset, length)).decode("utf-8", "surrogatepass").split("\n")]
            return blocks[s, b]

        for batch in batches:
            rows = []
            for key in batch["key"]:
                # Equal keys are in one shard, the last that starts at or before them.
                if (s := bisect_right(firsts, key) - 1) < 0:
                    continue
                own = directory(s)
                b = max(0, bisect_left(own, key, key=lambda x: x[0]) - 1)
                while b < len(own) and own[b][0] <= key:
                    some = lines(s, b)
                    at = bisect_left(some, key, key=lambda x: x[0])
                    while at < len(some) and some[at][0] == key:
                        rows.append((key, int(some[at][1]) if some[at][1] else None, some[at][2], int(some[at][3]), int(some[at][4])))
                        at += 1
                    b += 1
            yield _frame(rows, ["key", "page_id", "file", "offset", "length"])

    wanted = keys.select("key").distinct()
    tasks = _tasks(keys, keys.count(), LEAST_ROWS, READ_ROWS)
    return wanted.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInPandas(find, PLACE)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(places: DataFrame, folder: str, *, with_payload: bool = False) -> DataFrame:
    """Range-reads records by place, in the order of the files -> page_id, payload_bytes, payload_digest, record_type,
    refers_to, and on demand payload (null for revisits). A payload that does not match its digest is an error.

    places should be a written table: its bytes say to how many tasks the records are dealt."""
    opener = open_folder

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges = _Ranges(folder, opener)
        for batch in batches:
            rows = []
            for name, offset, length in zip(batch["file"], batch["offset"], batch["length"], strict=True):
                r = parse(ranges.read(name, int(offset), int(length)))
                if r.payload is not None and hashlib.sha256(r.payload).hexdigest() != r.digest:
                    raise ValueError(f"{name} at {offset}: the payload does not match its digest")
                rows.append((r.page_id, r.n_bytes, r.digest, r.kind, r.refers_to, *([r.payload] if with_payload else [])))
            yield _frame(rows, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if with_payload else [])])

    size = places.agg(F.sum("length")).first()[0] or 0
    ordered = places.select("file", "offset", "length").repartitionByRange(_tasks(places, size, LEAST_BYTES, READ_BYTES), "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInPandas(read, READ + (", payload binary" if with_payload else ""))


def key_of(url: Column, page_id: Column) -> Column:
    def keys(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for urls, ids in batches:
            yield pd.Series([capture_key(u, None if i is None else int(i)) for u, i in zip(urls, ids, strict=True)], dtype=object)

    return F.pandas_udf(keys, "string")(url, page_id.cast("string"))


def archive(pages: DataFrame, *, roll: int = ROLL, block: int = BLOCK, least: int = LEAST) -> tuple[str, list[tuple[str, str, int, int]]]:
    """Writes archives and index of pages -> the folder and the index's shards."""
    folder = scratch(pages.sparkSession, "warc")
    places = written(write_archives(planned(small_batches(pages), least), folder, roll), "places")
    shards = written(write_index(places, folder, block), "shards").collect()  # a row for each range of the index
    return folder, [tuple(s) for s in shards]


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archives pages (page_id, url, html) and reads every capture back through the index: a row for each row.

    Null html is an empty payload; payloads of fewer than least bytes are all responses, of others the rows with the smallest page_id
    are responses and the rest revisit them. Rows repeated with one page_id and payload are records of their own and
    of one kind; a null page_id is a revisit where another row has the payload, and other columns are not looked at.
    """
    folder, shards = archive(pages, **options)
    keys = pages.select(key_of(F.col("url"), F.col("page_id")).alias("key"))
    return read_records(written(lookup(keys, shards, folder), "found"), folder)
