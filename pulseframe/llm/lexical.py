"""Ranked lexical search over classes of documents that no item can tell apart."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

#: Items are searched for in blocks of about so many terms, repeats included, so that a worker's vocabulary is bounded.
BLOCK_TERMS = 200_000
#: Products of terms and items that are worked out at once.
AT_ONCE = 2_000_000
#: Null ids come after all others.
LAST = 2**63 - 1
#: Bytes of UTF-8 that are in no term become spaces, A-Z lose their case.
_KEPT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and all other characters from 128 on; null has none."""
    return text.translate(_KEPT).split() if text else []


def _vectors(words: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column("t"):
                found = terms(text.as_py())
                counts = Counter(found)
                held = sorted((words[w], counts[w]) for w in counts.keys() & words.keys())
                n.append(len(found))
                ids.append([k for k, _ in held])
                tfs.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(n, pa.int64()), pa.array(ids, ints), pa.array(tfs, ints)], ["i", "n", "ids", "tfs"])

    return run


class Postings:
    """For each term its weight and the items that hold it, with their numbers of it."""

    def __init__(self, items: list[Counter], words: dict[bytes, int], weights: np.ndarray):
        per: list[list[tuple[int, int]]] = [[] for _ in words]
        for k, counts in enumerate(items):
            for w, n in counts.items():
                per[words[w]].append((k, n))
        self.start = np.cumsum([0, *map(len, per)])
        self.item = np.array([k for x in per for k, _ in x], dtype=np.int64)
        self.gain = np.array([n for x in per for _, n in x], dtype=np.int64) * np.repeat(weights, np.diff(self.start))
        self.items = len(items)

    def scores(self, ids: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray) -> np.ndarray:
        """classes x items, in 64-bit integers."""
        out = np.zeros(len(ids) * self.items, dtype=np.int64)
        size = np.array([len(x) for x in ids])
        term, tf = np.concatenate(ids).astype(np.int64), np.concatenate(tfs).astype(np.int64)
        row = np.repeat(np.arange(len(ids)), size)
        share = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
        n = self.start[term + 1] - self.start[term]
        ends = np.cumsum(n)
        cuts = np.searchsorted(ends, np.arange(AT_ONCE, ends[-1] + AT_ONCE, AT_ONCE), side="right") if len(ends) else []
        a = 0
        for b in sorted({*map(int, cuts), len(term)}):
            if b > a:
                c = n[a:b]
                at = np.repeat(self.start[term[a:b]] - np.cumsum(c) + c, c) + np.arange(c.sum())
                np.add.at(out, np.repeat(row[a:b] * self.items, c) + self.item[at], np.repeat(share[a:b], c) * self.gain[at])
                a = b
        return out.reshape(len(ids), self.items)


def _best(postings: Postings, k: int):
    """Of the classes of a task the k best of each item, by score and then by smallest id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = np.zeros((0, postings.items), dtype=np.int64), np.zeros((0, postings.items), dtype=np.int64), np.zeros((0, postings.items), dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            score = postings.scores(list(batch["ids"]), list(batch["tfs"]), batch["m"].to_numpy(np.int64))
            wide = lambda c: np.repeat(c.to_numpy(np.int64)[:, None], postings.items, axis=1)
            own = score, wide(batch["least"]), wide(batch["class"])
            score, least, name = (np.concatenate(x) for x in zip(top, own, strict=True))
            order = np.lexsort((name, least, -score), axis=0)[:k]
            top = tuple(np.take_along_axis(x, order, axis=0) for x in (score, least, name))
        score, least, name = top
        at, item = np.nonzero(score)
        yield pd.DataFrame({"item": item, "score": score[at, item], "least": least[at, item], "class": name[at, item]})

    return run


def _search(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """One block of items (item_id, text as bytes)."""
    spark = docs.sparkSession
    counts = [Counter(terms(text)) for _, text in items]
    words = {w: j for j, w in enumerate(sorted(set().union(*counts)))}
    vectors = docs.mapInArrow(_vectors(words), "i long, n long, ids array<int>, tfs array<int>")
    vectors = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    every, length = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    # No more rows than the block has terms.
    held = dict(vectors.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1))).collect())
    weights = np.array([math.floor(1000 * math.log((2 * every + 2) / (2 * held.get(j, 0) + 1))) for j in range(len(words))], dtype=np.int64)

    sized = vectors.where("size(ids) > 0").withColumn("m", F.expr(f"75 + (25 * n * {every}L) div {length or 1}L"))
    same = Window.partitionBy("hash", "m", "ids", "tfs").orderBy(F.col("i").asc_nulls_last(), "row")
    members = sized.withColumn("hash", F.xxhash64("ids", "tfs", "m")).withColumn("place", F.row_number().over(same)).withColumn("class", F.first("row").over(same)).where(f"place <= {k}")
    lone = F.col("place") == 1
    members = written(members.select("class", "i", "row", "place", "m", F.when(lone, F.col("ids")).alias("ids"), F.when(lone, F.col("tfs")).alias("tfs")), "members")

    classes = small_batches(members.where(lone).select("class", F.coalesce("i", F.lit(LAST)).alias("least"), "m", "ids", "tfs"))
    partial = classes.mapInPandas(_best(Postings(counts, words, weights), k), "item int, score long, least long, class long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), "least", "class"))
    top = F.broadcast(partial.withColumn("rank", rank).where(f"rank <= {k}").select("item", "score", "class"))  # k rows for each item of the block
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("i").asc_nulls_last(), "row")
    found = members.select("class", "i", "row").join(top, "class").withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
    names = spark.createDataFrame([(j, name) for j, (name, _) in enumerate(items)], "item int, item_id long")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", F.col("i").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, *, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The k best documents of each item: (item_id, rank, doc_id, score).

    Documents are cut down to the items' vocabulary. Those whose term counts and length number m are the same have the same score for every item, so
    they are a class: rows are dealt by a hash of both and compared in full by the window's key. Each class is scored once, by its first
    document. Of the classes, the k best by score and smallest id hold the k best documents: each class before a document's own has a document
    before it. These classes are expanded to their k smallest ids. Tasks keep k classes of each item, so what is shuffled is their
    number times the items of a block. Items come in blocks of about block_terms terms, one search after the other, so
    neither the driver nor a worker holds more than a block's vocabulary.

    Scores: see the README. Only scores above 0 count. Null and empty texts have no terms: such documents are in no result and not counted, such items
    get no rows. Ids are integers. Of equal scores the smaller id comes first, null ids last. Repeated rows of docs are documents of their own, repeated
    items get their list each. Texts of any length are read whole; empty tables give no rows; other columns, of any name, do not matter.
    """
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    asked = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("binary").alias("t")).where("octet_length(t) > 0")
    # Two bytes a term at least.
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // (2 * block_terms)))
    block = F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks))
    results = []
    for b in range(blocks):
        part = [tuple(r) for r in asked.where(block == b).select("item_id", "t").collect()]
        if part:
            results.append(_search(small_batches(own), [(name, bytes(t)) for name, t in part], k))
    if not results:
        return asked.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
