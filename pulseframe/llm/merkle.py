"""A Merkle manifest of a data set: leaves, roots, proofs and their verification, by windows with fixed offsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written

#: Children of a node.
FAN_OUT = 16
#: A window's partition holds so many whole runs of one group, so that no group is one task.
RUNS = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(values: list[Column]) -> Column:
    """The digest of a row: each value is `-` if null, else the bytes of its text, a colon and its text."""
    texts = [v.cast("string") for v in values]
    return _h(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with a column `key`, not null -> pos, the place of each row among those of its key from 0, and n, their number.

    Rows are dealt to ranges of (key, order), so that a key with many rows is in many of them; each counts what it has, and a row for
    each key and range carries the counts on.
    """
    by = [F.col("key").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = written(rows.repartitionByRange(*by).withColumn("range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("key", "range").agg(F.count(F.lit(1)).alias("own"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "range", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("first"), F.sum("own").over(Window.partitionBy("key")).alias("n"))
    within = F.row_number().over(Window.partitionBy("key", "range").orderBy(*by[1:])) - 1
    return dealt.withColumn("within", within).join(counts, ["key", "range"]).withColumn("pos", F.col("first") + F.col("within")).drop("range", "within", "first")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """nodes (key, pos, n, hash) -> with before and after: the digests of the node's run, without its own, that stand left and right of it.

    A column for each lag and lead up to the run's length, of which those count that its slot and its run's length allow. A window's partition
    begins at a run's begin and holds RUNS runs at most.
    """
    w = Window.partitionBy("key", F.floor(F.col("pos") / (FAN_OUT * RUNS)).alias("block")).orderBy("pos")
    slot = F.pmod(F.col("pos"), F.lit(FAN_OUT))
    length = F.least(F.lit(FAN_OUT), F.col("n") - (F.col("pos") - slot))
    lags = [F.when(slot >= k, F.lag("hash", k).over(w)).otherwise("") for k in range(FAN_OUT - 1, 0, -1)]
    leads = [F.when(slot + k < length, F.lead("hash", k).over(w)).otherwise("") for k in range(1, FAN_OUT)]
    return nodes.select("*", F.concat(*lags).alias("before"), F.concat(*leads).alias("after"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The first child of each run hashes its parent; keys with one node have no parents."""
    first = with_siblings(nodes).where(f"n > 1 and pos % {FAN_OUT} = 0")
    up = lambda c: F.floor(F.col(c) / FAN_OUT)
    return first.select("key", up("pos").alias("pos"), F.ceil(F.col("n") / FAN_OUT).alias("n"), _h(F.col("hash"), F.col("after")).alias("hash"))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The nodes (key, pos, n, hash) of each level from the leaves up, until each key has one; a level has a 16th of the rows below it."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(written(_parents(levels[-1].select("key", "pos", "n", "hash")), "level"))
        most = -(-most // FAN_OUT)
    return levels


_NONE = "cast(array() as array<struct<before: string, after: string>>)"


def _path(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """nodes with path: their siblings and those of all nodes above them. above (key, pos, path, top, root) has their parents, and for keys
    whose only node this is what stands above that."""
    own = F.when(F.col("n") > 1, F.array(F.struct("before", "after"))).otherwise(F.expr(_NONE))
    up = above.select("key", F.col("pos").alias("up"), F.col("path").alias("rest"), "top", "root")
    met = with_siblings(nodes).withColumn("up", F.floor(F.col("pos") / FAN_OUT)).join(up, ["key", "up"])
    return met.withColumn("path", F.concat(own, F.col("rest"))).drop("up", "rest", "before", "after")


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest level with path, top and root. tops (key, path, top, root): what stands above each key's last node."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        ended = levels[k].where("n = 1").select("key").join(tops, "key").select("key", F.lit(0).cast("long").alias("pos"), "path", "top", "root")
        above = _path(levels[k], ended if above is None else above.select("key", "pos", "path", "top", "root").unionByName(ended))
        above = written(above, "paths") if k else above
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path give."""
    return F.aggregate(path, digest, lambda d, x: _h(x["before"], d, x["after"]))


def manifest(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, also: dict[str, Column] | None = None) -> DataFrame:
    """docs -> (id_col, leaf, subroot, root, path), a row for each row.

    Per group, leaves ascend by id; every 16 consecutive nodes are hashed to one of the next level until one is left, the
    subroot; subroots, ordered by group, are hashed likewise to the root. path is an array of (before, after), the digests left and right of the
    row's node in its run, level by level up to the root; a level without a run, as a lone leaf has, is none.

    Only ids, groups and digests are shuffled, never texts. No group, however large, is one task: ranges and blocks of runs cut it.
    Null ids come first and a null group is a group of its own, before all others; an empty text and a null one are different leaves, and texts of
    any length are hashed whole. Rows that share an id are ordered by their leaves; repeated rows are leaves of their own. An empty table gives no
    rows. Other columns of docs, of any name, do not matter. also: further columns, expressions over docs.
    """
    col = lambda name: F.col(f"`{name}`")
    extra = also or {}
    key = F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit("-"))  # "-" is before "="
    rows = docs.select(col(id_col).alias("i"), key.alias("key"), leaf([col(f) for f in fields]).alias("hash"), *[c.alias(f"also_{k}") for k, c in extra.items()])
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    levels = _levels(written(placed(rows, ["i", "hash", "row"]), "placed"))

    ends = reduce(DataFrame.unionByName, [x.where("n = 1").select("key", "hash") for x in levels])
    subroots = written(placed(ends.select(F.lit("").alias("key"), F.col("key").alias("group"), "hash"), ["group"]), "subroots")
    upper = _levels(subroots)
    root = upper[-1].where("n = 1").select("key", F.expr(_NONE).alias("path"), F.col("hash").alias("root"), F.lit(None).cast("string").alias("top"))
    tops = _paths(upper, root).select(F.col("group").alias("key"), "path", F.col("hash").alias("top"), "root")
    found = _paths(levels, written(tops, "tops"))
    return found.select(F.col("i").alias(id_col), F.col("hash").alias("leaf"), F.col("top").alias("subroot"), "root", "path", *[F.col(f"also_{k}").alias(k) for k in extra])


def tampered(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fields: tuple[str, ...] = FIELDS) -> Column:
    """The leaf of a row whose text lost its capitals A-Z, where 5 divides the CRC-32 of its id; the row's own leaf otherwise."""
    col = lambda name: F.col(f"`{name}`")
    chosen = F.crc32(col(id_col).cast("string").cast("binary")) % 5 == 0
    changed = F.when(col(text_col).isNotNull(), ascii_lower(col(text_col)))
    return F.when(chosen, leaf([changed if f == text_col else col(f) for f in fields])).otherwise(leaf([col(f) for f in fields]))


def verified(docs: DataFrame, **names) -> DataFrame:
    """docs -> (id_col, leaf, subroot, root, proof_sha256, folded_root, verified): the manifest, and the check of each row, of which some were
    tampered with, against it. See manifest for odd rows; a row with a null id is not tampered with."""
    found = manifest(docs, also={"given": tampered(docs)}, **names)
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["before"], x["after"])), ""), 256)
    folded = fold(F.col("given"), F.col("path"))
    return found.select(*[c for c in found.columns if c not in ("path", "given")], proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
