"""Documents that were seen on an earlier day: exact, with Bloom filters that rule out most of history before it is read.

History holds the ids of each day in buckets of their hash, and for each day and bucket a filter. A filter is cut into blocks of 256 bits, and an id
sets eight of one block, one in each 32: so a filter is rows of a block and its four words, made by bit_or, which Spark sums up in parts, and
asking the filters of all days is one join by bucket and block. What they do not rule out is read and compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions

#: Buckets of a day, and blocks of a filter, which so is 1 MB at most. A block holds 13 ids at an error of some 0.1 %, a day thus 27 million; more ids
#: are more errors, which are read and compared, and never another result.
BUCKETS, BLOCKS = 64, 1 << 15
WORDS = ["w0", "w1", "w2", "w3"]


def _hashed(ids: DataFrame, buckets: int, blocks: int) -> DataFrame:
    """ids (id) with bucket, block and the id's bits of each word."""
    place, bits = F.xxhash64("id"), F.xxhash64(F.lit("bits"), "id")
    bit: Callable[[int], Column] = lambda k: F.shiftrightunsigned(bits, 5 * k).bitwiseAND(31).cast("int")
    one: Callable[[Column], Column] = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), c)
    words = {w: one(bit(2 * k)).bitwiseOR(one(bit(2 * k + 1) + 32)) for k, w in enumerate(WORDS)}
    return ids.withColumns({"bucket": F.pmod(place, F.lit(buckets)).cast("int"), "block": F.pmod(F.shiftrightunsigned(place, 16), F.lit(blocks)).cast("int"), **words})


def add(rows: DataFrame, root: str, *, id_col: str = "document_id", day: str = "submission_date", buckets: int = BUCKETS, blocks: int = BLOCKS) -> None:
    """Takes the ids of rows into the history under root, a partition for each of their days; a day that is there already is replaced.

    buckets and blocks are those of the whole history. Rows without an id or a day take no part. A day is in history once its filters are, which
    are published last; one that failed before can be added again.
    """
    own = rows.select(F.col(id_col).cast("string").alias("id"), F.col(day).cast("date").alias("day")).where("id is not null and day is not null").distinct()
    hashed = _hashed(own, buckets, blocks)
    put = versions.publish(hashed.select("id", "day", "bucket").hint("rebalance", "day", "bucket"), f"{root}/ids", by=["day"], within=["bucket"])
    written = versions.read(rows.sparkSession, f"{root}/ids", of=put, parts=_days(own))
    filters = _hashed(written.select("id", "day"), buckets, blocks).groupBy("day", "bucket", "block").agg(*[F.bit_or(w).alias(w) for w in WORDS])
    versions.publish(filters.hint("rebalance", "day"), f"{root}/filters", by=["day"])


def _days(own: DataFrame) -> list[str]:
    """The partitions of rows (day): a row for each day."""
    return [f"day={r.day}" for r in own.select("day").distinct().collect()]


@dataclass
class Seen:
    """rows: (id, first_day, days) of each id that history has. Of so many partitions of history, by day and bucket, so many were read."""

    rows: DataFrame
    partitions: int
    read: int


def seen(rows: DataFrame, root: str, *, id_col: str = "document_id", buckets: int = BUCKETS, blocks: int = BLOCKS) -> Seen:
    """Which ids of rows the history under root has: exact.

    Rows are reduced to distinct ids, which meet the filters of all days by bucket and block; both are spread by the hash of ids, so no id or day is one
    task's work. Where a filter has all bits of an id, its partition is read, and only such pairs of id and day are compared. They are
    written under root once. The driver gets a row for each partition that is to be read: days times buckets at most.
    """
    spark: SparkSession = rows.sparkSession
    if not versions.versions(spark, f"{root}/filters"):
        return Seen(spark.createDataFrame([], "id string, first_day date, days long"), 0, 0)
    new = _hashed(rows.select(F.col(id_col).cast("string").alias("id")).where("id is not null").distinct(), buckets, blocks)
    of = versions.version(spark, f"{root}/filters")
    filters = versions.read(spark, f"{root}/filters", of=of).withColumnsRenamed({w: f"f_{w}" for w in WORDS})
    has = [F.col(f"f_{w}").bitwiseAND(F.col(w)) == F.col(w) for w in WORDS]
    path = f"{root}/candidates/{uuid.uuid4().hex}"
    new.join(filters, ["bucket", "block"]).where(reduce(Column.__and__, has)).select("id", "day", "bucket").write.parquet(path)
    maybe = spark.read.schema("id string, day date, bucket int").parquet(path)
    wanted = maybe.groupBy("day").agg(F.collect_set("bucket").alias("buckets")).collect()  # a row for each day, of all buckets at most
    ids = versions.read(spark, f"{root}/ids", parts=[f"day={r.day}" for r in wanted])
    if wanted:
        ids = ids.where(reduce(Column.__or__, [(F.col("day") == F.lit(r.day)) & F.col("bucket").isin(r.buckets) for r in wanted]))
    met = ids.join(maybe, ["id", "day", "bucket"], "left_semi")
    found = met.groupBy("id").agg(F.min("day").alias("first_day"), F.count(F.lit(1)).alias("days"))
    return Seen(found, len(of.parts) * buckets, sum(len(r.buckets) for r in wanted))


def unseen(rows: DataFrame, root: str, *, id_col: str = "document_id", buckets: int = BUCKETS, blocks: int = BLOCKS) -> DataFrame:
    """The rows whose id history does not have, those without an id too: what a micro-batch keeps in foreachBatch."""
    known = seen(rows, root, id_col=id_col, buckets=buckets, blocks=blocks).rows
    return rows.join(known, F.col(id_col).cast("string") == known["id"], "left_anti")


def repeats(rows: DataFrame, root: str, *, buckets: int = BUCKETS, blocks: int = BLOCKS) -> DataFrame:
    """Per day and channel the rows that repeat a document of history, and the clients that sent one."""
    known = seen(rows, root, buckets=buckets, blocks=blocks).rows
    again = rows.join(known, F.col("document_id").cast("string") == known["id"], "left_semi")
    return again.groupBy(F.to_date("ts").alias("day"), "channel").agg(F.count(F.lit(1)).alias("duplicates"), F.count_distinct("client_id").alias("clients"))
