"""Helpers that the corpus operators share: table reading and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder name under the folder that the cluster shares.

    That folder is ``spark.checkpoint.dir``; only where it is unset in a local session a
    temporary one is made and remembered in the session. Elsewhere executors would not share it, which is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: executors do not share a machine's folders")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read again: a cut in the lineage
    that outlives lost executors."""
    path = scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch of whole texts, where the session has Spark's default of 10,000.
BATCH = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """df, with its session's Arrow batches small enough for rows of whole texts: a Python worker holds a batch several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key) == "10000":
        df.sparkSession.conf.set(key, str(BATCH))
    return df


#: A key is hot if it holds more than such a part of all rows, so that there are fewer hot keys than this.
MOST_HOT = 1_000


def joined(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """left with the columns of right by key, which left never has null; no task gets more than its part of a hot key.

    right has one row for each key and says in its column `rows` how many rows left has with it; as it is read more than once,
    it should be a written table. Rows of right with hot keys are broadcast: there are fewer than MOST_HOT. The others are joined as usual.
    """
    every, most = right.agg(F.sum("rows"), F.max("rows")).first()
    if (most or 0) * MOST_HOT <= (every or 0):
        return left.join(right.drop("rows"), key, how)
    large = F.col("rows") * MOST_HOT > every
    hot, rest = F.broadcast(right.where(large).drop("rows")), right.where(~large).drop("rows")
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(rest, key, how))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty. Pure-ASCII texts take the fast built-in."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not use, so that an operator's columns never clash with the caller's."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name
