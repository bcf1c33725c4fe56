"""Data volume by channel, day and document type, and alerts on budgets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N


def newest_days(df: DataFrame, keys: list[str], day: str, n: int) -> DataFrame:
    """The rows of each key's n newest days."""
    days = df.select(*keys, day).distinct()
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc(day)))
    return df.join(days.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank"), [*keys, day], "left_semi")


def size_by_channel_day(sizes: DataFrame, newest: int = 60) -> DataFrame:
    """Payload sizes (channel, doc_type, submission_date, build, size) -> count and bytes by kind of date (submission
    or build), channel, day and type of document, for each channel's newest days. Builds without a date are skipped."""
    kinds = F.array(F.struct(F.lit("submission").alias("kind"), F.col("submission_date").alias("day")), F.struct(F.lit("build").alias("kind"), F.try_to_timestamp(N.build_date(F.col("build")), F.lit("yyyyMMdd")).cast("date").alias("day")))
    rows = sizes.select("channel", N.doc_type3(F.col("doc_type")).alias("doc_type"), "size", F.explode(kinds).alias("k")).where("k.day is not null")
    sums = rows.groupBy("k.kind", "channel", "k.day", "doc_type").agg(F.count(F.lit(1)).alias("count"), F.sum("size").alias("size"))
    rank = F.dense_rank().over(Window.partitionBy("kind", "channel").orderBy(F.desc("day")))  # over sums: a row per day and type
    return sums.withColumn("_rank", rank).where(F.col("_rank") <= newest).drop("_rank")


def budget_alerts(sums: DataFrame, targets: DataFrame, day: date) -> DataFrame:
    """Targets (channel, doc_type, clients, size, count) that a day's bytes exceed, with the alert's text, sorted."""
    own = sums.where((F.col("kind") == "submission") & (F.col("day") == F.lit(day))).select("channel", "doc_type", F.col("size").alias("actual"))
    goal = targets.select("channel", "doc_type", (F.col("size") * F.col("count") * F.col("clients")).alias("expected"))
    over = own.join(goal, ["channel", "doc_type"]).where("actual > expected")
    text = F.format_string("Channel %s, Type %s: Actual %s > Expected %s (%s)", "channel", "doc_type", N.gigabytes(F.col("actual")), N.gigabytes(F.col("expected")), N.percent(F.col("actual"), F.col("expected")))
    return over.withColumn("alert", text).orderBy("alert")
