"""Stability roll-ups: session and crash counters by build, system, place and experiment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from .derive import COUNTERS

DIMS = ["build_version", "build_id", "build_architecture", "channel", "os", "os_version", "os_servicepack_major", "os_servicepack_minor", "locale", "active_experiment_id", "active_experiment_branch", "country"]
SUMS = list(COUNTERS)
#: Days after an activity day in which its submissions are still awaited.
LATENCY = 10


def _submitted(df: DataFrame, day: date, before: int = 1, yesterday: date | None = None) -> DataFrame:
    """Submissions that can hold a day's activity. Days outside are not read."""
    last = min(day + timedelta(LATENCY - 1), yesterday or date.max)
    return df.where(F.col("submission_date").between(F.lit(day - timedelta(before)), F.lit(last)))


def _aborted() -> Column:
    return F.when(F.col("reason") == "aborted-session", 1).otherwise(0)


def main_counts(mains: DataFrame, keys: list[str]) -> DataFrame:
    sums = [F.sum(_aborted()).alias("aborted_session_count"), F.sum(N.clamp_session(F.col("subsession_length"))).alias("subsession_lengths"), *[F.sum(c).alias(c) for c in SUMS]]
    return mains.groupBy(*keys).agg(*sums)


def stability_main(mains: DataFrame, day: date, yesterday: date | None = None) -> DataFrame:
    """15 sums by 12 dimensions over one day's activity."""
    return main_counts(_submitted(mains, day, yesterday=yesterday).where(F.col("subsession_date") == F.lit(day)), DIMS)


def stability_actives(mains: DataFrame, day: date, *, weekly: bool = False, yesterday: date | None = None) -> DataFrame:
    """Users by the dimensions of their newest row and the number of days they were active on, of a day or the week that ends with it."""
    first = day - timedelta(6 if weekly else 0)
    own = _submitted(mains, day, 8 if weekly else 1, yesterday).where(F.col("subsession_date").between(F.lit(first), F.lit(day)) & F.col("client_id").isNotNull())
    keys = [d for d in DIMS if d != "build_id"]
    per = own.groupBy("client_id").agg(F.max_by(F.struct(*keys), F.struct("subsession_date", "timestamp", "event_id")).alias("r"), F.count_distinct("subsession_date").alias("active_days"))
    return per.groupBy(*[F.col(f"r.{k}").alias(k) for k in keys], "active_days").agg(F.count(F.lit(1)).alias("active_users"))


def active_day_rank(mains: DataFrame) -> DataFrame:
    """Each row with the number of its day among the client's days, by dense rank."""
    return mains.withColumn("active_day", F.dense_rank().over(Window.partitionBy("client_id").orderBy("subsession_date")))


def crash_counts(crashes: DataFrame, keys: list[str]) -> DataFrame:
    return crashes.groupBy(*keys).agg(F.count(F.lit(1)).alias("crashes"))


def stability_crashes(crashes: DataFrame, day: date, yesterday: date | None = None) -> DataFrame:
    """Crashes of one day by 13 keys."""
    return crash_counts(_submitted(crashes, day, yesterday=yesterday).where(F.col("crash_date") == F.lit(day)), [*DIMS, "has_crash_environment"])


def usage_aggregate(mains: DataFrame, crashes: DataFrame, days: tuple[date, date]) -> DataFrame:
    """Sessions and crashes in one table: 16 sums by submission day, activity day and dimensions. A crash is a row of zeros and one main crash."""
    own = lambda df: df.where(F.col("submission_date").between(*map(F.lit, days)))
    zero = F.lit(0)
    sessions = own(mains).select("submission_date", "subsession_date", *DIMS, _aborted().alias("aborts_main"), N.clamp_session(F.col("subsession_length")).alias("subsession_length"), *SUMS, zero.alias("crashes_detected_main"))
    crashed = own(crashes).select("submission_date", F.col("crash_date").alias("subsession_date"), *DIMS, F.lit(1).alias("crashes_detected_main"))
    both = sessions.unionByName(crashed, allowMissingColumns=True)
    sums = ["aborts_main", "subsession_length", *SUMS, "crashes_detected_main"]
    return both.fillna(0, sums).groupBy("submission_date", "subsession_date", *DIMS).agg(*[F.sum(c).alias(c) for c in sums])


def stability_summary(main: DataFrame, crashes: DataFrame, days: Sequence[str] = ()) -> DataFrame:
    """The day's roll-ups summed by channel, build and system (and columns of days); a side that has none reads zero."""
    keys = ["channel", "build_id", "os"]
    sums = ["aborted_session_count", "subsession_lengths", *SUMS, "crashes"]
    both = main.select(*days, *keys, *sums[:-1]).unionByName(crashes.select(*days, *keys, "crashes"), allowMissingColumns=True)
    empty = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]
    return both.groupBy(*days, *empty).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def stability_rollups(mains: DataFrame, crashes: DataFrame, start: date, end: date, *, yesterday: date, latency: int = LATENCY) -> dict[str, DataFrame]:
    """The stability tables of every activity day that submissions of start to end can change: from latency days before start to yesterday
    at most -> main, crashes, actives, actives_weekly and summary with their activity_date, and usage of the submission days.

    actives are users by the dimensions of their newest row and the days they were active on: of a day (one), and in actives_weekly of the
    week that ends with it. A user's day is a row before it is spread over the seven weeks that it is in.

    Each is one plan for all days; write it with dynamic partition overwrite by activity_date, usage by submission_date.
    """
    first, last = start - timedelta(latency), min(end, yesterday)

    def timely(df: DataFrame, day: str) -> DataFrame:
        own = df.where(F.col("submission_date").between(F.lit(first - timedelta(1)), F.lit(yesterday)) & F.col(day).between(F.lit(first), F.lit(last)))
        return own.where(F.datediff("submission_date", day).between(-1, latency - 1)).withColumn("activity_date", F.col(day))

    main = main_counts(timely(mains, "subsession_date"), ["activity_date", *DIMS])
    crashed = crash_counts(timely(crashes, "crash_date"), ["activity_date", *DIMS, "has_crash_environment"])
    keys = [d for d in DIMS if d != "build_id"]
    newest = F.max_by(F.struct(*keys), F.struct("timestamp", "event_id")).alias("r")
    users = lambda per: per.groupBy("activity_date", *[F.col(f"r.{k}").alias(k) for k in keys], "active_days").agg(F.count(F.lit(1)).alias("active_users"))
    actives = users(timely(mains, "subsession_date").where("client_id is not null").groupBy("activity_date", "client_id").agg(newest, F.lit(1).cast("long").alias("active_days")))

    # A week also waits for what comes latency days after its last day, and for what came up to two days before its first.
    own = mains.where(F.col("client_id").isNotNull() & F.col("submission_date").between(F.lit(first - timedelta(8)), F.lit(yesterday)) & F.col("subsession_date").between(F.lit(first - timedelta(6)), F.lit(last)))
    rows = own.groupBy("client_id", "subsession_date", "submission_date").agg(newest, F.max(F.struct("timestamp", "event_id")).alias("at"))
    ends = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.date_add("subsession_date", k))
    spread = rows.select("*", F.explode(ends).alias("activity_date")).where(F.col("activity_date").between(F.lit(first), F.lit(last)) & F.datediff("submission_date", "activity_date").between(-8, latency - 1))
    weekly = users(spread.groupBy("activity_date", "client_id").agg(F.max_by("r", F.struct("subsession_date", "at")).alias("r"), F.count_distinct("subsession_date").alias("active_days")))
    return {"main": main, "crashes": crashed, "actives": actives, "actives_weekly": weekly, "usage": usage_aggregate(mains, crashes, (start, last)), "summary": stability_summary(main, crashed, ["activity_date"])}
