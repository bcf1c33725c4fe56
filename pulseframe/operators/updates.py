"""Clients that are out of date, from arrays of their sessions, newest first."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Versions before this one are not looked at, and how far behind is out of date.
LEAST_VERSION, BEHIND = 42, 2
#: A client had its chance when it ran a version so many seconds within so many weeks.
CHANCE_S, WEEKS = 7200, 12


def latest_version(releases: DataFrame, day: date) -> DataFrame:
    """Releases (version: int, released: date) -> one row with the newest major version of a day."""
    return releases.where(F.col("released") <= F.lit(day)).agg(F.coalesce(F.max_by("version", F.struct("released", "version")), F.lit(0)).alias("latest"))


def recent(df: DataFrame, least: date) -> DataFrame:
    """Clients whose newest session has a date from least on."""
    first = F.try_to_timestamp(F.left(F.get("subsession_start_date", F.lit(0)), F.lit(10)), F.lit("yyyy-MM-dd")).cast("date")
    return df.where(first >= F.lit(least))


def _ran_long_enough(wednesday: date) -> Column:
    """Whether the sessions of the newest version, back to WEEKS weeks ago, last CHANCE_S seconds. Sessions without date or length are
    passed over; the first of another version or an older date ends the count."""
    old = F.lit(wednesday - timedelta(weeks=WEEKS))
    rows = F.arrays_zip("version", "subsession_start_date", "subsession_length")
    start = F.struct(F.lit(0).cast("long").alias("s"), F.lit(False).alias("over"))

    def step(acc: Column, row: Column) -> Column:
        day = F.try_to_timestamp(F.left(row["subsession_start_date"], F.lit(10)), F.lit("yyyy-MM-dd")).cast("date")
        ends = acc["over"] | (acc["s"] >= CHANCE_S) | ~row["version"].eqNullSafe(F.get("version", F.lit(0))) | F.coalesce(day < old, F.lit(False))
        add = F.when(ends | day.isNull() | row["subsession_length"].isNull(), F.lit(0)).otherwise(row["subsession_length"]).cast("long")
        return F.struct((acc["s"] + add).alias("s"), ends.alias("over"))

    return F.aggregate(rows, start, step)["s"] >= CHANCE_S


def update_status(df: DataFrame, latest: int, wednesday: date) -> DataFrame:
    """Adds status to a longitudinal table (version, subsession_start_date, subsession_length: arrays)."""
    text = F.get("version", F.lit(0))
    major = F.split_part(text, F.lit("."), F.lit(1)).try_cast("int")
    status = (
        F.when(text.isNull(), "none-version")
        .when(major.isNull(), "value-error")
        .when(major < LEAST_VERSION, "ignore-version-too-low")
        .when(major >= latest - BEHIND, "up-to-date")
        .when(_ran_long_enough(wednesday), "out-of-date")
        .otherwise("out-of-date-not-run-long-enough")
    )
    return df.withColumn("status", status)


def counted(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("clients"))


def update_enabled(df: DataFrame) -> DataFrame:
    """Clients that are out of date, with whether their updates are on."""
    on = F.get("enabled", F.lit(0))
    named = F.when(on.isNull(), "none-update-enabled").when(on, "update-enabled").otherwise("update-disabled")
    return df.where("status = 'out-of-date'").withColumn("update", named)


def orphan_versions(df: DataFrame) -> DataFrame:
    return counted(update_enabled(df).where("update = 'update-enabled'").withColumn("newest_version", F.get("version", F.lit(0))), "newest_version")


def update_check_code(df: DataFrame) -> DataFrame:
    """Adds check_code: the place of the first non-zero in the first array that has one; 0 where the newest count of checks
    without update is positive; else -1."""
    places = F.transform("update_check_code_notify", lambda a: F.array_position(F.transform(a, lambda x: x != 0), F.lit(True)) - 1)
    first = F.get(F.filter(places, lambda p: p >= 0), F.lit(0))
    none = F.when(F.get("update_check_no_update_notify", F.lit(0)) > 0, 0).otherwise(-1)
    return df.withColumn("check_code", F.when(F.col("update_check_code_notify").isNull(), -1).otherwise(F.coalesce(first.cast("int"), none)))
