"""Usage over time: searches, hours, distinct users, retention and engagement."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N

# Search origins, tried in this order, and the countries that have totals of their own.
ORIGINS = ("abouthome", "contextmenu", "searchbar", "urlbar")
SEARCH_COUNTRIES = ("US", "CN", "RU")


def days_between(df: DataFrame, column: str = "day") -> DataFrame:
    """Every day from the first to the last of a column: one row of bounds, exploded."""
    bounds = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null")
    return bounds.select(F.explode(F.sequence("a", "b")).alias("day"))


def search_totals(pings: DataFrame, searches: Column, country: Column) -> DataFrame:
    """Searches by day, engine and origin (and total), and by day, engine and country (and Total); days without any read zero."""
    exploded = pings.select(F.to_date("ts").alias("day"), country.alias("country"), F.explode(searches).alias("key", "value"))
    low = F.lower("key")
    engine = F.when(low.contains("google"), "google").when(low.contains("bing"), "bing").when(low.contains("yahoo"), "yahoo").otherwise("other")
    origin = F.lit(None).cast("string")
    for o in reversed(ORIGINS):
        origin = F.when(low.contains(o), o).otherwise(origin)
    where = F.when(F.col("country").isin(*SEARCH_COUNTRIES), F.col("country"))
    parts = F.array(F.struct(F.lit("origin").alias("kind"), origin.alias("name")), F.struct(F.lit("origin").alias("kind"), F.lit("total").alias("name")), F.struct(F.lit("country").alias("kind"), where.alias("name")), F.struct(F.lit("country").alias("kind"), F.lit("Total").alias("name")))
    counted = exploded.select("day", engine.alias("engine"), F.col("value.sum").alias("n"), F.explode(parts).alias("part"))
    sums = counted.where("part.name is not null").groupBy("day", "engine", "part.kind", "part.name").agg(F.sum("n").alias("searches"))
    spine = days_between(pings.select(F.to_date("ts").alias("day")))
    kinds = sums.select("engine", "kind", "name").distinct()
    grid = kinds.join(F.broadcast(spine))  # four engines, nine names, and the days of the report
    return grid.join(sums, ["day", "engine", "kind", "name"], "left").withColumn("searches", F.coalesce("searches", F.lit(0)))


def usage_hours_by_day(df: DataFrame, days: int = 30) -> DataFrame:
    """Hours per day, of the newest days."""
    per = df.groupBy(F.to_date("timestamp").alias("day")).agg(F.sum("hours").alias("hours"))
    last = df.agg(F.max(F.to_date("timestamp")).alias("last"))
    return per.join(F.broadcast(last)).where(F.datediff("last", "day") < days).select("day", "hours")


def usage_hours_by_month(df: DataFrame, months: int = 12) -> DataFrame:
    """Hours per month, with zero for months without any."""
    per = df.groupBy(N.month_start(F.to_date("timestamp")).alias("month")).agg(F.sum("hours").alias("hours"))
    last = df.agg(N.month_start(F.max(F.to_date("timestamp"))).alias("last")).where("last is not null")
    spine = last.select(F.explode(F.sequence(F.add_months("last", 1 - months), "last", F.expr("interval 1 month"))).alias("month"))
    return spine.join(per, "month", "left").select("month", F.coalesce("hours", F.lit(0.0)).alias("hours"))


def active_instances(df: DataFrame, *, exact: bool = True, period: str = "day") -> DataFrame:
    """Distinct clients per day or month, exactly or by a sketch of fixed size."""
    day = F.to_date("timestamp")
    count = F.count_distinct("client_id") if exact else F.approx_count_distinct("client_id", 0.01)
    return df.groupBy((day if period == "day" else N.month_start(day)).alias(period)).agg(count.alias("clients"))


def dau_wau_mau(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """(client_id, day) -> per day the distinct clients of the 1, 7 and 28 days that end with it; days without rows are none.

    Exact: each client's days are taken once, then spread to the days that they count for, and only as far
    as the client's next own day, so that a client and a day meet once. By sketch: a sketch per day, united over the frame.
    """
    days = df.select("client_id", "day").where("client_id is not null").distinct()
    if not exact:
        per = df.groupBy("day").agg(F.hll_sketch_agg("client_id").alias("sketch")).withColumn("n", F.unix_date("day"))
        frame = lambda k: Window.orderBy("n").rangeBetween(1 - k, 0)
        return per.select("day", *[F.hll_sketch_estimate(F.hll_union_agg("sketch").over(frame(k))).alias(name) for name, k in (("dau", 1), ("wau", 7), ("mau", 28))])
    w = Window.partitionBy("client_id").orderBy("day")
    # A day of a client covers the days up to its next one, 28 at most.
    ends = days.select("day", F.least(F.date_add("day", 27), F.coalesce(F.date_sub(F.lead("day").over(w), 1), F.date_add("day", 27))).alias("until"))
    spread = ends.select("day", F.explode(F.sequence("day", "until")).alias("on"))
    age = F.datediff("on", "day")
    counts = spread.groupBy(F.col("on").alias("day")).agg(*[F.sum(F.when(age < k, 1).otherwise(0)).alias(name) for name, k in (("dau", 1), ("wau", 7), ("mau", 28))])
    return counts.where("dau > 0")


def sketch_error(df: DataFrame) -> DataFrame:
    """Per day the sketch's count, the exact one, and their ratio. Clients are told apart first: an exact count beside a sketch in one aggregate would
    have a sketch for each client and day."""
    own = df.select("day", "client_id").distinct()
    per = own.groupBy("day").agg(F.approx_count_distinct("client_id", 0.01).alias("estimate"), F.count("client_id").alias("exact"))
    return per.withColumn("ratio", F.col("estimate") / F.col("exact"))


def retention(df: DataFrame, interval_days: int) -> DataFrame:
    """(client_id, day) -> by cohort (Sunday week of the first day) the clients that came back in interval k and in each before it.

    Interval k holds the days k * n + 1 to (k + 1) * n after the first. Cohorts whose clients never came back have a row with null interval.
    """
    days = df.select("client_id", "day").where("client_id is not null").distinct()
    firsts = days.groupBy("client_id").agg(F.min("day").alias("first"))
    sizes = firsts.groupBy(N.sunday_week(F.col("first")).alias("cohort")).agg(F.count(F.lit(1)).alias("cohort_user_count"))
    seen = days.join(firsts, "client_id").where("day > first")
    kept = seen.select("client_id", "first", F.floor((F.datediff("day", "first") - 1) / interval_days).cast("int").alias("interval")).distinct()
    rank = F.row_number().over(Window.partitionBy("client_id").orderBy("interval")) - 1
    whole = kept.withColumn("k", rank).where("k = interval")
    back = whole.groupBy(N.sunday_week(F.col("first")).alias("cohort"), "interval").agg(F.count(F.lit(1)).alias("users"))
    return sizes.join(back, "cohort", "left").select("cohort", "cohort_user_count", "interval", F.coalesce("users", F.lit(0)).alias("users"))


def mobile_retention(df: DataFrame, mode: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Core pings (document_id, client_id, os_version, country, channel, profile_day, submission_date) by period and every
    combination of system version, country and channel (`all` where one is not told apart): actives, new records, and clients
    back on day 1, 7 and 30 of their profile.

    A document counts once, by its first row (the smallest by day and then by its values); rows without a document id are documents of their own. A
    client counts once a day within a segment. Segments without a profile date have no row.
    """
    columns = ["submission_date", *[c for c in df.columns if c not in ("submission_date", "document_id")]]
    first = df.where(F.col("document_id").isNotNull()).groupBy("document_id").agg(F.min(F.struct(*columns)).alias("r")).select("document_id", "r.*")
    own = first.unionByName(df.where(F.col("document_id").isNull()))
    if start is not None:
        own = own.where(F.col("submission_date") >= (N.sunday_week(F.lit(start)) if mode == "weekly" else N.month_start(F.lit(start))))
    if end is not None:
        own = own.where(F.col("submission_date") <= F.lit(end))
    period = N.sunday_week(F.col("submission_date")) if mode == "weekly" else N.month_start(F.col("submission_date"))
    dims = ["os_version", "country", "channel"]
    # One row per client, day and dimensions before the cube makes eight of each.
    once = own.groupBy(period.alias("period"), "client_id", "submission_date", *dims).agg(F.min("profile_day").alias("profile_day"))
    sets = [[d for k, d in enumerate(dims) if mask >> k & 1] for mask in range(8)]
    age = F.unix_date("submission_date") - F.col("profile_day")
    keys = ["period", "client_id", "submission_date"]
    cubed = once.groupingSets([[F.col(c) for c in [*keys, *s]] for s in sets], *keys, *dims).agg(*[F.grouping(d).alias(f"_{d}") for d in dims], F.max(F.col("profile_day")).alias("profile_day"))
    named = cubed.select(*keys, *[F.when(F.col(f"_{d}") == 1, "all").otherwise(F.coalesce(F.col(d), F.lit(""))).alias(d) for d in dims], "profile_day")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    aged = named.groupBy("period", *dims).agg(
        F.count_distinct("client_id").alias("actives"), count(age == 0).alias("new_records"), *[count(age == k).alias(f"d{k}") for k in (1, 7, 30)], F.count("profile_day").alias("dated")
    )
    return aged.where("dated > 0").drop("dated")


def window_filter(df: DataFrame, activity: str, submission: str, low: date, high: date, past: int, future: int) -> DataFrame:
    """Activity from low - past to high, high included, submitted from then to high + future. The second range prunes partitions."""
    first = F.date_sub(F.lit(low), past)
    return df.where(F.col(activity).between(first, F.lit(high)) & F.col(submission).between(first, F.date_add(F.lit(high), future)))


def engagement(df: DataFrame, days: DataFrame, *, past: int = 28, future: int = 10) -> DataFrame:
    """(client_id, activity_date, submission_date) and target days -> dau, mau and their ratio per day.

    In one pass: only rows that a target day can reach are read (their submission days are partitions), each counts for the target days that
    it can reach, and each (day, client) is taken once before the count. The target days are a report's, so they are one row.
    """
    low, high = days.agg(F.min("day"), F.max("day")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "day date, dau long, mau long, ratio double")
    near = window_filter(df, "activity_date", "submission_date", low, high, past, future)
    own = near.where("client_id is not null").groupBy("client_id", "activity_date", "submission_date").agg(F.lit(1).alias("one"))
    targets = days.agg(F.collect_set("day").alias("targets"))
    reached = F.array_intersect(F.sequence("activity_date", F.date_add("activity_date", past)), F.col("targets"))
    reach = own.join(F.broadcast(targets)).select("client_id", "activity_date", "submission_date", F.explode(reached).alias("day"))  # one row
    fits = F.col("submission_date").between(F.date_sub("day", past), F.date_add("day", future))
    daily = (F.col("activity_date") == F.col("day")) & (F.col("submission_date") >= F.col("day"))
    met = reach.where(fits).groupBy("day", "client_id").agg(F.max(daily.cast("int")).alias("daily"))
    return met.groupBy("day").agg(F.sum("daily").alias("dau"), F.count(F.lit(1)).alias("mau")).withColumn("ratio", F.col("dau") / F.col("mau"))


def due_days(existing: DataFrame, today: date, *, cutoff: int = 30, fresh: int = 10) -> DataFrame:
    """The days of the last cutoff ones that must be computed: those not there, and those computed within fresh days of their day but not today."""
    wanted = existing.sparkSession.range(1, cutoff + 1).select(F.date_sub(F.lit(today), F.col("id").cast("int")).alias("day"))
    fine = existing.where((F.col("generated_on") >= F.lit(today)) | (F.datediff("generated_on", "day") > fresh))
    return wanted.join(fine.select("day"), "day", "left_anti")


def update_engagement(existing: DataFrame, df: DataFrame, today: date) -> DataFrame:
    """The engagement table brought up to date: rows that are fine stay, days that are due are computed."""
    due = due_days(existing, today)
    new = engagement(df, due).withColumn("generated_on", F.lit(today))
    return existing.join(due, "day", "left_anti").unionByName(new.select(*existing.columns))
