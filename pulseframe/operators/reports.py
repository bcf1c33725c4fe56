"""The executive report: activity by country, channel and system over a week or month."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N

DIMS = ["geo", "channel", "os"]
ENGINES = ["google", "bing", "yahoo", "other"]
MEASURES = ["actives", "hours", "inactives", "new_records", "five_of_seven", "total_records", "crashes", "default", *ENGINES]
#: Days with submissions that make a client a frequent one.
FREQUENT = {"weekly": 5, "monthly": 21}


def period(start: date, mode: str) -> tuple[date, date, date]:
    """The start and end (exclusive) of a report's period, and the start of the one before it."""
    if mode == "weekly":
        return start, start + timedelta(7), start - timedelta(7)
    first = start.replace(day=1)
    after = (first + timedelta(32)).replace(day=1)
    return first, after, (first - timedelta(1)).replace(day=1)


def between(df: DataFrame, start: date, end: date, column: str = "submission_date") -> DataFrame:
    """The days from start up to end. A filter on the partition column: other days are not read."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def latest(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Each key's newest row: a partial aggregate, so that no client's rows are sorted. Null keys go."""
    best = F.max_by(F.struct(*columns), F.struct(*order))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def _geo() -> Column:
    return F.col("country").alias("geo")


def easy_aggregates(df: DataFrame, day: date) -> DataFrame:
    """Hours, crash documents and searches by dimension."""
    crashes = F.sum(F.when(F.col("doc_type") == "crash", 1).otherwise(0)).alias("crashes")
    return df.groupBy(_geo(), "channel", "os").agg(F.sum("hours").alias("hours"), crashes, *[F.sum(e).alias(e) for e in ENGINES]).withColumn("date", F.lit(day))


def client_aggregates(df: DataFrame, day: date) -> DataFrame:
    """Clients by the dimensions of their newest row: actives, new profiles, and those with the browser as default."""
    own = latest(df, "client_id", ["timestamp", "event_id"], ["country", "channel", "os", "profile_creation_timestamp", "default"])
    new = F.when(F.col("profile_creation_timestamp") >= F.lit(day).cast("timestamp"), 1).otherwise(0)
    default = F.when(F.col("default"), 1).otherwise(0)
    return own.groupBy(_geo(), "channel", "os").agg(F.count(F.lit(1)).alias("actives"), F.sum(new).alias("new_records"), F.sum(default).alias("default")).withColumn("date", F.lit(day))


def lost_clients(last: DataFrame, this: DataFrame) -> DataFrame:
    """Rows of last whose client has none in this. Null clients are on neither side."""
    return last.where("client_id is not null").join(this.select("client_id").where("client_id is not null").distinct(), "client_id", "left_anti")


def inactives(last: DataFrame, this: DataFrame, day: date) -> DataFrame:
    own = latest(lost_clients(last, this), "client_id", ["timestamp", "event_id"], ["country", "channel", "os"])
    return own.groupBy(_geo(), "channel", "os").agg(F.count(F.lit(1)).alias("inactives")).withColumn("date", F.lit(day))


def five_of_seven(df: DataFrame, day: date, mode: str) -> DataFrame:
    """Clients seen on enough days; a client whose dimensions change is counted by each."""
    days = df.groupBy("client_id", "country", "channel", "os").agg(F.count_distinct(F.to_date("timestamp")).alias("n"))
    return days.groupBy(_geo(), "channel", "os").agg(F.sum(F.when(F.col("n") >= FREQUENT[mode], 1).otherwise(0)).alias("five_of_seven")).withColumn("date", F.lit(day))


def merge_aggregates(parts: Iterable[DataFrame], keys: list[str]) -> DataFrame:
    """A full outer merge of aggregates on null-safe keys, with empty for null keys and zero for what a part lacks.

    Done as a union and one aggregate: each part has a key once, and no join needs sorted sides.
    """
    total = None
    for p in parts:
        total = p if total is None else total.unionByName(p, allowMissingColumns=True)
    named = total.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys})
    return named.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in total.columns if c not in keys])


def executive_report(df: DataFrame, start: date, mode: str = "weekly") -> DataFrame:
    """The report of 16 columns over one period of the executive summary."""
    first, end, before = period(start, mode)
    this, last = between(df, first, end), between(df, before, first)
    parts = [easy_aggregates(this, first), client_aggregates(this, first), inactives(last, this, first), five_of_seven(this, first, mode)]
    merged = merge_aggregates(parts, [*DIMS, "date"])
    return merged.withColumn("total_records", F.col("actives") + F.col("inactives")).select(*DIMS, "date", *MEASURES)


def cube_all(report: DataFrame, today: date) -> DataFrame:
    """Sums over every combination of country, channel and system with `all`. Rows that hold `all` and days from today on go;
    countries and channels without a name of their own count as Other."""
    own = report.where((F.col("date") < F.lit(today.isoformat())) & ~((F.col("geo") == "all") | (F.col("channel") == "all") | (F.col("os") == "all")))
    channel = F.when(F.col("channel").isin(*N.CHANNELS[1:]), F.col("channel")).otherwise("Other")
    named = own.withColumns({"geo": N.top_country(F.col("geo")), "channel": channel})
    sums = [F.sum(m).alias(m) for m in MEASURES]
    # The date is in every set, so the cube of the three dimensions is eight grouping sets.
    sets = [[d for k, d in enumerate(DIMS) if mask >> k & 1] + ["date"] for mask in range(8)]
    cubed = named.groupingSets([[F.col(c) for c in s] for s in sets], *DIMS, "date").agg(*[F.grouping(d).alias(f"_{d}") for d in DIMS], *sums)
    return cubed.select(*[F.when(F.col(f"_{d}") == 1, "all").otherwise(F.col(d)).alias(d) for d in DIMS], "date", *MEASURES)


def interval_report(df: DataFrame, mode: str = "week", *, os_column: str = "os", finalize: bool = False) -> DataFrame:
    """Per interval, over all clients ever seen: the report's measures by the clients' dimensions as of that interval.

    A client counts in the partition of its newest row so far. It is active where it has a row in the interval, else
    inactive, which only partitions with a row in the interval report. It is new in its first interval if
    its profile is not older than that interval; frequent with rows on five days of a week (days
    are told apart in weekly mode only). A missing crash count is one crash, a negative one none. The last interval is open and left out unless
    finalize. Clients do not repeat over the intervals: each enters a partition once and leaves it once, and running sums
    over a partition's intervals count who is there.
    """
    interval = {"day": F.to_date("timestamp"), "week": N.sunday_week(F.to_date("timestamp")), "month": N.month_start(F.to_date("timestamp"))}[mode]
    dow = F.dayofweek("timestamp") - 1 if mode == "week" else F.lit(0)
    keys = ["country", "channel", "os"]
    rows = df.where("client_id is not null").withColumn("os", F.col(os_column)).withColumn("interval", interval).withColumn("bit", F.pow(F.lit(2), dow).cast("int"))
    last = rows.agg(F.max("interval").alias("last"))

    order = F.struct("timestamp", "event_id")
    per = rows.groupBy("client_id", "interval").agg(
        F.max_by(F.struct(*keys, "default"), order).alias("r"), F.bit_or("bit").alias("mask"), F.min_by("profile_creation_timestamp", order).alias("profile")
    )
    ever = Window.partitionBy("client_id").orderBy("interval")
    # Each client's rows hold until its next one: it enters its partition at the interval and leaves at `until`.
    held = per.select("*", F.lead("interval").over(ever).alias("until"), F.row_number().over(ever).alias("nth"))
    count = lambda c, name: F.when(c, 1).otherwise(0).cast("long").alias(name)
    enters = F.struct(
        F.col("interval").alias("at"),
        F.lit(1).cast("long").alias("held"),
        F.lit(1).cast("long").alias("actives"),
        count((F.col("nth") == 1) & (F.col("profile") >= F.col("interval").cast("timestamp")), "new_records"),
        count(F.bit_count("mask") >= 5, "five_of_seven"),
        count(F.col("r.default"), "default"),
    )
    none = F.lit(0).cast("long")
    leaves = F.struct(F.col("until").alias("at"), F.lit(-1).cast("long").alias("held"), *[none.alias(c) for c in ("actives", "new_records", "five_of_seven", "default")])
    changes = held.select(*[F.col(f"r.{k}").alias(k) for k in keys], F.explode(F.array(enters, leaves)).alias("c")).select(*keys, "c.*").where("at is not null")
    crash = F.when(F.col("doc_type") == "crash", F.greatest(F.coalesce(F.col("crash_count"), F.lit(1)), F.lit(0)) if "crash_count" in df.columns else F.lit(1)).otherwise(0)
    sums = rows.groupBy(F.col("interval").alias("at"), *keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("hours").alias("hours"), F.sum(crash).alias("crashes"), *[F.sum(e).alias(e) for e in ENGINES])
    parts = sums.unionByName(changes, allowMissingColumns=True)
    merged = parts.groupBy("at", *keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in ("at", *keys)])
    so_far = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    both = merged.withColumn("total", F.coalesce(F.sum("held").over(so_far), F.lit(0))).where("rows > 0")
    both = both.join(F.broadcast(last)).where(F.lit(finalize) | (F.col("at") < F.col("last")))  # one row is broadcast
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    inactives = (F.col("total") - F.coalesce("actives", F.lit(0))).alias("inactives")
    return both.select(F.col("country").alias("geo"), "channel", "os", F.col("at").alias("date"), zero("actives"), "hours", inactives, zero("new_records"), zero("five_of_seven"), F.col("total").alias("total_records"), zero("crashes"), zero("default"), *[zero(e) for e in ENGINES])
