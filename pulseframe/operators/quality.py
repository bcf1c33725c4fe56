"""Data quality: latency, duplicates, errors, counters, stalls and gaps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Clients not seen for so many days are lost.
LOST_DAYS = 42
#: Outputs that may stand still.
IGNORED = ("TelemetryErrorsOutput",)
PERCENTILES = {"median": 0.5, "p75": 0.75, "p99": 0.99}


def _percentiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """By nearest rank: the smallest value that a share of the values does not exceed."""
    return df.groupBy(*keys).agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})").alias(n) for n, p in PERCENTILES.items()])


def latency_percentiles(pings: DataFrame) -> DataFrame:
    """Pings (client_id, channel, reason, ts, creation_ts) -> nearest-rank percentiles by channel:reason of four measures:
    last_seen (days since each client's last ping), client_delay (hours from creation to receipt of that ping), and
    delay_24h and delay_7d (the same of all pings of the last day and week). The newest ping is now; clients lost by then go.
    """
    now = pings.agg(F.max("ts").alias("now"))
    named = pings.withColumn("series", F.concat_ws(":", F.coalesce("channel", F.lit("UNKNOWN")), "reason")).join(F.broadcast(now))  # one row
    hours = F.floor((F.unix_micros("ts") - F.unix_micros("creation_ts")) / 3_600_000_000)
    age = F.unix_micros("now") - F.unix_micros("ts")
    timed = named.select("series", "client_id", "ts", "event_id", hours.alias("hours"), age.alias("age"))
    last = timed.groupBy("series", "client_id").agg(F.max_by(F.struct("hours", "age"), F.struct("ts", "event_id")).alias("r")).where(F.col("r.age") <= LOST_DAYS * 86_400_000_000)
    one = lambda name, value: F.struct(F.lit(name).alias("metric"), value.cast("long").alias("value"))
    clients = last.select("series", F.explode(F.array(one("last_seen", F.floor(F.col("r.age") / 86_400_000_000)), one("client_delay", F.col("r.hours")))).alias("m"))
    kept = lambda name, days: F.when(F.col("age") < days * 86_400_000_000, one(name, F.col("hours")))
    all_pings = timed.select("series", F.explode(F.array_compact(F.array(kept("delay_24h", 1), kept("delay_7d", 7)))).alias("m"))
    return _percentiles(clients.unionByName(all_pings).select("series", "m.metric", "m.value"), ["series", "metric"], "value")


def error_tally(errors: DataFrame, column: str = "error") -> DataFrame:
    return errors.groupBy(F.coalesce(F.col(column), F.lit("<none>")).alias("error")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_report(pings: DataFrame) -> DataFrame:
    """Per day and channel the rows that repeat an earlier document's id, and the clients that sent one."""
    w = Window.partitionBy("document_id").orderBy("ts", "event_id")
    again = pings.where("document_id is not null").withColumn("nth", F.row_number().over(w)).where("nth > 1")
    return again.groupBy(F.to_date("ts").alias("day"), "channel").agg(F.count(F.lit(1)).alias("duplicates"), F.count_distinct("client_id").alias("clients"))


def unique_documents(pings: DataFrame) -> DataFrame:
    """The earliest row of each document id."""
    columns = pings.columns
    first = pings.groupBy("document_id").agg(F.min_by(F.struct(*columns), F.struct("ts", "event_id")).alias("r"))
    return first.select("r.*")


def channel_switches(pings: DataFrame) -> DataFrame:
    """Per day and channel the clients that are new, switched in and switched out, by the order of their pings."""
    before = F.lag("channel").over(Window.partitionBy("client_id").orderBy("ts", "event_id"))
    moved = pings.where("client_id is not null").select(F.to_date("ts").alias("day"), "channel", before.alias("before"))
    event = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("channel"))
    events = F.when(F.col("before").isNull(), F.array(event("new", F.col("channel")))).when(F.col("before") != F.col("channel"), F.array(event("out", F.col("before")), event("in", F.col("channel"))))
    rows = moved.select("day", F.explode(events).alias("e"))
    count = lambda kind: F.sum(F.when(F.col("e.kind") == kind, 1).otherwise(0))
    return rows.groupBy("day", "e.channel").agg(count("new").alias("new"), count("in").alias("switched_in"), count("out").alias("switched_out"))


def _carried(rows: DataFrame, key: str, aggregates: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
    """rows (with a column _slice) with what the slices of their key before theirs say: aggregates are made by slice, and carry, a
    name and a window expression for each, over the slices of a key, of which there is one row each."""
    per = rows.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_of")).agg(*[c.alias(n) for n, c in aggregates.items()])
    edges = per.select("_key", "_of", *[c.alias(n) for n, c in carry.items()])
    met = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of"))
    return rows.join(edges, met).drop("_key", "_of")


def _slices():
    return Window.partitionBy("_key").orderBy("_of")


def _before():
    return _slices().rowsBetween(Window.unboundedPreceding, -1)


def counter_deltas(df: DataFrame, source: str, value: str, scale: float | None = None, *, every: str = "hour") -> DataFrame:
    """Adds delta, the increase of a cumulative counter since the source's row before; after a reset the new value; null at first.

    A source is dealt to slices of time, whose last values are carried over, so that few sources are still many tasks' work. Rows need a time.
    """
    order = F.struct("ts", "event_id")
    within = Window.partitionBy(source, "_slice").orderBy("ts", "event_id")
    rows = df.withColumn("_slice", F.date_trunc(every, "ts"))
    own = _carried(rows, source, {"_last": F.max_by(F.struct(F.col(value).alias("v")), order)}, {"_carry": F.lag("_last.v").over(_slices())})
    before = F.when(F.row_number().over(within) == 1, F.col("_carry")).otherwise(F.lag(value).over(within))
    known = own.withColumn("_before", before)
    delta = F.when(F.col("_before").isNull(), None).when(F.col(value) >= F.col("_before"), F.col(value) - F.col("_before")).otherwise(F.col(value))
    return known.withColumn("delta", delta if scale is None else delta * scale).drop("_slice", "_carry", "_before")


def output_health(df: DataFrame, ignored: Iterable[str] = IGNORED, stall_s: int = 60) -> DataFrame:
    """Reports (name, ts, failures, messages) -> alerts: failures rose, or the count of messages stood for more than stall_s seconds;
    the first of each output and hour, a stall before a rise at one time.

    An output's hours are worked on apart; the last count, the most failures and the newest change of those before are carried over.
    """
    order = F.struct("ts", "event_id")
    w = Window.partitionBy("name", "_slice").orderBy("ts", "event_id")
    rows = df.where("name is not null").withColumn("_slice", F.date_trunc("hour", "ts"))
    known = _carried(
        rows,
        "name",
        {"_last": F.max_by(F.struct("messages"), order), "_most": F.max("failures")},
        {"_messages": F.lag("_last.messages").over(_slices()), "_failures": F.max("_most").over(_before())},
    )
    first = F.row_number().over(w) == 1
    before = F.when(first, F.col("_messages")).otherwise(F.lag("messages").over(w))
    changed = F.when(~F.col("messages").eqNullSafe(before), F.col("ts"))
    most = F.greatest(F.coalesce(F.max("failures").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.coalesce("_failures", F.lit(0)))
    judged = known.select(*rows.columns, (F.col("failures") > most).alias("rose"), changed.alias("_changed"))
    timed = _carried(judged, "name", {"_newest": F.max("_changed")}, {"_since": F.max("_newest").over(_before())})
    since = F.greatest(F.max("_changed").over(w), F.col("_since"))
    stalled = (F.unix_micros("ts") - F.unix_micros(since) > stall_s * 1_000_000) & ~F.col("name").isin(list(ignored))
    text = F.when(F.coalesce(stalled, F.lit(False)), F.format_string("%s ProcessMessageCount has stalled at %d", "name", "messages")).when(F.col("rose"), F.format_string("%s ProcessFileFailures has increased to %d", "name", "failures"))
    alerts = timed.withColumn("alert", text).where("alert is not null").withColumn("hour", F.col("_slice"))
    return alerts.withColumn("nth", F.row_number().over(w)).where("nth = 1").select("name", "hour", "ts", "alert")


def no_new_data(series: DataFrame, seconds: int) -> DataFrame:
    """Bucketed samples (series, bucket) -> each series with whether the newest bucket of all has none of it."""
    newest = series.agg(F.max("bucket").alias("newest"))
    per = series.groupBy("series").agg(F.max("bucket").alias("last"))
    return per.join(F.broadcast(newest)).select("series", "last", (F.col("last") < F.col("newest")).alias("silent"))  # one row


def offset_gaps(df: DataFrame, *, size: int = 1_000_000) -> DataFrame:
    """(topic, partition, offset) -> the offsets that do not follow the one before, what was expected, and the difference.

    A topic's partition is worked on in slices of size offsets, each of which knows the last offset of the slices before it from a row for each
    slice. Of equal offsets each but the first is reported.
    """
    own = ["topic", "partition"]
    cut = df.select(*own, "offset", F.floor(F.col("offset") / size).alias("_slice"))
    ends = cut.groupBy(*own, "_slice").agg(F.max("offset").alias("_end"))
    before = ends.select(*own, "_slice", F.lag("_end").over(Window.partitionBy(*own).orderBy("_slice")).alias("_end"))
    within = cut.withColumn("_last", F.lag("offset").over(Window.partitionBy(*own, "_slice").orderBy("offset")))
    named = before.select(*[F.col(c).alias(f"_{c}") for c in own], F.col("_slice").alias("_at"), "_end")
    met = within.join(named, F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition")) & F.col("_slice").eqNullSafe(F.col("_at")))
    return met.withColumn("expected", F.coalesce("_last", "_end") + 1).where("offset <> expected").select("topic", "partition", "offset", "expected", (F.col("offset") - F.col("expected")).alias("difference"))
