"""Time series in buckets: counts, rates, merging over hosts, and wide output."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N


def bucket(ts: Column, seconds: int) -> Column:
    """The start of the bucket that a time is in."""
    return F.window(ts, f"{seconds} seconds")["start"]


def counts_by_channel(pings: DataFrame, channel: Column, seconds: int = 60) -> DataFrame:
    """A column of counts per channel and bucket."""
    own = pings.select(bucket(F.col("ts"), seconds).alias("bucket"), channel.alias("channel"))
    return own.groupBy("bucket").pivot("channel", list(N.CHANNELS)).agg(F.count(F.lit(1))).fillna(0, list(N.CHANNELS))


def request_rates(df: DataFrame, seconds: int = 60) -> DataFrame:
    return df.groupBy(bucket(F.col("ts"), seconds).alias("bucket")).agg(F.count(F.lit(1)).alias("requests"))


def dnt_status(df: DataFrame, dnt: Column, seconds: int = 60) -> DataFrame:
    """Requests that ask not to be tracked, that allow it, and that say neither."""
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    own = df.select(bucket(F.col("ts"), seconds).alias("bucket"), dnt.alias("d"))
    known = F.coalesce(F.col("d").isin("0", "1"), F.lit(False))
    return own.groupBy("bucket").agg(count(F.col("d") == "1").alias("on"), count(F.col("d") == "0").alias("off"), count(~known).alias("unknown"))


def horizon(series: DataFrame, rows: int, seconds: int) -> DataFrame:
    """The newest rows buckets before and with the newest one of all."""
    newest = series.agg(F.max("bucket").alias("_newest"))
    return series.join(F.broadcast(newest)).where(F.unix_timestamp("bucket") > F.unix_timestamp("_newest") - rows * seconds).drop("_newest")  # one row


#: Documents that are nested deeper than this are none, as for Spark's own parser.
MOST_DEPTH = 1_000
LEAVES = "array<struct<parts: array<string>, kind: string, number: double, other: string>>"


def _leaves(text: str | None) -> list[tuple] | None:
    """A document's values in one walk, without recursion."""

    def refuse(x: str) -> None:
        raise ValueError(x)

    def unique(pairs: list[tuple[str, object]]) -> dict:
        if len(found := dict(pairs)) < len(pairs):
            raise ValueError("a key comes twice")
        return found

    try:
        top = json.loads(text, parse_constant=refuse, object_pairs_hook=unique) if text else None
    except (ValueError, RecursionError):
        return None
    if not isinstance(top, dict):
        return None
    out, todo = [], [((), top)]
    while todo:
        parts, v = todo.pop()
        if len(parts) > MOST_DEPTH:
            return None
        if isinstance(v, (dict, list)) and v:
            inner = v.items() if isinstance(v, dict) else ((f"[{k}]", x) for k, x in enumerate(v))
            todo += [((*parts, k), x) for k, x in inner]
        elif v is not None and parts:
            kind = "table" if isinstance(v, (dict, list)) else "string" if isinstance(v, str) else "boolean" if isinstance(v, bool) else "number"
            number = None if kind != "number" else float(v) if abs(v) < 1e308 else math.copysign(math.inf, v)
            out.append({"parts": list(parts), "kind": kind, "number": number, "other": v if kind == "string" else str(v).lower() if kind == "boolean" else None})
    return out


def _all_leaves(texts: pa.Array) -> pa.Array:
    """The leaves of each text, by column, so that no value is converted on its own; text that is no object has none."""
    found = [_leaves(x) or [] for x in texts.to_pylist()]
    flat = [leaf for leaves in found for leaf in leaves]
    types = {"parts": pa.list_(pa.string()), "kind": pa.string(), "number": pa.float64(), "other": pa.string()}
    values = pa.StructArray.from_arrays([pa.array([x[n] for x in flat], t) for n, t in types.items()], names=list(types))
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, found))], pa.int32()), values)


def flattened(df: DataFrame, doc: str) -> DataFrame:
    """JSON objects (a column of text), of any depth up to MOST_DEPTH -> rows (parts, kind, number, other), one for each value, kind being number, string,
    boolean, or table for an empty object or array.

    parts are the keys from the top, those of arrays as [0], [1] and so on. Nulls and text that is no object, or has a key twice in one, count
    for nothing. Each document is parsed once, in one pass, whatever the depth of any.
    """
    own = [c for c in df.columns if c != doc]
    return df.select(*own, F.inline(F.arrow_udf(_all_leaves, LEAVES)(doc)))


def merge_json_counts(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of flattened() with ts and event_id -> one value for each key and path: numbers add up, of texts and booleans the last one stays.

    What a path has first is its kind; later values of another kind are passed over, and with an object or array all that is in it. One
    aggregate by path and kind comes first, so that what meets by path is small.
    """
    order = F.struct("ts", "event_id")
    own = [*keys, "parts"]
    per = rows.groupBy(*own, "kind").agg(F.min(order).alias("first"), F.sum("number").alias("number"), F.max_by("other", order).alias("other"))
    above = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda n: F.slice("parts", 1, n))
    # From one branch, not a union of two, for which each document would be parsed twice.
    none = {"number": F.lit(None).cast("double"), "other": F.lit(None).cast("string")}
    place = lambda parts, kind, **values: F.struct(parts.alias("parts"), kind.alias("kind"), *[values.get(n, c).alias(n) for n, c in none.items()])
    size = F.size("parts")
    places = F.transform(F.sequence(F.lit(1), size), lambda n: F.when(n == size, place(F.col("parts"), F.col("kind"), number=F.col("number"), other=F.col("other"))).otherwise(place(F.slice("parts", 1, n), F.lit("table"))))
    every = per.select(*keys, "first", F.inline(places))
    chosen = every.groupBy(*own).agg(F.min_by(F.struct("kind", "number", "other"), "first").alias("r")).select(*own, "r.*")
    values = chosen.where("kind <> 'table'")
    under = values.where(F.size("parts") > 1).select(*own, F.explode(above).alias("above"))
    plain = values.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("parts").alias("_above"))
    met = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("above") == F.col("_above"))
    lost = under.join(plain, met).select(*[F.col(k).alias(f"_{k}") for k in own]).distinct()
    kept = values.join(lost, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in own]), "left_anti")
    path = F.replace(F.array_join("parts", "."), F.lit(".["), F.lit("["))
    return kept.select(*keys, path.alias("path"), "kind", "number", "other")


def merge_series(hosts: DataFrame) -> DataFrame:
    """Series of many hosts (series, bucket, name, aggregation, value) -> one: sums add, minima and maxima combine, NaN is no sample."""
    value = F.when(~F.isnan("value"), F.col("value"))
    merged = F.when(F.col("aggregation") == "min", F.min(value)).when(F.col("aggregation") == "max", F.max(value)).otherwise(F.sum(value))
    return hosts.groupBy("series", "bucket", "name", "aggregation").agg(merged.alias("value"))


def live_hosts(hosts: DataFrame, hours: int = 24) -> DataFrame:
    """The rows of hosts whose newest row is not hours older than the newest of all."""
    newest = hosts.agg(F.max("ts").alias("_newest"))
    per = hosts.groupBy("host").agg(F.max("ts").alias("_last")).join(F.broadcast(newest)).where(F.col("_last") >= F.col("_newest") - F.expr(f"interval {hours} hours"))  # one row
    return hosts.join(per.select("host"), "host", "left_semi")


def series_to_wide(series: DataFrame, names: list[str], *, least_rows: int = 3) -> DataFrame:
    """(bucket, name, value) -> Time and a column for each name; an error where there are fewer than least_rows buckets."""
    wide = series.groupBy("bucket").pivot("name", names).agg(F.sum("value"))
    counted = wide.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))  # a row per bucket of one series
    checked = F.when(F.col("_n") >= least_rows, F.date_format("bucket", "yyyy-MM-dd HH:mm:ss")).otherwise(F.raise_error(F.lit("too few rows")))
    return counted.select(checked.alias("Time"), *names)
