"""URL filters by a temporal list join: built-in operators only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import MOST_HOT

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    """The lower-case host of an absolute URL; empty for null and other texts."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """Dated entries (list_name, pattern, action 'add' or 'remove', effective) -> (list_name, pattern, valid_from,
    valid_to): from each addition to the pattern's next change, open (null) after the last. Patterns are hosts, so their case does not
    matter. Of changes with one date a removal counts; entries with a null in a column that matters are void, repeated ones count once."""
    dated = entries.where("list_name is not null and pattern is not null and effective is not null and action in ('add', 'remove')")
    changes = dated.groupBy("list_name", F.lower("pattern").alias("pattern"), "effective").agg(F.max("action").alias("action"))
    w = Window.partitionBy("list_name", "pattern").orderBy("effective")
    return changes.select("list_name", "pattern", "action", F.col("effective").alias("valid_from"), F.lead("effective").over(w).alias("valid_to")).where("action = 'add'").drop("action")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (capture_id, url, fetched: timestamp) and dated entries -> (capture_id, host, fetched, n_active, lists,
    since, blocked), a row for each capture.

    An entry matches its host and all hosts below it while valid_from <= fetched < valid_to. n_active counts
    matching (list, pattern) pairs, lists joins their lists' names, since is the latest valid_from.

    Patterns meet hosts first, each of which is there once, so that a list's entry for a whole domain is no key of captures. The as-of
    join then meets on host and month, into which intervals are cut. Captures are taken together by (host, fetched) before it, and
    a host with more than 1/MOST_HOT of these is dealt to several keys, in each of which its intervals are; such hosts
    are fewer than MOST_HOT, so their list is broadcast. Captures without host or time match nothing; URLs of any length are read
    for their host only; repeated captures are rows of their own; without entries nothing is blocked, without captures there are no rows.
    """
    own = captures.select("capture_id", host(F.col("url")).alias("host"), F.col("fetched").cast("timestamp").alias("fetched"))
    known = (F.col("host") != "") & F.col("fetched").isNotNull()
    seen = own.where(known).select("host", "fetched").distinct()
    per = seen.groupBy("host").agg(F.count(F.lit(1)).alias("times"))
    first, last, every = own.agg(F.min("fetched"), F.max("fetched"), F.count(F.lit(1))).first()
    part = max(1, every // MOST_HOT)
    hot = F.broadcast(per.where(F.col("times") > part).select("host", F.ceil(F.col("times") / part).cast("int").alias("salts")))

    names = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, k, F.size(names)), "."))
    active = intervals(entries).withColumn("valid_from", F.col("valid_from").cast("timestamp")).withColumn("valid_to", F.col("valid_to").cast("timestamp"))
    listed = per.select("host", F.explode(above).alias("pattern")).join(active, "pattern").join(hot, "host", "left")

    low, high = F.greatest("valid_from", F.lit(first).cast("timestamp")), F.least("valid_to", F.lit(last).cast("timestamp"))
    months = F.sequence(F.trunc(low, "month"), F.trunc(high, "month"), F.expr("interval 1 month"))
    cut = listed.where((low <= high) & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))).select("host", "list_name", "valid_from", "valid_to", "salts", F.explode(months).alias("month"))
    cut = cut.select("host", "list_name", "valid_from", "valid_to", "month", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    salt = F.pmod(F.xxhash64("fetched"), F.coalesce("salts", F.lit(1))).cast("int")
    asked = seen.join(hot, "host", "left").select("host", "fetched", F.trunc("fetched", "month").alias("month"), salt.alias("salt"))

    met = asked.join(cut, ["host", "month", "salt"]).where("valid_from <= fetched and (valid_to is null or fetched < valid_to)")
    verdict = met.groupBy("host", "fetched").agg(F.count(F.lit(1)).alias("n_active"), F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("lists"), F.max("valid_from").alias("since"))
    rest = own.where(~F.coalesce(known, F.lit(False)))
    judged = own.where(known).join(verdict, ["host", "fetched"], "left").unionByName(rest, allowMissingColumns=True)
    n = F.coalesce("n_active", F.lit(0)).cast("long")
    return judged.select("capture_id", "host", "fetched", n.alias("n_active"), F.coalesce("lists", F.lit("")).alias("lists"), "since", (n > 0).alias("blocked"))
