"""A snapshot of all clients ever seen, which one interval's rows at a time bring up to date, and the interval report by such increments.

Under one root folder: `state-*` (a row for each client, bucketed by client), `totals-*` (clients by partition), `report-*` (an interval's
rows) and `log`, a folder for each increment that names its tables. An increment writes new tables and then its log entry: until that is
whole, readers and the next increment see those of the one before it, so one that failed can be run again. Tables that are no longer
named may be deleted.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .reports import ENGINES, between

KEYS = ["country", "channel", "os"]
COUNTS = ["actives", "new_records", "five_of_seven", "default"]
_DIMS = ", ".join(f"{k}: string" for k in KEYS)
STATE = f"client_id string, first_seen date, now struct<{_DIMS}>, was struct<{_DIMS}>, active boolean, is_new boolean, mask int, is_default boolean"
TOTALS = "country string, channel string, os string, total long"
#: Buckets of the state, of which each is one task's: some 100 MB of clients each, and no fewer than the session's shuffle partitions, else Spark
#: shuffles the state to these. Their number is kept from the first increment on.
BUCKETS = 512


def next_start(start: date, mode: str) -> date:
    """The start of the interval after the one that starts so."""
    return start + timedelta({"day": 1, "week": 7}[mode]) if mode != "month" else (start.replace(day=1) + timedelta(32)).replace(day=1)


def log(spark: SparkSession, root: str) -> list[dict]:
    """The whole increments, oldest first: a small row for each."""
    try:
        rows = spark.read.schema("n int, entry string").json(f"{root}/log/*").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [json.loads(r.entry) | {"n": r.n} for r in sorted(rows, key=lambda r: r.n)]


def _bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The state at path; Spark learns of its buckets by a table in the session's catalog."""
    name = "state_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({STATE}) USING parquet CLUSTERED BY (client_id) SORTED BY (client_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def state(spark: SparkSession, root: str) -> DataFrame:
    """client_id, first_seen and now, the dimensions of the client's newest row, after the last whole increment."""
    done = log(spark, root)
    return (_bucketed(spark, done[-1]["state"], done[-1]["buckets"]) if done else spark.createDataFrame([], STATE)).select("client_id", "first_seen", "now")


def _crashes(df: DataFrame) -> Column:
    return F.when(F.col("doc_type") == "crash", F.greatest(F.coalesce(F.col("crash_count"), F.lit(1)), F.lit(0)) if "crash_count" in df.columns else F.lit(1)).otherwise(0)


def merged(rows: DataFrame, before: DataFrame, start: date, mode: str) -> DataFrame:
    """The state after an interval: its rows, reduced to one for each client, and the state before it meet by client. The latter is bucketed and not
    shuffled. Rows without a client take no part."""
    bit = F.pow(F.lit(2), F.dayofweek("timestamp") - 1 if mode == "week" else F.lit(0)).cast("int")
    order = F.struct("timestamp", "event_id")
    per = rows.where("client_id is not null").groupBy("client_id").agg(
        F.max_by(F.struct(*KEYS), order).alias("new"), F.max_by("default", order).alias("new_default"), F.bit_or(bit).alias("new_mask"), F.min_by("profile_creation_timestamp", order).alias("profile"), F.min(F.to_date("timestamp")).alias("day")
    )
    met = before.join(per, "client_id", "full_outer")
    seen = F.col("new").isNotNull()
    fresh = seen & F.col("now").isNull() & (F.col("profile") >= F.lit(start).cast("timestamp"))
    return met.select("client_id", F.coalesce("first_seen", "day").alias("first_seen"), F.coalesce("new", "now").alias("now"), F.when(seen, F.col("now")).alias("was"), seen.alias("active"), F.coalesce(fresh, F.lit(False)).alias("is_new"), F.col("new_mask").alias("mask"), F.coalesce("new_default", F.lit(False)).alias("is_default"))


def _entry(paths: dict[str, str], start: date, mode: str, buckets: int) -> str:
    """What the log says of an increment."""
    return json.dumps(paths | {"start": start.isoformat(), "mode": mode, "buckets": buckets})


def advance(spark: SparkSession, root: str, df: DataFrame, start: date, mode: str = "week", *, day_column: str = "submission_date", buckets: int = BUCKETS) -> DataFrame:
    """Brings the snapshot under root up to date with the rows of df in the interval that starts so, and gives that interval's report, as
    reports.interval_report has it. Only that interval is read of df (day_column is its partition column), and of the past a row for each client.

    Intervals come in order; one may have no rows. Once an interval is in the log, it or an earlier one is refused, as is one that another
    writer logged meanwhile. A client moves from its partition's total to another's with its newest row, so totals are carried by differences.
    """
    done = log(spark, root)
    last = done[-1] if done else None
    if last and (date.fromisoformat(last["start"]) >= start or last["mode"] != mode):
        raise ValueError(f"the snapshot has {last['mode']} {last['start']} already")
    n, buckets = (last["n"] + 1, last["buckets"]) if last else (0, buckets)
    name = lambda kind: f"{root}/{kind}-{n:06d}-{uuid.uuid4().hex}"
    paths = {kind: name(kind) for kind in ("state", "totals", "report")}
    rows = between(df, start, next_start(start, mode), day_column)

    table = f"writing_{uuid.uuid4().hex}"
    merged(rows, state(spark, root), start, mode).write.bucketBy(buckets, "client_id").sortBy("client_id").option("path", paths["state"]).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay
    now = _bucketed(spark, paths["state"], buckets).where("active")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    count = lambda c, as_: F.when(c, 1).otherwise(0).cast("long").alias(as_)
    enters = F.struct("now.*", one.alias("held"), one.alias("actives"), count(F.col("is_new"), "new_records"), count(F.bit_count("mask") >= 5, "five_of_seven"), count(F.col("is_default"), "default"))
    leaves = F.struct("was.*", (-one).alias("held"), *[none.alias(c) for c in COUNTS])
    changes = now.select(F.explode(F.when(F.col("was").isNull(), F.array(enters)).otherwise(F.array(enters, leaves))).alias("c")).select("c.*")
    sums = rows.where("client_id is not null").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"), F.sum("hours").alias("hours"), F.sum(_crashes(rows)).alias("crashes"), *[F.sum(e).alias(e) for e in ENGINES])
    totals = spark.read.schema(TOTALS).parquet(last["totals"]) if last else spark.createDataFrame([], TOTALS)
    parts = changes.unionByName(sums, allowMissingColumns=True).unionByName(totals.withColumnRenamed("total", "held"), allowMissingColumns=True)
    whole = parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in KEYS])
    zero = lambda c: F.coalesce(F.col(c), none).cast("long")
    own = whole.select(*KEYS, "rows", zero("held").alias("total"), "hours", *[zero(c).alias(c) for c in (*COUNTS, "crashes", *ENGINES)])
    own.write.parquet(paths["report"])  # a row for each partition ever seen
    written = spark.read.schema(own.schema).parquet(paths["report"])
    written.select(*KEYS, "total").write.parquet(paths["totals"])

    spark.createDataFrame([(n, _entry(paths, start, mode, buckets))], "n int, entry string").coalesce(1).write.mode("error").json(f"{root}/log/{n:06d}")
    return _report(written, start)


def _report(written: DataFrame, start: date) -> DataFrame:
    inactives = (F.col("total") - F.col("actives")).alias("inactives")
    rest = ["crashes", "default", *ENGINES]
    return written.where("rows > 0").select(F.col("country").alias("geo"), "channel", "os", F.lit(start).alias("date"), "actives", "hours", inactives, "new_records", "five_of_seven", F.col("total").alias("total_records"), *rest)


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """The reports of all whole increments, null without any."""
    out = None
    for entry in log(spark, root):
        one = _report(spark.read.parquet(entry["report"]), date.fromisoformat(entry["start"]))
        out = one if out is None else out.unionByName(one)
    return out


def as_of(rows: DataFrame, before: DataFrame, value: Column, *, carried: str) -> DataFrame:
    """rows with first_seen and value, each client's last value that is not null so far: of the rows of this interval, else what before (client_id,
    first_seen, and the column carried) has of earlier ones. Clients' rows are ordered within the interval only. Rows without a client have neither."""
    w = Window.partitionBy("client_id")
    so_far = w.orderBy("timestamp", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("_first", F.min(F.to_date("timestamp")).over(w)).withColumn("_last", F.last(value, ignorenulls=True).over(so_far))
    known = before.select("client_id", F.col("first_seen").alias("_seen"), F.col(carried).alias("_carried"))
    met = own.join(known, "client_id", "left")
    is_client = F.col("client_id").isNotNull()
    names = [c for c in rows.columns if c not in ("first_seen", "value")]
    return met.select(*names, F.when(is_client, F.coalesce("_seen", "_first")).alias("first_seen"), F.when(is_client, F.coalesce("_last", "_carried")).alias("value"))
