"""Queries of the streaming forms: each runs over files of submissions to their end, and its result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..sources import scan
from ..streaming import announced, jobs, timers
from .aggregates import plain
from .fixtures import pings, with_flat
from .ingestion import folder
from .registry import query

_COLUMNS = ["event_id", "document_id", "client_id", "ts", "doc_type", "raw_channel", "value", "k"]
#: A micro-batch is a file; tasks share its blocks.
BLOCKS = {"parquet.block.size": 2 << 20}


def source(spark, sf_dir, columns=_COLUMNS):
    """A stream of the submissions from a folder of files, and a folder for what comes of it."""
    path = folder(spark)
    pings(spark, sf_dir).select(*columns).repartitionByRange(4, "ts").write.options(**BLOCKS).parquet(path + "/in")
    return scan.stream_new_files(spark, path + "/in", spark.read.parquet(path + "/in").schema), path


def disordered(spark, sf_dir, columns=_COLUMNS):
    """A stream of the submissions in five micro-batches, in which a row may be an hour before rows of the batch before it; and in the
    last one a row of nobody (source and client are empty), two days after all others, that lets the watermark pass them."""
    path = folder(spark)
    df = pings(spark, sf_dir).select(*columns)
    first, last = df.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    shifted = F.unix_micros("ts") + F.col("event_id") * 7 % 60 * 60_000_000
    part = F.least(F.floor((shifted - first) * 4 / max(1, last - first)), F.lit(3))
    for k in range(4):  # files are taken by their age; all cores read the table for each
        df.where(part == k).repartition(1).write.options(**BLOCKS).mode("append").parquet(path + "/in")
    closing = df.agg(F.max("ts").alias("ts")).select(F.expr("ts + interval 2 days").alias("ts"), F.lit("").alias("client_id"), F.lit("").alias("raw_channel"), F.lit("crash").alias("doc_type"))
    df.limit(0).unionByName(closing, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(path + "/in")
    return scan.stream_new_files(spark, path + "/in", spark.read.parquet(path + "/in").schema, per_trigger=1), path


def finished(spark, df, path, mode="append", **options):
    with timers.state_store(spark):
        q = jobs.run(df, path + "/out", path + "/checkpoint", mode=mode, **options)
    q.awaitTermination()
    return spark.read.parquet(path + "/out")


def _updates(spark, df, path, mode):
    """The rows that a query in update or complete mode gives, by micro-batch."""

    def write(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/out/part={number}")

    with timers.state_store(spark):
        q = df.writeStream.outputMode(mode).option("checkpointLocation", path + "/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    return spark.read.option("basePath", path + "/out").parquet(path + "/out")


#: One row of seven comes after all others, in a file of its own.
LATE = "event_id % 7 = 3"


def late_source(spark, sf_dir, query, mode="update"):
    """Runs a query over the submissions that are on time and again over the late ones, from where it stopped -> its rows by micro-batch."""
    path = folder(spark)
    df = pings(spark, sf_dir).select(*_COLUMNS)
    df.where(f"not ({LATE})").write.parquet(path + "/in")
    schema = spark.read.parquet(path + "/in").schema
    _updates(spark, query(scan.stream_new_files(spark, path + "/in", schema)), path, mode)
    df.where(LATE).write.mode("append").parquet(path + "/in")
    return _updates(spark, query(scan.stream_new_files(spark, path + "/in", schema)), path, mode)


@query("x02_timer_emit", with_flat("""SELECT doc_type, until, CAST(sum(total) OVER w AS BIGINT) AS total, max(most) OVER w AS most
FROM (SELECT doc_type, time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS until, sum(k) AS total, CAST(max(k) AS BIGINT) AS most FROM f GROUP BY ALL) d
WINDOW w AS (PARTITION BY doc_type ORDER BY until)"""))
def timer_emit(spark, sf_dir):
    """User code that adds to a state with each submission, and whose running result leaves by a timer at the end of each day."""
    df, path = disordered(spark, sf_dir)
    add = lambda a, b: {"total": a["total"] + b["total"], "most": max(a["most"], b["most"])}
    seq = lambda s, r: add(s, {"total": r["k"], "most": r["k"]})
    finish = lambda key, until, s: {"doc_type": key[0], "until_ms": until, **s}
    own = df.select("ts", "doc_type", "client_id", F.coalesce("k", F.lit(0)).alias("k"))
    out = timers.aggregate_on_timer(own, ["doc_type"], lambda: {"total": 0, "most": -1}, seq, add, finish, "total long, most long", "doc_type string, until_ms long, total long, most long", every_s=86_400, delay_s=7200, running=True)
    return finished(spark, out, path).select("doc_type", F.timestamp_millis("until_ms").alias("until"), "total", "most")


def _late_sql(days, keys=""):
    """A late row counts if its bucket was not closed yet: if it ends after the newest time that was on time, less the horizon."""
    bucket = _BUCKET.format(86400)
    return with_flat(f"SELECT {bucket} AS bucket, {keys} count(*) AS n FROM f WHERE NOT ({LATE}) OR {bucket} + INTERVAL 1 DAY > (SELECT max(ts) FROM f WHERE NOT ({LATE})) - INTERVAL {days} DAY GROUP BY ALL")


_BUCKET = "time_bucket(INTERVAL '{} seconds', ts, TIMESTAMP '1970-01-01')"


@query("st01_bucket_counts", with_flat(f"SELECT {_BUCKET.format(86400)} AS bucket, doc_type, count(*) AS n, round(sum(value), 4) AS total FROM f GROUP BY ALL"))
def bucket_counts(spark, sf_dir):
    df, path = source(spark, sf_dir)
    counted = jobs.bucket_counts(df, [F.col("doc_type")], seconds=86_400, rows=90)
    out = _updates(spark, counted, path, "complete")  # ST3: the full output; the last micro-batch has all
    last = out.agg(F.max("batch").alias("batch"))
    return out.join(F.broadcast(last), "batch").select("bucket", "doc_type", "n", F.round("total", 4).alias("total"))  # one row


@query("st03_delta_output", with_flat(f"SELECT {_BUCKET.format(86400)} AS bucket, count(*) AS n FROM f GROUP BY 1"))
def delta_output(spark, sf_dir):
    """Changed buckets by micro-batch; the newest row of a bucket is its count."""
    df, path = source(spark, sf_dir)
    out = _updates(spark, jobs.bucket_counts(df, [], seconds=86_400, rows=90), path, "update")
    return out.groupBy("bucket").agg(F.max_by("n", "batch").alias("n"))


@query("st02_horizon_stream", _late_sql(2))
def horizon_stream(spark, sf_dir):
    """A horizon of two buckets of a day: of the late rows only those within it are counted."""
    out = late_source(spark, sf_dir, lambda df: jobs.bucket_counts(df, [], seconds=86_400, rows=2))
    return out.groupBy("bucket").agg(F.max_by("n", "batch").alias("n"))


@query("st02_horizon_batch", with_flat("SELECT event_id FROM f WHERE epoch(ts) > (SELECT max(epoch(ts)) FROM f) - 2 * 86400"))
def horizon(spark, sf_dir):
    df = pings(spark, sf_dir)
    newest = df.agg(F.max("ts").alias("newest"))
    return df.join(F.broadcast(newest)).where("ts > newest - interval 2 days").select("event_id")  # one row


@query("st05_unique_within", with_flat("SELECT DISTINCT document_id FROM f"))
def unique(spark, sf_dir):
    df, path = source(spark, sf_dir)
    return finished(spark, jobs.unique_within(df, "40 days"), path).select("document_id")


@query("st05_duplicate_counts", with_flat(f"SELECT bucket, CAST(sum(n - 1) AS BIGINT) AS repeats FROM (SELECT {_BUCKET.format(86400)} AS bucket, document_id, count(*) AS n FROM f GROUP BY ALL) t GROUP BY 1"))
def duplicate_counts(spark, sf_dir):
    df, path = source(spark, sf_dir)
    out = _updates(spark, jobs.duplicate_counts(df, horizon="60 days"), path, "update")
    newest = out.groupBy("bucket", "document_id").agg(F.max_by("repeats", "batch").alias("repeats"))
    return newest.groupBy("bucket").agg(F.sum("repeats").alias("repeats"))


@query("st06_channel_events", with_flat(""", l AS (SELECT *, lag(channel) OVER (PARTITION BY client_id ORDER BY ts, event_id) AS b FROM f)
SELECT day, channel, kind, count(*) AS n FROM (SELECT CAST(submission_date AS VARCHAR) AS day, channel, 'new' AS kind FROM l WHERE b IS NULL UNION ALL SELECT CAST(submission_date AS VARCHAR), b, 'out' FROM l WHERE b <> channel UNION ALL SELECT CAST(submission_date AS VARCHAR), channel, 'in' FROM l WHERE b <> channel) e GROUP BY ALL"""))
def channel_events(spark, sf_dir):
    df, path = disordered(spark, sf_dir)
    out = finished(spark, timers.channel_events(df.withColumn("channel", N.norm_channel(F.col("raw_channel"))), delay="2 hours"), path).where("client_id <> ''")
    return plain(out.groupBy("day", "channel", "kind").agg(F.count(F.lit(1)).alias("n")))


@query("st07_last_seen", with_flat("SELECT client_id, max(ts) AS last_seen, max(ts) + INTERVAL 2 DAY < (SELECT max(ts) FROM f) - INTERVAL 1 HOUR AS forgotten FROM f GROUP BY 1"))
def last_seen(spark, sf_dir):
    """Clients idle for two days at the end are forgotten then."""
    df, path = source(spark, sf_dir)
    out = _updates(spark, timers.last_seen(df, ttl_days=2), path, "update")
    return out.groupBy("client_id").agg(F.max("last_seen").alias("last_seen"), F.max_by("forgotten", F.struct("last_seen", "batch")).alias("forgotten"))


@query("st08_late_rows", _late_sql(10, "doc_type,"))
def late_rows(spark, sf_dir):
    """Rows later than ten days are dropped, others are added to their bucket."""
    out = late_source(spark, sf_dir, lambda df: jobs.bucket_counts(df, [F.col("doc_type")], seconds=86_400, rows=10))
    return out.groupBy("bucket", "doc_type").agg(F.max_by("n", "batch").alias("n"))


@query("st09_merged_hosts", with_flat("SELECT time_bucket(INTERVAL '60 seconds', ts, TIMESTAMP '1970-01-01') AS bucket, doc_type AS name, round(sum(value), 4) AS value FROM f GROUP BY ALL"))
def merged_hosts(spark, sf_dir):
    df, path = source(spark, sf_dir)
    own = df.select("ts", F.col("doc_type").alias("name"), (F.col("event_id") % 3).alias("host"), "value")
    out = _updates(spark, jobs.merged_hosts(own, hours=24 * 60), path, "complete")
    last = out.agg(F.max("batch").alias("batch"))
    return out.join(F.broadcast(last), "batch").select("bucket", "name", F.round("value", 4).alias("value"))  # one row


@query(
    "st10_throttled",
    with_flat(""", a AS (SELECT raw_channel AS source, ts, arg_min(document_id, event_id) AS alert FROM f WHERE doc_type = 'crash' GROUP BY ALL),
r AS (WITH RECURSIVE t(source, ts) AS (SELECT source, min(ts) FROM a GROUP BY 1 UNION ALL SELECT t.source, min(a.ts) FROM t JOIN a ON a.source = t.source AND a.ts >= t.ts + INTERVAL 1 HOUR GROUP BY t.source, t.ts) SELECT * FROM t)
SELECT source, ts, alert FROM r JOIN a USING (source, ts)"""),
)
def throttled(spark, sf_dir):
    """Whether an alert passes depends on the last that passed, so the SQL is recursive."""
    df, path = disordered(spark, sf_dir)
    alerts = df.where("doc_type = 'crash'").select(F.col("raw_channel").alias("source"), "ts", "event_id", F.col("document_id").alias("alert"))
    return finished(spark, timers.throttled(alerts, delay="2 hours"), path).where("source <> ''")


@query("st11_restart", with_flat("SELECT event_id FROM f"))
def restart(spark, sf_dir):
    """A query that stops half way and goes on from its checkpoint gives each row once."""
    df, path = source(spark, sf_dir)
    one = scan.stream_new_files(spark, path + "/in", df.schema, per_trigger=1)
    q = jobs.run(one.select("event_id"), path + "/out", path + "/checkpoint", every="1 seconds")
    q.processAllAvailable()
    q.stop()
    return finished(spark, one.select("event_id"), path)


@query("st12_fan_out", with_flat("SELECT 'summary' AS sink, event_id FROM f WHERE doc_type = 'main' UNION ALL SELECT 'original', event_id FROM f"))
def fan_out(spark, sf_dir):
    df, path = source(spark, sf_dir)
    sinks = [(path + "/summary", lambda b: b.where("doc_type = 'main'").select("event_id")), (path + "/original", lambda b: b.select("event_id"))]
    jobs.fan_out(df, sinks, path + "/checkpoint").awaitTermination()
    read = lambda name: spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("sink"), "event_id")
    return read("summary").unionByName(read("original"))


@query("st13_rolled_folders", with_flat("SELECT doc_type, count(*) AS n, TRUE AS by_size, TRUE AS by_age FROM f GROUP BY 1"))
def rolled(spark, sf_dir):
    """Folders by type; a file has 40 rows at most, and none has rows of two micro-batches, of which there is one for each input file."""
    df, path = source(spark, sf_dir)
    one = scan.stream_new_files(spark, path + "/in", df.schema, per_trigger=1)
    own = one.select("event_id", "doc_type", F.col("_metadata.file_name").alias("origin"))
    out = finished(spark, own, path, partition_by=["doc_type"], roll_rows=40)
    files = out.withColumn("file", F.col("_metadata.file_path")).groupBy("doc_type", "file").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("origin").alias("origins"))
    return files.groupBy("doc_type").agg(F.sum("n").alias("n"), (F.max("n") <= 40).alias("by_size"), (F.max("origins") == 1).alias("by_age"))


@query("st13_filled_batches", with_flat("SELECT doc_type, count(*) AS n, TRUE AS by_size, TRUE AS by_age FROM f GROUP BY 1"))
def filled_batches(spark, sf_dir):
    """Folders by type; files are of 200 KB, none has twice that, nor rows of two micro-batches."""
    df, path = source(spark, sf_dir)
    one = scan.stream_new_files(spark, path + "/in", df.schema, per_trigger=1).select("*", F.col("_metadata.file_name").alias("origin"))
    jobs.run_filled(one, path + "/out", path + "/checkpoint", by=["doc_type"], target=200_000).awaitTermination()
    out = spark.read.parquet(path + "/out").withColumns({"file": F.col("_metadata.file_path"), "size": F.col("_metadata.file_size")})
    files = out.groupBy("doc_type", "file", "size").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("origin").alias("origins"))
    return files.groupBy("doc_type").agg(F.sum("n").alias("n"), (F.max("size") <= 400_000).alias("by_size"), (F.max("origins") == 1).alias("by_age"))


@query("s06_stream_new_files", with_flat("SELECT event_id, k FROM f"))
def new_files(spark, sf_dir):
    df, path = source(spark, sf_dir)
    return finished(spark, df.select("event_id", "k"), path)


@query("s06_announced_objects", with_flat("SELECT event_id, k FROM f"))
def announced_objects(spark, sf_dir):
    """Objects are files by day, whose names come as a stream, some of them again, and one of an object that is not there."""
    path = folder(spark)
    pings(spark, sf_dir).select("event_id", "k", "submission_date").repartition("submission_date").write.partitionBy("submission_date").parquet(path + "/objects")
    stored = spark.read.parquet(path + "/objects")
    names = stored.select(F.concat(F.lit(path + "/objects/submission_date="), F.col("submission_date").cast("string")).alias("path"), F.day("submission_date").alias("d")).distinct()
    again = names.where("d % 3 = 0").unionByName(spark.createDataFrame([(path + "/objects/none", 0)], "path string, d int"))
    for n, some in enumerate((names.where("d < 20"), names.where("d >= 20").unionByName(again))):
        some.coalesce(1).select("path").write.mode("append").parquet(f"{path}/announced/{n}")
    stream = spark.readStream.schema("path string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path + "/announced")
    announced.ingest(stream, path + "/taken", stored.select("event_id", "k").schema, path + "/checkpoint").awaitTermination()
    return announced.read_rows(spark, path + "/taken")


@query("st04_final_emission", with_flat("SELECT channel, count(*) AS n FROM f GROUP BY 1"))
def final_emission(spark, sf_dir):
    df, path = source(spark, sf_dir)
    counted = df.groupBy(N.norm_channel(F.col("raw_channel")).alias("channel")).agg(F.count(F.lit(1)).alias("n"))
    out = _updates(spark, counted, path, "complete")
    last = out.agg(F.max("batch").alias("batch"))
    return out.join(F.broadcast(last), "batch").select("channel", "n")  # one row
