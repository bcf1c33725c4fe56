"""Queries of data quality, time series and joins over places."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import derive, geo, history, quality, series, user
from .aggregates import plain
from .fixtures import pings, with_flat
from .registry import folder, query, table


def _channelled(spark, sf_dir):
    return pings(spark, sf_dir).withColumn("channel", N.norm_channel(F.col("raw_channel")))


_HOURS = "CAST(floor((epoch_us(ts) - epoch_us(created)) / 3600000000.0) AS BIGINT)"


@query(
    "a27_latency_percentiles",
    with_flat(f""", n AS (SELECT *, raw_channel || ':' || doc_type AS series, ts - (k % 30) * INTERVAL '37' MINUTE AS created, (SELECT max(ts) FROM f) AS now FROM f),
h AS (SELECT *, {_HOURS} AS lag_h, epoch_us(now) - epoch_us(ts) AS age FROM n),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series, client_id ORDER BY ts DESC, event_id DESC) AS r FROM h) t WHERE r = 1 AND age <= 42 * 86400000000),
v AS (SELECT series, 'last_seen' AS metric, age // 86400000000 AS value FROM l UNION ALL SELECT series, 'client_delay', lag_h FROM l UNION ALL SELECT series, 'delay_24h', lag_h FROM h WHERE age < 86400000000 UNION ALL SELECT series, 'delay_7d', lag_h FROM h WHERE age < 7 * 86400000000)
SELECT series, metric, CAST(quantile_disc(value, 0.5) AS DOUBLE) AS median, CAST(quantile_disc(value, 0.75) AS DOUBLE) AS p75, CAST(quantile_disc(value, 0.99) AS DOUBLE) AS p99 FROM v GROUP BY ALL"""),
)
def latency(spark, sf_dir):
    df = pings(spark, sf_dir).withColumn("creation_ts", F.expr("timestampadd(MINUTE, -37 * (k % 30), ts)"))
    return quality.latency_percentiles(df.select("client_id", F.col("raw_channel").alias("channel"), F.col("doc_type").alias("reason"), "ts", "event_id", "creation_ts"))


@query("t04_nearest_rank", with_flat("SELECT channel, CAST(quantile_disc(seconds, 0.75) AS DOUBLE) AS p75 FROM f GROUP BY 1"))
def nearest(spark, sf_dir):
    return _channelled(spark, sf_dir).groupBy("channel").agg(F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY seconds)").alias("p75"))


@query("a28_error_tally", with_flat("SELECT coalesce(CASE k % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'gzip' WHEN 2 THEN 'uri' END, '<none>') AS error, count(*) AS n FROM f GROUP BY 1"))
def tally(spark, sf_dir):
    error = F.get(F.array(F.lit("json"), F.lit("gzip"), F.lit("uri")), F.col("k") % 4)
    return quality.error_tally(pings(spark, sf_dir).withColumn("error", error))


@query("a29_duplicate_report", with_flat("SELECT CAST(submission_date AS VARCHAR) AS day, channel, count(*) AS duplicates, count(DISTINCT client_id) AS clients FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY ts, event_id) AS r FROM f) t WHERE r > 1 GROUP BY ALL"))
def duplicates(spark, sf_dir):
    return plain(quality.duplicate_report(_channelled(spark, sf_dir)))


#: The last week, in which one submission of ten sends an old document again, is held against the days before it.
_NEW = "submission_date > (SELECT max(submission_date) FROM f) - 7"
_AGAIN = "CASE WHEN event_id % 10 = 0 THEN CAST(CAST(FLOOR(event_id / 20) AS BIGINT) AS {}) ELSE document_id END"


@query(
    "a29_repeats_of_history",
    with_flat(f"SELECT CAST(submission_date AS VARCHAR) AS day, channel, count(*) AS duplicates, count(DISTINCT client_id) AS clients FROM f WHERE {_NEW} AND {_AGAIN.format('VARCHAR')} IN (SELECT document_id FROM f WHERE NOT {_NEW}) GROUP BY ALL"),
)
def repeats(spark, sf_dir):
    path, df = folder(spark), _channelled(spark, sf_dir)
    first = F.lit(df.agg(F.max("submission_date")).first()[0] - timedelta(6))
    history.add(df.where(F.col("submission_date") < first), path, buckets=4)
    return plain(history.repeats(df.where(F.col("submission_date") >= first).withColumn("document_id", F.expr(_AGAIN.format("string"))), path, buckets=4))


@query("u04_unique_documents", with_flat("SELECT document_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY ts, event_id) AS r FROM f) t WHERE r = 1"))
def unique(spark, sf_dir):
    return quality.unique_documents(pings(spark, sf_dir).select("document_id", "event_id", "ts")).select("document_id", "event_id")


@query(
    "a30_channel_switches",
    with_flat(""", l AS (SELECT *, lag(channel) OVER (PARTITION BY client_id ORDER BY ts, event_id) AS b FROM f), e AS (SELECT submission_date AS day, channel, 'new' AS kind FROM l WHERE b IS NULL UNION ALL SELECT submission_date, b, 'out' FROM l WHERE b <> channel UNION ALL SELECT submission_date, channel, 'in' FROM l WHERE b <> channel)
SELECT CAST(day AS VARCHAR) AS day, channel, count(*) FILTER (WHERE kind = 'new') AS "new", count(*) FILTER (WHERE kind = 'in') AS switched_in, count(*) FILTER (WHERE kind = 'out') AS switched_out FROM e GROUP BY ALL"""),
)
def switches(spark, sf_dir):
    return plain(quality.channel_switches(_channelled(spark, sf_dir)))


_JSON = "json_object('n', k, 'os', raw_os, 'on', is_default, 'sub', json_object('x', k % 3))"


_BUCKET = "time_bucket(INTERVAL '{} seconds', ts, TIMESTAMP '1970-01-01')"
_LAST = "arg_max({}, (ts, event_id))"


@query(
    "a31_merge_json_counts",
    with_flat(f"""SELECT path, kind, number, other FROM (
  SELECT 'n' AS path, 'number' AS kind, CAST(sum(k) AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS other FROM f UNION ALL SELECT 'sub.x.deep', 'number', CAST(sum(k % 3) AS DOUBLE), NULL FROM f
  UNION ALL SELECT 'list[' || i || ']', 'number', CAST(sum(k) AS DOUBLE), NULL FROM f, range(0, 3) r(i) WHERE i <= event_id % 3 GROUP BY i
  UNION ALL SELECT 'digits', 'string', NULL, {_LAST.format("'00' || k")} FROM f
  UNION ALL SELECT 'os', 'string', NULL, {_LAST.format("raw_os")} FROM f UNION ALL SELECT 'on', 'boolean', NULL, {_LAST.format("CASE WHEN is_default THEN 'true' ELSE 'false' END")} FROM f) t"""),
)
def merge_json(spark, sf_dir):
    """Objects, arrays of different lengths, texts of digits, and three levels."""
    k = F.col("k")
    items = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")), lambda _: k)
    doc = F.to_json(F.struct(k.alias("n"), F.col("raw_os").alias("os"), F.col("is_default").alias("on"), F.struct(F.struct((k % 3).alias("deep")).alias("x")).alias("sub"), items.alias("list"), F.concat(F.lit("00"), k.cast("string")).alias("digits")))
    rows = series.flattened(pings(spark, sf_dir).select("ts", "event_id", doc.alias("doc")), "doc")
    return series.merge_json_counts(rows)


@query(
    "sf13_deep_merge",
    with_flat(f""", h AS (SELECT raw_os, event_id, ts, k, k % 2 = 0 AS even, {_LAST.replace("arg_max", "arg_min").format("k % 2 = 0")} OVER (PARTITION BY raw_os) AS first FROM f)
  SELECT raw_os, 'v.x' AS path, 'number' AS kind, CAST(sum(k) AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS other FROM h WHERE even AND first GROUP BY raw_os
  UNION ALL SELECT raw_os, 'v', 'number', CAST(sum(k) AS DOUBLE), NULL FROM h WHERE NOT even AND NOT first GROUP BY raw_os
  UNION ALL SELECT raw_os, 'n', 'number', CAST(count(*) AS DOUBLE), NULL FROM h GROUP BY raw_os"""),
)
def deep_merge(spark, sf_dir):
    """By system: v is an object in some rows and a number in others; what comes first decides."""
    k = F.col("k").cast("string")
    doc = F.when(F.col("k") % 2 == 0, F.concat(F.lit('{"n":1,"v":{"x":'), k, F.lit("}}"))).otherwise(F.concat(F.lit('{"n":1,"v":'), k, F.lit("}")))
    rows = series.flattened(pings(spark, sf_dir).select("raw_os", "ts", "event_id", doc.alias("doc")), "doc")
    return series.merge_json_counts(rows, ["raw_os"])


@query(
    "a32_merge_series",
    with_flat(f""", hs AS (SELECT doc_type AS series, {_BUCKET.format(86400)} AS bucket, event_id % 3 AS host, count(*) AS n, min(k) AS lo, max(k) AS hi FROM f GROUP BY ALL)
SELECT series, bucket, name, aggregation, CAST(CASE aggregation WHEN 'sum' THEN sum(n) WHEN 'min' THEN min(lo) ELSE max(hi) END AS DOUBLE) AS value FROM hs, (VALUES ('n', 'sum'), ('lo', 'min'), ('hi', 'max')) a(name, aggregation) GROUP BY series, bucket, name, aggregation"""),
)
def merge_series(spark, sf_dir):
    per = pings(spark, sf_dir).groupBy(F.col("doc_type").alias("series"), series.bucket(F.col("ts"), 86_400).alias("bucket"), (F.col("event_id") % 3).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    one = lambda name, how: F.struct(F.lit(name).alias("name"), F.lit(how).alias("aggregation"), F.col(name).cast("double").alias("value"))
    nothing = F.struct(F.lit("n").alias("name"), F.lit("sum").alias("aggregation"), F.lit(float("nan")).alias("value"))
    rows = per.select("series", "bucket", F.explode(F.array(one("n", "sum"), one("lo", "min"), one("hi", "max"), nothing)).alias("v")).select("series", "bucket", "v.*")
    return series.merge_series(rows)


_COUNTER = "(event_id * 7 + k) % 1000"


@query("a33_counter_deltas", with_flat(f"SELECT event_id, CASE WHEN b IS NULL THEN NULL WHEN c >= b THEN c - b ELSE c END AS delta FROM (SELECT event_id, {_COUNTER} AS c, lag({_COUNTER}) OVER (PARTITION BY raw_os ORDER BY ts, event_id) AS b FROM f) t"))
def deltas(spark, sf_dir):
    df = pings(spark, sf_dir).withColumn("counter", F.expr(_COUNTER))
    return quality.counter_deltas(df, "raw_os", "counter").select("event_id", "delta")


@query("w04_lag_reset", with_flat(f"SELECT event_id, b AS before, c < b AS reset FROM (SELECT event_id, {_COUNTER} AS c, lag({_COUNTER}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM f) t"))
def lag_reset(spark, sf_dir):
    from pyspark.sql import Window

    before = F.lag(F.expr(_COUNTER)).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return pings(spark, sf_dir).select("event_id", before.alias("before"), (F.expr(_COUNTER) < before).alias("reset"))


@query(
    "a34_output_health",
    with_flat(""", o AS (SELECT 'out' || (user_id % 9) AS name, ts, event_id, k % 20 AS failures, CAST(event_id AS BIGINT) // 1000 AS messages FROM f),
a AS (SELECT *, failures > coalesce(max(failures) OVER (PARTITION BY name ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rose, CASE WHEN messages IS NOT DISTINCT FROM lag(messages) OVER (PARTITION BY name ORDER BY ts, event_id) THEN 0 ELSE 1 END AS ch FROM o),
b AS (SELECT *, sum(ch) OVER (PARTITION BY name ORDER BY ts, event_id) AS run FROM a),
d AS (SELECT *, epoch_us(ts) - epoch_us(first_value(ts) OVER (PARTITION BY name, run ORDER BY ts, event_id)) > 60000000 AND name <> 'out3' AS stalled FROM b),
e AS (SELECT name, date_trunc('hour', ts) AS hour, ts, event_id, CASE WHEN stalled THEN name || ' ProcessMessageCount has stalled at ' || messages WHEN rose THEN name || ' ProcessFileFailures has increased to ' || failures END AS alert FROM d)
SELECT name, hour, ts, alert FROM (SELECT *, row_number() OVER (PARTITION BY name, hour ORDER BY ts, event_id) AS r FROM e WHERE alert IS NOT NULL) t WHERE r = 1"""),
)
def health(spark, sf_dir):
    df = pings(spark, sf_dir).select(F.concat(F.lit("out"), (F.col("user_id") % 9).cast("string")).alias("name"), "ts", "event_id", (F.col("k") % 20).alias("failures"), F.floor(F.col("event_id") / 1000).alias("messages"))
    return quality.output_health(df, ["out3"])


_CHANNELS = ", ".join(f"count(*) FILTER (WHERE channel = '{c}') AS {c}" for c in N.CHANNELS)


@query("a35_counts_by_channel", with_flat(f"SELECT {_BUCKET.format(60)} AS bucket, {_CHANNELS} FROM f GROUP BY 1"))
def by_channel(spark, sf_dir):
    return series.counts_by_channel(pings(spark, sf_dir), N.norm_channel(F.col("raw_channel")))


@query("a36_request_rates", with_flat(f"SELECT {_BUCKET.format(60)} AS bucket, count(*) AS requests FROM f GROUP BY 1"))
def rates(spark, sf_dir):
    return series.request_rates(pings(spark, sf_dir))


@query("a37_dnt_status", with_flat(f"""SELECT {_BUCKET.format(3600)} AS bucket, count(*) FILTER (WHERE k % 3 = 1) AS "on", count(*) FILTER (WHERE k % 3 = 0) AS "off", count(*) FILTER (WHERE k % 3 = 2) AS unknown FROM f GROUP BY 1"""))
def dnt(spark, sf_dir):
    value = F.when(F.col("k") % 3 != 2, (F.col("k") % 3).cast("string")).when(F.col("k") % 2 == 0, "x")
    return series.dnt_status(pings(spark, sf_dir), value, 3600)


@query("a38_no_new_data", with_flat(f""", b AS (SELECT client_id AS series, {_BUCKET.format(3600)} AS bucket FROM f) SELECT series, max(bucket) AS last, max(bucket) < (SELECT max(bucket) FROM b) AS silent FROM b GROUP BY 1"""))
def silent(spark, sf_dir):
    return quality.no_new_data(pings(spark, sf_dir).select(F.col("client_id").alias("series"), series.bucket(F.col("ts"), 3600).alias("bucket")), 3600)


@query("t02_horizon", with_flat(f", b AS (SELECT event_id, {_BUCKET.format(3600)} AS bucket FROM f) SELECT event_id FROM b WHERE epoch(bucket) > (SELECT max(epoch(bucket)) FROM b) - 24 * 3600"))
def horizon(spark, sf_dir):
    df = pings(spark, sf_dir).select("event_id", series.bucket(F.col("ts"), 3600).alias("bucket"))
    return series.horizon(df, 24, 3600).select("event_id")


@query("t03_ordered_cohorts", with_flat("SELECT channel, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, channel"))
def ordered(spark, sf_dir):
    return _channelled(spark, sf_dir).groupBy("channel").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "channel")


@query("s18_series_to_wide", with_flat(f"""SELECT strftime({_BUCKET.format(86400)}, '%Y-%m-%d %H:%M:%S') AS "Time", CAST(sum(CASE WHEN doc_type = 'main' THEN k END) AS BIGINT) AS main, CAST(sum(CASE WHEN doc_type = 'crash' THEN k END) AS BIGINT) AS crash, CAST(sum(CASE WHEN doc_type = 'saved-session' THEN k END) AS BIGINT) AS "saved-session" FROM f GROUP BY 1"""))
def wide(spark, sf_dir):
    long = pings(spark, sf_dir).select(series.bucket(F.col("ts"), 86_400).alias("bucket"), F.col("doc_type").alias("name"), F.col("k").alias("value"))
    return series.series_to_wide(long, ["main", "crash", "saved-session"])


@query("s19_offset_gaps", with_flat("""SELECT topic, "partition", "offset", expected, "offset" - expected AS difference FROM (SELECT doc_type AS topic, user_id % 4 AS "partition", event_id AS "offset", lag(event_id) OVER (PARTITION BY doc_type, user_id % 4 ORDER BY event_id) + 1 AS expected FROM f) t WHERE "offset" <> expected"""))
def gaps(spark, sf_dir):
    return quality.offset_gaps(pings(spark, sf_dir).select(F.col("doc_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset")))


@query("st09_live_hosts", with_flat(", h AS (SELECT client_id, max(ts) AS last FROM f GROUP BY 1) SELECT event_id FROM f JOIN h USING (client_id) WHERE last >= (SELECT max(ts) FROM f) - INTERVAL '3' HOUR"))
def live_hosts(spark, sf_dir):
    return series.live_hosts(pings(spark, sf_dir).select("event_id", "ts", F.col("client_id").alias("host")), 3).select("event_id")


_IP = "16777216 * 10 + 65536 * (user_id % 40) + 256 * k + event_id % 256"


@query(
    "jn06_locate",
    with_flat(f""", nums AS (SELECT event_id, {_IP} AS n FROM f), rg AS (SELECT DISTINCT 16777216 * 10 + 65536 * (user_id % 40) + 1000 AS first, 16777216 * 10 + 65536 * (user_id % 40) + 1000 + CASE WHEN user_id % 40 % 5 = 0 THEN 64000 ELSE 20000 END AS last, 'C' || (user_id % 40 % 7) AS country FROM f WHERE user_id % 40 % 4 <> 3)
SELECT event_id, coalesce(country, '??') AS country, CASE WHEN country IS NULL THEN '??' ELSE country || '-city' END AS city FROM nums LEFT JOIN rg ON n BETWEEN first AND last"""),
)
def locate(spark, sf_dir):
    df = pings(spark, sf_dir)
    ip = F.concat_ws(".", F.lit("10"), (F.col("user_id") % 40).cast("string"), F.col("k").cast("string"), (F.col("event_id") % 256).cast("string"))
    base = F.expr("16777216L * 10 + 65536 * (user_id % 40) + 1000")
    ranges = df.where("user_id % 40 % 4 <> 3").select(base.alias("first"), (base + F.when(F.col("user_id") % 40 % 5 == 0, 64_000).otherwise(20_000)).alias("last"), F.concat(F.lit("C"), (F.col("user_id") % 40 % 7).cast("string")).alias("country")).distinct().withColumn("city", F.concat("country", F.lit("-city")))
    return geo.locate(df.select("event_id", ip.alias("ip")), ranges).select("event_id", "country", "city")


@query(
    "jn06_locate_nested",
    with_flat(f""", nums AS (SELECT event_id, {_IP} AS n FROM f), nets AS (SELECT DISTINCT 16777216 * 10 + 65536 * (user_id % 40) AS base, user_id % 40 AS net FROM f),
rg AS (SELECT base AS first, base + 65535 AS last, 'C' || (net % 7) AS country, CASE WHEN net % 2 = 0 THEN 'outer' END AS city FROM nets UNION ALL SELECT base + 5000, base + 9000, 'D' || (net % 3), 'inner' FROM nets WHERE net % 3 > 0
UNION ALL SELECT base + 6000, base + 6500, 'E', 'innermost' FROM nets WHERE net % 2 = 1)
SELECT event_id, coalesce(arg_min(country, last - first), '??') AS country, coalesce(first(city ORDER BY last - first), '??') AS city FROM nums LEFT JOIN rg ON n BETWEEN first AND last GROUP BY event_id"""),
)
def locate_nested(spark, sf_dir):
    """Ranges within ranges, of both families: odd events come from an address of the sixth version with the same last bits."""
    df = pings(spark, sf_dir)
    n = F.expr("16777216L * 10 + 65536 * (user_id % 40) + 256 * k + event_id % 256")
    group = lambda c: F.lower(F.hex(c))
    six = lambda c: F.concat(F.lit("2001:DB8::"), group(F.floor(c / 65536)), F.lit(":"), group(c % 65536))
    four = lambda c: F.concat_ws(".", *[(F.floor(c / 256**k) % 256).cast("string") for k in (3, 2, 1, 0)])
    nets = df.select(F.expr("16777216L * 10 + 65536 * (user_id % 40)").alias("base"), (F.col("user_id") % 40).alias("net")).distinct()
    part = lambda rows, a, b, country, city: rows.select((F.col("base") + a).alias("first"), (F.col("base") + b).alias("last"), country.alias("country"), city.alias("city"))
    rows = part(nets, 0, 65535, F.concat(F.lit("C"), F.col("net") % 7), F.when(F.col("net") % 2 == 0, "outer"))
    rows = rows.unionByName(part(nets.where("net % 3 > 0"), 5000, 9000, F.concat(F.lit("D"), F.col("net") % 3), F.lit("inner"))).unionByName(part(nets.where("net % 2 = 1"), 6000, 6500, F.lit("E"), F.lit("innermost")))
    ranges = rows.select(four(F.col("first")).alias("first"), four(F.col("last")).alias("last"), "country", "city").unionByName(rows.select(six(F.col("first")).alias("first"), six(F.col("last")).alias("last"), "country", "city"))
    return geo.locate(df.select("event_id", F.when(F.col("event_id") % 2 == 1, six(n)).otherwise(four(n)).alias("ip")), ranges).select("event_id", "country", "city")


@query("jn05_semi_clients", with_flat("SELECT event_id FROM f WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)"))
def semi(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"))
    return pings(spark, sf_dir).join(wanted, "user_id", "left_semi").select("event_id")


@query("jn04_targets", with_flat("SELECT doc_type, channel, n, n > 900 * 2 AS over FROM (SELECT doc_type, channel, count(*) AS n FROM f GROUP BY ALL) a JOIN (VALUES ('main'), ('crash')) t(doc_type) USING (doc_type)"))
def targets(spark, sf_dir):
    goal = spark.createDataFrame([("main", 1800), ("crash", 1800)], "doc_type string, most long")
    own = _channelled(spark, sf_dir).groupBy("doc_type", "channel").agg(F.count(F.lit(1)).alias("n"))
    return own.join(F.broadcast(goal), "doc_type").select("doc_type", "channel", "n", (F.col("n") > F.col("most")).alias("over"))  # two rows


@query("x01_user_transform", with_flat("SELECT event_id, i AS part, upper(raw_os) AS os FROM f, range(0, 3) r(i) WHERE i < k % 3"))
def transform(spark, sf_dir):
    def split(row):
        for i in range(row["k"] % 3):
            yield {"event_id": row["event_id"], "part": i, "os": row["raw_os"].upper()}

    return user.transform_rows(pings(spark, sf_dir).select("event_id", "k", "raw_os"), split, "event_id long, part long, os string")


@query("x02_user_aggregate", with_flat("SELECT doc_type, CAST(sum(k) AS BIGINT) AS total, CAST(max(k) AS BIGINT) AS most FROM f GROUP BY 1"))
def aggregate(spark, sf_dir):
    def seq(state, row):
        return {"total": state["total"] + row["k"], "most": max(state["most"], row["k"])}

    def comb(a, b):
        return {"total": a["total"] + b["total"], "most": max(a["most"], b["most"])}

    return user.aggregate_rows(pings(spark, sf_dir).select("doc_type", "k"), ["doc_type"], lambda: {"total": 0, "most": -1}, seq, comb, lambda key, s: {"doc_type": key[0], **s}, "total long, most long", "doc_type string, total long, most long")


@query("x03_column_function", with_flat("SELECT event_id, k * 2 AS twice, left(raw_channel, 3) AS short FROM f"))
def column_function(spark, sf_dir):
    return derive.derived_stream(pings(spark, sf_dir), [("event_id", "BIGINT", "event_id"), ("twice", "INTEGER", lambda: F.col("k") * 2), ("short", "VARCHAR(3)", "raw_channel")])


@query("x04_seq_comb", with_flat("SELECT channel, CAST(sum(CASE WHEN doc_type = 'crash' THEN 1 ELSE 0 END) AS BIGINT) AS crashes, count(DISTINCT client_id) AS clients FROM f GROUP BY 1"))
def seq_comb(spark, sf_dir):
    """Crashes and clients by channel in the seq and comb form: rows are added to states within tasks, then states to each other. Rows are
    taken together by client first, so that a state is two numbers."""
    rows = _channelled(spark, sf_dir).groupBy("channel", "client_id").agg(F.count_if(F.col("doc_type") == "crash").alias("n"))
    zero = lambda: {"crashes": 0, "clients": 0}
    seq = lambda s, r: {"crashes": s["crashes"] + r["n"], "clients": s["clients"] + 1}
    comb = lambda a, b: {k: a[k] + b[k] for k in a}
    return user.aggregate_rows(rows, ["channel"], zero, seq, comb, lambda key, s: {"channel": key[0], **s}, "crashes long, clients long", "channel string, crashes long, clients long")
