"""Queries of ingestion: routing, decoding, derivations, and round trips through sources and sinks."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as N
from ..functions.normalize import iso_countries
from ..operators import decode, derive
from ..sources import filled, index, scan, sinks, versions
from .aggregates import plain
from .fixtures import crashes, mains, nested, pings, with_flat
from .registry import folder, query, table


def _raw(spark, sf_dir):
    """Submissions over HTTP: most are well formed, some have a part too few, too many or too long."""
    k = F.col("k")
    to = lambda *parts: F.concat_ws("/", F.lit(""), *[F.lit(p) if isinstance(p, str) else p for p in parts])
    own = [F.col("document_id"), F.col("doc_type"), "Browser", F.col("raw_channel")]
    path = (
        F.when(k == 0, None)
        .when(k == 1, F.lit("/submit/"))
        .when(k < 4, to("other", "telemetry", F.col("document_id")))
        .when(k < 8, to("submit", "nowhere", F.col("document_id")))
        .when(k < 12, F.lit("/submit/telemetry/"))
        .when(k < 16, to("submit", "telemetry", F.col("document_id"), "main"))
        .when((k >= 20) & (k < 30), to("submit", "telemetry", *own, "more", ""))
        .when((k >= 30) & (k < 34), to("submit", "telemetry", *own, "x" * 250))
        .otherwise(F.concat(F.lit("/"), to("submit", F.when(k % 2 == 0, "telemetry").otherwise("plain"), *own)))
    )
    payload = F.when((k >= 16) & (k < 20), F.repeat(F.col("props"), 40)).otherwise(F.col("props"))
    ip = F.when(k % 3 == 0, F.concat(F.lit("10.0.0."), k.cast("string"), F.lit(", 1.1.1.1")))
    return pings(spark, sf_dir).select("event_id", path.alias("path"), payload.alias("payload"), ip.alias("forwarded_for"), F.lit("9.9.9.9").alias("remote_addr"), "ts")


def _namespaces(spark):
    rows = [("telemetry", 300, 200, ["docType", "appName", "appUpdateChannel"], None), ("plain", 300, 200, None, "other-log")]
    return spark.createDataFrame(rows, "namespace string, max_data_length int, max_path_length int, dims array<string>, logger string")


def _ranges(spark):
    """The third is within the first, and has no city."""
    return spark.createDataFrame([(167772160, 167772191, "AA", "A-city"), (151587072, 151587327, "BB", "B-city"), (167772168, 167772175, "AC", None)], "first long, last long, country string, city string")


_ERROR = "CASE WHEN k < 2 THEN 'not enough path components' WHEN k < 4 THEN 'invalid path prefix' WHEN k < 8 THEN 'invalid namespace' WHEN k BETWEEN 16 AND 19 AND length(props) * 40 > 300 THEN 'payload too large' WHEN k BETWEEN 30 AND 33 THEN 'path too long' END"
#: What is known of no forwarded address is asked of the remote one.
_PLACE = "CASE WHEN k % 3 > 0 OR k >= 32 THEN 'BB' WHEN k BETWEEN 8 AND 15 THEN 'AC' ELSE 'AA' END"


@query("j01_route_submissions", with_flat(f"SELECT coalesce({_ERROR}, 'decoded') AS outcome, CASE WHEN {_ERROR} IS NULL THEN {_PLACE} END AS country, count(*) AS n FROM f GROUP BY ALL UNION ALL SELECT 'landfill', {_PLACE}, count(*) FROM f GROUP BY ALL"))
def route(spark, sf_dir):
    landfill, decoded, errors = decode.route_submissions(_raw(spark, sf_dir), _namespaces(spark), _ranges(spark))
    count = lambda df, outcome, place: df.groupBy(outcome.alias("outcome"), place.alias("country")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    return count(landfill, F.lit("landfill"), F.col("geo_country")).unionByName(count(decoded, F.lit("decoded"), F.col("geo_country"))).unionByName(count(errors, F.col("error_type"), none))


_PLAIN = "(k >= 34 AND k % 2 = 1 OR k BETWEEN 16 AND 19 AND k % 2 = 1)"


@query("j01_decoded_dimensions", with_flat(f"""SELECT CASE WHEN k >= 12 THEN document_id END AS id, CASE WHEN {_PLAIN} THEN 'other-log' ELSE 'telemetry' END AS logger, CASE WHEN k BETWEEN 12 AND 15 THEN 'main' WHEN k >= 16 AND NOT k BETWEEN 20 AND 29 AND NOT {_PLAIN} THEN doc_type END AS doc_type,
  CASE WHEN k >= 16 AND NOT k BETWEEN 20 AND 29 AND NOT {_PLAIN} THEN raw_channel END AS channel, CASE WHEN k BETWEEN 20 AND 29 THEN doc_type || '/Browser/' || raw_channel || '/more' WHEN {_PLAIN} THEN doc_type || '/Browser/' || raw_channel END AS components FROM f WHERE {_ERROR} IS NULL"""))
def decoded_dimensions(spark, sf_dir):
    _, decoded, _ = decode.route_submissions(_raw(spark, sf_dir), _namespaces(spark), _ranges(spark))
    at = lambda key: F.try_element_at("dims", F.lit(key))
    return decoded.select(F.col("document_id").alias("id"), "logger", at("docType").alias("doc_type"), at("appUpdateChannel").alias("channel"), F.array_join("path_components", "/").alias("components"))


def _documents(spark, sf_dir):
    """Payload bytes of each format, plain and gzip, with and without what the format must have."""
    import gzip

    k = F.col("k") % 16
    json = lambda **fields: F.to_json(F.struct(*[(c if hasattr(c, "alias") else F.lit(c)).alias(n) for n, c in fields.items()]))
    struct = lambda **fields: F.struct(*[(c if hasattr(c, "alias") else F.lit(c)).alias(n) for n, c in fields.items()])
    app = struct(name="Browser", version="40.0", channel=F.col("raw_channel"), buildId="2015", vendor="V")
    date_, client, kind = "2024-01-05T10:00:00.000Z", F.col("client_id"), F.col("doc_type")
    environment = struct(system=struct(os=struct(name=F.col("raw_os"))), settings=struct(telemetryEnabled=F.col("is_default")), other=struct(a=1))
    texts = {
        0: F.lit("{broken"),
        1: F.lit("[1]"),
        2: json(ver=1, info=struct(reason="idle", appName="Mobile", appUpdateChannel=F.col("raw_channel"), OS=F.col("raw_os"), vendor="V"), clientID=client),
        3: F.lit(""),
        4: json(version=4, type=kind, clientId=client, creationDate=date_, application=app, environment=environment, payload=struct(info=struct(reason="shutdown"), extra=1)),
        6: json(ver=3, clientId=client),
        7: json(ver=1, clientID=client),
        8: json(version=4, type=kind, creationDate=date_),
        9: json(version=4, type=kind, application=app, creationDate="today"),
        10: F.concat(F.lit('{"deviceinfo":{"deviceinfo.platform_version":"28.0","deviceinfo.update_channel":"'), F.col("raw_channel"), F.lit('"}}')),
        11: json(v=7, clientId=client),
        12: json(hello=1),
        13: F.lit('"text"'),
    }
    text = json(version=4, type=kind, clientId=client, creationDate=date_, application=app, payload=struct(info=struct(reason="daily")))
    for n, t in texts.items():
        text = F.when(k == n, t).otherwise(text)

    def pack(text: str, k: int) -> bytes:
        return gzip.compress(text.encode()) if k in (2, 4) else b"\x1f\x8bnot" if k == 5 else text.encode()

    made = pings(spark, sf_dir).select("ts", "raw_channel", F.udf(pack, "binary", useArrow=False)(text, k).alias("payload"))
    dims = F.create_map(F.lit("docType"), F.lit("ftu"), F.lit("appName"), F.lit("App"), F.lit("appUpdateChannel"), F.col("raw_channel"))
    return made.select("ts", "payload", dims.alias("dims"))


_DECODED = ["kind", "error", "doc_type", "app_name", "app_version", "channel", "os", "reason", "enabled", "version", "sections"]


@query("j02_decode_pings", with_flat("""SELECT *, count(*) AS n FROM (SELECT
  CASE j WHEN 0 THEN 'json' WHEN 3 THEN 'read' WHEN 5 THEN 'gzip' WHEN 7 THEN 'payload' WHEN 8 THEN 'payload' WHEN 9 THEN 'payload' WHEN 13 THEN 'payload' WHEN 1 THEN 'other' WHEN 2 THEN 'old' WHEN 6 THEN 'saved' WHEN 10 THEN 'device' WHEN 11 THEN 'core' WHEN 12 THEN 'other' ELSE 'unified' END AS kind,
  CASE j WHEN 7 THEN 'missing info object' WHEN 8 THEN 'missing application object' WHEN 9 THEN 'missing creationDate' WHEN 13 THEN 'no object' END AS error,
  CASE WHEN j IN (0, 3, 5, 7, 8, 9, 13) THEN NULL WHEN j IN (1, 6, 11, 12) THEN 'ftu' WHEN j = 2 THEN 'idle' WHEN j = 10 THEN 'appusage' ELSE doc_type END AS doc_type,
  CASE WHEN j IN (0, 3, 5, 7, 8, 9, 13) THEN NULL WHEN j IN (1, 6, 11, 12) THEN 'App' WHEN j = 2 THEN 'Mobile' WHEN j = 10 THEN 'Device' ELSE 'Browser' END AS app_name,
  CASE WHEN j IN (4, 14, 15) THEN '40.0' WHEN j = 2 THEN 'UNKNOWN' WHEN j = 10 THEN '28.0' END AS app_version,
  CASE WHEN j IN (2, 4, 6, 10, 14, 15) THEN channel END AS channel,
  CASE WHEN j IN (2, 4) THEN raw_os END AS os,
  CASE j WHEN 2 THEN 'idle' WHEN 4 THEN 'shutdown' WHEN 14 THEN 'daily' WHEN 15 THEN 'daily' END AS reason,
  CASE WHEN j = 2 OR j = 4 AND is_default THEN 'true' WHEN j = 4 THEN 'false' END AS enabled,
  CASE WHEN j IN (4, 14, 15) THEN '4' WHEN j = 2 THEN '1' WHEN j IN (6, 10) THEN '3' WHEN j = 11 THEN '7' END AS version,
  CASE WHEN j = 4 THEN CASE WHEN doc_type = 'crash' THEN 'environment.settings,environment.system' ELSE 'environment.settings,environment.system,payload.info' END WHEN j IN (14, 15) AND doc_type <> 'crash' THEN 'payload.info' WHEN j IN (0, 3, 5, 7, 8, 9, 13) THEN NULL ELSE '' END AS sections
  FROM (SELECT *, k % 16 AS j FROM f) g) t GROUP BY ALL"""))
def decoded_pings(spark, sf_dir):
    good, bad = decode.decode_pings(_documents(spark, sf_dir), device_app="Device")
    sections = F.array_join(F.array_sort(F.map_keys("sections")), ",")
    own = good.select(F.col("format").alias("kind"), "doc_type", "app_name", "app_version", F.col("normalized_channel").alias("channel"), "os", "reason", F.col("telemetry_enabled").cast("string").alias("enabled"), F.col("source_version").alias("version"), sections.alias("sections"))
    return own.unionByName(bad.select(F.col("error_type").alias("kind"), "error"), allowMissingColumns=True).groupBy(*_DECODED).agg(F.count(F.lit(1)).alias("n"))


@query("j03_validate_pings", with_flat("""SELECT event_id, CASE WHEN k % 9 < 5 THEN 'uri' WHEN k % 9 < 7 THEN 'json' END AS error_type, CASE WHEN k % 9 > 6 THEN client_id END AS client_id, CASE WHEN k % 9 > 6 THEN channel END AS normalized_channel,
  CASE k % 9 WHEN 7 THEN 'saved-session' WHEN 8 THEN 'main' END AS doc_type, CASE WHEN k % 9 > 6 THEN raw_os END AS os, CASE WHEN k % 9 > 6 THEN TIMESTAMP '2024-01-05 10:00:00' END AS creation_ts, CASE WHEN k % 9 > 4 THEN CASE k % 9 WHEN 7 THEN 'saved-session' ELSE 'main' END WHEN k % 9 = 4 THEN 'no-such' END AS path_type FROM f"""))
def validate(spark, sf_dir):
    k = F.col("k") % 9
    to = lambda *parts: F.concat_ws("/", F.lit(""), *[F.lit(p) if isinstance(p, str) else p for p in parts])
    ident = F.col("document_id")
    kind = F.when(k == 7, "saved-session").when(k == 4, "no-such").otherwise("main")
    path = F.when(k == 0, to("submit", "telemetry")).when(k == 1, to("other", "telemetry", ident, "main")).when(k == 2, to("submit", "nowhere", ident, "main")).when(k == 3, to("submit", "telemetry", ident, "main", "a", "b", "c")).otherwise(to("submit", "telemetry", ident, kind))
    app = F.struct(F.lit("Browser").alias("name"), F.col("raw_channel").alias("channel"))
    environment = F.struct(F.struct(F.struct(F.col("raw_os").alias("name")).alias("os")).alias("system"))
    whole = F.to_json(F.struct(F.col("client_id").alias("clientId"), kind.alias("type"), F.lit("2024-01-05T10:00:00Z").alias("creationDate"), app.alias("application"), environment.alias("environment")))
    body = F.when(k == 5, F.lit('{"application": {}}')).when(k == 6, F.lit("{nope")).otherwise(whole)
    df = pings(spark, sf_dir).select("event_id", path.alias("path"), body.alias("document"))
    schema = T.StructType([T.StructField("clientId", T.StringType()), T.StructField("application", T.StructType([T.StructField("name", T.StringType())]))])
    out = decode.validate_pings(df, _namespaces(spark), {"main": (schema, ["clientId", "application.name"])})
    return out.select("event_id", "error_type", "client_id", "normalized_channel", "doc_type", "os", "creation_ts", F.try_element_at("dims", F.lit("docType")).alias("path_type"))


#: A ping's schema, with a definition used twice, and what is wrong with some documents.
_PING_SCHEMA = {
    "type": "object",
    "required": ["clientId", "type"],
    "definitions": {"version": {"type": "string", "pattern": "^[0-9]+[.][0-9]$"}},
    "properties": {
        "clientId": {"type": "string", "minLength": 1},
        "type": {"enum": ["main", "saved-session"]},
        "version": {"$ref": "#/definitions/version"},
        "application": {"type": "object", "properties": {"channel": {"type": "string", "maxLength": 13}, "version": {"$ref": "#/definitions/version"}}, "additionalProperties": False},
        "counts": {"type": "array", "maxItems": 3, "items": {"type": "integer", "minimum": 0, "maximum": 98}},
    },
}


@query("j03_json_schema", with_flat("""SELECT event_id, CASE WHEN k % 8 = 0 THEN 'json' WHEN v IS NOT NULL THEN 'json' END AS error_type, v AS violation, CASE WHEN k % 8 > 0 AND v IS NULL THEN client_id END AS client_id FROM (SELECT *, CASE WHEN k % 8 = 0 THEN NULL WHEN k % 8 = 1 THEN '#: required clientId' WHEN k % 8 = 2 THEN '#/version: pattern'
  WHEN length(raw_channel) > 13 THEN '#/application/channel: maxLength' WHEN k % 8 = 3 THEN '#/application/version: type' WHEN k % 8 = 4 THEN '#/application/extra: not allowed' WHEN k % 8 = 5 THEN '#/counts: maxItems' WHEN k - 1 < 0 THEN '#/counts/1: minimum' WHEN k - 1 > 98 THEN '#/counts/1: maximum' END AS v FROM f) t"""))
def json_schema(spark, sf_dir):
    """Documents against a JSON Schema; each broken one with the place and keyword that it breaks first."""
    k = F.col("k") % 8
    application = F.struct(F.col("raw_channel").alias("channel"), F.when(k == 3, F.lit(None).cast("string")).otherwise("40.0").alias("version"), F.when(k == 4, "x").alias("extra"))
    counts = F.when(k == 5, F.array(*[F.lit(1)] * 4)).otherwise(F.array(F.lit(0), F.col("k") - 1))
    whole = F.to_json(F.struct(F.when(k != 1, F.col("client_id")).alias("clientId"), F.lit("main").alias("type"), F.when(k == 2, "4").otherwise("40.1").alias("version"), application.alias("application"), counts.alias("counts")))
    null_version = F.regexp_replace(whole, "[}],\"counts\"", ',"version":null},"counts"')
    body = F.when(k == 0, F.lit("[1,")).when(k == 3, null_version).otherwise(whole)
    df = pings(spark, sf_dir).select("event_id", F.concat(F.lit("/submit/telemetry/"), "document_id", F.lit("/main")).alias("path"), body.alias("document"))
    return decode.validate_pings(df, _namespaces(spark), {"main": _PING_SCHEMA}).select("event_id", "error_type", "violation", "client_id")


_EXEC = """SELECT event_id, ts AS "timestamp", CASE WHEN doc_type = 'crash' THEN CAST(submission_date - CAST(event_id % 3 AS INT) AS TIMESTAMP) ELSE CAST(submission_date - CAST(event_id % 3 AS INT) AS TIMESTAMP) END AS activity_timestamp, profile_ts AS profile_creation_timestamp,
  client_id, document_id, doc_type, country, channel, os, is_default AS "default", round(hours, 6) AS hours, google, bing, yahoo, other, CASE WHEN doc_type = 'main' THEN CASE WHEN event_id % 5 = 0 THEN 'aborted-session' ELSE 'shutdown' END END AS reason, 'City' || (user_id % 9) AS city FROM f WHERE doc_type IN ('main', 'crash')"""
_EXEC_COLUMNS = ["event_id", "timestamp", "activity_timestamp", "profile_creation_timestamp", "client_id", "document_id", "doc_type", "country", "channel", "os", "default", "hours", "google", "bing", "yahoo", "other", "reason", "city"]


@query("j04_executive_summary", with_flat(_EXEC))
def executive_summary(spark, sf_dir):
    return derive.executive_summary(nested(spark, sf_dir), iso_countries()).withColumn("hours", F.round("hours", 6)).select(*_EXEC_COLUMNS)


@query("j05_executive_summary_full", with_flat(_EXEC))
def executive_summary_full(spark, sf_dir):
    return derive.executive_summary_full(nested(spark, sf_dir), iso_countries()).withColumn("hours", F.round("hours", 6)).select(*_EXEC_COLUMNS)


@query("j06_main_summary", with_flat("SELECT event_id, document_id, CAST(activity_date AS VARCHAR) AS subsession_date, client_id, build_id, channel, os, country, reason, seconds AS subsession_length, CASE WHEN k % 3 > 0 THEN k % 3 END AS plugin_hangs, CASE WHEN k % 2 > 0 THEN 1 END AS aborts_content, plugin_crashes AS crashes_detected_plugin, k % 4 + 1 AS active_addons, '18.0.0.' || k AS flash_version FROM m"))
def main_summary(spark, sf_dir):
    return plain(mains(spark, sf_dir).select("event_id", "document_id", "subsession_date", "client_id", "build_id", "channel", "os", "country", "reason", "subsession_length", "plugin_hangs", "aborts_content", "crashes_detected_plugin", "active_addons", "flash_version"))


@query("j07_crash_summary", with_flat("SELECT event_id, CAST(crash_date AS VARCHAR) AS crash_date, client_id, channel, os, country, has_environment AS has_crash_environment FROM c"))
def crash_summary(spark, sf_dir):
    return plain(crashes(spark, sf_dir).select("event_id", "crash_date", "client_id", "channel", "os", "country", "has_crash_environment"))


@query("j08_payload_size", with_flat("SELECT build_id AS build, channel, doc_type, count(*) AS n, CAST(sum(length(props) * 100) AS BIGINT) AS size FROM f GROUP BY ALL"))
def payload_size(spark, sf_dir):
    sizes = derive.payload_size(nested(spark, sf_dir), F.length("props") * 100)
    return sizes.groupBy("build", "channel", "doc_type").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))


@query("j09_fhr_dimensions", with_flat("""SELECT event_id, CAST(submission_date AS VARCHAR) AS submission_date, coalesce(raw_country, '??') AS geo_country, CASE WHEN j = 8 THEN NULL WHEN j = 9 THEN '9' WHEN j < 4 THEN '1' WHEN j < 6 THEN '2' ELSE '3' END AS fhr_version,
  CASE WHEN j IN (0, 1, 4, 6) THEN 'Browser' END AS app_name, CASE WHEN j IN (0, 1, 4, 6) THEN 'UNKNOWN' END AS app_version, CASE WHEN j IN (0, 1, 4, 6) THEN raw_channel END AS app_update_channel, CASE WHEN j IN (0, 1, 4, 6) THEN raw_os END AS os, CASE WHEN j IN (0, 1, 4, 6) THEN client_id END AS client_id,
  CASE j WHEN 2 THEN 'missing object: data.last[.appInfo.appinfo]' WHEN 3 THEN 'missing object: data' WHEN 5 THEN 'missing object: geckoAppInfo' WHEN 7 THEN 'missing object: environments.current' WHEN 8 THEN 'json' WHEN 9 THEN 'unknown payload version' END AS error FROM (SELECT *, k % 10 AS j FROM f) g"""))
def fhr(spark, sf_dir):
    k = F.col("k") % 10
    struct = lambda **fields: F.struct(*[(c if hasattr(c, "alias") else F.lit(c)).alias(n) for n, c in fields.items()])
    info = struct(name="Browser", updateChannel=F.col("raw_channel"), os=F.col("raw_os"))
    client = {"clientID": F.col("client_id")}
    of = lambda key: F.to_json(struct(version=1, data=struct(last=F.struct(info.alias(key))), **client))
    texts = {
        0: of("org.x.appInfo.appinfo"),
        1: of("org.x.appInfo.appinfo.1"),
        2: of("org.x.appInfo"),
        3: F.to_json(struct(version=1, **client)),
        4: F.to_json(struct(version=2, geckoAppInfo=info, **client)),
        5: F.to_json(struct(version=2, **client)),
        6: F.to_json(struct(version=3, environments=struct(current=struct(geckoAppInfo=info)), **client)),
        7: F.to_json(struct(version=3, environments=struct(older=1), **client)),
        8: F.lit("{"),
    }
    doc = F.lit('{"version": 9}')
    for n, t in texts.items():
        doc = F.when(k == n, t).otherwise(doc)
    out = decode.fhr_dimensions(pings(spark, sf_dir).select("event_id", "ts", F.col("raw_country").alias("geo_country"), doc.alias("document")))
    return plain(out).select("event_id", "submission_date", "geo_country", "fhr_version", "app_name", "app_version", "app_update_channel", "os", "client_id", "error")


@query("j10_tls_reports", with_flat("""SELECT event_id, 'h' || (user_id % 9) || '.example' AS hostname, CAST(NULL AS VARCHAR) AS "version", CAST(k % 3 AS BIGINT) AS chain_length, 1704067200 + event_id - 1706659200 AS skew, CASE WHEN k % 3 > 0 THEN 'c0' END AS first_certificate, CASE WHEN k % 3 > 0 THEN 'c' || (k % 3 - 1) END AS last_certificate FROM f WHERE k % 7 <> 0"""))
def tls(spark, sf_dir):
    chain = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), F.col("k") % 3), lambda x: F.concat(F.lit("c"), x.cast("string")))
    doc = F.when(F.col("k") % 7 == 0, "{").otherwise(F.to_json(F.struct(F.concat(F.lit("h"), (F.col("user_id") % 9).cast("string"), F.lit(".example")).alias("hostname"), (1704067200 + F.col("event_id")).alias("timestamp"), chain.alias("failedCertChain"), F.create_map().cast("map<string,string>").alias("version"))))
    out = derive.tls_reports(pings(spark, sf_dir).select("event_id", doc.alias("document")), F.timestamp_seconds(F.lit(1706659200)))
    return out.select("event_id", "hostname", "version", F.col("chain_length").cast("long").alias("chain_length"), "skew", "first_certificate", "last_certificate")


@query("j11_recombine", with_flat("""SELECT event_id, '{"payload":{"info":{"k":' || k || '}},"environment":{"os":{"name":"' || raw_os || '"}},"meta":{"doc_type":"' || doc_type || '"}}' AS document FROM f"""))
def recombine(spark, sf_dir):
    df = pings(spark, sf_dir).select("event_id", "doc_type", F.struct("k").alias("a"), F.struct(F.col("raw_os").alias("name")).alias("b"))
    return derive.recombine(df, {"payload.info": "a", "environment.os": "b"}, ["doc_type"]).select("event_id", "document")


@query("j12_oom_crashes", with_flat("""SELECT 'u' || event_id AS uuid, event_id AS address, CAST(k * 10 AS BIGINT) AS uptime, 'a|b' AS app_notes, date_trunc('second', ts) AS date, CAST(NULL AS BIGINT) AS oom_allocation_size FROM f WHERE doc_type = 'crash'"""))
def oom(spark, sf_dir):
    hits = pings(spark, sf_dir).where("doc_type = 'crash'").select(F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("uuid"), F.concat(F.lit("0x"), F.hex("event_id")).alias("address"), (F.col("k") * 10).cast("string").alias("uptime"), F.lit("a\nb").alias("app_notes"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"), F.lit("many").alias("oom_allocation_size"))
    return derive.oom_crashes(hits).select("uuid", "address", "uptime", "app_notes", "date", "oom_allocation_size")


@query("j13_derived_stream", with_flat("SELECT event_id, left(raw_os, 4) AS os, ts AS at, CAST(floor(value) AS BIGINT) AS whole, is_default AS flag FROM f"))
def derived(spark, sf_dir):
    return derive.derived_stream(pings(spark, sf_dir), [("event_id", "BIGINT", "event_id"), ("os", "VARCHAR(4)", "raw_os"), ("at", "TIMESTAMP", "ts"), ("whole", "BIGINT", "value"), ("flag", "BOOLEAN", "is_default")])


SPEC = {"version": 1, "dimensions": [{"field_name": "doc_type", "allowed_values": ["main", "crash"]}, {"field_name": "raw_channel", "allowed_values": "*"}]}


def _written(spark, sf_dir):
    path = folder(spark)
    sinks.write_dims(pings(spark, sf_dir).select("event_id", "doc_type", "raw_channel", "k"), SPEC, path)
    return path


@query("s02_write_dims", with_flat("SELECT event_id, CASE WHEN doc_type IN ('main', 'crash') THEN doc_type ELSE 'OTHER' END AS doc_type, replace(raw_channel, '-', '_') AS raw_channel FROM f"))
def write_dims(spark, sf_dir):
    return spark.read.parquet(_written(spark, sf_dir)).select("event_id", "doc_type", "raw_channel")


@query("s01_scan_dims", with_flat("SELECT event_id FROM f WHERE doc_type = 'main' AND replace(raw_channel, '-', '_') BETWEEN 'b' AND 'nightly'"))
def scan_dims(spark, sf_dir):
    spec = {"version": 1, "dimensions": [{"field_name": "doc_type", "allowed_values": "main"}, {"field_name": "raw_channel", "allowed_values": {"min": "b", "max": "nightly"}}]}
    return scan.scan_dims(spark, _written(spark, sf_dir), spec).select("event_id")


@query("s03_scan_days", with_flat("SELECT event_id FROM f WHERE submission_date BETWEEN DATE '2024-01-25' AND DATE '2024-02-03' AND raw_os = 'Darwin'"))
def scan_days(spark, sf_dir):
    return scan.scan_days(pings(spark, sf_dir), date(2024, 1, 25), 10, where=F.col("raw_os") == "Darwin").select("event_id")


@query("u01_union_of_days", with_flat("SELECT event_id FROM f WHERE submission_date IN (DATE '2024-01-03', DATE '2024-01-05')"))
def union_days(spark, sf_dir):
    df = pings(spark, sf_dir)
    one = lambda d: scan.scan_days(df, d, 1).select("event_id")
    return one(date(2024, 1, 3)).unionByName(one(date(2024, 1, 5)))


@query("s04_scan_service_logs", with_flat("SELECT event_id, event_type AS action FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'"))
def service_logs(spark, sf_dir):
    """Logs with the day in the file's name; Spark names files itself, so tasks write these."""
    from collections.abc import Iterator

    import pandas as pd

    path = folder(spark)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(path)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for day, rows in batch.groupby("day"):
                with files.open_output_stream(f"{base}/loop-{day}-{uuid.uuid4().hex}.json") as out:
                    out.write(rows[["event_id", "action"]].to_json(orient="records", lines=True).encode())
            yield pd.DataFrame({"rows": [len(batch)]})

    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("action"), F.date_format("ts", "yyyyMMdd").alias("day"))
    events.repartition("day").mapInPandas(write, "rows long").agg(F.sum("rows")).collect()
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("action", T.StringType())])
    return scan.scan_service_logs(spark, path, "loop", date(2024, 1, 3), date(2024, 1, 9), schema).select("event_id", "action")


@query("s07_import_json_day", with_flat("SELECT event_id, CAST(k AS BIGINT) AS k, raw_os FROM f"))
def import_json(spark, sf_dir):
    path = folder(spark)
    schema = {"type": "object", "properties": {"event_id": {"type": "integer"}, "k": {"$ref": "#/definitions/count"}, "raw_os": {"type": ["string", "null"]}}, "definitions": {"count": {"type": "integer"}}}
    own = pings(spark, sf_dir)
    own.select("event_id", "k", "raw_os", "submission_date").repartition("submission_date").write.partitionBy("submission_date").json(path + "/json")
    first, last = own.agg(F.min("submission_date"), F.max("submission_date")).first()
    scan.backfill_json(spark, lambda d: f"{path}/json/submission_date={d}", schema, first, last, path + "/table")
    scan.import_json_day(spark, f"{path}/json/submission_date={last}", schema, last, path + "/table")  # again: no row is there twice
    return versions.read(spark, path + "/table").select("event_id", "k", "raw_os")


_FIELDS = [("event_id", "BIGINT", "event_id"), ("note", "VARCHAR(40)", "note"), ("seconds", "INTEGER", "seconds"), ("flag", "BOOLEAN", "is_default"), ("at", "TIMESTAMP", "ts")]


def _noted(spark, sf_dir):
    return pings(spark, sf_dir).withColumn("note", F.when(F.col("k") % 5 != 0, F.concat_ws("|", "raw_os", F.lit("a\\b"))))


@query("s09_write_derived", with_flat("SELECT event_id, CASE WHEN k % 5 <> 0 THEN raw_os || '|a\\b' END AS note, seconds, is_default AS flag, ts AS at FROM f"))
def write_derived(spark, sf_dir):
    path = folder(spark)
    sinks.write_derived(_noted(spark, sf_dir), _FIELDS, path, day=F.col("submission_date"))
    return _unescaped(spark, path)


def _unescaped(spark, path):
    """Lines split at delimiters that no backslash precedes, and the backslashes taken away."""
    line = spark.read.text(path)
    cells = F.split("value", r"(?<!\\)(?:\\\\)*\|")
    cell = lambda k: F.nullif(F.regexp_replace(F.get(cells, F.lit(k)), r"\\(.)", "$1"), F.lit(""))
    return line.select(cell(0).cast("long").alias("event_id"), cell(1).alias("note"), cell(2).cast("int").alias("seconds"), cell(3).cast("boolean").alias("flag"), cell(4).cast("timestamp").alias("at"))


@query("s09_write_derived_tsv", with_flat(r"SELECT event_id || chr(9) || CASE WHEN k % 5 <> 0 THEN raw_os || '|a\\b' ELSE '\N' END || chr(9) || seconds || chr(9) || CASE WHEN is_default THEN 'TRUE' ELSE 'FALSE' END || chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS value FROM f"))
def write_tsv(spark, sf_dir):
    path = folder(spark)
    sinks.write_derived(_noted(spark, sf_dir), _FIELDS, path, day=F.col("submission_date"), fmt="tsv")
    return sinks.read_lines(spark, path).select("value")


@query("s09_filled_files", with_flat("SELECT event_id, raw_channel, props, TRUE AS by_size FROM f"))
def filled_files(spark, sf_dir):
    """Folders by channel, files of 150 KB, of which none has twice that; where a folder has several, none has less than half."""
    path = folder(spark)
    filled.write_filled(pings(spark, sf_dir).select("event_id", "raw_channel", "props"), path + "/out", by=["raw_channel"], staging=path + "/staging", target=150_000)
    out = spark.read.parquet(path + "/out").withColumns({"file": F.col("_metadata.file_path"), "size": F.col("_metadata.file_size")})
    sizes = out.groupBy("raw_channel").agg(F.min("size").alias("least"), F.max("size").alias("most"), F.count_distinct("file").alias("files"))
    good = sizes.select("raw_channel", ((F.col("most") <= 300_000) & ((F.col("files") == 1) | (F.col("least") >= 75_000))).alias("by_size"))
    return out.join(F.broadcast(good), "raw_channel").select("event_id", "raw_channel", "props", "by_size")  # a row for each of six channels


@query("s10_write_jdbc", with_flat("SELECT event_id, raw_os, k FROM f"))
def write_jdbc(spark, sf_dir):
    """To the database that the session's pulseframe.jdbc.url and .driver name. Where they are unset, to an in-memory one, which only a
    local session's tasks share with the driver; elsewhere that is an error."""
    url, driver = spark.conf.get("pulseframe.jdbc.url", None), spark.conf.get("pulseframe.jdbc.driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    if url is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("pulseframe.jdbc.url is not set")
        url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    name = f"rows_of_days_{uuid.uuid4().hex}"
    rows = pings(spark, sf_dir).select("event_id", "raw_os", "k", "submission_date")
    days = sinks.write_jdbc_days(rows, url, name, day="submission_date", driver=driver, run="one")
    days = days if sinks.write_jdbc_days(rows, url, name, day="submission_date", driver=driver, run="one") == days else []  # a run that is done adds nothing
    tables = [spark.read.option("driver", driver).jdbc(url, sinks.day_table(name, d)).select("event_id", "raw_os", "k") for d in days]
    return reduce(DataFrame.unionByName, tables)


@query("s11_load_day_table", with_flat("SELECT event_id, left(raw_channel, 5) AS raw_channel FROM f WHERE submission_date = DATE '2024-01-06'"))
def load_day(spark, sf_dir):
    path = folder(spark)
    pings(spark, sf_dir).where("submission_date = date'2024-01-06'").select("event_id", "raw_channel").write.option("sep", "|").csv(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("raw_channel", T.StringType())])
    return scan.load_day_table(spark, path, schema, {"raw_channel": 5})


@query("s12_merge_report", with_flat("SELECT channel, CAST(submission_date AS VARCHAR) AS day, CASE WHEN submission_date >= DATE '2024-01-20' THEN count(*) ELSE 0 END AS n FROM f GROUP BY channel, submission_date"))
def merge_report(spark, sf_dir):
    new = pings(spark, sf_dir).groupBy(N.norm_channel(F.col("raw_channel")).alias("channel"), F.col("submission_date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    existing = new.withColumn("n", F.lit(0).cast("long"))
    path = folder(spark)
    for rows in (existing, new.where("day >= '2024-01-20'"), new.where("day >= '2024-01-20'")):
        sinks.publish_report(rows, path, ["channel", "day"])
    return versions.read(spark, path)


_TABLE = with_flat("SELECT event_id, raw_os, k FROM f")


@query("s13_write_csv_gz", _TABLE)
def csv_gz(spark, sf_dir):
    path = folder(spark)
    sinks.write_csv_gz(pings(spark, sf_dir).select("event_id", "raw_os", "k"), path)
    return spark.read.schema("event_id long, raw_os string, k int").option("header", True).csv(path)


@query("s13_write_json_gz", _TABLE)
def json_gz(spark, sf_dir):
    path = folder(spark)
    sinks.write_json_gz(pings(spark, sf_dir).select("event_id", "raw_os", "k"), path)
    return spark.read.schema("event_id long, raw_os string, k int").json(path)


@query("s14_to_bulk_json", with_flat("""SELECT '{"index":{"_index":"pings","_type":"ping","_id":"' || document_id || '"}}' || chr(10) || '{"Timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z","doc_type":"' || doc_type || '","k":' || k || CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN ',"tag":"a"' ELSE ',"tag":["a","b"]' END
  || ',"subsessionStartDate":"' || strftime(submission_date - CAST(event_id % 3 AS INT), '%Y-%m-%d') || 'T00:00:00.0Z","subsessionLength":' || seconds || ',"telemetryEnabled":true,"architecture":"x86","Latency":' || (event_id % 90) * 60 || ',"creationTimestamp":"' || strftime(ts - (event_id % 90) * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%S') || 'Z"}' AS value FROM f"""))
def bulk(spark, sf_dir):
    tags = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), F.col("k") % 3)
    settings, document = F.lit('{"telemetryEnabled":true,"locale":"x"}'), F.to_json(F.struct(F.struct("environment.build.architecture").alias("application")))
    return sinks.to_bulk_json(nested(spark, sf_dir).withColumn("tag", tags), "pings", "ping", ["doc_type", "k", "tag"], info=F.to_json("payload.info"), settings=settings, document=document)


@query("s15_export_matching", with_flat("""SELECT '{"event_id":' || event_id || ',"doc_type":"' || doc_type || '"}' AS value FROM f WHERE doc_type = 'crash'"""))
def export(spark, sf_dir):
    return sinks.export_matching(pings(spark, sf_dir).select("event_id", "doc_type"), "doc_type = 'crash'")


def _by_day(spark, sf_dir):
    path = folder(spark)
    own = pings(spark, sf_dir).select("event_id", F.when(F.col("k") % 50 != 0, F.col("client_id")).alias("client_id"), "submission_date")
    own.repartition("submission_date").sortWithinPartitions("submission_date", "client_id", "event_id").write.partitionBy("submission_date").parquet(path)
    return path


@query("s16_build_client_index", with_flat("""SELECT client_id, CAST(submission_date AS VARCHAR) AS submission_date, min(place) AS position, count(*) AS n
FROM (SELECT CASE WHEN k % 50 <> 0 THEN client_id END AS client_id, submission_date, row_number() OVER (PARTITION BY submission_date ORDER BY CASE WHEN k % 50 <> 0 THEN client_id END NULLS FIRST, event_id) - 1 AS place FROM f) t GROUP BY client_id, submission_date"""))
def client_index(spark, sf_dir):
    """A day is a file here, sorted by client: a run of each."""
    path = folder(spark)
    index.write_client_index(index.build_client_index(spark, _by_day(spark, sf_dir)), path)
    return plain(spark.read.parquet(path).select("client_id", "submission_date", "position", F.col("rows").alias("n")))


@query("s17_lookup_clients", with_flat("SELECT event_id FROM f WHERE k % 50 <> 0 AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND submission_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-10'"))
def lookup(spark, sf_dir):
    path = _by_day(spark, sf_dir)
    clients = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("client_id"))
    return index.lookup_clients(spark, index.build_client_index(spark, path), path, clients, date(2024, 1, 8), date(2024, 1, 10)).select("event_id")


@query("s_missing_days", "SELECT CAST(DATE '2024-01-25' + CAST(i AS INT) AS VARCHAR) AS submission_date FROM range(0, 10) r(i) WHERE DATE '2024-01-25' + CAST(i AS INT) NOT IN (SELECT CAST(ts AS DATE) FROM events)")
def missing(spark, sf_dir):
    return plain(scan.missing_days(pings(spark, sf_dir), date(2024, 1, 25), 10))
