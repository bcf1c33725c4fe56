"""Submissions made from the `events` table, as nested pings for Spark and as flat rows for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import iso_countries
from ..operators import derive
from .registry import table

#: Text that Spark and DuckDB both run.
PINGS = """
SELECT CAST(event_id - CASE WHEN event_id % 50 = 49 THEN 1 ELSE 0 END AS STRING) AS document_id,
       event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(ts AS DATE) AS submission_date, CAST(user_id AS STRING) AS client_id, user_id,
       CASE event_type WHEN 'error' THEN 'crash' WHEN 'signup' THEN 'saved-session' ELSE 'main' END AS doc_type,
       CASE CAST(user_id + FLOOR(EXTRACT(DAY FROM ts) / 10) AS BIGINT) % 6
            WHEN 0 THEN 'release' WHEN 1 THEN 'beta-x' WHEN 2 THEN 'nightly-cck-y' WHEN 3 THEN 'nightly'
            WHEN 4 THEN 'aurora' ELSE 'esr' END AS raw_channel,
       CASE user_id % 5 WHEN 0 THEN 'WINNT' WHEN 1 THEN 'Windows_NT' WHEN 2 THEN 'Darwin' WHEN 3 THEN 'GNU/Linux'
            ELSE 'Haiku' END AS raw_os,
       CASE user_id % 7 WHEN 0 THEN 'us' WHEN 1 THEN 'CN' WHEN 2 THEN 'RU' WHEN 3 THEN 'DE' WHEN 4 THEN 'GB'
            WHEN 5 THEN '??' ELSE NULL END AS raw_country,
       CAST(FLOOR(value * 360) AS INT) - 500 AS seconds, event_id % 3 = 0 AS is_default,
       CAST(user_id % 30 AS INT) AS profile_offset_days, CAST(event_id % 4 AS INT) AS engine_id,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, props, value
FROM {events}
"""

#: The flat form of what the derivations make of pings, for SQL.
FLAT = f"""
p AS ({PINGS.replace("{events}", "events")}),
f AS (SELECT *,
  CASE WHEN raw_channel = 'release' THEN 'release' WHEN raw_channel LIKE 'beta%' THEN 'beta'
       WHEN raw_channel = 'nightly' OR raw_channel LIKE 'nightly-cck-%' THEN 'nightly' WHEN raw_channel = 'aurora' THEN 'aurora' ELSE 'Other' END AS channel,
  CASE WHEN raw_os LIKE 'Windows%' OR raw_os LIKE 'WINNT%' THEN 'Windows' WHEN raw_os LIKE 'Darwin%' THEN 'Mac'
       WHEN raw_os LIKE '%Linux%' THEN 'Linux' ELSE 'Other' END AS os,
  CASE WHEN upper(raw_country) IN ('US', 'CN', 'RU', 'DE', 'GB') THEN upper(raw_country) ELSE 'Other' END AS country,
  CASE WHEN doc_type = 'crash' THEN 0.0 WHEN seconds >= 0 AND seconds < 15552000 THEN seconds / 3600.0 ELSE 0.0 END AS hours,
  CASE WHEN doc_type <> 'crash' AND engine_id = 0 THEN k % 5 + 1 ELSE 0 END AS google,
  CASE WHEN doc_type <> 'crash' AND engine_id = 1 THEN k % 5 + 1 ELSE 0 END AS bing,
  CASE WHEN doc_type <> 'crash' AND engine_id = 2 THEN k % 5 + 1 ELSE 0 END AS yahoo,
  CASE WHEN doc_type <> 'crash' AND engine_id = 3 THEN k % 5 + 1 ELSE 0 END AS other,
  CAST(submission_date - profile_offset_days AS TIMESTAMP) AS profile_ts,
  CASE WHEN k = 0 THEN NULL ELSE k END AS plugin_crashes,
  strftime(ts, '%Y%m%d') || '030201' AS build_id
  FROM p),
s AS (SELECT * REPLACE (CASE WHEN user_id % 4 = (day(submission_date) - 1) // 7 % 4 THEN client_id || 'b' ELSE client_id END AS client_id) FROM f WHERE doc_type IN ('main', 'crash')),
m AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN 'aborted-session' ELSE 'shutdown' END AS reason,
  CASE WHEN seconds < 0 THEN 0 WHEN seconds > 90000 THEN 90000 ELSE seconds END AS clamped,
  submission_date - CAST(event_id % 3 AS INT) AS activity_date FROM f WHERE doc_type = 'main'),
c AS (SELECT *, submission_date - CAST(event_id % 3 AS INT) AS crash_date, event_id % 2 = 0 AS has_environment FROM f WHERE doc_type = 'crash')
"""


def with_flat(sql: str) -> str:
    return f"WITH {FLAT.strip()}\n{sql}"


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat rows of PINGS."""
    return spark.sql(PINGS, events=table(spark, sf_dir, "events"))


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings with the sections of a decoded submission as structs and maps."""
    engine = F.element_at(F.array(*[F.lit(x) for x in ("google", "bing-x", "Yahoo", "duckduckgo")]), F.col("engine_id") + 1)
    value = lambda c: F.struct(c.cast("long").alias("sum"))
    hist = lambda *pairs: F.create_map(*[x for key, c in pairs for x in (F.lit(key), value(c))])
    day = F.date_sub("submission_date", (F.col("event_id") % 3).cast("int"))
    k = F.col("k")
    return pings(spark, sf_dir).select(
        "*",
        F.expr("ts - make_interval(0, 0, 0, 0, 0, cast(event_id % 90 as int))").alias("creation_ts"),
        F.col("raw_channel").alias("app_update_channel"),
        F.col("raw_os").alias("os_name"),
        F.col("raw_country").alias("geo_country"),
        F.concat(F.lit("City"), (F.col("user_id") % 9).cast("string")).alias("geo_city"),
        F.lit("Browser").alias("app_name"),
        F.concat((40 + F.col("user_id") % 12).cast("string"), F.lit(".0")).alias("app_version"),
        F.lit("Vendor").alias("app_vendor"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("030201")).alias("app_build_id"),
        F.struct(
            F.struct((F.unix_date("submission_date") - F.col("profile_offset_days")).alias("creationDate")).alias("profile"),
            F.struct(F.col("is_default").alias("isDefaultBrowser"), F.lit("en-US").alias("locale")).alias("settings"),
            F.struct(F.concat((40 + F.col("user_id") % 12).cast("string"), F.lit(".0")).alias("version"), F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("030201")).alias("buildId"), F.lit("x86").alias("architecture")).alias("build"),
            F.struct(F.struct(F.when(F.col("user_id") % 5 < 2, "6.1").otherwise("10.0").alias("version"), F.lit("1").alias("servicePackMajor"), F.lit("0").alias("servicePackMinor")).alias("os")).alias("system"),
            F.struct(
                F.map_from_entries(F.transform(F.sequence(F.lit(0), F.pmod(k, F.lit(4))), lambda x: F.struct(F.concat(F.lit("addon"), x.cast("string")), F.lit(True)))).alias("activeAddons"),
                F.array(F.struct(F.lit("Shockwave Flash").alias("name"), F.concat(F.lit("18.0.0."), k.cast("string")).alias("version")), F.struct(F.lit("Shockwave Flash").alias("name"), F.lit("9.9.9.9").alias("version")), F.struct(F.lit("Java").alias("name"), F.lit("99.0.0.1").alias("version"))).alias("activePlugins"),
                F.struct(F.when(k % 2 == 0, "exp").alias("id"), F.when(k % 2 == 0, "a").alias("branch")).alias("activeExperiment"),
            ).alias("addons"),
        ).alias("environment"),
        F.struct(
            F.struct(F.col("seconds").alias("subsessionLength"), F.date_format(day, "yyyy-MM-dd'T'00:00:00.0'Z'").alias("subsessionStartDate"), F.lit(60).alias("timezoneOffset"), F.when(F.col("event_id") % 5 == 0, "aborted-session").otherwise("shutdown").alias("reason")).alias("info"),
            F.create_map(
                F.lit("SEARCH_COUNTS"), F.map_from_arrays(F.array(F.concat(engine, F.lit(".urlbar")), F.concat(engine, F.lit(".searchbar"))), F.array(value(k % 5), value(F.lit(1)))),
                F.lit("SUBPROCESS_CRASHES_WITH_DUMP"), hist(("plugin", k), ("pluginhang", k % 3)),
                F.lit("SUBPROCESS_ABNORMAL_ABORT"), hist(("content", k % 2)),
            ).alias("keyedHistograms"),
            F.struct(F.date_format(day, "yyyy-MM-dd").alias("crashDate"), (F.col("event_id") % 2 == 0).alias("hasCrashEnvironment")).alias("crash"),
        ).alias("payload"),
    )


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The executive summary of all submissions. Each user sends from another client in one week of four, so clients pause and come back."""
    other = F.col("user_id") % 4 == F.floor((F.dayofmonth("submission_date") - 1) / 7) % 4
    client = F.when(other, F.concat("client_id", F.lit("b"))).otherwise(F.col("client_id"))
    return derive.executive_summary(nested(spark, sf_dir).withColumn("client_id", client), iso_countries())


def mains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.main_summary(nested(spark, sf_dir), iso_countries())


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.crash_summary(nested(spark, sf_dir), iso_countries())
