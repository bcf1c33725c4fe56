"""Queries of the reports: executive, stability, usage, retention, engagement, budget and updates."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions.normalize import iso_countries
from ..operators import budget, derive, reports, snapshot, stability, updates, usage
from .fixtures import crashes, mains, nested, pings, summaries, with_flat
from .registry import SQL, folder, query, table

WEEK = date(2024, 1, 14)
DAY = date(2024, 1, 15)
YESTERDAY = date(2024, 1, 28)
_THIS = "submission_date >= DATE '2024-01-14' AND submission_date < DATE '2024-01-21'"
_LAST = "submission_date >= DATE '2024-01-07' AND submission_date < DATE '2024-01-14'"


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that any engine's result compares."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if t == "date" else F.col(f"`{c}`") for c, t in df.dtypes])


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


_EASY = f"""SELECT country AS geo, channel, os, '2024-01-14' AS date, round(sum(hours), 4) AS hours, CAST(sum(CASE WHEN doc_type = 'crash' THEN 1 ELSE 0 END) AS BIGINT) AS crashes,
  CAST(sum(google) AS BIGINT) AS google, CAST(sum(bing) AS BIGINT) AS bing, CAST(sum(yahoo) AS BIGINT) AS yahoo, CAST(sum(other) AS BIGINT) AS other FROM s WHERE {_THIS} GROUP BY ALL"""
_CLIENT = f"""SELECT country AS geo, channel, os, '2024-01-14' AS date, count(*) AS actives, CAST(sum(CASE WHEN profile_ts >= TIMESTAMP '2024-01-14' THEN 1 ELSE 0 END) AS BIGINT) AS new_records,
  CAST(sum(CASE WHEN is_default THEN 1 ELSE 0 END) AS BIGINT) AS "default" FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) AS r FROM s WHERE {_THIS}) t WHERE r = 1 GROUP BY 1, 2, 3"""
_INACTIVE = f"""SELECT country AS geo, channel, os, '2024-01-14' AS date, count(*) AS inactives FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) AS r FROM s
  WHERE {_LAST} AND client_id IN (SELECT client_id FROM s WHERE {_LAST} EXCEPT SELECT client_id FROM s WHERE {_THIS})) t WHERE r = 1 GROUP BY 1, 2, 3"""
_FIVE = f"""SELECT country AS geo, channel, os, '2024-01-14' AS date, CAST(sum(CASE WHEN n >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS five_of_seven FROM
  (SELECT client_id, country, channel, os, count(DISTINCT CAST(ts AS DATE)) AS n FROM s WHERE {_THIS} GROUP BY ALL) t GROUP BY 1, 2, 3"""
_REPORT = f"""SELECT coalesce(e.geo, a.geo, i.geo) AS geo, coalesce(e.channel, a.channel, i.channel) AS channel, coalesce(e.os, a.os, i.os) AS os, '2024-01-14' AS date,
  coalesce(actives, 0) AS actives, coalesce(hours, 0) AS hours, coalesce(inactives, 0) AS inactives, coalesce(new_records, 0) AS new_records, coalesce(five_of_seven, 0) AS five_of_seven,
  coalesce(actives, 0) + coalesce(inactives, 0) AS total_records, coalesce(crashes, 0) AS crashes, coalesce("default", 0) AS "default", coalesce(google, 0) AS google, coalesce(bing, 0) AS bing, coalesce(yahoo, 0) AS yahoo, coalesce(other, 0) AS other
  FROM ({_EASY}) e FULL JOIN ({_CLIENT}) a USING (geo, channel, os) FULL JOIN ({_INACTIVE}) i USING (geo, channel, os) FULL JOIN ({_FIVE}) v USING (geo, channel, os)"""
_REPORT = _REPORT.replace("coalesce(e.geo, a.geo, i.geo) AS geo, coalesce(e.channel, a.channel, i.channel) AS channel, coalesce(e.os, a.os, i.os) AS os", "geo, channel, os")


def _periods(spark, sf_dir):
    s = summaries(spark, sf_dir)
    first, end, before = reports.period(WEEK, "weekly")
    return reports.between(s, first, end), reports.between(s, before, first)


@query("a01_easy_aggregates", with_flat(_EASY))
def easy(spark, sf_dir):
    return plain(rounded(reports.easy_aggregates(_periods(spark, sf_dir)[0], WEEK), "hours"))


@query("a02_client_aggregates", with_flat(_CLIENT))
def client(spark, sf_dir):
    return plain(reports.client_aggregates(_periods(spark, sf_dir)[0], WEEK))


@query("a03_inactives", with_flat(_INACTIVE))
def inactive(spark, sf_dir):
    this, last = _periods(spark, sf_dir)
    return plain(reports.inactives(last, this, WEEK))


@query("a04_five_of_seven", with_flat(_FIVE))
def five(spark, sf_dir):
    return plain(reports.five_of_seven(_periods(spark, sf_dir)[0], WEEK, "weekly"))


@query("a05_executive_report", with_flat(_REPORT))
def executive(spark, sf_dir):
    return plain(rounded(reports.executive_report(summaries(spark, sf_dir), WEEK), "hours"))


@query(
    "a06_interval_report",
    with_flat(""", x AS (SELECT *, CAST(date_trunc('week', submission_date + 1) AS DATE) - 1 AS w, 1 << CAST(dayofweek(submission_date) AS INT) AS bit FROM s),
spans AS (SELECT DISTINCT w FROM x WHERE w < (SELECT max(w) FROM x)),
per AS (SELECT client_id, w, arg_max({'c': country, 'h': channel, 'o': os, 'd': is_default}, (ts, event_id)) AS r, bit_or(bit) AS mask, arg_min(profile_ts, (ts, event_id)) AS profile FROM x GROUP BY client_id, w),
held AS (SELECT *, lead(w) OVER (PARTITION BY client_id ORDER BY w) AS until, row_number() OVER (PARTITION BY client_id ORDER BY w) AS nth FROM per),
spine AS (SELECT spans.w AS "at", held.*, spans.w = held.w AS active FROM held JOIN spans ON spans.w >= held.w AND (until IS NULL OR spans.w < until)),
cl AS (SELECT "at", r.c AS geo, r.h AS channel, r.o AS os, count(*) FILTER (WHERE active) AS actives, count(*) FILTER (WHERE NOT active) AS inactives,
  count(*) FILTER (WHERE active AND nth = 1 AND profile >= CAST("at" AS TIMESTAMP)) AS new_records, count(*) FILTER (WHERE active AND bit_count(mask) >= 5) AS five_of_seven, count(*) FILTER (WHERE active AND r.d) AS dflt FROM spine GROUP BY ALL),
sums AS (SELECT w AS "at", country AS geo, channel, os, round(sum(hours), 4) AS hours, CAST(sum(CASE WHEN doc_type = 'crash' THEN 1 ELSE 0 END) AS BIGINT) AS crashes, CAST(sum(google) AS BIGINT) AS google, CAST(sum(bing) AS BIGINT) AS bing, CAST(sum(yahoo) AS BIGINT) AS yahoo, CAST(sum(other) AS BIGINT) AS other FROM x GROUP BY ALL)
SELECT geo, channel, os, CAST("at" AS VARCHAR) AS date, coalesce(actives, 0) AS actives, hours, coalesce(inactives, 0) AS inactives, coalesce(new_records, 0) AS new_records, coalesce(five_of_seven, 0) AS five_of_seven,
  coalesce(actives, 0) + coalesce(inactives, 0) AS total_records, crashes, coalesce(dflt, 0) AS "default", google, bing, yahoo, other
FROM sums LEFT JOIN cl USING ("at", geo, channel, os) WHERE "at" IN (SELECT w FROM spans)"""),
)
def interval(spark, sf_dir):
    return plain(rounded(reports.interval_report(summaries(spark, sf_dir), "week"), "hours"))


@query("a06_increments", SQL["a06_interval_report"])
def increments(spark, sf_dir):
    """The interval report week by week: each increment reads one week and the snapshot of clients that the one before it left."""
    path = folder(spark)
    rows = summaries(spark, sf_dir)
    rows.withColumn("submission_date", F.to_date("timestamp")).write.partitionBy("submission_date").parquet(path + "/rows")
    rows = spark.read.parquet(path + "/rows")
    first, last = rows.agg(F.min("submission_date"), F.max("submission_date")).first()
    week, end = (d - timedelta((d.weekday() + 1) % 7) for d in (first, last))
    while week < end:  # the last one is open
        snapshot.advance(spark, path + "/root", rows, week, "week", buckets=8)
        week += timedelta(7)
    return plain(rounded(snapshot.published(spark, path + "/root"), "hours"))


@query(
    "a07_cube_all",
    with_flat(f""", rep AS ({_REPORT.replace('round(sum(hours), 4)', 'sum(hours)')}) SELECT CASE WHEN grouping(geo) = 1 THEN 'all' ELSE geo END AS geo, CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel, CASE WHEN grouping(os) = 1 THEN 'all' ELSE os END AS os, date,
  CAST(sum(actives) AS BIGINT) AS actives, round(sum(hours), 1) AS hours, CAST(sum(inactives) AS BIGINT) AS inactives, CAST(sum(new_records) AS BIGINT) AS new_records, CAST(sum(five_of_seven) AS BIGINT) AS five_of_seven, CAST(sum(total_records) AS BIGINT) AS total_records,
  CAST(sum(crashes) AS BIGINT) AS crashes, CAST(sum("default") AS BIGINT) AS "default", CAST(sum(google) AS BIGINT) AS google, CAST(sum(bing) AS BIGINT) AS bing, CAST(sum(yahoo) AS BIGINT) AS yahoo, CAST(sum(other) AS BIGINT) AS other
  FROM rep GROUP BY date, CUBE (geo, channel, os)"""),
)
def cube(spark, sf_dir):
    out = reports.cube_all(reports.executive_report(summaries(spark, sf_dir), WEEK), date(2024, 2, 1))
    return plain(out.withColumn("hours", F.round("hours", 1)))


_MOBILE = """, o AS (SELECT DISTINCT ON (document_id) document_id, client_id, submission_date, CAST(8 + user_id % 16 AS VARCHAR) AS os_version, country, channel, CASE WHEN k % 10 <> 0 THEN (submission_date - DATE '1970-01-01') - profile_offset_days END AS profile_day FROM f ORDER BY document_id, ts, event_id),
one AS (SELECT CAST(date_trunc('week', submission_date + 1) AS DATE) - 1 AS period, client_id, submission_date, os_version, country, channel, min(profile_day) AS profile_day FROM o GROUP BY ALL),
cu AS (SELECT period, client_id, submission_date, CASE WHEN grouping(os_version) = 1 THEN 'all' ELSE os_version END AS os_version, CASE WHEN grouping(country) = 1 THEN 'all' ELSE country END AS country, CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel, max(profile_day) AS profile_day
  FROM one GROUP BY period, client_id, submission_date, CUBE (os_version, country, channel))
SELECT CAST(period AS VARCHAR) AS period, os_version, country, channel, count(DISTINCT client_id) AS actives, CAST(sum(CASE WHEN age = 0 THEN 1 ELSE 0 END) AS BIGINT) AS new_records, CAST(sum(CASE WHEN age = 1 THEN 1 ELSE 0 END) AS BIGINT) AS d1, CAST(sum(CASE WHEN age = 7 THEN 1 ELSE 0 END) AS BIGINT) AS d7, CAST(sum(CASE WHEN age = 30 THEN 1 ELSE 0 END) AS BIGINT) AS d30
FROM (SELECT *, (submission_date - DATE '1970-01-01') - profile_day AS age FROM cu) t GROUP BY 1, 2, 3, 4 HAVING count(profile_day) > 0"""


def _core(spark, sf_dir):
    df = pings(spark, sf_dir)
    from ..operators.quality import unique_documents

    df = unique_documents(df)  # the earliest of a document's rows, so that the result does not depend on the run
    day = F.when(F.col("k") % 10 != 0, F.unix_date("submission_date") - F.col("profile_offset_days"))
    return df.select("document_id", "client_id", "submission_date", (8 + F.col("user_id") % 16).cast("string").alias("os_version"), N.norm_country(F.col("raw_country"), iso_countries()).alias("country"), N.norm_channel(F.col("raw_channel")).alias("channel"), day.alias("profile_day"))


@query("a08_mobile_retention", with_flat(_MOBILE))
def mobile(spark, sf_dir):
    return plain(usage.mobile_retention(_core(spark, sf_dir), "weekly"))


@query("a08_mobile_retention_monthly", with_flat(_MOBILE.replace("CAST(date_trunc('week', submission_date + 1) AS DATE) - 1 AS period", "CAST(date_trunc('month', submission_date) AS DATE) AS period")))
def mobile_monthly(spark, sf_dir):
    return plain(usage.mobile_retention(_core(spark, sf_dir), "monthly"))


#: The dimensions of the stability tables in the flat form.
_DIMS = "CAST(40 + user_id % 12 AS VARCHAR) || '.0' AS build_version, build_id, 'x86' AS build_architecture, channel, os, CASE WHEN user_id % 5 < 2 THEN '6.1' ELSE '10.0' END AS os_version, '1' AS os_servicepack_major, '0' AS os_servicepack_minor, 'en-US' AS locale, CASE WHEN k % 2 = 0 THEN 'exp' END AS active_experiment_id, CASE WHEN k % 2 = 0 THEN 'a' END AS active_experiment_branch, country"
_VALUES = {"plugin_hangs": "CASE WHEN k % 3 > 0 THEN k % 3 END", "aborts_content": "CASE WHEN k % 2 > 0 THEN 1 END", "crashes_detected_plugin": "plugin_crashes"}
_SUM = lambda zero: ", ".join(f"CAST({'coalesce(' if zero else ''}sum({_VALUES.get(c, 'NULL::INT')}){', 0)' if zero else ''} AS BIGINT) AS {c}" for c in stability.SUMS)
_MAIN_SUMS = f"CAST(sum(CASE WHEN reason = 'aborted-session' THEN 1 ELSE 0 END) AS BIGINT) AS aborted_session_count, CAST(sum(clamped) AS BIGINT) AS subsession_lengths, {_SUM(False)}"
_WINDOW = "submission_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-24'"
_MAIN = f"SELECT {_DIMS}, {_MAIN_SUMS} FROM m WHERE {_WINDOW} AND activity_date = DATE '2024-01-15' GROUP BY ALL"
_CRASH = f"SELECT {_DIMS}, has_environment AS has_crash_environment, count(*) AS crashes FROM c WHERE {_WINDOW} AND crash_date = DATE '2024-01-15' GROUP BY ALL"


@query("a09_stability_main", with_flat(_MAIN))
def main_rollup(spark, sf_dir):
    return stability.stability_main(mains(spark, sf_dir), DAY, YESTERDAY)


def _actives_sql(first, start):
    dims = _DIMS.replace("build_id, ", "")
    names = ", ".join(d for d in stability.DIMS if d != "build_id")
    return with_flat(f"""SELECT {names}, active_days, count(*) AS active_users FROM (SELECT {dims}, row_number() OVER (PARTITION BY client_id ORDER BY activity_date DESC, ts DESC, event_id DESC) AS r, dense_rank() OVER (PARTITION BY client_id ORDER BY activity_date) AS active_days
      FROM m WHERE submission_date BETWEEN DATE '{start}' AND DATE '2024-01-24' AND activity_date BETWEEN DATE '{first}' AND DATE '2024-01-15') t WHERE r = 1 GROUP BY ALL""")


@query("a10_stability_actives", _actives_sql("2024-01-15", "2024-01-14"))
def actives(spark, sf_dir):
    return stability.stability_actives(mains(spark, sf_dir), DAY, yesterday=YESTERDAY)


@query("a10_stability_actives_weekly", _actives_sql("2024-01-09", "2024-01-07"))
def weekly_actives(spark, sf_dir):
    return stability.stability_actives(mains(spark, sf_dir), DAY, weekly=True, yesterday=YESTERDAY)


@query("a11_stability_crashes", with_flat(_CRASH))
def crash_rollup(spark, sf_dir):
    return stability.stability_crashes(crashes(spark, sf_dir), DAY, YESTERDAY)


@query(
    "a12_usage_aggregate",
    with_flat(f"""SELECT submission_date, subsession_date, {', '.join(stability.DIMS)}, CAST(sum(a) AS BIGINT) AS aborts_main, CAST(sum(l) AS BIGINT) AS subsession_length, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in stability.SUMS)}, CAST(sum(x) AS BIGINT) AS crashes_detected_main FROM (
  SELECT CAST(submission_date AS VARCHAR) AS submission_date, CAST(activity_date AS VARCHAR) AS subsession_date, {_DIMS}, CASE WHEN reason = 'aborted-session' THEN 1 ELSE 0 END AS a, clamped AS l, {', '.join(f'coalesce({_VALUES.get(c, "0")}, 0) AS {c}' for c in stability.SUMS)}, 0 AS x FROM m WHERE submission_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
  UNION ALL SELECT CAST(submission_date AS VARCHAR), CAST(crash_date AS VARCHAR), {_DIMS}, 0, 0, {', '.join('0' for _ in stability.SUMS)}, 1 FROM c WHERE submission_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16') t GROUP BY ALL"""),
)
def usage_table(spark, sf_dir):
    return plain(stability.usage_aggregate(mains(spark, sf_dir), crashes(spark, sf_dir), (date(2024, 1, 10), date(2024, 1, 16))))


_SUMMARY = ["aborted_session_count", "subsession_lengths", *stability.SUMS]


@query(
    "a13_stability_summary",
    with_flat(f"""SELECT channel, build_id, os, {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in [*_SUMMARY, 'crashes'])} FROM (
  SELECT channel, build_id, os, {', '.join(_SUMMARY)}, 0 AS crashes FROM ({_MAIN}) a UNION ALL SELECT channel, build_id, os, {', '.join('0' for _ in _SUMMARY)}, crashes FROM ({_CRASH}) b) t GROUP BY ALL"""),
)
def summary(spark, sf_dir):
    return stability.stability_summary(stability.stability_main(mains(spark, sf_dir), DAY, YESTERDAY), stability.stability_crashes(crashes(spark, sf_dir), DAY, YESTERDAY))


_ROLLED = "submission_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-28' AND {0} BETWEEN DATE '2024-01-10' AND DATE '2024-01-22' AND submission_date - {0} BETWEEN -1 AND 9"
_ROLLED_MAIN = f"SELECT CAST(activity_date AS VARCHAR) AS activity_date, {_DIMS}, {_MAIN_SUMS} FROM m WHERE {_ROLLED.format('activity_date')} GROUP BY ALL"
_ROLLED_CRASH = f"SELECT CAST(crash_date AS VARCHAR) AS activity_date, {_DIMS}, has_environment AS has_crash_environment, count(*) AS crashes FROM c WHERE {_ROLLED.format('crash_date')} GROUP BY ALL"


def _rolled(spark, sf_dir, name):
    return plain(stability.stability_rollups(mains(spark, sf_dir), crashes(spark, sf_dir), date(2024, 1, 20), date(2024, 1, 22), yesterday=YESTERDAY)[name])


@query("a39_stability_rollups", with_flat(_ROLLED_MAIN))
def rollups(spark, sf_dir):
    return _rolled(spark, sf_dir, "main")


@query("a39_rollup_crashes", with_flat(_ROLLED_CRASH))
def rollup_crashes(spark, sf_dir):
    return _rolled(spark, sf_dir, "crashes")


@query(
    "a39_rollup_actives",
    with_flat(f"""SELECT CAST(activity_date AS VARCHAR) AS activity_date, {', '.join(d for d in stability.DIMS if d != 'build_id')}, CAST(1 AS BIGINT) AS active_days, count(*) AS active_users FROM (SELECT activity_date, {_DIMS.replace('build_id, ', '')}, row_number() OVER (PARTITION BY client_id, activity_date ORDER BY ts DESC, event_id DESC) AS r FROM m WHERE {_ROLLED.format('activity_date')}) t WHERE r = 1 GROUP BY ALL"""),
)
def rollup_actives(spark, sf_dir):
    return _rolled(spark, sf_dir, "actives")


@query(
    "a39_rollup_actives_weekly",
    with_flat(f""", ends AS (SELECT CAST(DATE '2024-01-10' + CAST(i AS INT) AS DATE) AS day FROM range(0, 13) r(i)),
w AS (SELECT day, client_id, {_DIMS.replace('build_id, ', '')}, dense_rank() OVER (PARTITION BY day, client_id ORDER BY activity_date) AS active_days, row_number() OVER (PARTITION BY day, client_id ORDER BY activity_date DESC, ts DESC, event_id DESC) AS r
  FROM m JOIN ends ON activity_date <= day AND activity_date > day - 7 AND submission_date BETWEEN day - 8 AND least(day + 9, DATE '2024-01-28'))
SELECT CAST(day AS VARCHAR) AS activity_date, {', '.join(d for d in stability.DIMS if d != 'build_id')}, active_days, count(*) AS active_users FROM w WHERE r = 1 GROUP BY ALL"""),
)
def rollup_actives_weekly(spark, sf_dir):
    return _rolled(spark, sf_dir, "actives_weekly")


@query("a39_rollup_usage", SQL["a12_usage_aggregate"].replace("2024-01-10", "2024-01-20").replace("2024-01-16", "2024-01-22"))
def rollup_usage(spark, sf_dir):
    return _rolled(spark, sf_dir, "usage")


@query(
    "a39_rollup_summary",
    with_flat(f"""SELECT activity_date, channel, build_id, os, {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in [*_SUMMARY, 'crashes'])} FROM (
  SELECT activity_date, channel, build_id, os, {', '.join(_SUMMARY)}, 0 AS crashes FROM ({_ROLLED_MAIN}) a UNION ALL SELECT activity_date, channel, build_id, os, {', '.join('0' for _ in _SUMMARY)}, crashes FROM ({_ROLLED_CRASH}) b) t GROUP BY ALL"""),
)
def rollup_summary(spark, sf_dir):
    return _rolled(spark, sf_dir, "summary")


_SIZES = "z AS (SELECT channel, CASE WHEN doc_type IN ('main', 'saved-session') THEN doc_type ELSE 'other' END AS doc_type, submission_date, CASE WHEN user_id % 4 = 0 THEN NULL ELSE submission_date - CAST(user_id % 5 AS INT) END AS build_day, length(props) * 100 AS size FROM f)"
_BY_DAY = f""", {_SIZES}, u AS (SELECT 'submission' AS kind, channel, submission_date AS day, doc_type, size FROM z UNION ALL SELECT 'build', channel, build_day, doc_type, size FROM z WHERE build_day IS NOT NULL),
g AS (SELECT kind, channel, day, doc_type, count(*) AS count, CAST(sum(size) AS BIGINT) AS size FROM u GROUP BY ALL), q AS (SELECT *, dense_rank() OVER (PARTITION BY kind, channel ORDER BY day DESC) AS r FROM g)"""


def _sizes(spark, sf_dir):
    df = pings(spark, sf_dir)
    build = F.concat(F.when(F.col("user_id") % 4 == 0, "x").otherwise(""), F.date_format(F.date_sub("submission_date", (F.col("user_id") % 5).cast("int")), "yyyyMMdd"), F.lit("0302"))
    return df.select(N.norm_channel(F.col("raw_channel")).alias("channel"), "doc_type", "submission_date", build.alias("build"), (F.length("props") * 100).alias("size"))


@query("a14_size_by_channel_day", with_flat(_BY_DAY + " SELECT kind, channel, CAST(day AS VARCHAR) AS day, doc_type, count, size FROM q WHERE r <= 12"))
def sizes(spark, sf_dir):
    return plain(budget.size_by_channel_day(_sizes(spark, sf_dir), 12))


@query("t01_newest_days", with_flat("SELECT event_id FROM (SELECT event_id, dense_rank() OVER (PARTITION BY channel ORDER BY submission_date DESC) AS r FROM f) t WHERE r <= 3"))
def newest(spark, sf_dir):
    df = pings(spark, sf_dir).withColumn("channel", N.norm_channel(F.col("raw_channel")))
    return budget.newest_days(df, ["channel"], "submission_date", 3).select("event_id")


_TARGETS = "SELECT channel, doc_type, 2 AS clients, CAST(avg(size) AS BIGINT) AS size, count(*) // 80 + 1 AS count FROM z GROUP BY ALL"


@query(
    "a15_budget_alerts",
    with_flat(_BY_DAY + f""", tg AS ({_TARGETS}), hit AS (SELECT q.channel, q.doc_type, q.size AS actual, tg.size * tg.count * tg.clients AS expected FROM q JOIN tg ON q.channel = tg.channel AND q.doc_type = tg.doc_type WHERE kind = 'submission' AND day = DATE '2024-01-20')
SELECT channel, doc_type, actual, CAST(expected AS BIGINT) AS expected, 'Channel ' || channel || ', Type ' || doc_type || ': Actual ' || printf('%.2fGB', actual / 1073741824.0) || ' > Expected ' || printf('%.2fGB', expected / 1073741824.0) || ' (' || printf('%.1f%%', 100.0 * actual / expected) || ')' AS alert FROM hit WHERE actual > expected"""),
)
def alerts(spark, sf_dir):
    own = _sizes(spark, sf_dir)
    typed = own.withColumn("doc_type", N.doc_type3(F.col("doc_type")))
    targets = typed.groupBy("channel", "doc_type").agg(F.lit(2).alias("clients"), F.round(F.avg("size")).cast("long").alias("size"), (F.floor(F.count(F.lit(1)) / 80) + 1).alias("count"))
    return budget.budget_alerts(budget.size_by_channel_day(own, 60), targets, date(2024, 1, 20))


_ORIGIN = "CASE WHEN key LIKE '%abouthome%' THEN 'abouthome' WHEN key LIKE '%contextmenu%' THEN 'contextmenu' WHEN key LIKE '%searchbar%' THEN 'searchbar' WHEN key LIKE '%urlbar%' THEN 'urlbar' END"


@query(
    "a16_search_totals",
    with_flat(f""", k1 AS (SELECT submission_date AS day, country, list_extract(['google', 'bing', 'yahoo', 'other'], engine_id + 1) AS engine, 'urlbar' AS key, k % 5 AS n FROM f UNION ALL SELECT submission_date, country, list_extract(['google', 'bing', 'yahoo', 'other'], engine_id + 1), 'searchbar', 1 FROM f),
pt AS (SELECT day, engine, 'origin' AS kind, {_ORIGIN} AS name, n FROM k1 UNION ALL SELECT day, engine, 'origin', 'total', n FROM k1 UNION ALL SELECT day, engine, 'country', CASE WHEN country IN ('US', 'CN', 'RU') THEN country END, n FROM k1 UNION ALL SELECT day, engine, 'country', 'Total', n FROM k1),
g AS (SELECT day, engine, kind, name, sum(n) AS n FROM pt WHERE name IS NOT NULL GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(min(submission_date), max(submission_date), INTERVAL '1' DAY)) AS DATE) AS day FROM f)
SELECT CAST(days.day AS VARCHAR) AS day, kk.engine, kk.kind, kk.name, CAST(coalesce(g.n, 0) AS BIGINT) AS searches FROM (SELECT DISTINCT engine, kind, name FROM g) kk CROSS JOIN days LEFT JOIN g ON g.day = days.day AND g.engine = kk.engine AND g.kind = kk.kind AND g.name = kk.name"""),
)
def searches(spark, sf_dir):
    country = N.norm_country(F.col("geo_country"), iso_countries())
    return plain(usage.search_totals(nested(spark, sf_dir), F.try_element_at("payload.keyedHistograms", F.lit("SEARCH_COUNTS")), country))


@query("a17_usage_hours", with_flat("SELECT CAST(submission_date AS VARCHAR) AS day, round(sum(hours), 4) AS hours FROM s WHERE (SELECT max(submission_date) FROM s) - submission_date < 30 GROUP BY 1"))
def hours(spark, sf_dir):
    return plain(rounded(usage.usage_hours_by_day(summaries(spark, sf_dir)), "hours"))


@query("a17_usage_hours_monthly", with_flat(", months AS (SELECT CAST(unnest(generate_series(date_trunc('month', max(submission_date)) - INTERVAL '11' MONTH, date_trunc('month', max(submission_date)), INTERVAL '1' MONTH)) AS DATE) AS month FROM s) SELECT CAST(month AS VARCHAR) AS month, round(coalesce(sum(hours), 0.0), 2) AS hours FROM months LEFT JOIN s ON CAST(date_trunc('month', submission_date) AS DATE) = month GROUP BY 1"))
def hours_monthly(spark, sf_dir):
    return plain(usage.usage_hours_by_month(summaries(spark, sf_dir)).withColumn("hours", F.round("hours", 2)))


@query("a18_active_instances", with_flat("SELECT CAST(submission_date AS VARCHAR) AS day, count(DISTINCT client_id) AS clients FROM s GROUP BY 1"))
def instances(spark, sf_dir):
    return plain(usage.active_instances(summaries(spark, sf_dir)))


def _near(estimate, exact):
    """Whether an estimate is within a twentieth of the exact count, or off by one."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * 0.05)


@query("a18_active_instances_sketch", with_flat("SELECT CAST(date_trunc('month', submission_date) AS VARCHAR) AS month, count(DISTINCT client_id) AS clients, TRUE AS near FROM s GROUP BY 1").replace("CAST(date_trunc('month', submission_date) AS VARCHAR)", "strftime(submission_date, '%Y-%m-01')"))
def instances_sketch(spark, sf_dir):
    """The sketch beside the exact count: near tells whether it is within its error."""
    df = summaries(spark, sf_dir)
    exact, sketch = (usage.active_instances(df, exact=e, period="month") for e in (True, False))
    both = exact.join(sketch.withColumnRenamed("clients", "estimate"), "month")
    return plain(both.select("month", "clients", _near(F.col("estimate"), F.col("clients")).alias("near")))


_DAYS = "d AS (SELECT DISTINCT client_id, submission_date AS day FROM s)"


@query("a19_dau_wau_mau", with_flat(f", {_DAYS} SELECT CAST(t.day AS VARCHAR) AS day, count(DISTINCT CASE WHEN d.day = t.day THEN client_id END) AS dau, count(DISTINCT CASE WHEN t.day - d.day < 7 THEN client_id END) AS wau, count(DISTINCT client_id) AS mau FROM (SELECT DISTINCT day FROM d) t JOIN d ON d.day <= t.day AND t.day - d.day < 28 GROUP BY t.day"))
def dau(spark, sf_dir):
    return plain(usage.dau_wau_mau(_days(spark, sf_dir)))


@query("a19_dau_wau_mau_sketch", f"SELECT *, TRUE AS near FROM ({SQL['a19_dau_wau_mau']}) q")
def dau_sketch(spark, sf_dir):
    """The sketches beside the exact counts: near tells whether all three are within their error."""
    days = _days(spark, sf_dir)
    names = ("dau", "wau", "mau")
    sketch = usage.dau_wau_mau(days, exact=False).withColumnsRenamed({n: f"{n}_estimate" for n in names})
    near = reduce(Column.__and__, [_near(F.col(f"{n}_estimate"), F.col(n)) for n in names])
    return plain(usage.dau_wau_mau(days).join(sketch, "day").select("day", *names, near.alias("near")))


def _days(spark, sf_dir):
    return summaries(spark, sf_dir).select("client_id", F.to_date("timestamp").alias("day"))


def _retention_sql(n):
    return with_flat(f""", {_DAYS}, f0 AS (SELECT client_id, min(day) AS first FROM d GROUP BY 1), k0 AS (SELECT DISTINCT d.client_id, first, (day - first - 1) // {n} AS i FROM d JOIN f0 USING (client_id) WHERE day > first),
w0 AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY i) - 1 AS r FROM k0), b0 AS (SELECT CAST(date_trunc('week', first + 1) AS DATE) - 1 AS cohort, CAST(i AS INT) AS i, count(*) AS users FROM w0 WHERE i = r GROUP BY ALL),
z0 AS (SELECT CAST(date_trunc('week', first + 1) AS DATE) - 1 AS cohort, count(*) AS n FROM f0 GROUP BY 1) SELECT CAST(cohort AS VARCHAR) AS cohort, n AS cohort_user_count, i AS "interval", coalesce(users, 0) AS users FROM z0 LEFT JOIN b0 USING (cohort)""")


def _register_retention(name, n):
    @query(f"a20_retention_{name}", _retention_sql(n))
    def run(spark, sf_dir):
        return plain(usage.retention(_days(spark, sf_dir), n))


for _name, _n in (("daily", 1), ("weekly", 7), ("monthly", 28)):
    _register_retention(_name, _n)


@query("a21_sketch_error", with_flat("SELECT CAST(submission_date AS VARCHAR) AS day, count(DISTINCT client_id) AS exact, TRUE AS near FROM s GROUP BY 1"))
def sketch_error(spark, sf_dir):
    errors = usage.sketch_error(_days(spark, sf_dir))
    return plain(errors.select("day", "exact", (F.abs(F.col("ratio") - 1) <= F.greatest(F.lit(0.1), 1 / F.col("exact"))).alias("near")))


_ENGAGE = """SELECT t.day AS day, CAST(sum(CASE WHEN daily THEN 1 ELSE 0 END) AS BIGINT) AS dau, count(*) AS mau, round(sum(CASE WHEN daily THEN 1 ELSE 0 END) / count(*), 6) AS ratio FROM (
  SELECT t.day, client_id, bool_or(activity_date = t.day AND submission_date >= t.day) AS daily FROM ({days}) t JOIN m ON activity_date BETWEEN t.day - 28 AND t.day AND submission_date BETWEEN t.day - 28 AND t.day + 10 GROUP BY ALL) t GROUP BY 1"""


def _activity(spark, sf_dir):
    return mains(spark, sf_dir).select("client_id", F.col("subsession_date").alias("activity_date"), "submission_date")


@query("a22_engagement", with_flat(f"SELECT CAST(day AS VARCHAR) AS day, dau, mau, ratio FROM ({_ENGAGE.format(days='SELECT DISTINCT submission_date AS day FROM m')}) e"))
def engagement(spark, sf_dir):
    a = _activity(spark, sf_dir)
    return plain(usage.engagement(a, a.select(F.col("submission_date").alias("day")))).withColumn("ratio", F.round("ratio", 6))


@query(
    "a22_update_engagement",
    with_flat(f""", ex AS (SELECT DISTINCT submission_date AS day, 1 AS dau, 2 AS mau, 0.5 AS ratio, submission_date + CAST(day(submission_date) % 20 AS INT) AS generated_on FROM m WHERE day(submission_date) % 7 <> 0),
due AS (SELECT DATE '2024-01-30' - CAST(i AS INT) AS day FROM range(1, 31) r(i) WHERE DATE '2024-01-30' - CAST(i AS INT) NOT IN (SELECT day FROM ex WHERE generated_on >= DATE '2024-01-30' OR generated_on - day > 10))
SELECT CAST(day AS VARCHAR) AS day, dau, mau, ratio, CAST(generated_on AS VARCHAR) AS generated_on FROM ex WHERE day NOT IN (SELECT day FROM due) UNION ALL SELECT CAST(day AS VARCHAR), dau, mau, ratio, '2024-01-30' FROM ({_ENGAGE.format(days='SELECT day FROM due')}) e"""),
)
def engagement_update(spark, sf_dir):
    a = _activity(spark, sf_dir)
    days = a.select(F.col("submission_date").alias("day")).distinct().where(F.dayofmonth("day") % 7 != 0)
    existing = days.select("day", F.lit(1).cast("long").alias("dau"), F.lit(2).cast("long").alias("mau"), F.lit(0.5).alias("ratio"), F.date_add("day", F.dayofmonth("day") % 20).alias("generated_on"))
    return plain(usage.update_engagement(existing, a, date(2024, 1, 30)).withColumn("ratio", F.round("ratio", 6)))


def _longitudinal(spark, sf_dir):
    """Sessions of each client, newest first, with versions that change over the days."""
    df = pings(spark, sf_dir)
    version = F.when(F.col("user_id") % 29 == 0, None).when(F.col("user_id") % 23 == 0, "x.1").otherwise(F.concat((36 + F.col("user_id") % 14).cast("string"), F.lit(".0.1")))
    text = F.when(F.col("event_id") % 13 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd'T'00:00:00"))
    codes = F.when(F.col("user_id") % 11 != 0, F.array((F.col("user_id") % 3 == 0).cast("int"), F.lit(0), (F.col("user_id") % 2).cast("int")))
    own = df.select("client_id", "ts", "event_id", version.alias("version"), text.alias("subsession_start_date"), F.when(F.col("k") % 7 != 0, F.col("k") * 10).alias("subsession_length"), F.when(F.col("user_id") % 6 != 0, F.col("user_id") % 3 != 1).alias("enabled"), codes.alias("update_check_code_notify"), (F.col("user_id") % 5 - 2).alias("update_check_no_update_notify"))
    return derive.longitudinal(own, "client_id", ["ts", "event_id"], ["version", "subsession_start_date", "subsession_length", "enabled", "update_check_code_notify", "update_check_no_update_notify"])


_LONG = """, l0 AS (SELECT *, CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 23 = 0 THEN 'x.1' ELSE CAST(36 + user_id % 14 AS VARCHAR) || '.0.1' END AS version, event_id % 13 = 0 AS bad, CASE WHEN k % 7 <> 0 THEN k * 10 END AS len,
  CASE WHEN user_id % 6 <> 0 THEN user_id % 3 <> 1 END AS enabled, row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) AS r FROM f),
l1 AS (SELECT *, min(CASE WHEN NOT bad AND submission_date < DATE '2024-01-30' - 6 - 84 THEN r END) OVER (PARTITION BY client_id) AS cut FROM l0),
cl AS (SELECT client_id, any_value(user_id) AS u, max(version) AS version, bool_or(enabled) AS enabled, max(CASE WHEN r = 1 THEN bad END) AS first_bad, max(CASE WHEN r = 1 THEN submission_date END) AS first_day, sum(CASE WHEN NOT bad AND (cut IS NULL OR r < cut) THEN coalesce(len, 0) ELSE 0 END) AS secs FROM l1 GROUP BY 1),
st AS (SELECT *, CASE WHEN version IS NULL THEN 'none-version' WHEN version = 'x.1' THEN 'value-error' WHEN CAST(split_part(version, '.', 1) AS INT) < 42 THEN 'ignore-version-too-low' WHEN CAST(split_part(version, '.', 1) AS INT) >= 50 - 2 THEN 'up-to-date' WHEN secs >= 7200 THEN 'out-of-date' ELSE 'out-of-date-not-run-long-enough' END AS status FROM cl WHERE NOT first_bad AND first_day >= DATE '2024-01-07')"""
_WEDNESDAY = date(2024, 1, 24)


def _statuses(spark, sf_dir):
    return updates.update_status(updates.recent(_longitudinal(spark, sf_dir), date(2024, 1, 7)), 50, _WEDNESDAY)


@query("j14_longitudinal", with_flat("SELECT client_id, event_id, nth FROM (SELECT client_id, event_id, CAST(row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) - 1 AS INT) AS nth FROM f) t"))
def longitudinal(spark, sf_dir):
    out = derive.longitudinal(pings(spark, sf_dir), "client_id", ["ts", "event_id"], ["event_id", "doc_type"])
    return out.select("client_id", F.posexplode("event_id").alias("nth", "event_id")).select("client_id", "event_id", "nth")


@query("f06_recent_clients", with_flat(_LONG + " SELECT client_id FROM cl WHERE NOT first_bad AND first_day >= DATE '2024-01-30'"))
def recent(spark, sf_dir):
    return updates.recent(_longitudinal(spark, sf_dir), date(2024, 1, 30)).select("client_id")


@query("a23_update_status", with_flat(_LONG + " SELECT status, count(*) AS clients FROM st GROUP BY 1"))
def update_status(spark, sf_dir):
    return updates.counted(_statuses(spark, sf_dir), "status")


@query("a24_update_enabled", with_flat(_LONG + """ SELECT CASE WHEN enabled IS NULL THEN 'none-update-enabled' WHEN enabled THEN 'update-enabled' ELSE 'update-disabled' END AS "update", count(*) AS clients FROM st WHERE status = 'out-of-date' GROUP BY 1"""))
def update_enabled(spark, sf_dir):
    return updates.counted(updates.update_enabled(_statuses(spark, sf_dir)), "update")


@query("a25_orphan_versions", with_flat(_LONG + " SELECT version AS newest_version, count(*) AS clients FROM st WHERE status = 'out-of-date' AND enabled GROUP BY 1"))
def orphans(spark, sf_dir):
    return updates.orphan_versions(_statuses(spark, sf_dir))


@query("a26_update_check_codes", with_flat(_LONG + " SELECT CASE WHEN u % 11 <> 0 AND u % 3 = 0 THEN 0 WHEN u % 11 <> 0 AND u % 2 = 1 THEN 2 WHEN u % 5 - 2 > 0 THEN 0 ELSE -1 END AS check_code, count(*) AS clients FROM cl GROUP BY 1"))
def check_codes(spark, sf_dir):
    return updates.counted(updates.update_check_code(_longitudinal(spark, sf_dir)), "check_code")


@query("sf12_latest_version", "SELECT max(v) AS latest FROM (SELECT l_suppkey % 50 AS v, CAST(l_shipdate AS DATE) AS d FROM lineitem) t WHERE d = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1996-06-01')")
def latest_version(spark, sf_dir):
    rel = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).cast("long").alias("version"), F.to_date("l_shipdate").alias("released"))
    return updates.latest_version(rel, date(1996, 6, 1))


_LATEST = with_flat("SELECT client_id, event_id, channel FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts DESC, event_id DESC) AS r FROM s) t WHERE r = 1")


@query("w01_latest_row", _LATEST)
def latest_row(spark, sf_dir):
    return reports.latest(summaries(spark, sf_dir), "client_id", ["timestamp", "event_id"], ["event_id", "channel"])


@query("w02_active_day_rank", with_flat("SELECT event_id, CAST(dense_rank() OVER (PARTITION BY client_id ORDER BY activity_date) AS INT) AS active_day FROM m"))
def day_rank(spark, sf_dir):
    return stability.active_day_rank(mains(spark, sf_dir)).select("event_id", "active_day")


@query("w03_trailing_frame", with_flat("SELECT client_id, CAST(day AS VARCHAR) AS day, CAST(sum(n) OVER (PARTITION BY client_id ORDER BY day RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week FROM (SELECT client_id, submission_date AS day, count(*) AS n FROM f GROUP BY ALL) t"))
def trailing(spark, sf_dir):
    per = pings(spark, sf_dir).groupBy("client_id", F.col("submission_date").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("d", F.unix_date("day"))
    return plain(per.select("client_id", "day", F.sum("n").over(Window.partitionBy("client_id").orderBy("d").rangeBetween(-6, 0)).alias("week")))


@query("w05_state_as_of", with_flat("SELECT event_id, CAST(min(submission_date) OVER (PARTITION BY client_id) AS VARCHAR) AS first_seen, last_value(CASE WHEN k % 3 = 0 THEN channel END IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS channel FROM f"))
def as_of(spark, sf_dir):
    w = Window.partitionBy("client_id")
    known = F.when(F.col("k") % 3 == 0, N.norm_channel(F.col("raw_channel")))
    return plain(pings(spark, sf_dir).select("event_id", F.min("submission_date").over(w).alias("first_seen"), F.last(known, ignorenulls=True).over(w.orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)).alias("channel")))


@query("jn01_lost_clients", with_flat(f"SELECT event_id FROM s WHERE {_LAST} AND client_id NOT IN (SELECT client_id FROM s WHERE {_THIS})"))
def lost(spark, sf_dir):
    this, last = _periods(spark, sf_dir)
    return reports.lost_clients(last, this).select("event_id")


@query("jn02_full_merge", with_flat(_REPORT))
def full_merge(spark, sf_dir):
    this, last = _periods(spark, sf_dir)
    parts = [rounded(reports.easy_aggregates(this, WEEK), "hours"), reports.client_aggregates(this, WEEK), reports.inactives(last, this, WEEK), reports.five_of_seven(this, WEEK, "weekly")]
    return reports.merge_aggregates(parts, [*reports.DIMS, "date"]).withColumn("total_records", F.col("actives") + F.col("inactives"))


@query("jn03_segment_join", with_flat("SELECT channel, os, a.n AS pings, b.n AS crashes FROM (SELECT channel, os, count(*) AS n FROM m GROUP BY ALL) a JOIN (SELECT channel, os, count(*) AS n FROM c GROUP BY ALL) b USING (channel, os)"))
def segment_join(spark, sf_dir):
    count = lambda df, n: df.groupBy("channel", "os").agg(F.count(F.lit(1)).alias(n))
    return count(mains(spark, sf_dir), "pings").join(count(crashes(spark, sf_dir), "crashes"), ["channel", "os"])


@query("u02_padded_union", with_flat("SELECT channel, CAST(sum(a) AS BIGINT) AS sessions, CAST(sum(b) AS BIGINT) AS crashes FROM (SELECT channel, 1 AS a, 0 AS b FROM m UNION ALL SELECT channel, 0, 1 FROM c) t GROUP BY 1"))
def padded_union(spark, sf_dir):
    both = mains(spark, sf_dir).select("channel", F.lit(1).alias("sessions")).unionByName(crashes(spark, sf_dir).select("channel", F.lit(1).alias("crashes")), allowMissingColumns=True)
    return both.fillna(0).groupBy("channel").agg(F.sum("sessions").alias("sessions"), F.sum("crashes").alias("crashes"))


@query("u03_except_clients", with_flat(f"SELECT client_id FROM s WHERE {_LAST} EXCEPT SELECT client_id FROM s WHERE {_THIS}"))
def except_clients(spark, sf_dir):
    this, last = _periods(spark, sf_dir)
    return last.select("client_id").subtract(this.select("client_id"))


@query("jn07_sessions_and_crashes", with_flat("SELECT coalesce(a.channel, b.channel) AS channel, coalesce(a.os, b.os) AS os, coalesce(sessions, 0) AS sessions, coalesce(crashes, 0) AS crashes FROM (SELECT channel, os, count(*) AS sessions FROM m GROUP BY ALL) a FULL JOIN (SELECT channel, os, count(*) AS crashes FROM c GROUP BY ALL) b ON a.channel = b.channel AND a.os = b.os"))
def sessions_and_crashes(spark, sf_dir):
    count = lambda df, n: df.groupBy("channel", "os").agg(F.count(F.lit(1)).alias(n))
    return reports.merge_aggregates([count(mains(spark, sf_dir), "sessions"), count(crashes(spark, sf_dir), "crashes")], ["channel", "os"])
