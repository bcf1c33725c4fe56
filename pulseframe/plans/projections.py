"""Queries of the row projections and predicates, over all submissions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions.normalize import iso_countries
from ..functions import warehouse as W
from ..operators import usage
from ..sources import dims
from .fixtures import nested, pings, with_flat
from .registry import QUERIES, SQL, query, table

_VERSIONS = ("10.0", "6.1", "6.2", "6.3", "5.1", "x")
def _version():
    return F.element_at(F.array(*[F.lit(v) for v in _VERSIONS]), (F.col("user_id") % 6 + 1).cast("int"))
_version_sql = "list_extract(['10.0', '6.1', '6.2', '6.3', '5.1', 'x'], CAST(user_id % 6 AS INT) + 1)"
def _build():
    return F.concat(F.when(F.col("user_id") % 4 == 0, "x").otherwise(""), F.date_format("ts", "yyyyMMdd"), F.lit("0302"))
_build_sql = "CASE WHEN user_id % 4 = 0 THEN 'x' ELSE '' END || strftime(ts, '%Y%m%d') || '0302'"
def _when():
    return F.when(F.col("user_id") % 3 == 0, F.date_format("submission_date", "yyyy-MM-dd'T'10:20:30'Z'")).when(F.col("user_id") % 3 == 1, F.date_format("submission_date", "yyyy-MM-dd")).otherwise("soon")
def _ip():
    return F.when(F.col("user_id") % 3 == 0, F.concat(F.lit(" , 10.0.0."), F.col("k").cast("string"), F.lit(", 1.1.1.1"))).when(F.col("user_id") % 3 == 1, "")

#: name -> (Spark columns, SQL select list) over pings and their flat form.
SIMPLE = {
    "p01_norm_channel": (lambda: [N.norm_channel(F.col("raw_channel")).alias("channel")], "channel"),
    "p02_norm_os": (lambda: [N.norm_os(F.col("raw_os")).alias("os")], "os"),
    "p04_win_version_bucket": (lambda: [N.win_version_bucket(_version()).alias("bucket")], f"CASE {_version_sql} WHEN '10.0' THEN 'Windows 10' WHEN '6.1' THEN 'Windows 7' WHEN '6.2' THEN 'Windows 8' WHEN '6.3' THEN 'Windows 8' ELSE 'Other' END AS bucket"),
    "p05_dimension_ids": (
        lambda: [N.dimension_id(N.norm_channel(F.col("raw_channel")), N.CHANNELS).alias("channel_id"), N.dimension_name(N.dimension_id(N.norm_os(F.col("raw_os")), N.SYSTEMS), N.SYSTEMS).alias("os")],
        "CASE channel WHEN 'release' THEN 1 WHEN 'beta' THEN 2 WHEN 'nightly' THEN 3 WHEN 'aurora' THEN 4 ELSE 0 END AS channel_id, os",
    ),
    "p06_activity_ts": (lambda: [N.activity_ts(_when(), F.col("ts")).alias("activity")], "CASE user_id % 3 WHEN 0 THEN CAST(submission_date AS TIMESTAMP) + INTERVAL '10' HOUR + INTERVAL '20' MINUTE + INTERVAL '30' SECOND WHEN 1 THEN CAST(submission_date AS TIMESTAMP) ELSE ts END AS activity"),
    "p07_usage_hours": (lambda: [F.round(N.usage_hours(F.col("seconds")), 6).alias("lo0"), F.round(N.usage_hours(F.col("seconds"), 1), 6).alias("lo1")], "round(CASE WHEN seconds >= 0 AND seconds < 15552000 THEN seconds / 3600.0 ELSE 0.0 END, 6) AS lo0, round(CASE WHEN seconds >= 1 AND seconds < 15552000 THEN seconds / 3600.0 ELSE 0.0 END, 6) AS lo1"),
    "p12_profile_creation_ts": (lambda: [N.profile_creation_ts(F.when(F.col("k") % 10 != 0, F.unix_date("submission_date") - F.col("profile_offset_days")).otherwise(-1)).alias("created")], "CASE WHEN k % 10 <> 0 THEN profile_ts ELSE TIMESTAMP '1970-01-01' END AS created"),
    "p14_build_date": (lambda: [N.build_date(_build()).alias("build_date")], "CASE WHEN user_id % 4 = 0 THEN NULL ELSE strftime(ts, '%Y%m%d') END AS build_date"),
    "p15_doc_type3": (lambda: [N.doc_type3(F.col("doc_type")).alias("doc_type")], "CASE WHEN doc_type IN ('main', 'saved-session') THEN doc_type ELSE 'other' END AS doc_type"),
    "p16_android_version": (lambda: [N.android_version(F.col("user_id") % 25).alias("android")], "CASE WHEN user_id % 25 = 8 THEN 'Froyo' WHEN user_id % 25 IN (9, 10) THEN 'Gingerbread' WHEN user_id % 25 BETWEEN 11 AND 13 THEN 'Honeycomb' WHEN user_id % 25 IN (14, 15) THEN 'ICS' WHEN user_id % 25 BETWEEN 16 AND 18 THEN 'JellyBean' WHEN user_id % 25 = 19 THEN 'KitKat' WHEN user_id % 25 = 20 THEN 'KitKat Watch' WHEN user_id % 25 IN (21, 22) THEN 'Lollipop' WHEN user_id % 25 = 23 THEN 'Marshmallow' ELSE 'Other' END AS android"),
    "p17_top_country": (lambda: [N.top_country(F.upper("raw_country")).alias("country")], "country"),
    "p18_clamp_session": (lambda: [N.clamp_session(F.when(F.col("k") % 9 != 0, F.col("seconds"))).alias("clamped")], "CASE WHEN k % 9 = 0 THEN NULL WHEN seconds < 0 THEN 0 WHEN seconds > 90000 THEN 90000 ELSE seconds END AS clamped"),
    "p20_text_values": (
        lambda: [N.hex_to_long(F.concat(F.lit("0x"), F.hex("event_id"))).alias("address"), N.one_line(F.concat(F.lit("a\r\nb\n"), F.col("raw_os"))).alias("notes"), N.parsed_time(F.when(F.col("k") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("never")).alias("at"), F.col("raw_os").try_cast("int").alias("bad")],
        "event_id AS address, 'a|b|' || raw_os AS notes, CASE WHEN k % 2 = 0 THEN date_trunc('second', ts) END AS at, CAST(NULL AS INT) AS bad",
    ),
    "p21_flag": (lambda: [N.flag(F.when(F.col("k") % 3 == 0, "true").when(F.col("k") % 3 == 1, "maybe")).alias("flag")], "k % 3 = 0 AS flag"),
    "p22_first_forwarded_ip": (lambda: [N.first_forwarded_ip(_ip(), F.lit("9.9.9.9")).alias("ip")], "CASE WHEN user_id % 3 = 0 THEN '10.0.0.' || k ELSE '9.9.9.9' END AS ip"),
    "sf03_calendar": (
        lambda: [N.sunday_week(F.col("submission_date")).cast("string").alias("week"), N.month_start(F.col("submission_date")).cast("string").alias("month"), F.unix_date("submission_date").alias("day")],
        "CAST(CAST(date_trunc('week', submission_date + 1) AS DATE) - 1 AS VARCHAR) AS week, CAST(CAST(date_trunc('month', submission_date) AS DATE) AS VARCHAR) AS month, CAST(submission_date - DATE '1970-01-01' AS INT) AS day",
    ),
    "sf04_last_complete": (
        lambda: [N.last_complete_week(F.col("submission_date")).cast("string").alias("week"), N.last_complete_month(F.col("submission_date")).cast("string").alias("month")],
        "CAST(CAST(date_trunc('week', submission_date + 1) AS DATE) - 8 AS VARCHAR) AS week, CAST(CAST(date_trunc('month', submission_date) - INTERVAL '1' MONTH AS DATE) AS VARCHAR) AS month",
    ),
    "sf05_previous_wednesday": (lambda: [N.previous_wednesday(F.col("submission_date")).cast("string").alias("wednesday"), F.date_sub(N.previous_wednesday(F.col("submission_date")), 17).cast("string").alias("floor")], "CAST(submission_date - CAST((dayofweek(submission_date) + 4) % 7 AS INT) AS VARCHAR) AS wednesday, CAST(submission_date - CAST((dayofweek(submission_date) + 4) % 7 AS INT) - 17 AS VARCHAR) AS floor"),
    "sf06_day_number": (lambda: [N.day_number(F.date_format("ts", "yyyyMMdd")).alias("n"), F.datediff("submission_date", F.lit("2024-01-01")).alias("diff")], "CAST(submission_date - DATE '1970-01-01' AS INT) AS n, CAST(submission_date - DATE '2024-01-01' AS INT) AS diff"),
    "sf08_texts": (lambda: [N.percent(F.col("k"), F.lit(7)).alias("pct"), N.gigabytes(F.col("event_id") * 1048577).alias("gb"), N.pretty_size(F.col("event_id") * 7919 + 1).alias("size")], "printf('%.1f%%', 100.0 * k / 7) AS pct, printf('%.2fGB', event_id * 1048577 / 1073741824.0) AS gb, CASE WHEN (event_id * 7919 + 1) < 1024 THEN (event_id * 7919 + 1) || 'B' WHEN (event_id * 7919 + 1) < 1048576 THEN printf('%.2fKB', (event_id * 7919 + 1) / 1024.0) WHEN (event_id * 7919 + 1) < 1073741824 THEN printf('%.2fMB', (event_id * 7919 + 1) / 1048576.0) ELSE printf('%.2fGB', (event_id * 7919 + 1) / 1073741824.0) END AS size"),
    "w_fitted_types": (
        lambda: [W.fitted(F.col("seconds") * 1000, "SMALLINT").alias("small"), W.fitted(F.col("value"), "INTEGER").alias("whole"), W.fitted(F.concat(F.lit("é"), F.col("raw_os")), "CHAR(5)").alias("char5"), W.fitted(F.col("raw_channel"), "VARCHAR(4)").alias("var4"), W.fitted(F.col("doc_type"), "BOOLEAN").alias("bool")],
        "CAST(CASE WHEN abs(seconds * 1000) <= 32767 THEN seconds * 1000 END AS SMALLINT) AS small, CAST(floor(value) AS INT) AS whole, left('?' || raw_os, 5) AS char5, left(raw_channel, 4) AS var4, CAST(NULL AS BOOLEAN) AS bool",
    ),
    "f02_dimension_values": (
        lambda: [dims.dimension(F.col("raw_channel"), ["release", "aurora", "beta-x"]).alias("listed"), dims.dimension(F.col("raw_country"), "*").alias("any"), dims.dimension(F.col("raw_os"), {"min": "D", "max": "W"}).alias("ranged"), dims.dimension(F.col("doc_type"), {"min": "n"}).alias("least")],
        "CASE WHEN raw_channel IN ('release', 'aurora', 'beta-x') THEN replace(raw_channel, '-', '_') ELSE 'OTHER' END AS listed, CASE WHEN raw_country IS NULL THEN 'UNKNOWN' ELSE replace(raw_country, '?', '_') END AS any, CASE WHEN raw_os BETWEEN 'D' AND 'W' THEN replace(raw_os, '/', '_') ELSE 'OTHER' END AS ranged, CASE WHEN doc_type >= 'n' THEN replace(doc_type, '-', '_') ELSE 'OTHER' END AS least",
    ),
}


def _simple(columns):
    return lambda spark, sf_dir: pings(spark, sf_dir).select("event_id", *columns())


for _name, (_columns, _sql) in SIMPLE.items():
    QUERIES[_name] = _simple(_columns)
    SQL[_name] = with_flat(f"SELECT event_id, {_sql} FROM f")


@query("p03_norm_country", with_flat("SELECT event_id, country FROM f"))
def norm_country(spark, sf_dir):
    return pings(spark, sf_dir).select("event_id", N.norm_country(F.col("raw_country"), iso_countries()).alias("country"))


@query("p08_search_counts", with_flat("SELECT event_id, " + ", ".join(f"CAST(CASE WHEN engine_id = {i} THEN k % 5 + 1 ELSE 0 END AS BIGINT) AS {e}" for i, e in enumerate(N.ENGINES)) + " FROM f"))
def search_counts(spark, sf_dir):
    found = N.search_counts(F.try_element_at("payload.keyedHistograms", F.lit("SEARCH_COUNTS")))
    return nested(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in found.items()])


@query("p09_khist_sum", with_flat("SELECT event_id, CAST(plugin_crashes AS BIGINT) AS plugin, CAST(CASE WHEN k % 3 > 0 THEN k % 3 END AS BIGINT) AS hangs, CAST(NULL AS BIGINT) AS none FROM f"))
def khist_sum(spark, sf_dir):
    h = F.col("payload.keyedHistograms")
    crashes = "SUBPROCESS_CRASHES_WITH_DUMP"
    return nested(spark, sf_dir).select("event_id", N.khist_sum(h, crashes, "plugin").alias("plugin"), N.khist_sum(h, crashes, "pluginhang").alias("hangs"), N.khist_sum(h, "NO_SUCH", "x").alias("none"))


@query("p10_flash_version", with_flat("SELECT event_id, '18.0.0.' || k AS flash FROM f"))
def flash_version(spark, sf_dir):
    return nested(spark, sf_dir).select("event_id", N.flash_version(F.col("environment.addons.activePlugins")).alias("flash"))


@query("p11_num_active_addons", with_flat("SELECT event_id, k % 4 + 1 AS addons FROM f"))
def num_active_addons(spark, sf_dir):
    return nested(spark, sf_dir).select("event_id", N.num_active_addons(F.col("environment.addons.activeAddons")).alias("addons"))


#: CRC-32 of an ASCII text, a bit at a time: each character is xored in and followed by eight shifts.
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''), lambda ch: [(unicode(ch) + 256)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: xor((CASE WHEN x > 0 THEN xor(c, x - 256) ELSE c END) >> 1, CASE WHEN (CASE WHEN x > 0 THEN xor(c, x - 256) ELSE c END) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"


@query("p13_sample_id", with_flat(f"SELECT event_id, CAST({_CRC.format('client_id')} % 100 AS INT) AS sample_id FROM f"))
def sample_id(spark, sf_dir):
    return pings(spark, sf_dir).select("event_id", N.sample_id(F.col("client_id")).alias("sample_id"))


@query("p19_split_path", "SELECT page_id, len(p) AS n, coalesce(p[1], '') AS a, coalesce(p[2], '') AS b FROM (SELECT page_id, list_filter(string_split(regexp_replace(url, '^[a-z]+:', ''), '/'), lambda x: x <> '') AS p FROM pages) t")
def split_path(spark, sf_dir):
    parts = N.split_path(F.regexp_replace("url", "^[a-z]+:", ""))
    part = lambda k: F.coalesce(F.get(parts, F.lit(k)), F.lit(""))
    return table(spark, sf_dir, "pages").select("page_id", F.size(parts).cast("long").alias("n"), part(0).alias("a"), part(1).alias("b"))


@query("f01_message_predicate", with_flat("SELECT event_id, doc_type FROM f WHERE doc_type = 'main' AND (raw_country IS NULL OR regexp_matches(raw_os, '^Win')) AND seconds > 100 AND raw_channel <> 'esr'"))
def message_predicate(spark, sf_dir):
    return pings(spark, sf_dir).where("doc_type = 'main' AND (raw_country IS NULL OR raw_os RLIKE '^Win') AND seconds > 100 AND raw_channel <> 'esr'").select("event_id", "doc_type")


@query("f03_webrtc_only", with_flat("SELECT event_id FROM f WHERE k % 4 = 0 OR k % 6 = 1"))
def webrtc_only(spark, sf_dir):
    ice = lambda c: F.when(c, F.create_map(F.lit("1"), F.lit(2))).otherwise(F.create_map().cast("map<string,int>"))
    payload = lambda c, d: F.struct(ice(c).alias("webrtc"), ice(d).alias("loop"))
    df = pings(spark, sf_dir).select("event_id", payload(F.col("k") % 4 == 0, F.lit(False)).alias("own"), F.array(payload(F.lit(False), F.lit(False)), payload(F.lit(False), F.col("k") % 6 == 1)).alias("children"))
    some = lambda p: (F.size(p["webrtc"]) > 0) | (F.size(p["loop"]) > 0)
    return df.where(some(F.col("own")) | F.exists("children", some)).select("event_id")


@query("f04_window_filter", with_flat("SELECT event_id FROM m WHERE activity_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND submission_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-13'"))
def window_filter(spark, sf_dir):
    df = pings(spark, sf_dir).where("doc_type = 'main'").withColumn("activity_date", F.date_sub("submission_date", (F.col("event_id") % 3).cast("int")))
    return usage.window_filter(df, "activity_date", "submission_date", date(2024, 1, 12), date(2024, 1, 12), 7, 1).select("event_id")


@query("f05_sampling_filter", with_flat(f"SELECT event_id, client_id FROM f WHERE {_CRC.format('client_id')} % 100 = 42"))
def sampling_filter(spark, sf_dir):
    return pings(spark, sf_dir).where(N.sample_id(F.col("client_id")) == 42).select("event_id", "client_id")


@query("f07_os_and_profile", with_flat("SELECT event_id FROM f WHERE raw_os = 'Darwin' AND k % 10 <> 0"))
def os_and_profile(spark, sf_dir):
    df = pings(spark, sf_dir).withColumn("profile_day", F.when(F.col("k") % 10 != 0, F.unix_date("submission_date")))
    return df.where((F.col("raw_os") == "Darwin") & F.col("profile_day").isNotNull()).select("event_id")


@query("f08_fraction_sampling", with_flat(f"SELECT event_id FROM f WHERE CAST('0x' || left(md5('7-' || event_id), 8) AS BIGINT) < {int(0.1 * 2**32)}"))
def fraction_sampling(spark, sf_dir):
    return pings(spark, sf_dir).where(N.sampled(F.col("event_id").cast("string"), 0.1, "7-")).select("event_id")


@query("sf01_strings", with_flat("SELECT event_id, starts_with(raw_os, 'Win') AS prefix, contains(raw_os, 'nu') OR contains(raw_os, 'NU') AS inside, regexp_matches(raw_channel, '^b.*x$') AS matched, upper(raw_os) AS up, split_part(raw_channel, '-', 2) AS second, replace(raw_channel, '-', '.') AS replaced, substr(raw_channel, 2, 3) AS part FROM f"))
def strings(spark, sf_dir):
    os, channel = F.col("raw_os"), F.col("raw_channel")
    return pings(spark, sf_dir).select("event_id", os.startswith("Win").alias("prefix"), (os.contains("nu") | os.contains("NU")).alias("inside"), channel.rlike("^b.*x$").alias("matched"), F.upper(os).alias("up"), F.split_part(channel, F.lit("-"), F.lit(2)).alias("second"), F.regexp_replace(channel, "-", ".").alias("replaced"), F.substring(channel, 2, 3).alias("part"))


@query("sf02_escaping", with_flat("SELECT event_id, replace(replace(replace(raw_os || '|\\' || chr(10), '\\', '\\\\'), '|', '\\|'), chr(10), '\\' || chr(10)) AS bars FROM f"))
def escaping(spark, sf_dir):
    return pings(spark, sf_dir).select("event_id", W.escaped(F.concat("raw_os", F.lit("|\\\n")), "|").alias("bars"))


@query("sf07_times", with_flat("SELECT event_id, CASE WHEN k % 3 = 0 THEN date_trunc('second', ts) END AS at, CASE WHEN k % 3 = 1 THEN CAST(submission_date AS VARCHAR) END AS day FROM f"))
def times(spark, sf_dir):
    k = F.col("k") % 3
    text = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("2024-13-99")
    at = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    day = F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    return pings(spark, sf_dir).select("event_id", at.alias("at"), day.cast("string").alias("day"))


@query("sf09_crc32", with_flat(f"SELECT event_id, {_CRC.format('props')} AS crc FROM f"))
def crc32(spark, sf_dir):
    return pings(spark, sf_dir).select("event_id", F.crc32(F.col("props").cast("binary")).alias("crc"))


@query("sf10_collections", with_flat("SELECT event_id, k % 5 AS size, k % 5 > 2 AS some, CASE WHEN k % 5 > 0 THEN 1 END AS first, CAST((k % 5) * (k % 5 + 1) / 2 AS BIGINT) AS total FROM f"))
def collections(spark, sf_dir):
    values = F.when(F.col("k") % 5 > 0, F.sequence(F.lit(1), F.col("k") % 5)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x)
    return pings(spark, sf_dir).select("event_id", values.alias("v")).select("event_id", F.size("v").alias("size"), F.exists("v", lambda x: x > 2).alias("some"), F.get("v", F.lit(0)).alias("first"), total.alias("total"))


@query("sf11_json", with_flat("SELECT event_id, CASE WHEN k % 2 = 0 THEN k END AS k, k % 2 = 1 AS bad FROM f"))
def json(spark, sf_dir):
    doc = F.try_parse_json(F.when(F.col("k") % 2 == 0, F.col("props")).otherwise("{nope"))
    return pings(spark, sf_dir).select("event_id", doc.alias("d")).select("event_id", F.try_variant_get("d", "$.k", "int").alias("k"), F.col("d").isNull().alias("bad"))
