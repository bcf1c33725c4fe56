"""Nested submissions to typed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import warehouse as W

#: A column of a derived stream: its name, declared type, and an expression: a column's name, a Column, or what makes one.
Field = tuple[str, str, "str | Column | Callable[[], Column]"]



def derived_stream(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """A table by declaration: each field fitted to its type. Nothing is parsed or shuffled."""
    columns = []
    for name, declared, expr in fields:
        value = F.col(expr) if isinstance(expr, str) else expr if isinstance(expr, Column) else expr()
        columns.append(W.fitted(value, declared).alias(name))
    return df.select(*columns)


def _rfc_date(c: Column) -> Column:
    return F.try_to_timestamp(F.left(c, F.lit(10)), F.lit("yyyy-MM-dd")).cast("date")


def executive_summary(pings: DataFrame, countries: Iterable[str], *, least_seconds: int = 0) -> DataFrame:
    """Main and crash pings with client and document id -> 22 columns and the submission date.

    A crash's activity is its crash date and it has no hours and no searches; documents without a date
    are active at their creation.
    """
    crash = F.col("doc_type") == "crash"
    info, crashed = "payload.info", "payload.crash"
    searches = N.search_counts(F.try_element_at("payload.keyedHistograms", F.lit("SEARCH_COUNTS")))
    fields: list[Field] = [
        ("timestamp", "TIMESTAMP", "ts"),
        ("activity_timestamp", "TIMESTAMP", F.when(crash, N.activity_ts(F.col(f"{crashed}.crashDate"), F.col("creation_ts"))).otherwise(N.activity_ts(F.regexp_replace(f"{info}.subsessionStartDate", r"\.0Z$", "Z"), F.col("creation_ts")))),
        ("profile_creation_timestamp", "TIMESTAMP", N.profile_creation_ts(F.col("environment.profile.creationDate"))),
        ("build_id", "CHAR(14)", "app_build_id"),
        ("client_id", "CHAR(36)", "client_id"),
        ("document_id", "CHAR(36)", "document_id"),
        ("doc_type", "CHAR(36)", "doc_type"),
        ("country", "VARCHAR(5)", N.norm_country(F.col("geo_country"), countries)),
        ("channel", "VARCHAR(7)", N.norm_channel(F.col("app_update_channel"))),
        ("os", "VARCHAR(7)", N.norm_os(F.col("os_name"))),
        ("os_version", "VARCHAR(32)", "environment.system.os.version"),
        ("app", "VARCHAR(32)", "app_name"),
        ("version", "VARCHAR(32)", "app_version"),
        ("vendor", "VARCHAR(32)", "app_vendor"),
        ("reason", "VARCHAR(32)", F.when(~crash, F.col(f"{info}.reason"))),
        ("default", "BOOLEAN", N.flag(F.col("environment.settings.isDefaultBrowser"))),
        ("hours", "DOUBLE PRECISION", F.when(crash, 0.0).otherwise(N.usage_hours(F.col(f"{info}.subsessionLength"), least_seconds))),
        *[(e, "INTEGER", F.when(crash, 0).otherwise(c)) for e, c in searches.items()],
        ("city", "VARCHAR(32)", "geo_city"),
    ]
    own = pings.where(F.col("doc_type").isin("main", "crash") & F.col("client_id").isNotNull() & F.col("document_id").isNotNull())
    return derived_stream(own, [*fields, ("submission_date", "DATE", "submission_date"), ("event_id", "BIGINT", "event_id")])


def executive_summary_full(pings: DataFrame, countries: Iterable[str]) -> DataFrame:
    """The same table straight from raw pings: a session must last a second at least to count."""
    return executive_summary(pings, countries, least_seconds=1)


def _shared(countries: Iterable[str]) -> list[Field]:
    e = "environment"
    return [
        ("client_id", "CHAR(36)", "client_id"),
        ("build_version", "VARCHAR(32)", f"{e}.build.version"),
        ("build_id", "CHAR(14)", f"{e}.build.buildId"),
        ("build_architecture", "VARCHAR(32)", f"{e}.build.architecture"),
        ("channel", "VARCHAR(7)", N.norm_channel(F.col("app_update_channel"))),
        ("os", "VARCHAR(7)", N.norm_os(F.col("os_name"))),
        ("os_version", "VARCHAR(32)", f"{e}.system.os.version"),
        ("os_servicepack_major", "VARCHAR(32)", f"{e}.system.os.servicePackMajor"),
        ("os_servicepack_minor", "VARCHAR(32)", f"{e}.system.os.servicePackMinor"),
        ("locale", "VARCHAR(32)", f"{e}.settings.locale"),
        ("active_experiment_id", "VARCHAR(32)", f"{e}.addons.activeExperiment.id"),
        ("active_experiment_branch", "VARCHAR(32)", f"{e}.addons.activeExperiment.branch"),
        ("country", "VARCHAR(5)", N.norm_country(F.col("geo_country"), countries)),
    ]


# The counters of main_summary, and the histogram and key of each.
COUNTERS = {
    "plugin_hangs": ("SUBPROCESS_CRASHES_WITH_DUMP", "pluginhang"),
    "aborts_plugin": ("SUBPROCESS_ABNORMAL_ABORT", "plugin"),
    "aborts_content": ("SUBPROCESS_ABNORMAL_ABORT", "content"),
    "aborts_gmplugin": ("SUBPROCESS_ABNORMAL_ABORT", "gmplugin"),
    "crashes_detected_plugin": ("SUBPROCESS_CRASHES_WITH_DUMP", "plugin"),
    "crashes_detected_content": ("SUBPROCESS_CRASHES_WITH_DUMP", "content"),
    "crashes_detected_gmplugin": ("SUBPROCESS_CRASHES_WITH_DUMP", "gmplugin"),
    "crash_submit_attempt_main": ("PROCESS_CRASH_SUBMIT_ATTEMPT", "main-crash"),
    "crash_submit_attempt_content": ("PROCESS_CRASH_SUBMIT_ATTEMPT", "content-crash"),
    "crash_submit_attempt_plugin": ("PROCESS_CRASH_SUBMIT_ATTEMPT", "plugin-crash"),
    "crash_submit_success_main": ("PROCESS_CRASH_SUBMIT_SUCCESS", "main-crash"),
    "crash_submit_success_content": ("PROCESS_CRASH_SUBMIT_SUCCESS", "content-crash"),
    "crash_submit_success_plugin": ("PROCESS_CRASH_SUBMIT_SUCCESS", "plugin-crash"),
}


def main_summary(pings: DataFrame, countries: Iterable[str]) -> DataFrame:
    """Main pings -> 33 columns, with the submission date by which the table is stored."""
    hist = F.col("payload.keyedHistograms")
    fields: list[Field] = [
        ("timestamp", "TIMESTAMP", "ts"),
        ("subsession_date", "DATE", _rfc_date(F.col("payload.info.subsessionStartDate"))),
        *_shared(countries),
        ("reason", "VARCHAR(32)", "payload.info.reason"),
        ("subsession_length", "INTEGER", "payload.info.subsessionLength"),
        ("timezone_offset", "INTEGER", "payload.info.timezoneOffset"),
        *[(name, "INTEGER", N.khist_sum(hist, *where)) for name, where in COUNTERS.items()],
        ("active_addons", "INTEGER", N.num_active_addons(F.col("environment.addons.activeAddons"))),
        ("flash_version", "VARCHAR(16)", N.flash_version(F.col("environment.addons.activePlugins"))),
        ("submission_date", "DATE", "submission_date"),
        ("document_id", "CHAR(36)", "document_id"),
        ("event_id", "BIGINT", "event_id"),
    ]
    return derived_stream(pings.where("doc_type = 'main'"), fields)


def crash_summary(pings: DataFrame, countries: Iterable[str]) -> DataFrame:
    """Crash pings -> 16 columns, with the submission date by which the table is stored."""
    fields: list[Field] = [
        ("timestamp", "TIMESTAMP", "ts"),
        ("crash_date", "DATE", _rfc_date(F.col("payload.crash.crashDate"))),
        *_shared(countries),
        ("has_crash_environment", "BOOLEAN", "payload.crash.hasCrashEnvironment"),
        ("submission_date", "DATE", "submission_date"),
        ("event_id", "BIGINT", "event_id"),
    ]
    return derived_stream(pings.where("doc_type = 'crash'"), fields)


def payload_size(pings: DataFrame, size: Column) -> DataFrame:
    return derived_stream(pings, [("timestamp", "TIMESTAMP", "ts"), ("build", "VARCHAR", "app_build_id"), ("channel", "VARCHAR", N.norm_channel(F.col("app_update_channel"))), ("doc_type", "VARCHAR", "doc_type"), ("size", "BIGINT", size), ("submission_date", "DATE", "submission_date")])


# What a certificate report is expected to have.
TLS_FIELDS = ("hostname", "port", "timestamp", "errorCode", "failedCertChain", "userAgent", "version", "build", "product", "channel")


def tls_reports(df: DataFrame, now: Column) -> DataFrame:
    """Certificate reports (document: JSON text) -> the expected fields as text (empty objects are dropped), the reporter's clock skew in
    seconds, and the first and last certificate of the chain."""
    doc = df.withColumn("doc", F.try_parse_json("document"))
    get = lambda f: F.nullif(F.try_variant_get("doc", f"$.{f}", "string"), F.lit("{}"))
    chain = F.try_variant_get("doc", "$.failedCertChain", "array<string>")
    fields = [get(f).alias(f) for f in TLS_FIELDS if f != "failedCertChain"]
    skew = F.try_variant_get("doc", "$.timestamp", "long") - F.unix_timestamp(now)
    return doc.where("doc is not null").select(*[c for c in df.columns if c != "document"], *fields, F.size(F.coalesce(chain, F.array().cast("array<string>"))).alias("chain_length"), skew.alias("skew"), F.try_element_at(chain, F.lit(1)).alias("first_certificate"), F.try_element_at(chain, F.lit(-1)).alias("last_certificate"))


def recombine(df: DataFrame, sections: dict[str, str], meta: Iterable[str]) -> DataFrame:
    """Sections that were split off (dotted name -> column) back in one document, other fields in its meta object."""
    top: dict[str, list[Column]] = {}
    for dotted, column in sections.items():
        outer, _, inner = dotted.partition(".")
        top.setdefault(outer, []).append(F.col(column).alias(inner or outer))
    parts = [F.struct(*cs).alias(outer) for outer, cs in top.items()]
    return df.select("*", F.to_json(F.struct(*parts, F.struct(*meta).alias("meta"))).alias("document"))


# The columns of the out-of-memory crash table.
OOM_FIELDS: list[Field] = [
    *[(n, "VARCHAR", n) for n in ("uuid", "signature", "product", "version", "build", "release_channel", "os_name", "os_version", "cpu_name")],
    ("date", "TIMESTAMP", lambda: N.parsed_time(F.col("date"))),
    *[(n, "BIGINT", n) for n in ("uptime", "total_virtual_memory", "available_virtual_memory", "available_page_file", "available_physical_memory", "oom_allocation_size", "system_memory_use_percentage")],
    ("address", "BIGINT", lambda: N.hex_to_long(F.col("address"))),
    ("app_notes", "VARCHAR", lambda: N.one_line(F.col("app_notes"))),
    ("moz_crash_reason", "VARCHAR", lambda: N.one_line(F.col("moz_crash_reason"))),
]


def oom_crashes(hits: DataFrame) -> DataFrame:
    """Crash hits of texts -> the typed table of 20 columns; columns that hits lacks are null."""
    missing = [n for n, _, _ in OOM_FIELDS if n not in hits.columns]
    return derived_stream(hits.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else hits, OOM_FIELDS)


def longitudinal(df: DataFrame, client: str, order: list[str], columns: list[str]) -> DataFrame:
    """A row per client with an array for each column, newest first. Its memory is one client's rows."""
    keys = [F.col(c) for c in order]
    rows = F.sort_array(F.collect_list(F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(keys)], *columns)), asc=False)
    packed = df.where(F.col(client).isNotNull()).groupBy(client).agg(rows.alias("_rows"))
    return packed.select(client, *[F.col(f"_rows.{c}").alias(c) for c in columns])
