"""Submissions as they come over HTTP: routing, decoding, validation, and health reports."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonschema
from ..functions import normalize as N
from . import geo

# What a missing dimension and an unknown place read, the type and source version of device reports.
UNKNOWN, UNKNOWN_PLACE = "UNKNOWN", "??"
DEVICE_TYPE, DEVICE_VERSION = "appusage", "3"
#: Namespaces that are broadcast at most, a row of settings each; and beyond that, the copies to which the rows of one are dealt.
MOST_NAMESPACES, SALTS = 10_000, 256
#: Documents of more bytes are refused.
MOST_BYTES = 2 * 1024 * 1024
# The objects that become sections of their own, and the types of document whose payload is split.
ENVIRONMENT_OBJECTS = ("addons", "build", "partner", "profile", "settings", "system")
PAYLOAD_OBJECTS = ("addonDetails", "addonHistograms", "childPayloads", "chromeHangs", "fileIOReports", "histograms", "info", "keyedHistograms", "lateWrites", "log", "simpleMeasurements", "slowSQL", "slowSQLstartup", "threadHangStats", "UIMeasurements")
SPLIT_TYPES = ("main", "saved-session")
# How the names of the two measurements end under which health reports of version 1 have their application's fields.
HEALTH_KEYS = (".appInfo.appinfo", ".appInfo.appinfo.1")


def _within(parts: Column, namespaces: DataFrame, df: DataFrame) -> DataFrame:
    """df with the path's namespace and its settings (null where there are none), the document's id and the rest of the path.

    Most submissions have one namespace, so no task may get all of its rows: up to MOST_NAMESPACES are broadcast; of more,
    each has SALTS copies, and its rows are dealt to these by their paths."""
    own = df.withColumn("namespace", F.get(parts, F.lit(1))).withColumn("document_id", F.get(parts, F.lit(2)))
    rest = F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0)))
    known = namespaces if "logger" in namespaces.columns else namespaces.withColumn("logger", F.lit(None).cast("string"))
    if known.limit(MOST_NAMESPACES + 1).count() <= MOST_NAMESPACES:
        return own.withColumn("rest", rest).join(F.broadcast(known), "namespace", "left")
    salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return own.withColumn("rest", rest).withColumn("_salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(salted, ["namespace", "_salt"], "left").drop("_salt")


def _fits() -> Column:
    return F.coalesce(F.size("dims") >= F.size("rest"), F.lit(False))


def _named() -> Column:
    """The rest of the path by the first of the namespace's dimensions."""
    return F.map_from_arrays(F.slice("dims", 1, F.size("rest")), F.col("rest"))


def route_submissions(raw: DataFrame, namespaces: DataFrame, ranges: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """HTTP submissions (path, payload, forwarded_for, remote_addr, ts) and namespaces (namespace, max_data_length,
    max_path_length, dims: array or null, perhaps logger) -> landfill, decoded and errors.

    Landfill is each submission without addresses, with its day and place. A decoded one has a logger (the namespace unless that names
    another), a document id if the path has one, and the parts after it by the namespace's first dimensions; as path_components where it has
    fewer dimensions than there are parts. Addresses are looked up in ranges (see geo.locate_first) and then dropped: country and city
    are each those of the first forwarded address, or of the remote one where nothing is known of that. What is wrong is named in error_type, the first that holds.
    """
    seen = raw.withColumn("ip", N.first_forwarded_ip(F.col("forwarded_for"), F.col("remote_addr"))).drop("forwarded_for")
    unknown = {"country": F.lit(UNKNOWN_PLACE), "city": F.lit(UNKNOWN_PLACE)}
    placed = (geo.locate_first(seen, ranges, ["ip", "remote_addr"]) if ranges is not None else seen.withColumns(unknown)).drop("ip", "remote_addr")
    landfill = placed.withColumnsRenamed({"country": "geo_country", "city": "geo_city"}).withColumn("submission_date", F.to_date("ts"))
    known = _within(F.col("parts"), namespaces, landfill.withColumn("parts", N.split_path(F.col("path"))))
    error = (
        F.when(F.col("path").isNull() | (F.size("parts") < 2), "not enough path components")
        .when(F.get("parts", F.lit(0)) != "submit", "invalid path prefix")
        .when(F.col("max_path_length").isNull(), "invalid namespace")
        .when(F.octet_length("payload") > F.col("max_data_length"), "payload too large")
        .when(F.octet_length("path") > F.col("max_path_length"), "path too long")
    )
    judged = known.withColumn("error_type", error)
    some = F.size("rest") > 0
    dims = F.when(some & _fits(), _named()).otherwise(F.create_map().cast("map<string,string>"))
    components = F.when(some & ~_fits(), F.col("rest"))
    decoded = judged.where("error_type is null").select("namespace", F.coalesce("logger", "namespace").alias("logger"), "document_id", "ts", "submission_date", "geo_country", "geo_city", "payload", dims.alias("dims"), components.alias("path_components"))
    return landfill, decoded, judged.where("error_type is not null").select("path", "ts", "error_type")


def gunzipped(payload: Column, most: int = MOST_BYTES) -> Column:
    """Gzip bytes to struct(document, size); bytes that are not gzip as they are. The document is null where the stream is broken or
    too large; no more than most bytes and one are ever unpacked. Rows come one by one and not as Arrow's batches, of which each
    could hold 10,000 unpacked documents; so the workers need neither Arrow nor pandas."""

    def unpacked(raw: bytes) -> bytes | None:
        if raw[:2] != b"\x1f\x8b":
            return raw
        out = b""
        try:
            while raw and len(out) <= most:
                stream = zlib.decompressobj(16 + zlib.MAX_WBITS)
                out += stream.decompress(raw, most + 1 - len(out))
                if not stream.eof:
                    return out if len(out) > most else None
                raw = stream.unused_data.lstrip(b"\0")
        except zlib.error:
            return None
        return out

    def run(raw: bytes | None) -> tuple[str | None, int | None]:
        found = None if raw is None else unpacked(bytes(raw))
        if found is None:
            return None, None
        return None if len(found) > most else found.decode("utf-8", "replace"), len(found)

    return F.udf(run, "document string, size long", useArrow=False)(payload)


def _get(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("doc", path, kind)


def _is_object(path: str) -> Column:
    return F.try_variant_get("doc", path, "struct<>").isNotNull()


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is worked out once for each row, however often and in whatever filter it is used: what a generator makes is
    not put in the place of its name, as a projection's expression is."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _creation() -> Column:
    return F.try_to_timestamp(_get("$.creationDate"), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"))


def _sections(split_payload: Column) -> tuple[Column, Column]:
    """The sections split off (dotted name -> JSON text) and the document that is left, as JSON text."""
    inner = lambda name: F.try_variant_get("doc", f"$.{name}", "map<string,variant>")
    parts = {"environment": (inner("environment"), ENVIRONMENT_OBJECTS, F.lit(True)), "payload": (inner("payload"), PAYLOAD_OBJECTS, split_payload)}
    empty = F.create_map().cast("map<string,string>")
    sections, rest = [], F.map_filter(F.try_variant_get("doc", "$", "map<string,variant>"), lambda k, v: ~k.isin(*parts))
    for name, (own, objects, wanted) in parts.items():
        split = wanted & own.isNotNull()
        cut = F.transform_values(F.map_filter(own, lambda k, v: k.isin(*objects)), lambda _, v: F.to_json(v))
        sections.append(F.when(split, F.transform_keys(cut, lambda k, _: F.concat(F.lit(f"{name}."), k))).otherwise(empty))
        left = F.when(split, F.to_variant_object(F.map_filter(own, lambda k, v: ~k.isin(*objects)))).otherwise(F.try_variant_get("doc", f"$.{name}", "variant"))
        rest = F.when(left.isNotNull(), F.map_concat(rest, F.create_map(F.lit(name), left))).otherwise(rest)
    return F.map_concat(*sections), F.to_json(rest)


#: The columns of a decoded submission beside those that it came with.
DECODED = ["format", "size", "source_version", "doc_type", "app_name", "app_version", "app_update_channel", "app_build_id", "normalized_channel", "app_vendor", "os", "reason", "creation_ts", "telemetry_enabled", "active_experiment_id", "client_id", "sample_id", "sections", "document"]


def decode_pings(raw: DataFrame, *, device_app: str = UNKNOWN) -> tuple[DataFrame, DataFrame]:
    """Submissions (payload: binary, ts, perhaps dims: a map of what the path said) -> decoded pings and errors (error_type: read,
    gzip, size, json or payload; error: what is missing).

    The document is parsed once. Its format follows from its fields: ver 3 (dimensions are the path's), another ver (in info), version
    (in application, with environment and, for main and saved-session, payload split into sections), deviceinfo, v, or none of them (the path's).
    Dimensions that the format has but the document lacks are UNKNOWN; device reports never name their application, which is device_app. Formats beside ver and version have no sections and stay whole.
    """
    own = raw if "dims" in raw.columns else raw.withColumn("dims", F.create_map().cast("map<string,string>"))
    text = own.withColumn("unpacked", gunzipped(F.col("payload"))).withColumn("document", F.col("unpacked.document")).withColumn("size", F.col("unpacked.size"))
    parsed = _once(text, "doc", F.try_parse_json("document"))
    has = lambda path: F.try_variant_get("doc", path, "variant").isNotNull() & ~F.is_variant_null(F.try_variant_get("doc", path, "variant"))
    form = F.when(has("$.ver"), F.when(_get("$.ver", "double") == 3, "saved").otherwise("old")).when(has("$.version"), "unified").when(_is_object("$.deviceinfo"), "device").when(has("$.v"), "core").otherwise("other")
    formed = _once(parsed, "format", F.when(_is_object("$"), form).otherwise("other"))
    kind = F.col("format")
    missing = (
        F.when((kind == "other") & ~_is_object("$") & F.try_variant_get("doc", "$", "array<variant>").isNull(), "no object")
        .when((kind == "old") & ~_is_object("$.info"), "missing info object")
        .when((kind == "unified") & ~_is_object("$.application"), "missing application object")
        .when((kind == "unified") & _creation().isNull(), "missing creationDate")
    )
    phase = (
        F.when(F.col("payload").isNull() | (F.octet_length("payload") == 0), "read")
        .when(F.col("size").isNull(), "gzip")
        .when(F.col("size") > MOST_BYTES, "size")
        .when(F.col("doc").isNull(), "json")
        .when(F.col("missing").isNotNull(), "payload")
    )
    judged = _once(formed.withColumn("missing", missing), "error_type", phase).withColumn("error", F.when(F.col("error_type") == "payload", F.col("missing")))
    of_path = lambda name: F.try_element_at("dims", F.lit(name))
    unknown = F.lit(UNKNOWN)

    def pick(unified: str | None, old: str | None, device: Column, path: str | None = None) -> Column:
        a = F.coalesce(_get(unified), unknown) if unified else F.lit(None).cast("string")
        b = F.coalesce(_get(old), unknown) if old else F.lit(None).cast("string")
        return F.when(kind == "unified", a).when(kind == "old", b).when(kind == "device", device).otherwise(of_path(path) if path else F.lit(None))

    device = lambda key: F.coalesce(_get(f"$.deviceinfo['deviceinfo.{key}']"), unknown)
    plain = lambda unified, old=None: F.when(kind == "unified", _get(unified)).when(kind == "old", _get(old) if old else F.lit(None).cast("string"))
    channel = F.when(kind == "unified", _get("$.application.channel")).when(kind == "old", _get("$.info.appUpdateChannel")).when(kind == "device", _get("$.deviceinfo['deviceinfo.update_channel']"))
    client = F.when(kind == "old", _get("$.clientID")).when(kind.isin("unified", "core"), _get("$.clientId"))
    version = F.when(kind.isin("saved", "old"), _get("$.ver")).when(kind == "unified", _get("$.version")).when(kind == "device", DEVICE_VERSION).when(kind == "core", _get("$.v"))
    sections, rest = _sections(_get("$.type").isin(*SPLIT_TYPES))
    split = (kind == "unified") & (_is_object("$.environment") | _get("$.type").isin(*SPLIT_TYPES) & _is_object("$.payload"))
    columns = {
        "source_version": version,
        "doc_type": pick("$.type", "$.info.reason", F.lit(DEVICE_TYPE), "docType"),
        "app_name": pick("$.application.name", "$.info.appName", F.lit(device_app), "appName"),
        "app_version": pick("$.application.version", "$.info.appVersion", device("platform_version"), "appVersion"),
        "app_update_channel": pick("$.application.channel", "$.info.appUpdateChannel", device("update_channel"), "appUpdateChannel"),
        "app_build_id": pick("$.application.buildId", "$.info.appBuildID", device("platform_build_id"), "appBuildId"),
        "normalized_channel": F.when(kind.isin("unified", "old", "device"), N.norm_channel(channel)).when((kind == "saved") & of_path("appUpdateChannel").isNotNull(), N.norm_channel(of_path("appUpdateChannel"))),
        "app_vendor": plain("$.application.vendor", "$.info.vendor"),
        "os": plain("$.environment.system.os.name", "$.info.OS"),
        "reason": plain("$.payload.info.reason", "$.info.reason"),
        "creation_ts": F.when(kind == "unified", _creation()),
        "telemetry_enabled": F.when(kind == "old", F.lit(True)).when(kind == "unified", _get("$.environment.settings.telemetryEnabled", "boolean")),
        "active_experiment_id": F.when(kind == "unified", _get("$.environment.addons.activeExperiment.id")),
        "client_id": client,
        "sample_id": N.sample_id(client),
        "sections": F.when(split, sections).otherwise(F.create_map().cast("map<string,string>")),
        "document": F.when(split, rest).otherwise(F.col("document")),
    }
    carried = [c for c in raw.columns if c not in ("payload", "dims", *DECODED)]
    good = judged.where("error_type is null").select(*carried, "format", "size", *[c.alias(n) for n, c in columns.items()])
    return good, judged.where("error_type is not null").select(*carried, "error_type", "error")


def validate_pings(df: DataFrame, namespaces: DataFrame, schemas: dict[str, tuple[T.StructType, list[str]] | dict | str]) -> DataFrame:
    """Submissions (path, document: JSON text) against a schema per document type: a JSON Schema, or a declared one with the fields that must be there.

    Adds the dimensions of the path (dims) and of the document (creation_ts to sample_id) and error_type: uri for a path that is short, has
    another prefix, an unknown namespace, too many characters or more parts than dimensions, or whose type has no schema; json for a document that is none or
    does not fit its schema. saved-session is held against main's schema. violation says where and how a document first breaks a JSON Schema.
    """
    known = _within(F.col("parts"), namespaces, df.withColumn("parts", N.split_path(F.col("path"))))
    short = F.col("path").isNull() | (F.size("parts") < 3) | (F.get("parts", F.lit(0)) != "submit")
    wrong = short | F.col("max_path_length").isNull() | (F.octet_length("path") > F.col("max_path_length")) | ~_fits()
    named = known.withColumn("dims", F.when(~wrong, _named()))
    doc_type = F.try_element_at("dims", F.lit("docType"))
    kind = F.when(doc_type == "saved-session", "main").otherwise(doc_type)
    unknown = wrong | ~F.coalesce(kind.isin(list(schemas)), F.lit(False))
    named = _once(named, "doc", F.when(~unknown, F.try_parse_json("document")))
    error, broken = F.when(unknown, "uri"), F.lit(None).cast("string")
    for name, given in schemas.items():
        if not isinstance(given, tuple):
            broken = F.when(kind == name, jsonschema.violation(given, F.col("doc"))).otherwise(broken)
            error = error.when((kind == name) & (F.col("doc").isNull() | F.col("violation").isNotNull()), "json")
            continue
        schema, required = given
        open_schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        value = F.from_json("document", open_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        bad = value.isNull() | value["_corrupt_record"].isNotNull()
        for r in required:
            at = value
            for part in r.split("."):
                at = at[part]
            bad = bad | at.isNull()
        error = error.when((kind == name) & bad, "json")
    judged = _once(_once(named, "violation", broken), "error_type", error)
    fields = {
        "creation_ts": _creation(),
        "reason": _get("$.payload.info.reason"),
        "os": _get("$.environment.system.os.name"),
        "telemetry_enabled": _get("$.environment.settings.telemetryEnabled", "boolean"),
        "active_experiment_id": _get("$.environment.addons.activeExperiment.id"),
        "client_id": _get("$.clientId"),
        "source_version": _get("$.version"),
        "doc_type": _get("$.type"),
        "app_name": _get("$.application.name"),
        "app_version": _get("$.application.version"),
        "app_build_id": _get("$.application.buildId"),
        "app_update_channel": _get("$.application.channel"),
        "normalized_channel": N.norm_channel(_get("$.application.channel")),
        "app_vendor": _get("$.application.vendor"),
        "sample_id": N.sample_id(_get("$.clientId")),
    }
    good = F.col("error_type").isNull()
    own = [c for c in df.columns if c not in fields]
    return judged.select(*own, "namespace", "document_id", "dims", "error_type", "violation", *[F.when(good, c).alias(n) for n, c in fields.items()])


def fhr_dimensions(df: DataFrame) -> DataFrame:
    """Health reports (document: JSON text, perhaps geo_country and ts) of versions 1 to 3 -> their dimensions, with error for a document
    without them: the first object that is missing, or its version.

    Version 1 has them under a measurement of the last day, of two possible names. Name, version and channel that are missing are UNKNOWN; build, system, vendor
    and client have no default.
    """
    doc = _once(df, "doc", F.try_parse_json("document")).withColumn("fhr_version", _get("$.version"))
    version = F.col("fhr_version")
    last = F.try_variant_get("doc", "$.data.last", "map<string,variant>")
    # Of names that end alike the smallest counts.
    names_of = lambda end: F.array_sort(F.map_keys(F.map_filter(last, lambda k, v: k.endswith(end) & F.try_variant_get(v, "$", "struct<>").isNotNull())))
    old = F.coalesce(*[F.try_element_at(last, F.get(names_of(end), F.lit(0))) for end in HEALTH_KEYS])
    at = (
        F.when(version == "1", old)
        .when(version == "2", F.try_variant_get("doc", "$.geckoAppInfo", "variant"))
        .when(version == "3", F.try_variant_get("doc", "$.environments.current.geckoAppInfo", "variant"))
    )
    error = F.when(F.col("doc").isNull(), "json")
    for number, objects in (("1", ("data", "data.last")), ("2", ("geckoAppInfo",)), ("3", ("environments", "environments.current", "environments.current.geckoAppInfo"))):
        for name in objects:
            error = error.when((version == number) & ~_is_object(f"$.{name}"), f"missing object: {name}")
    error = error.when((version == "1") & old.isNull(), f"missing object: data.last[{HEALTH_KEYS[0]}]")
    error = error.when(~F.coalesce(version.isin("1", "2", "3"), F.lit(False)), "unknown payload version")
    own = _once(doc.withColumn("error", error), "info", at)
    info = lambda f: F.when(F.col("error").isNull(), F.try_variant_get("info", f"$.{f}", "string"))
    named = lambda f: F.when(F.col("error").isNull(), F.coalesce(info(f), F.lit(UNKNOWN)))
    country = F.coalesce("geo_country", F.lit(UNKNOWN_PLACE)) if "geo_country" in df.columns else F.lit(UNKNOWN_PLACE)
    day = [F.to_date("ts").alias("submission_date")] if "ts" in df.columns else []
    return own.select(
        *[c for c in df.columns if c not in ("geo_country", "document")], *day, country.alias("geo_country"), "fhr_version",
        named("name").alias("app_name"), named("version").alias("app_version"), named("updateChannel").alias("app_update_channel"),
        info("appBuildID").alias("app_build_id"), info("os").alias("os"), info("vendor").alias("vendor"), F.when(F.col("error").isNull(), _get("$.clientID")).alias("client_id"), "error",
    )
