"""Operators on small hand-made tables: boundaries, ties, resets, nulls and empty input."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import normalize as N
from pulseframe.operators import budget, quality, reports, series, updates, usage
from pulseframe.plans import streams

T0 = datetime(2024, 1, 1)


def test_budget_keeps_newest_days(spark):
    rows = [("nightly", "main", date(2015, 6, d), f"201506{d:02d}030201", 100 + d) for d in range(20, 27)] + [("aurora", "main", date(2015, 8, 9), "20150809030201", s) for s in (400, 401, 480, 500)] + [("aurora", "x", date(2015, 8, 9), "junk", 7)]
    sizes = spark.createDataFrame(rows, "channel string, doc_type string, submission_date date, build string, size long")
    got = {(r.kind, r.channel, r.day, r.doc_type): (r["count"], r["size"]) for r in budget.size_by_channel_day(sizes, 5).collect()}
    assert got["submission", "aurora", date(2015, 8, 9), "main"] == (4, 1781) and got["submission", "aurora", date(2015, 8, 9), "other"] == (1, 7)
    assert ("build", "aurora", date(2015, 8, 9), "other") not in got
    days = sorted(k[2] for k in got if k[:2] == ("submission", "nightly"))
    assert days == [date(2015, 6, d) for d in range(22, 27)]


def merged(spark, *docs):
    rows = spark.createDataFrame([(d, T0, k) for k, d in enumerate(docs)], "doc string, ts timestamp, event_id long")
    return {r.path: r.number if r.kind == "number" else r.other for r in series.merge_json_counts(series.flattened(rows, "doc")).collect()}


def test_merge_of_objects(spark):
    assert merged(spark, '{"foo": 1, "s": "a", "sub": {"x": 3}}', '{"foo": 5, "s": "b", "sub": {"y": 100}}', '{"foo": "text"}') == {"foo": 6, "s": "b", "sub.x": 3, "sub.y": 100}
    both = merged(spark, '{"foo":1,"bar":[1,1,3],"quux":3}', '{"foo":5,"bar":[0,0,5,1],"baz":{"hello":100}}')
    assert both == {"foo": 6, "bar[0]": 1, "bar[1]": 1, "bar[2]": 8, "bar[3]": 1, "baz.hello": 100, "quux": 3}
    assert merged(spark, '{"a": "007", "t": true, "n": null}', '{"a": "5", "t": false, "n": 1}', "[1]", "{", None) == {"a": "5", "t": "false", "n": 1}
    assert merged(spark, '{"a": {"b": {"c": 1}}, "x": 2}', '{"a": 7, "x": {"y": 1}}', '{"a": {"b": 3}}', '{"a": {"b": {"c": 4, "d": [{"e": 1.5}]}}}') == {"a.b.c": 5, "a.b.d[0].e": 1.5, "x": 2}
    assert merged(spark, None) == {}


def test_merge_of_any_depth(spark):
    """500 levels of objects and arrays in turn; 1,001 are none; a key that comes twice makes no object."""
    deep = lambda n: '{"a":[' * (n // 2) + "7" + "]}" * (n // 2)
    path = ".".join(["a[0]"] * 250)
    assert merged(spark, deep(500), deep(500), deep(1002), '{"b": 1, "b": 2}', '{"c": NaN}') == {path: 14}
    assert len(merged(spark, deep(1000))) == 1
    rows = spark.createDataFrame([(deep(1002), T0, 1)], "doc string, ts timestamp, event_id long")
    assert series.flattened(rows, "doc").count() == 0
    short, long = (series.flattened(spark.createDataFrame([(deep(n), T0, 1)], "doc string, ts timestamp, event_id long"), "doc")._jdf.queryExecution().executedPlan().toString().count("\n") for n in (2, 500))
    assert short == long  # the plan does not follow the depth


def test_merge_of_series(spark):
    rows = [("s", T0, "n", "sum", 1.0), ("s", T0, "n", "sum", float("nan")), ("s", T0, "n", "sum", 4.0), ("s", T0, "lo", "min", 3.0), ("s", T0, "lo", "min", 2.0), ("s", T0, "hi", "max", 3.0), ("s", T0, "hi", "max", 2.0)]
    got = {r.name: r.value for r in series.merge_series(spark.createDataFrame(rows, "series string, bucket timestamp, name string, aggregation string, value double")).collect()}
    assert got == {"n": 5, "lo": 2, "hi": 3}


def test_counter_resets(spark):
    rows = [("a", T0 + timedelta(seconds=k), k, v) for k, v in enumerate((5, 9, 2, 2))]
    got = quality.counter_deltas(spark.createDataFrame(rows, "src string, ts timestamp, event_id long, v long"), "src", "v").orderBy("ts").collect()
    assert [r.delta for r in got] == [None, 4, 2, 0]


def test_offset_gaps(spark):
    rows = [("t", 0, o) for o in (1, 2, 5, 6)] + [("t", 1, 9)]
    got = quality.offset_gaps(spark.createDataFrame(rows, "topic string, partition int, offset long")).collect()
    assert [(r.offset, r.expected, r.difference) for r in got] == [(5, 3, 2)]


@pytest.mark.parametrize("size", [1, 3, 10, 10**6])
def test_offset_gaps_in_slices(spark, size):
    """However offsets are cut, each is held against the one before it, in the same slice or an earlier one; null topics too."""
    rows = [("t", 0, o) for o in (1, 2, 3, 4, 40, 41, 41, 99)] + [(None, None, o) for o in (7, 9)] + [("t", 1, o) for o in range(50, 60)]
    got = quality.offset_gaps(spark.createDataFrame(rows, "topic string, partition int, offset long"), size=size).collect()
    assert sorted((r.topic or "", r.offset, r.expected) for r in got) == [("", 9, 8), ("t", 40, 5), ("t", 41, 42), ("t", 99, 42)]


def test_retention_of_rows_without_ids(spark):
    """Rows without a document id are documents of their own; of a repeated id the first row counts."""
    day = date(2024, 1, 8)
    rows = [(None, f"c{k}", "6", "US", "release", day - timedelta(1), day) for k in range(5)] + [("d", "x", "6", "US", "release", day - timedelta(1), day), ("d", "y", "6", "US", "release", day - timedelta(1), day + timedelta(1))]
    df = spark.createDataFrame(rows, "document_id string, client_id string, os_version string, country string, channel string, profile_day date, submission_date date").withColumn("profile_day", F.unix_date("profile_day"))
    got = {r.os_version: (r.actives, r.d1) for r in usage.mobile_retention(df, "weekly").where("country = 'US' and channel = 'release'").collect()}
    assert got == {"6": (6, 6), "all": (6, 6)}


def test_samples_are_of_keys(spark):
    """About the share of all keys, the same in any order, another set with another seed, no null."""
    df = spark.range(20_000).select(F.col("id").cast("string").alias("key")).union(spark.createDataFrame([(None,)], "key string"))
    one = {r.key for r in df.where(N.sampled(F.col("key"), 0.1)).collect()}
    assert abs(len(one) - 2000) < 4 * (20_000 * 0.09) ** 0.5 and None not in one
    assert one == {r.key for r in df.repartition(7).where(N.sampled(F.col("key"), 0.1)).collect()}
    assert len(one & {r.key for r in df.where(N.sampled(F.col("key"), 0.1, "b")).collect()}) < 400
    assert df.where(N.sampled(F.col("key"), 0.0)).count() == 0 and df.where(N.sampled(F.col("key"), 1.0)).count() == 20_000


def test_channel_switches(spark):
    rows = [("a", c, T0 + timedelta(hours=k), k) for k, c in enumerate(("x", "y", "x", "x"))] + [(None, "x", T0, 9)]
    got = {r.channel: (r.new, r.switched_in, r.switched_out) for r in quality.channel_switches(spark.createDataFrame(rows, "client_id string, channel string, ts timestamp, event_id long")).collect()}
    assert got == {"x": (1, 1, 1), "y": (0, 1, 1)}


def test_retention_needs_every_interval(spark):
    first = date(2024, 1, 7)
    visits = {"a": (0, 1, 2), "b": (0, 2), "c": (0,), "d": (0, 1)}
    rows = [(u, first + timedelta(d)) for u, ds in visits.items() for d in ds]
    got = {r.interval: r.users for r in usage.retention(spark.createDataFrame(rows, "client_id string, day date"), 1).collect()}
    assert got == {0: 2, 1: 1}


def test_trailing_distinct(spark):
    rows = [("a", date(2024, 1, 1)), ("a", date(2024, 1, 3)), ("b", date(2024, 1, 3)), ("c", date(2024, 2, 20)), (None, date(2024, 1, 3))]
    got = {r.day: (r.dau, r.wau, r.mau) for r in usage.dau_wau_mau(spark.createDataFrame(rows, "client_id string, day date")).collect()}
    assert got == {date(2024, 1, 1): (1, 1, 1), date(2024, 1, 3): (2, 2, 2), date(2024, 2, 20): (1, 1, 1)}


def test_interval_report_counts_idle_clients(spark):
    schema = "client_id string, timestamp timestamp, event_id long, country string, channel string, os string, default boolean, hours double, doc_type string, profile_creation_timestamp timestamp, google long, bing long, yahoo long, other long"
    row = lambda c, day, k: (c, datetime(2024, 1, day, 5), k, "US", "release", "Mac", True, 1.0, "main", datetime(2024, 1, day), 0, 0, 0, 0)
    rows = [row("a", 7, 1), row("b", 8, 2), row("a", 15, 3), row("a", 21, 4)]
    got = {r.date: (r.actives, r.inactives, r.new_records, r.total_records) for r in reports.interval_report(spark.createDataFrame(rows, schema), "week").collect()}
    assert got == {date(2024, 1, 7): (2, 0, 2, 2), date(2024, 1, 14): (1, 1, 0, 2)}


def test_interval_report_counts_every_interval(spark):
    """60 weeks and 420 days: none is beyond a limit, and the oldest ones count as the newest do."""
    schema = "client_id string, timestamp timestamp, event_id long, country string, channel string, os string, default boolean, hours double, doc_type string, profile_creation_timestamp timestamp, google long, bing long, yahoo long, other long"
    row = lambda c, geo, day: (c, datetime(2023, 1, 1, 5) + timedelta(day), day, geo, "release", "Mac", True, 1.0, "main", datetime(2023, 1, 1), 0, 0, 0, 0)
    # One client a week (each day) in US; another is seen in US on day 0 and in DE from day 210 on; DE has a third one at the start.
    rows = [row("a", "US", d) for d in range(420)] + [row("b", "US", 0), row("b", "DE", 210), row("c", "DE", 0), row("d", "DE", 350)]
    df = spark.createDataFrame(rows, schema)
    for mode, step in (("week", 7), ("day", 1)):
        got = {(r.geo, r.date): (r.actives, r.inactives, r.new_records, r.five_of_seven, r.total_records) for r in reports.interval_report(df, mode, finalize=True).collect()}
        assert len(got) == 420 // step + 3
        frequent = int(mode == "week")
        for k in range(420 // step):
            expected = (2, 0, 2, frequent, 2) if k == 0 else (1, int(k * step < 210), 0, frequent, 1 + int(k * step < 210))
            assert got["US", date(2023, 1, 1) + timedelta(k * step)] == expected
        de = lambda day: got["DE", date(2023, 1, 1) + timedelta(day)]
        assert [de(d) for d in (0, 210, 350)] == [(1, 0, 1, 0, 1), (1, 1, 0, 0, 2), (1, 2, 0, 0, 3)]


def test_update_status(spark):
    rows = [(None, None, None), ([None], ["2024-01-20"], [9]), (["x.0"], ["2024-01-20"], [9]), (["40.0"], ["2024-01-20"], [9]), (["48.0"], ["2024-01-20"], [9]), (["45.0", "45.0", "44.0"], ["2024-01-20", "bad", "2024-01-19"], [7199, 5000, 9000]), (["45.0", "45.0"], ["2024-01-20", "2024-01-19"], [7199, 1]), (["45.0", "45.0"], ["2024-01-20", "2023-01-19"], [7199, 100])]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k long, version array<string>, subsession_start_date array<string>, subsession_length array<long>")
    got = [r.status for r in updates.update_status(df, 50, date(2024, 1, 24)).orderBy("k").collect()]
    assert got == ["none-version", "none-version", "value-error", "ignore-version-too-low", "up-to-date", "out-of-date-not-run-long-enough", "out-of-date", "out-of-date-not-run-long-enough"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "client_id string, day date, channel string, ts timestamp, event_id long, document_id string")
    assert usage.retention(none, 7).count() == usage.dau_wau_mau(none).count() == quality.channel_switches(none).count() == quality.duplicate_report(none).count() == 0
    assert usage.days_between(none).count() == 0


def test_throttled_alerts(spark, sf_dir):
    from pulseframe.plans.fixtures import pings

    got = sorted((r.source, r.ts) for r in streams.throttled(spark, sf_dir).collect())
    last, expected = {}, []
    for r in pings(spark, sf_dir).where("doc_type = 'crash'").orderBy("ts", "event_id").collect():
        if r.raw_channel not in last or (r.ts - last[r.raw_channel]).total_seconds() >= 3600:
            expected.append((r.raw_channel, r.ts))
            last[r.raw_channel] = r.ts
    assert got == sorted(expected)


def test_filters_reach_the_scan(spark, tmp_path):
    """A specification of allowed dimensions is a partition filter: other folders are not read."""
    from pulseframe.sources import scan, sinks

    spec = {"dimensions": [{"field_name": "a", "allowed_values": "*"}]}
    path = f"file://{tmp_path}/t"
    sinks.write_dims(spark.range(10).select(F.col("id"), (F.col("id") % 3).cast("string").alias("a")), spec, path)
    df = scan.scan_dims(spark, path, {"dimensions": [{"field_name": "a", "allowed_values": "1"}]})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(a" in plan and df.count() == 3


def test_topic_messages(spark):
    """The projection on a stand-in with the columns of the connector, which is not here."""
    from pulseframe.sources import scan

    raw = spark.createDataFrame([(b"k", b"v", "t", 3, 7, T0, 0)], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    (r,) = scan.kafka_messages(raw).collect()
    assert (bytes(r.payload), bytes(r.key), r.topic, r.partition, r.offset, r.timestamp) == (b"v", b"k", "t", 3, 7, T0) and len(r) == 6


def test_counters_over_slices(spark):
    """Values are carried over hours without rows, and a source's first row has no delta."""
    rows = [("a", T0 + timedelta(minutes=m), m, v) for m, v in ((0, 5), (30, 9), (200, 12), (201, 3), (600, 3), (601, None), (700, 4))]
    got = quality.counter_deltas(spark.createDataFrame(rows, "src string, ts timestamp, event_id long, v long"), "src", "v").orderBy("ts").collect()
    assert [r.delta for r in got] == [None, 4, 3, 3, 0, None, None]


def test_gunzip_stops_at_the_cap(spark):
    import gzip

    from pulseframe.operators import decode

    cap = decode.MOST_BYTES
    bodies = {"bomb": gzip.compress(b"0" * (cap * 40)), "at": gzip.compress(b"1" * cap), "over": b"x" * (cap + 1), "two": gzip.compress(b"a") + gzip.compress(b"b"), "cut": gzip.compress(b"abc" * 99)[:-9], "none": b"", "plain": b"{}"}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in bodies.items()], "name string, b binary")
    got = {r.name: (r.u.size, None if r.u.document is None else len(r.u.document)) for r in df.select("name", decode.gunzipped(F.col("b")).alias("u")).collect()}
    assert got == {"bomb": (cap + 1, None), "at": (cap, cap), "over": (cap + 1, None), "two": (2, 2), "cut": (None, None), "none": (0, 0), "plain": (2, 2)}


def test_decoded_documents_lose_their_sections(spark):
    import json

    from pulseframe.operators import decode

    doc = {"version": 4, "type": "main", "creationDate": "2024-01-05T10:00:00Z", "application": {"name": "B"}, "environment": {"system": {"os": {"name": "L"}}, "other": [1]}, "payload": {"info": {"reason": "r"}, "more": {"x": 1}}, "n": 1.5}
    good, bad = decode.decode_pings(spark.createDataFrame([(bytearray(json.dumps(doc).encode()), T0)], "payload binary, ts timestamp"))
    (r,) = good.collect()
    assert {k: json.loads(v) for k, v in r.sections.items()} == {"environment.system": {"os": {"name": "L"}}, "payload.info": {"reason": "r"}}
    rest = {k: v for k, v in doc.items()} | {"environment": {"other": [1]}, "payload": {"more": {"x": 1}}}
    assert json.loads(r.document) == rest and bad.count() == 0 and (r.os, r.reason, r.app_version) == ("L", "r", "UNKNOWN")


def test_sketches_are_by_day_only(spark):
    """No aggregate that has a sketch is by client too, and nulls and repeats count for nothing."""
    df = spark.range(3000).select(F.expr("date'2024-01-01' + cast(id % 3 as int)").alias("day"), F.when(F.col("id") % 10 > 0, (F.col("id") % 700).cast("string")).alias("client_id"))
    out = usage.sketch_error(df)
    sketches = [line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "approx_count_distinct" in line and "Aggregate" in line]
    assert sketches and not any("keys=[day" in line and "client_id" in line.split("functions=")[0] for line in sketches)
    expected = {r.day: r.n for r in df.groupBy("day").agg(F.count_distinct("client_id").alias("n")).collect()}
    assert {r.day: r.exact for r in out.collect()} == expected
    assert all(abs(r.ratio - 1) < 0.05 for r in out.collect())


def test_documents_are_parsed_once(spark):
    """The plan of merged documents has one walk over them, but for what is an exchange's copy."""
    df = spark.range(40).select(F.timestamp_seconds("id").alias("ts"), F.col("id").alias("event_id"), F.to_json(F.struct(F.struct(F.col("id").alias("x")).alias("a"), F.lit("t").alias("b"))).alias("doc"))
    out = series.merge_json_counts(series.flattened(df, "doc"))
    assert sorted((r.path, r.kind, r.number, r.other) for r in out.collect()) == [("a.x", "number", 780.0, None), ("b", "string", None, "t")]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ArrowEvalPython") == 1
