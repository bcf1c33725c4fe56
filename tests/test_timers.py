"""State with timers, over micro-batches whose rows come out of order, against loops over the rows in order."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.sources import scan
from pulseframe.streaming import jobs, timers

START = datetime(2024, 1, 1)
SCHEMA = "client_id string, source string, ts timestamp, event_id long, channel string, alert string, k long"


def rows_of(seed, n=400, hours=400, clients=6):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        ts = START + timedelta(seconds=rng.randrange(hours * 3600) if k % 9 else 3600 * (k // 9))
        who = f"c{min(rng.randrange(clients), rng.randrange(clients))}"
        out.append((None if k % 37 == 5 else who, f"s{k % 3}", None if k % 53 == 7 else ts, k, rng.choice("abc") if k % 11 else None, f"a{k}", k % 7))
    return out


def batches(rows, seed, late_s):
    """Rows by time, each moved up to late_s later, cut into five parts, each part shuffled; then a row long after."""
    rng = random.Random(seed)
    known = sorted(rows, key=lambda r: (r[2] or START) + timedelta(seconds=rng.randrange(late_s)))
    size = -(-len(known) // 5)
    parts = [known[k : k + size] for k in range(0, len(known), size)]
    for p in parts:
        rng.shuffle(p)
    return [*parts, [("end", "end", START + timedelta(days=300), -1, "a", "end", 0)]]


def streamed(spark, tmp_path, parts, make, mode="append"):
    path = f"file://{tmp_path}"
    for p in parts:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(path + "/in")
    df = scan.stream_new_files(spark, path + "/in", spark.createDataFrame([], SCHEMA).schema, per_trigger=1)
    before = spark.conf.get(timers.PROVIDER, None)
    with timers.state_store(spark):
        q = jobs.run(make(df), path + "/out", path + "/checkpoint", mode=mode)
    assert spark.conf.get(timers.PROVIDER, None) == before
    q.awaitTermination()
    assert sum(p.numInputRows > 0 for p in q.recentProgress) == len(parts)  # a micro-batch for each part
    return spark.read.parquet(path + "/out").collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_channels_in_order(spark, tmp_path, seed):
    """Rows of a client come up to three hours late and out of order; events are those of the rows in order. Idle clients are new again."""
    rows = rows_of(seed)
    got = streamed(spark, tmp_path, batches(rows, seed, 3 * 3600), lambda df: timers.channel_events(df, ttl_days=3, delay="3 hours"))
    per = defaultdict(list)
    for r in rows:
        if r[0] and r[2] and r[4]:
            per[r[0]].append(r)
    expected = []
    for client, own in per.items():
        before, last = None, None
        for r in sorted(own, key=lambda r: (r[2], r[3])):
            if last and r[2] - last >= timedelta(days=3):
                before = None
            if before is None:
                expected.append((r[2].date(), r[4], "new", client))
            elif before != r[4]:
                expected += [(r[2].date(), before, "out", client), (r[2].date(), r[4], "in", client)]
            before, last = r[4], r[2]
    assert sorted(tuple(r) for r in got if r.client_id != "end") == sorted(expected)
    assert {e[2] for e in expected} == {"new", "in", "out"} and sum(e[2] == "new" for e in expected) > len(per)


def test_throttled_in_order(spark, tmp_path):
    rows = rows_of(5)
    got = streamed(spark, tmp_path, batches(rows, 5, 7200), lambda df: timers.throttled(df, seconds=20_000, delay="2 hours"))
    last, expected = {}, []
    for r in sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[3])):
        if r[1] not in last or (r[2] - last[r[1]]).total_seconds() >= 20_000:
            expected.append((r[1], r[2], r[5]))
            last[r[1]] = r[2]
    assert sorted(tuple(r) for r in got if r.source != "end") == sorted(expected) and len(expected) < len(rows) / 2


def test_ties_and_nulls(spark, tmp_path):
    """Of rows with one time the smaller id is the first, a null id the last."""
    same = START + timedelta(hours=1)
    parts = [[("c", "s", same, 3, "b", "x", 0), ("c", "s", same, None, "c", "x", 0)], [("c", "s", same, 1, "a", "x", 0)], [("end", "e", START + timedelta(days=9), 0, "a", "x", 0)]]
    got = streamed(spark, tmp_path, parts, lambda df: timers.channel_events(df, delay="2 hours"))
    assert [(r.channel, r.kind) for r in sorted(got, key=lambda r: r.kind) if r.client_id == "c"] == [("b", "in"), ("c", "in"), ("a", "new"), ("a", "out"), ("b", "out")]


def test_late_rows_are_dropped(spark, tmp_path):
    parts = [[("c", "s", START + timedelta(days=9), 1, "a", "x", 0)], [("d", "s", START + timedelta(days=10), 2, "a", "x", 0)], [("c", "s", START, 3, "b", "x", 0)], [("end", "e", START + timedelta(days=99), 0, "a", "x", 0)]]
    got = streamed(spark, tmp_path, parts, lambda df: timers.channel_events(df, delay="1 hour"))
    assert sorted((r.client_id, r.channel, r.kind) for r in got if r.client_id != "end") == [("c", "a", "new"), ("d", "a", "new")]


def test_last_seen(spark, tmp_path):
    """The newest time of each client with each micro-batch, and one row when it is forgotten."""
    at = lambda h: START + timedelta(hours=h)
    row = lambda who, h: (who, "s", at(h), 1, "a", "x", 0)
    parts = [[row("a", 1), row("a", 5), row("b", 4)], [row("a", 4.5)], [row("b", 60)], [row("a", 100)], [("end", "e", START + timedelta(days=99), 0, "a", "x", 0)]]
    rows = []
    path = f"file://{tmp_path}"
    for p in parts:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(path + "/in")
    df = scan.stream_new_files(spark, path + "/in", spark.createDataFrame([], SCHEMA).schema, per_trigger=1)
    with timers.state_store(spark):
        q = timers.last_seen(df, ttl_days=2).writeStream.outputMode("update").foreachBatch(lambda b, n: rows.extend(tuple(r) for r in b.collect())).trigger(availableNow=True).option("checkpointLocation", path + "/c").start()
    q.awaitTermination()
    assert [r for r in rows if r[0] == "a"] == [("a", at(5), False), ("a", at(5), False), ("a", at(5), True), ("a", at(100), False), ("a", at(100), True)]
    assert [r for r in rows if r[0] == "b"] == [("b", at(4), False), ("b", at(4), True), ("b", at(60), False), ("b", at(60), True)]


@pytest.mark.parametrize("running", [True, False])
def test_aggregate_on_timer(spark, tmp_path, running):
    """User sums by source and six hours, emitted at the end of each; running ones hold all before."""
    rows = rows_of(9)
    add = lambda a, b: {"total": a["total"] + b["total"], "n": a["n"] + b["n"]}
    out = streamed(spark, tmp_path, batches(rows, 9, 7200), lambda df: timers.aggregate_on_timer(df.select("ts", "client_id", "k"), ["client_id"], lambda: {"total": 0, "n": 0}, lambda s, r: add(s, {"total": r["k"], "n": 1}), add, lambda key, until, s: {"client_id": key[0], "until": until, **s}, "total long, n long", "client_id string, until long, total long, n long", every_s=21_600, delay_s=7200, running=running))
    ticks = defaultdict(lambda: [0, 0])
    for r in rows:
        if r[2]:
            until = (int((r[2] - START).total_seconds()) // 21_600 + 1) * 21_600
            ticks[r[0] or "", until][0] += r[6]
            ticks[r[0] or "", until][1] += 1
    expected, totals = [], defaultdict(lambda: [0, 0])
    for (who, until), (a, b) in sorted(ticks.items()):
        t = totals[who] if running else [0, 0]
        t[0], t[1] = t[0] + a, t[1] + b
        expected.append((who, until, *t))
    base = int(START.timestamp()) - int(datetime(1970, 1, 1).timestamp())
    got = sorted((r.client_id or "", r.until // 1000 - base, r.total, r.n) for r in out if r.client_id != "end")
    assert got == sorted(expected)


def test_state_is_restarted(spark, tmp_path):
    """A query that stops between micro-batches goes on with the rows that wait and the timers that are set."""
    rows = [r for r in rows_of(3) if r[0] and r[2] and r[4]]
    parts = batches(rows, 3, 3600)
    path = f"file://{tmp_path}"
    schema = spark.createDataFrame([], SCHEMA).schema
    for p in parts:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(path + "/in")
        with timers.state_store(spark):
            q = jobs.run(timers.channel_events(scan.stream_new_files(spark, path + "/in", schema), delay="1 hour"), path + "/out", path + "/checkpoint")
        q.awaitTermination()
    got = sorted((r.client_id, r.day, r.kind, r.channel) for r in spark.read.parquet(path + "/out").collect() if r.client_id != "end")
    expected, before = [], {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        if r[0] not in before:
            expected.append((r[0], r[2].date(), "new", r[4]))
        elif before[r[0]] != r[4]:
            expected += [(r[0], r[2].date(), "out", before[r[0]]), (r[0], r[2].date(), "in", r[4])]
        before[r[0]] = r[4]
    assert got == sorted(expected)


def test_states_are_as_many_as_groups(spark, tmp_path):
    """Many keys in few states, each row in its key's order all the same."""
    start = int(datetime(2024, 1, 1).timestamp())
    rows = spark.range(4000).select(F.concat(F.lit("c"), (F.col("id") % 800).cast("string")).alias("client_id"), F.timestamp_seconds(start + F.col("id") * 7919 % 4000).alias("ts"), F.col("id").alias("event_id"), F.lit("a").alias("channel"))
    path = str(tmp_path)
    rows.repartition(1).write.parquet(path + "/in")
    rows.limit(1).withColumn("client_id", F.lit("end")).withColumn("ts", F.expr("ts + interval 2 days")).coalesce(1).write.mode("append").parquet(path + "/in")
    step = lambda key, state, row: ((state[0] + 1 if state else 1, row[0]), [(key[0], row[0], state[0] + 1 if state else 1, state is None or state[1] <= row[0])])
    own = scan.stream_new_files(spark, path + "/in", rows.schema, per_trigger=1)
    out = timers.in_order(own, "client_id", ["event_id"], step, schema="client_id string, us long, n long, fine boolean", idle_s=86_400, groups=16)
    with timers.state_store(spark):
        q = jobs.run(out, path + "/out", path + "/checkpoint")
    q.awaitTermination()
    assert max(o.numRowsTotal for p in q.recentProgress for o in p.stateOperators) <= 16
    got = spark.read.parquet(path + "/out").where("client_id <> 'end'")
    assert got.where("fine").count() == 4000
    assert {tuple(r) for r in got.groupBy("client_id").agg(F.max("n"), F.count_distinct("n")).select("max(n)", "count(DISTINCT n)").collect()} == {(5, 5)}
