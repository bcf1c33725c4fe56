"""The client snapshot: increments against one run over all rows, what an increment reads, and increments that fail."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import reports, snapshot

START = date(2024, 1, 7)  # a Sunday
SCHEMA = "client_id string, event_id long, timestamp timestamp, submission_date date, doc_type string, country string, channel string, os string, profile_creation_timestamp timestamp, default boolean, hours double, crash_count long, google long, bing long, yahoo long, other long"


def made(seed, days=40, n=900):
    """Clients that move between partitions, pause and come back, have no id, and a week without rows."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        day = rng.randrange(days)
        if 14 <= day < 21:
            continue
        ts = datetime(2024, 1, 7) + timedelta(days=day, seconds=rng.randrange(86_400))
        client = None if k % 29 == 0 else f"c{rng.randrange(60)}"
        out.append((client, k, ts, ts.date(), rng.choice(["main", "main", "crash"]), rng.choice(["US", "DE", None]), rng.choice(["beta", "release"]), "Windows", datetime(2024, 1, 7) + timedelta(days=rng.randrange(-5, days)), rng.choice([True, False, None]), float(k % 5), rng.choice([None, -1, 0, 3]), k % 3, 1, 0, 2))
    rng.shuffle(out)
    return out


def stored(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("submission_date").parquet(f"file://{tmp_path}/rows")
    return spark.read.parquet(f"file://{tmp_path}/rows")


def sorted_rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


@pytest.mark.parametrize("mode", ["week", "month"])
def test_increments_are_the_full_run(spark, tmp_path, mode):
    df = stored(spark, tmp_path, made(1))
    root, start = f"file://{tmp_path}/root", START if mode == "week" else date(2024, 1, 1)
    while start < START + timedelta(40):
        one = snapshot.advance(spark, root, df, start, mode, buckets=3)
        assert {r.date for r in one.collect()} <= {start}
        start = snapshot.next_start(start, mode)
    full = reports.interval_report(df, mode, finalize=True)
    got = snapshot.published(spark, root)
    assert sorted_rows(got) == sorted_rows(full) and set(got.columns) == set(full.columns)
    seen = {r.client_id: (r.first_seen, tuple(r.now)) for r in snapshot.state(spark, root).collect()}
    expected = {r.client_id: (r.first, tuple(r.now)) for r in df.where("client_id is not null").groupBy("client_id").agg(F.min("submission_date").alias("first"), F.max_by(F.struct(*snapshot.KEYS), F.struct("timestamp", "event_id")).alias("now")).collect()}
    assert seen == expected


def test_an_increment_reads_one_interval(spark, tmp_path):
    """The rows of one week, and a snapshot that is not shuffled."""
    df = stored(spark, tmp_path, made(2))
    root = f"file://{tmp_path}/root"
    snapshot.advance(spark, root, df, START, buckets=8)
    start = START + timedelta(7)
    plan = snapshot.merged(reports.between(df, start, start + timedelta(7)), snapshot.state(spark, root), start, "week")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(submission_date" in plan and str(start) in plan
    assert "SelectedBucketsCount: 8 out of 8" in plan
    assert "Exchange" not in plan[plan.index("SortMergeJoin") : plan.index("Bucketed: true")]  # the state's side comes first


def test_a_failed_increment_is_run_again(spark, tmp_path, monkeypatch):
    """Until its log entry is there, readers see the report before it, and the same increment can be run again; then it is refused."""
    df = stored(spark, tmp_path, made(3))
    root = f"file://{tmp_path}/root"
    assert snapshot.published(spark, root) is None and snapshot.state(spark, root).count() == 0
    snapshot.advance(spark, root, df, START, buckets=2)
    before = sorted_rows(snapshot.published(spark, root))
    with monkeypatch.context() as m:
        m.setattr(snapshot, "_entry", lambda *_: 1 / 0)  # what comes after the tables and before the log
        with pytest.raises(ZeroDivisionError):
            snapshot.advance(spark, root, df, START + timedelta(7))
    assert sorted_rows(snapshot.published(spark, root)) == before
    snapshot.advance(spark, root, df, START + timedelta(7))
    full = [r for r in sorted_rows(reports.interval_report(df, finalize=True)) if dict(r)["date"] < START + timedelta(14)]
    assert sorted_rows(snapshot.published(spark, root)) == full
    for start in (START, START + timedelta(7)):
        with pytest.raises(ValueError, match="already"):
            snapshot.advance(spark, root, df, start)


def test_two_writers(spark, tmp_path, monkeypatch):
    """Of two increments that began from the same state one is logged, the other fails."""
    df = stored(spark, tmp_path, made(4))
    root = f"file://{tmp_path}/root"
    snapshot.advance(spark, root, df, START, buckets=2)
    old = snapshot.log(spark, root)
    snapshot.advance(spark, root, df, START + timedelta(7))
    after = sorted_rows(snapshot.published(spark, root))
    with monkeypatch.context() as m:
        m.setattr(snapshot, "log", lambda s, r: old)
        with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
            snapshot.advance(spark, root, df, START + timedelta(7))
    assert sorted_rows(snapshot.published(spark, root)) == after


def test_values_as_of_a_row(spark):
    """The last known value of a client, of this interval or of those before it, against a loop."""
    at = lambda d, h: datetime(2024, 1, d, h)
    old = [("a", at(1, 1), 1, "x"), ("a", at(2, 1), 2, None), ("b", at(2, 2), 3, None), ("d", at(3, 1), 9, "w")]
    new = [("a", at(8, 1), 4, None), ("a", at(8, 2), 5, "y"), ("b", at(8, 1), 6, None), ("c", at(9, 1), 7, "z"), ("a", at(9, 1), 8, None), (None, at(9, 1), 10, "n")]
    schema = "client_id string, timestamp timestamp, event_id long, channel string"
    before = spark.createDataFrame(old, schema).groupBy("client_id").agg(F.min(F.to_date("timestamp")).alias("first_seen"), F.max_by("channel", F.when(F.col("channel").isNotNull(), F.col("timestamp"))).alias("known"))
    got = {r.event_id: (r.first_seen, r.value) for r in snapshot.as_of(spark.createDataFrame(new, schema), before, F.col("channel"), carried="known").collect()}
    assert got == {4: (date(2024, 1, 1), "x"), 5: (date(2024, 1, 1), "y"), 8: (date(2024, 1, 1), "y"), 6: (date(2024, 1, 2), None), 7: (date(2024, 1, 9), "z"), 10: (None, None)}
