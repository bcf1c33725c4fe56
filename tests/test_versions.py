"""Published versions: what readers see while writers fail or meet; and history by Bloom filters against a join."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import history
from pulseframe.sources import scan, sinks, versions

SCHEMA = "day date, k long, name string"


def rows(spark, *some):
    return spark.createDataFrame(list(some), SCHEMA)


def got(spark, root, **more):
    return sorted(map(tuple, versions.read(spark, root, **more).collect()), key=repr)


D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_partitions_are_replaced_and_versions_stay(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    first = versions.publish(rows(spark, (D1, 1, "a"), (D2, 2, None), (None, 3, "n")), root, by=["day"])
    versions.publish(rows(spark, (D2, 5, "b")), root, by=["day"])
    assert got(spark, root) == sorted([(D1, 1, "a"), (D2, 5, "b"), (None, 3, "n")], key=repr)
    assert got(spark, root, of=first) == sorted([(D1, 1, "a"), (D2, 2, None), (None, 3, "n")], key=repr)
    assert got(spark, root, parts=["day=2024-01-02", "day=1999-01-01"]) == [(D2, 5, "b")]
    versions.publish(rows(spark), root, by=["day"], replaces=["day=2024-01-01"])  # a day that has no rows any more
    assert got(spark, root) == sorted([(D2, 5, "b"), (None, 3, "n")], key=repr)
    with pytest.raises(ValueError, match="schema"):
        versions.publish(rows(spark, (D1, 1, "a")).withColumn("more", F.lit(1)), root, by=["day"])
    versions.publish(rows(spark), root, replaces=versions.ALL)
    assert got(spark, root) == [] and versions.read(spark, root).columns == ["day", "k", "name"]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    versions.publish(rows(spark, (D1, 1, "a")), root)
    reader = versions.read(spark, root)
    broken = rows(spark, (D1, 2, "b"), (D2, 3, "c")).withColumn("k", F.when(F.col("k") == 3, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="broken"):
        versions.publish(broken, root, replaces=versions.ALL)
    assert versions.versions(spark, root) == [1] and got(spark, root) == [(D1, 1, "a")]
    versions.publish(rows(spark, (D2, 9, "z")), root, replaces=versions.ALL)
    assert [tuple(r) for r in reader.collect()] == [(D1, 1, "a")]  # what a reader opened stays
    assert got(spark, root) == [(D2, 9, "z")]


def test_two_writers(spark, tmp_path):
    """Other partitions are no conflict; the same one is, as is a table as a whole."""
    root = f"file://{tmp_path}/t"
    base = versions.publish(rows(spark, (D1, 1, "a"), (D2, 2, "b")), root, by=["day"])
    versions.publish(rows(spark, (D1, 10, "one")), root, by=["day"], base=base)
    versions.publish(rows(spark, (D2, 20, "two")), root, by=["day"], base=base)
    assert got(spark, root) == [(D1, 10, "one"), (D2, 20, "two")]
    for more in ({"replaces": versions.ALL}, {"replaces": ["day=2024-01-02"]}, {}):
        with pytest.raises(versions.Conflict):
            versions.publish(rows(spark, (D1, 99, "late")), root, by=["day"], base=base, **more)
    assert got(spark, root) == [(D1, 10, "one"), (D2, 20, "two")] and versions.versions(spark, root) == [1, 2, 3]
    assert versions.expire(spark, root, 1) == 2
    assert got(spark, root) == [(D1, 10, "one"), (D2, 20, "two")] and versions.versions(spark, root) == [3]
    assert len(list((tmp_path / "t/data/day=2024-01-01").glob("_run=*"))) == 4  # three of writers that failed, which none deletes


def days(n):
    return [date(2024, 1, 1) + timedelta(k) for k in range(n)]


def test_history_against_a_join(spark, tmp_path):
    """Small filters make many errors, and no other result."""
    rng = random.Random(7)
    old = [(f"d{rng.randrange(4000)}", rng.choice(days(12))) for _ in range(3000)] + [(None, D1), ("lost", None)]
    new = [(f"d{rng.randrange(8000)}",) for _ in range(800)] * 2 + [(None,), ("",), ("lost",)]
    past = spark.createDataFrame(old, "document_id string, submission_date date")
    now = spark.createDataFrame(new, "document_id string")
    expected = {}
    for i, d in old:
        if i is not None and d is not None and (i,) in set(new):
            expected.setdefault(i, set()).add(d)
    for name, buckets, blocks in (("good", 4, 256), ("crowded", 2, 2)):
        root = f"file://{tmp_path}/{name}"
        history.add(past.where("submission_date <= date'2024-01-05'"), root, buckets=buckets, blocks=blocks)
        history.add(past.where("submission_date > date'2024-01-04' or submission_date is null"), root, buckets=buckets, blocks=blocks)  # a day twice
        out = history.seen(now, root, buckets=buckets, blocks=blocks)
        assert {r.id: (r.first_day, r.days) for r in out.rows.collect()} == {i: (min(s), len(s)) for i, s in expected.items()}
        left = sorted((r.document_id for r in history.unseen(now, root, buckets=buckets, blocks=blocks).collect()), key=repr)
        assert left == sorted((i for (i,) in new if i not in expected), key=repr)


def test_history_reads_few_partitions(spark, tmp_path):
    """Of 20 days, 8 buckets each, only those that have one of the repeated documents, and a few by error; without a repeat nearly none."""
    root = f"file://{tmp_path}/h"
    past = spark.range(20_000).select(F.concat(F.lit("d"), "id").alias("document_id"), F.expr("date_add(date'2024-01-01', cast(id % 20 as int))").alias("submission_date"))
    history.add(past, root, buckets=8, blocks=64)
    fresh = spark.range(500).select(F.concat(F.lit("n"), "id").alias("document_id"))
    out = history.seen(fresh, root, buckets=8, blocks=64)
    assert out.rows.count() == 0 and out.partitions == 160 and out.read <= 8
    again = fresh.unionByName(past.where("submission_date = date'2024-01-20'").select("document_id"))
    out = history.seen(again, root, buckets=8, blocks=64)
    assert out.rows.count() == 1000 and 8 <= out.read <= 20
    files = {f for f in out.rows.inputFiles() if "/ids/" in f}
    assert {f.split("/day=")[1][:10] for f in files} >= {"2024-01-20"} and len({tuple(p for p in f.split("/") if p.startswith(("day=", "bucket="))) for f in files}) == out.read


def test_history_without_days(spark, tmp_path):
    root = f"file://{tmp_path}/h"
    now = spark.createDataFrame([("a",), (None,)], "document_id string")
    assert history.seen(now, root).rows.count() == 0 and history.unseen(now, root).count() == 2
    history.add(spark.createDataFrame([], "document_id string, submission_date date"), root)
    assert history.seen(now, root).rows.count() == 0 and history.unseen(now, root).count() == 2


def test_reports_and_imports_in_versions(spark, tmp_path):
    """A report that another writer published meanwhile, an import that fails, and one that runs again."""
    root = f"file://{tmp_path}/report"
    report = lambda *some: spark.createDataFrame(list(some), "channel string, n long")
    sinks.publish_report(report(("beta", 1), (None, 2)), root, ["channel"])
    sinks.publish_report(report((None, 3), ("new", 4)), root, ["channel"])
    assert got(spark, root) == sorted([("beta", 1), (None, 3), ("new", 4)], key=repr)
    seen_before = versions.version(spark, root)
    late = sinks.merge_report(versions.read(spark, root, of=seen_before), report(("beta", 9)), ["channel"])
    sinks.publish_report(report(("beta", 5)), root, ["channel"])
    with pytest.raises(versions.Conflict):
        versions.publish(late, root, base=seen_before, replaces=versions.ALL)
    assert ("beta", 5) in got(spark, root)

    table, schema = f"file://{tmp_path}/table", {"type": "object", "properties": {"k": {"type": "integer"}}}
    for d, lines in ((D1, '{"k": 1}\n{"k": 2}\n'), (D2, '{"k": 3}\n')):
        (tmp_path / f"{d}.json").write_text(lines)
    src = lambda d: f"file://{tmp_path}/{d}.json"
    scan.backfill_json(spark, src, schema, D1, D2, table)
    scan.import_json_day(spark, src(D1), schema, D1, table)
    assert got(spark, table) == [(1, D1), (2, D1), (3, D2)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan.backfill_json(spark, src, schema, D1, D2 + timedelta(1), table)
    (tmp_path / f"{D1}.json").write_text("")
    scan.backfill_json(spark, src, schema, D1, D2, table)
    assert got(spark, table) == [(3, D2)] and versions.versions(spark, table) == [1, 2, 3]
