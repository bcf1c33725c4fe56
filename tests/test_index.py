"""The positional client index, what a lookup reads, and day tables that are written once however often tasks run."""

import random
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from pulseframe.sources import index, sinks

DAY = date(2024, 1, 1)
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def stored(spark, tmp_path, n=4000, clients=300):
    rng = random.Random(1)
    rows = [(k, None if k % 31 == 0 else f"c{rng.randrange(clients):04d}", DAY + timedelta(days=k % 3)) for k in range(n)]
    df = spark.createDataFrame(rows, "event_id long, client_id string, submission_date date")
    path = f"file://{tmp_path}/t"
    ordered = df.repartition("submission_date").sortWithinPartitions("submission_date", "client_id", "event_id")
    # Small row groups and pages.
    ordered.write.partitionBy("submission_date").option("parquet.block.size", 4096).option("parquet.page.size", 1024).option("parquet.block.size.row.check.min", 50).option("parquet.page.size.row.check.min", 50).option("parquet.page.size.row.check.max", 50).parquet(path)
    return rows, path


def test_positions(spark, tmp_path):
    """Each run's rows stand at its positions in its file, and every row is in one run. Files that are not sorted have several runs of a client."""
    rows, path = stored(spark, tmp_path)
    loose = f"file://{tmp_path}/loose"
    spark.createDataFrame(rows, "event_id long, client_id string, submission_date date").orderBy("event_id").coalesce(1).write.partitionBy("submission_date").parquet(loose)
    for p in (path, loose):
        at = {(r.f, r.p): r.client_id for r in spark.read.parquet(p).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("p"), "client_id").collect()}
        runs = index.build_client_index(spark, p).collect()
        covered = [(r.file, r.position + k) for r in runs for k in range(r["rows"])]
        assert len(covered) == len(set(covered)) == len(rows) and set(covered) == set(at)
        assert all(at[r.file, r.position + k] == r.client_id for r in runs for k in range(r["rows"]))
        assert all(at.get((r.file, r.position - 1), "none") != r.client_id and at.get((r.file, r.position + r["rows"]), "none") != r.client_id for r in runs)
        assert (len(runs) == len({(r.file, r.client_id) for r in runs})) == (p == path)


def read_rows(spark, df):
    """The rows that the scan of a plan gave, before any filter of Spark's own."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()
        leaf = plan.collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize(("files", "named"), [(100, 100), (0, 100), (100, 0)])
def test_lookup(spark, tmp_path, files, named):
    rows, path = stored(spark, tmp_path)
    index.write_client_index(index.build_client_index(spark, path), f"file://{tmp_path}/index", row_group=4096)
    own = spark.read.parquet(f"file://{tmp_path}/index")
    for wanted in (["c0007"], ["c0001", "c0150", "c0299", None, "nobody"], ["nobody"], []):
        clients = spark.createDataFrame([(c,) for c in wanted], "client_id string")
        got = sorted(r.event_id for r in index.lookup_clients(spark, own, path, clients, DAY, DAY + timedelta(1), most_files=files, most_named=named).collect())
        assert got == sorted(k for k, c, d in rows if c and c in wanted and d <= DAY + timedelta(1))


def test_lookup_reads_what_it_needs(spark, tmp_path):
    """With more clients more rows are read, and with few of them few."""
    rows, path = stored(spark, tmp_path)
    own = index.build_client_index(spark, path)
    names = sorted({c for _, c, _ in rows if c})
    read = []
    for n in (1, 60, 150):
        clients = spark.createDataFrame([(c,) for c in names[:n]], "client_id string")
        read.append(read_rows(spark, index.lookup_clients(spark, own, path, clients, DAY, DAY + timedelta(2))))
    assert 0 < read[0] < read[1] < read[2] < len(rows) and read[0] < len(rows) / 8


def database():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


def day_rows(spark, url, days):
    return sorted(tuple(r) for d in days for r in spark.read.option("driver", DRIVER).jdbc(url, sinks.day_table("events", d)).collect())


def test_rows_are_written_once(spark, monkeypatch):
    """Every task of the staging table runs again after its rows were committed: the day tables have each row once, equal rows as often as they are."""
    rows = [(k // 2, "x" if k % 5 else None, DAY + timedelta(days=k % 3)) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, name string, day date").repartition(4)
    url, write = database(), DataFrameWriter.jdbc

    def again(self, url, table, *args, **kwargs):
        write(self, url, table, *args, **kwargs)
        if "_staging_" in table:
            write(self, url, table, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "jdbc", again)
    days = sinks.write_jdbc_days(df, url, "events", day="day", driver=DRIVER)
    assert days == [DAY + timedelta(days=k) for k in range(3)]
    got = [tuple(r) for d in days for r in spark.read.option("driver", DRIVER).jdbc(url, sinks.day_table("events", d)).collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)


def test_days_are_replaced_together(spark):
    """A second run replaces its days and no others; a run in the ledger is not written again; one that fails changes nothing."""
    url = database()
    make = lambda name, days: spark.createDataFrame([(k, name, DAY + timedelta(days=k % days)) for k in range(12)], "id long, name string, day date")
    three = [DAY + timedelta(days=k) for k in range(3)]
    sinks.write_jdbc_days(make("old", 3), url, "events", day="day", driver=DRIVER, run="one")
    sinks.write_jdbc_days(make("again", 3), url, "events", day="day", driver=DRIVER, run="one")
    assert {r[1] for r in day_rows(spark, url, three)} == {"old"}
    with pytest.raises(Exception, match="truncat|A truncation|VARCHAR"):  # the ledger, last in the transaction, has no room for this name
        sinks.write_jdbc_days(make("bad", 3), url, "events", day="day", driver=DRIVER, run="x" * 65)
    assert {r[1] for r in day_rows(spark, url, three)} == {"old"} and len(day_rows(spark, url, three)) == 12
    assert sinks.write_jdbc_days(make("new", 2), url, "events", day="day", driver=DRIVER, run="two") == three[:2]
    got = day_rows(spark, url, three)
    assert {(r[1], r[2]) for r in got} == {("new", three[0]), ("new", three[1]), ("old", three[2])} and len(got) == 16
    with pytest.raises(ValueError, match="rows without day"):
        sinks.write_jdbc_days(spark.createDataFrame([(1, "n", None)], "id long, name string, day date"), url, "events", day="day", driver=DRIVER)
    assert sinks.write_jdbc_days(make("none", 2).limit(0), url, "events", day="day", driver=DRIVER) == []
