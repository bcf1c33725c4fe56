"""Objects that are announced: each once, over batches, reruns and checkpoints; what cannot be read is entered and stops nothing."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.sources import versions
from pulseframe.streaming import announced

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])


def objects(spark, folder, n):
    """One parquet file each, of two rows."""
    for i in range(n):
        spark.createDataFrame([(2 * i, "a"), (2 * i + 1, None)], SCHEMA).coalesce(1).write.parquet(f"file://{folder}/o{i}")
    return [f"file://{folder}/o{i}" for i in range(n)]


def names(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def ks(spark, root):
    return sorted(r.k for r in announced.read_rows(spark, root).collect())


def test_each_object_once(spark, tmp_path):
    o, root = objects(spark, tmp_path, 5), f"file://{tmp_path}/root"
    announced.take(names(spark, o[0], o[1], o[1], None), root, "x-0", SCHEMA)
    announced.take(names(spark, o[1], o[2]), root, "x-1", SCHEMA)
    assert ks(spark, root) == [0, 1, 2, 3, 4, 5]
    announced.take(names(spark, o[1], o[2]), root, "x-1", SCHEMA)  # the batch runs again
    announced.take(names(spark), root, "x-2", SCHEMA)
    announced.take(names(spark, o[0]), root, "y-0", SCHEMA)
    assert ks(spark, root) == [0, 1, 2, 3, 4, 5]
    assert sorted(r.path for r in announced.read_ledger(spark, root).collect()) == o[:3]


def test_a_stop_between_rows_and_ledger(spark, tmp_path, monkeypatch):
    o, root = objects(spark, tmp_path, 2), f"file://{tmp_path}/root"
    announced.take(names(spark, o[0]), root, "x-0", SCHEMA)

    def stopped(*a, **k):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", stopped)
        with pytest.raises(RuntimeError):
            announced.take(names(spark, o[0], o[1]), root, "x-1", SCHEMA)
    assert [r.path for r in announced.read_ledger(spark, root).collect()] == o[:1]
    announced.take(names(spark, o[0], o[1]), root, "x-1", SCHEMA)
    assert ks(spark, root) == [0, 1, 2, 3] and announced.read_ledger(spark, root).count() == 2


def test_objects_that_cannot_be_read(spark, tmp_path):
    """A broken one, one that is not there, and one that is there only later."""
    o, root = objects(spark, tmp_path, 4), f"file://{tmp_path}/root"
    (tmp_path / "broken.parquet").write_bytes(b"this is no parquet")
    bad, gone, later = f"file://{tmp_path}/broken.parquet", f"file://{tmp_path}/gone", f"file://{tmp_path}/later"
    announced.take(names(spark, *o, bad, gone, later), root, "x-0", SCHEMA)
    assert ks(spark, root) == list(range(8))
    errors = {r.path: r.error for r in announced.read_ledger(spark, root).where("error is not null").collect()}
    assert set(errors) == {bad, gone, later} and "PATH_NOT_FOUND" in errors[gone]
    spark.createDataFrame([(100, "late")], SCHEMA).write.parquet(later)
    announced.take(names(spark, later, bad), root, "x-1", SCHEMA)
    assert ks(spark, root) == [*range(8), 100]
    assert sorted(r.path for r in announced.read_ledger(spark, root).where("error is null").collect()) == sorted([*o, later])


def test_a_stream_of_announcements(spark, tmp_path):
    """Two files of announcements, of which the second repeats some of the first; another checkpoint starts over and takes nothing."""
    o, root = objects(spark, tmp_path, 4), f"file://{tmp_path}/root"
    (tmp_path / "in").mkdir()
    for i, some in enumerate([o[:3], o[1:]]):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps({"path": p}) for p in some))
    stream = spark.readStream.schema("path string").option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/in")
    more = {"transform": lambda df: df.withColumn("double", F.col("k") * 2)}
    for checkpoint in ("one", "one", "two"):
        announced.ingest(stream, root, SCHEMA, f"file://{tmp_path}/{checkpoint}", **more).awaitTermination()
        assert ks(spark, root) == list(range(8))
    assert announced.read_rows(spark, root).columns == ["k", "name", "double"]
    assert announced.read_rows(spark, root).where("double = 2 * k").count() == 8
