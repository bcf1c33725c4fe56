"""Ingestion of objects that are announced by name: each once, and a table of those that could not be read.

Under one root folder: `rows`, the objects' rows, and `ledger` (path, error, read_at), a row for each object of a micro-batch, both tables in versions
with a partition for each micro-batch. A batch that runs again replaces what it made before. Its rows are published before its entries, and its
names are held against the entries of other batches only, so a stop between the two leaves nothing twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versions

LEDGER = "path string, error string, read_at timestamp, _batch string"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """path, error (null of what was read) and read_at of each object of each batch."""
    path = f"{root}/ledger"
    return (versions.read(spark, path) if versions.versions(spark, path) else spark.createDataFrame([], LEDGER)).drop("_batch")


def read_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all objects that were read. Where none was announced yet that is an error."""
    return versions.read(spark, f"{root}/rows").drop("_batch")


def take(names: DataFrame, root: str, batch: str, schema: T.StructType, *, fmt: str = "parquet", options: dict[str, str] | None = None, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Reads the objects that names (path) announces and no other batch has read, and publishes their rows and entries.

    A batch's names are collected, as Spark's readers take them from the driver: the source's rate bounds them. All are read by one job. If it
    fails, halves are, and so on, until what fails is a single object: it is entered with its error and gives no rows, whole
    objects beside it do. One that could not be read may be announced again. Null names take no part.
    """
    spark = names.sparkSession
    wanted = names.where("path is not null").select("path").distinct()
    done = versions.version(spark, f"{root}/ledger")
    others = [p for p in done.parts if p != f"_batch={batch}"]
    if others:
        wanted = wanted.join(versions.read(spark, f"{root}/ledger", of=done, parts=others).where("error is null").select("path"), "path", "left_anti")
    paths = sorted(r.path for r in wanted.collect())
    runs: list[str] = []
    entries: list[tuple[str, str | None]] = []

    def rows(some: list[str]) -> DataFrame:
        read = spark.read.schema(schema).format(fmt).options(**(options or {})).load(some)
        return (transform(read) if transform else read).withColumn("_batch", F.lit(batch))

    def attempt(some: list[str]) -> None:
        try:
            runs.extend(r for made in versions.write(rows(some), f"{root}/rows", by=["_batch"]).values() for r in made)
            entries.extend((p, None) for p in some)
        except (PySparkException, Py4JError) as e:
            if len(some) == 1:
                entries.append((some[0], str(e).split("\n", 1)[0]))
                return
            attempt(some[: len(some) // 2])
            attempt(some[len(some) // 2 :])

    if paths:
        attempt(paths)
    nullable = lambda s: T.StructType([T.StructField(f.name, f.dataType, True) for f in s])
    empty = spark.createDataFrame([], schema)
    kind = nullable((transform(empty) if transform else empty).withColumn("_batch", F.lit(batch)).schema)
    key = f"_batch={batch}"
    versions.commit(spark, f"{root}/rows", {key: runs} if runs else {}, kind, replaces=[key])
    made = spark.createDataFrame(entries, "path string, error string").withColumns({"read_at": F.current_timestamp(), "_batch": F.lit(batch)})
    versions.publish(made, f"{root}/ledger", by=["_batch"], replaces=[key])


def ingest(announcements: DataFrame, root: str, schema: T.StructType, checkpoint: str, *, every: str | None = None, **options):
    """Starts a query that takes what a stream (path) announces, see take(). Batches are named by the checkpoint, so another one, as a second source of
    announcements has, is no rerun of the first. Each micro-batch makes a folder, so `every` should be minutes."""
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def one(batch: DataFrame, number: int) -> None:
        take(batch, root, f"{name}-{number}", schema, **options)

    writer = announcements.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
