"""Files of a given size: rows are staged once, what they take on disk is measured for each folder, and ranges of equal bytes become the files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET = 128 << 20
#: Staged files of which a row each is broadcast; of more, they are joined.
MOST_BROADCAST = 100_000


def plan(sizes: list[tuple[int, int]], target: int) -> dict[int, tuple[int, int]]:
    """Folders with their bytes -> the first task and the number of files of each. A folder has as many files as it fills, one at least; those of
    one file share a task while they fill no more than a file together."""
    out, task, filled = {}, -1, target
    for folder, size in sizes:
        files = max(1, round(size / target))
        if files == 1 and filled + size <= target:
            filled += size
        else:
            task, filled = task + 1, size
        out[folder] = (task, files)
        if files > 1:
            task, filled = task + files - 1, target
    return out


def write_filled(df: DataFrame, path: str, *, by: Iterable[str], staging: str, target: int = TARGET, rows: int = 100_000) -> None:
    """Writes rows as a parquet table partitioned by columns, with files of target bytes: of a folder of several files each has between three
    and five quarters of it, as far as its rows are measured right; a folder of less than one and a half is one file.

    Rows are written to the folder staging first, in files of so many rows at most, and these tell what a row takes in its folder, compressed. A
    folder's files in order are then cut into ranges of equal bytes, a row's bytes being its staged file's share: rows keep their order, and copies
    of a row, of which a folder may be full, are no hot key. The cut depends on stored positions alone, so a task that runs again gives the
    same rows. The driver gets a row for each folder. Null values of columns are folders of their own; an empty table makes no file.
    """
    spark, by = df.sparkSession, list(by)
    df.write.option("maxRecordsPerFile", rows).partitionBy(*by).parquet(staging)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    staged = spark.read.schema(schema).parquet(staging).withColumn("_at", F.col("_metadata"))
    key = F.xxhash64(*by, *[F.col(c).isNull() for c in by])
    files = staged.groupBy(key.alias("_folder"), F.col("_at.file_path").alias("_file")).agg(F.first("_at.file_size").alias("_size"), F.count(F.lit(1)).alias("_rows"))
    totals = files.groupBy("_folder").agg(F.sum("_size").alias("size"), F.min("_file").alias("file")).collect()  # a row for each folder
    made = plan([(r["_folder"], r["size"]) for r in sorted(totals, key=lambda r: r["file"])], target)
    if not made:
        df.limit(0).write.partitionBy(*by).mode("overwrite").parquet(path)
        return
    total = {r["_folder"]: r["size"] for r in totals}
    folders = spark.createDataFrame([(f, first, n, total[f]) for f, (first, n) in made.items()], "_folder long, _first int, _n int, _total long")
    w = Window.partitionBy("_folder").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.join(folders, "_folder").withColumn("_start", F.coalesce(F.sum("_size").over(w), F.lit(0))).drop("_folder")
    starts = F.broadcast(starts) if files.count() <= MOST_BROADCAST else starts
    place = (F.col("_start") + F.col("_size") * F.col("_at.row_index") / F.col("_rows")) * F.col("_n") / F.col("_total")
    task = F.col("_first") + F.least(F.floor(place), F.col("_n") - 1)
    placed = staged.join(starts, F.col("_at.file_path") == F.col("_file")).withColumn("_task", task.cast("int"))
    tasks = max(first + n for first, n in made.values())
    placed.repartitionById(tasks, "_task").select(*[f"`{c}`" for c in schema.names]).write.partitionBy(*by).mode("overwrite").parquet(path)
