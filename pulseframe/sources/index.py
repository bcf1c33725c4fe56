"""An index of clients over files, by which few files, and few of their row groups, are read for few clients."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Files that a lookup names to the scan at most; their names go through the driver.
MOST_FILES = 10_000
#: Clients that a lookup names to the scan at most.
MOST_NAMED = 200


def build_client_index(spark: SparkSession, path: str, *, client: str = "client_id", day: str = "submission_date") -> DataFrame:
    """Each file's runs of rows of one client that follow each other: file, day, client, the position of the first row in the file, from 0, and how
    many rows there are. Rows without a client are under null. A file whose rows are sorted by client has one run of each."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_at"), day, client)
    # The rows of a run have their positions and their places among the client's rows of the file in step.
    run = F.col("_at") - F.row_number().over(Window.partitionBy("file", client).orderBy("_at"))
    return rows.withColumn("_run", run).groupBy("file", day, client, "_run").agg(F.min("_at").alias("position"), F.count(F.lit(1)).alias("rows")).drop("_run")


def write_client_index(index: DataFrame, path: str, *, client: str = "client_id", row_group: int = 1 << 20) -> None:
    """The index sorted by client, in ranges. Its files' row groups and their bounds are the sparse directory that a filter on client looks through."""
    sorted_ = index.repartitionByRange(client, "file", "position").sortWithinPartitions(client, "file", "position")
    sorted_.write.mode("overwrite").option("parquet.block.size", row_group).parquet(path)


def _named(clients: list[str], client: str) -> Column:
    """One of these, as equalities that the scan holds against the bounds and dictionaries of row groups and pages; a longer list with isin would
    be held against its smallest and largest only."""
    return reduce(Column.__or__, [F.col(client) == c for c in clients], F.lit(False))


def lookup_clients(spark: SparkSession, index: DataFrame, path: str, clients: DataFrame, start: date, end: date, *, client: str = "client_id", day: str = "submission_date", most_files: int = MOST_FILES, most_named: int = MOST_NAMED) -> DataFrame:
    """All rows of the listed clients from start to end. The index is asked first; only its files are read.

    Up to most_files of them are named to the scan, and up to most_named clients, in the index as in the files, so that row groups without them are
    passed over: what is read follows the clients where files are sorted by client. Where there are more files, the table's days are read and rows
    of other files left out by a join; where there are more clients, the files are read whole.
    """
    wanted = clients.select(client).where(F.col(client).isNotNull()).distinct()
    few = [r[0] for r in wanted.limit(most_named + 1).collect()]
    only = (lambda df: df.where(_named(few, client))) if len(few) <= most_named else (lambda df: df.join(wanted, client, "left_semi"))
    own = only(index.where(F.col(day).between(F.lit(start), F.lit(end))))
    wanted_files = own.select("file").distinct()
    files = [r.file for r in wanted_files.limit(most_files + 1).collect()]
    if len(files) > most_files:
        whole = spark.read.parquet(path)
        rows = whole.withColumn("_file", F.col("_metadata.file_path")).join(wanted_files.withColumnRenamed("file", "_file"), "_file", "left_semi").drop("_file")
    else:
        rows = spark.read.option("basePath", path).parquet(*files) if files else spark.read.parquet(path).limit(0)
    return only(rows.where(F.col(day).between(F.lit(start), F.lit(end))))
