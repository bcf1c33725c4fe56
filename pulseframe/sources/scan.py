"""Sources: what is read, and how little of it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dims, versions


def scan_dims(spark: SparkSession, root: str, spec: str | dict, *, schema: T.StructType | None = None) -> DataFrame:
    """The rows whose partition dimensions the specification allows. The filter is on partition columns alone."""
    reader = spark.read.option("recursiveFileLookup", "false")
    df = (reader.schema(schema) if schema else reader).parquet(root)
    own = dims.parsed(spec)
    partitioned = df.withColumns({n: F.col(f"`{n}`").cast("string") for n, _ in own if dict(df.dtypes)[n] != "string"})
    return partitioned.where(dims.predicate(own))


def scan_days(df: DataFrame, start: date, days: int, *, column: str = "submission_date", where: Column | None = None) -> DataFrame:
    """The rows of so many days from start; days without a partition are no error. A filter goes to the scan of each."""
    own = df.where(F.col(column).between(F.lit(start), F.lit(start + timedelta(days - 1))))
    return own if where is None else own.where(where)


def missing_days(df: DataFrame, start: date, days: int, *, column: str = "submission_date") -> DataFrame:
    """The days of a scan that have no rows, for a warning."""
    wanted = df.sparkSession.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(column))
    return wanted.join(scan_days(df, start, days, column=column).select(column).distinct(), column, "left_anti")


def scan_service_logs(spark: SparkSession, root: str, service: str, start: date, end: date, schema: T.StructType) -> DataFrame:
    """JSON logs of a service whose file name holds a date (service-YYYYMMDD...) from start to end. Names are matched before files are read."""
    files = spark.read.schema(schema).option("pathGlobFilter", f"{service}-*").option("recursiveFileLookup", "true").json(root)
    day = F.try_to_timestamp(F.regexp_extract(F.col("_metadata.file_name"), rf"^{service}-(\d{{8}})", 1), F.lit("yyyyMMdd")).cast("date")
    return files.withColumn("log_date", day).where(F.col("log_date").between(F.lit(start), F.lit(end)))


def kafka_options(topics: list[str], servers: str, start: str = "newest") -> dict[str, str]:
    """The options of a topic stream. Names must be there, and start is newest or oldest."""
    if not topics or not all(topics):
        raise ValueError("topics are missing")
    if not servers:
        raise ValueError("servers are missing")
    if start not in ("newest", "oldest"):
        raise ValueError(f"start is newest or oldest, not {start}")
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": {"newest": "latest", "oldest": "earliest"}[start], "failOnDataLoss": "false"}


def stream_kafka(spark: SparkSession, topics: list[str], servers: str, start: str = "newest") -> DataFrame:
    """A stream of messages with key, topic, partition and offset. Needs Spark's Kafka connector on the class path."""
    return kafka_messages(spark.readStream.format("kafka").options(**kafka_options(topics, servers, start)).load())


def kafka_messages(raw: DataFrame) -> DataFrame:
    """The columns of a topic stream under the names of messages."""
    return raw.select(F.col("value").alias("payload"), "key", "topic", "partition", "offset", "timestamp")


def stream_new_files(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """Each new file once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(path)


# JSON Schema's types and Spark's.
_TYPES = {"string": T.StringType(), "integer": T.LongType(), "boolean": T.BooleanType(), "number": T.DoubleType()}


def from_json_schema(schema: dict, root: dict | None = None) -> T.DataType:
    """A JSON Schema as a Spark type: references resolved, nullable where null is among the types."""
    root = root or schema
    while "$ref" in schema:
        node = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            node = node[part]
        schema = node
    kinds = schema.get("type", "string")
    kind = next(k for k in ([kinds] if isinstance(kinds, str) else kinds) if k != "null")
    if kind == "array":
        item = schema.get("items", {"type": "string"})
        return T.ArrayType(from_json_schema(item, root), nullable(item, root))
    if kind == "object":
        return T.StructType([T.StructField(n, from_json_schema(s, root), nullable(s, root)) for n, s in schema.get("properties", {}).items()])
    return _TYPES[kind]


def nullable(schema: dict, root: dict) -> bool:
    while "$ref" in schema:
        node = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            node = node[part]
        schema = node
    kinds = schema.get("type", "string")
    return kinds == "null" or "null" in kinds if not isinstance(kinds, str) else False


def import_json_day(spark: SparkSession, src: str, schema: T.StructType | dict, day: date, dest: str) -> None:
    """A day of JSON lines as a partition of a table in versions (see versions.read); a second import replaces the first, and one that fails
    leaves it."""
    backfill_json(spark, lambda _: src, schema, day, day, dest)


def backfill_json(spark: SparkSession, src_of: Callable[[date], str], schema: T.StructType | dict, start: date, end: date, dest: str) -> None:
    """import_json_day() for each day from start to end, in one job and one version; src_of gives a day's path. A day of which
    there is no path is an error, one without lines has no rows any more."""
    declared = schema if isinstance(schema, T.StructType) else from_json_schema(schema)
    days = [start + timedelta(k) for k in range((end - start).days + 1)]
    rows = reduce(DataFrame.unionByName, [spark.read.schema(declared).json(src_of(d)).withColumn("day", F.lit(d)) for d in days])
    versions.publish(rows.hint("rebalance", "day"), dest, by=["day"], replaces=[f"day={d}" for d in days])


def load_day_table(spark: SparkSession, src: str, schema: T.StructType, widths: dict[str, int]) -> DataFrame:
    """A day's delimited files: texts cut to their widths, characters that are none replaced."""
    df = spark.read.schema(schema).option("sep", "|").option("escape", "\\").option("mode", "PERMISSIVE").csv(src)
    return df.withColumns({c: F.left(F.replace(F.col(c), F.lit("�"), F.lit("?")), F.lit(n)) for c, n in widths.items()})
