"""Files by bytes: sizes on widths that differ a hundredfold, small folders, copies, and rows that all stay."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from pulseframe.sources import filled

SCHEMA = "kind string, k long, text string"


def sizes(path):
    return {d.name: sorted(f.stat().st_size for f in d.glob("*.parquet")) for d in Path(path).glob("kind=*")}


def test_plan():
    assert filled.plan([(1, 40), (2, 50), (3, 20), (4, 350), (5, 10), (6, 0)], 100) == {1: (0, 1), 2: (0, 1), 3: (1, 1), 4: (2, 4), 5: (6, 1), 6: (6, 1)}
    assert filled.plan([], 100) == {}


def test_files_by_bytes(spark, tmp_path):
    """By rows, files of the wide kind would be a hundred times those of the narrow one."""
    rng = random.Random(3)
    wide = spark.range(3_000).select(F.lit("wide").alias("kind"), F.col("id").alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 1).alias("text"))
    wide = wide.withColumn("text", F.concat(*[F.sha2(F.concat("text", F.lit(str(i))), 512) for i in range(10)]))
    narrow = spark.range(60_000).select(F.lit("narrow").alias("kind"), F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("text"))
    copies = spark.range(20_000).select(F.lit("copies").alias("kind"), F.lit(1).cast("long").alias("k"), F.lit("same").alias("text"))
    few = spark.createDataFrame([(x, rng.randrange(9), None) for x in ("a", "b", "c", None, "")], SCHEMA)
    df = wide.unionByName(narrow).unionByName(copies).unionByName(few)
    target = 200_000
    filled.write_filled(df, f"file://{tmp_path}/out", by=["kind"], staging=f"file://{tmp_path}/staging", target=target, rows=1_000)
    got = sizes(tmp_path / "out")
    assert len(got["kind=wide"]) > 5 and len(got["kind=narrow"]) > 5 and len(got["kind=copies"]) == 1 and len(got["kind=a"]) == 1
    for kind in ("kind=wide", "kind=narrow"):
        assert target / 2 <= got[kind][0] and got[kind][-1] <= target * 2, (kind, got[kind])
    back = spark.read.schema(SCHEMA).parquet(f"file://{tmp_path}/out").select("kind", "k", "text")
    nullable = df.withColumn("kind", F.nullif("kind", F.lit("")))  # a folder cannot tell an empty text from none
    assert back.count() == df.count() and back.exceptAll(nullable).count() == 0


def test_an_empty_table(spark, tmp_path):
    filled.write_filled(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/out", by=["kind"], staging=f"file://{tmp_path}/staging")
    assert sizes(tmp_path / "out") == {} and spark.read.schema(SCHEMA).parquet(f"file://{tmp_path}/out").count() == 0
