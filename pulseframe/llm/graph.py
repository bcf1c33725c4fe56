"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. links: a > b."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    return large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b: long, not null) -> (node, root): root is the smallest node of the component.

    Nodes without a link to another one are not returned. Every round is written to the shared
    folder, so that neither lineage nor a lost executor makes it start again; the rounds end when
    the set of links no longer changes. Rounds grow with the logarithm of a component's diameter.
    """
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count(F.lit(1))
    before = links.agg(*mark).first()
    while before[1]:
        links = written(_stars(links), "links")
        now = links.agg(*mark).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
