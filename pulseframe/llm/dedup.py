"""Exact duplicates by content sort: built-in operators only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MOST_HOT, ascii_lower, fresh, written

#: Characters of the normalised text that the sampled splitters see.
PREFIX = 128
#: No group of fewer rows is hot.
LEAST_HOT = 1_000


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_hot: int = MOST_HOT, least_hot: int = LEAST_HOT) -> DataFrame:
    """Adds to every row of docs the group of equal texts that it belongs to.

    Texts are equal when they are identical after lower-casing A-Z. Rows are dealt to ranges by sampled splitters over the start of the
    normalised text, then its digest, where starts are equal; each range is sorted externally by the text, which puts
    equal texts side by side, and neighbours are compared in full (the normalised text is part of the window's key). The row with
    the largest id stays.

    A group with more than 1/most_hot of all rows (and least_hot rows at least) is hot. Rows of a hot group get a salt, so that they
    are several runs in several ranges. Each run is sorted and compared like any other; then the runs' heads are, one row a run, and
    what comes out is broadcast to the rows: there are fewer hot groups than most_hot, and some 100 bytes of each.

    Null text counts as empty; a null id is smaller than any other; of rows repeated with the same id one stays; texts of any length are
    compared whole. An empty table gives an empty result. Columns of docs are kept as they are.

    New columns: keep_id (the id that stays), group_size, kept, text_sha256 (lower-case hex).
    A column of docs with one of these names is replaced.
    """
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    sha, prefix, salt, norm = (fresh(docs, x) for x in ("sha", "prefix", "salt", "norm"))
    salts, hot_max, hot_n = fresh(docs, "salts"), fresh(docs, "hot_max"), fresh(docs, "hot_n")
    own = [F.col(f"`{c}`") for c in docs.columns]
    ident, text = F.col(f"`{id_col}`"), ascii_lower(F.col(f"`{text_col}`"))

    counted = docs.select(F.sha2(text, 256).alias(sha)).groupBy(sha).agg(F.count(F.lit(1)).alias("n"))
    counted = written(counted.where(f"n > {least_hot}"), "counted")  # the groups that can be hot
    least = max(least_hot, docs.count() // most_hot) if counted.take(1) else least_hot
    hot = F.broadcast(counted.where(f"n > {least}").select(sha, F.ceil(F.col("n") / least).alias(salts)))

    marked = docs.select(*own, text.alias(norm)).select(*own, F.left(F.col(norm), F.lit(PREFIX)).alias(prefix), F.sha2(F.col(norm), 256).alias(sha))

    def runs(rows: DataFrame) -> DataFrame:
        """Rows with what the comparison of neighbours says of their run: its largest id, its rows, and the row's place."""
        dealt = rows.withColumn(salt, F.when(F.col(salts).isNotNull(), F.pmod(F.xxhash64(ident), F.col(salts))).otherwise(F.lit(0)))
        ranged = dealt.repartitionByRange(prefix, sha, salt).withColumn(norm, text)
        run = Window.partitionBy(prefix, norm, sha, salt)  # sorted by these: the start, then the whole text
        newest = run.orderBy(ident.desc_nulls_last())
        return ranged.select(*own, norm, sha, salts, F.first(ident).over(newest).alias("keep_id"), F.row_number().over(newest).alias(prefix), F.count(F.lit(1)).over(run).alias("group_size"))

    heads = runs(marked.join(hot, sha)).where(F.col(prefix) == 1).groupBy(norm, sha).agg(F.max("keep_id").alias(hot_max), F.sum("group_size").alias(hot_n))
    whole = F.broadcast(written(heads.select(sha, hot_max, hot_n), "hot"))

    seen = runs(marked.join(hot, sha, "left")).drop(norm, salts).join(whole, sha, "left")
    keep = F.when(F.col(hot_n).isNotNull(), F.col(hot_max)).otherwise(F.col("keep_id"))
    # Rows of a hot group whose ids are all null have no largest id; they have one salt, so one row stays.
    head = (F.col(prefix) == 1) & ident.eqNullSafe(keep)
    return seen.select(*own, keep.alias("keep_id"), F.coalesce(F.col(hot_n), F.col("group_size")).alias("group_size"), head.alias("kept"), F.col(sha).alias("text_sha256"))
