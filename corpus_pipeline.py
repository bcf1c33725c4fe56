"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import dedup, langid, packing, simhash
from pulseframe.llm.common import table, written

#: A document goes if its text has no letters, or if its cosine with the declared language is under this share of its best
#: cosine. Both shrink alike on short texts. Documents that quote another language, or are half in it, stay.
LEAST_SHARE = 0.5
#: A best cosine below says nothing: it is three deviations of a cosine of random vectors of langid.DIM.
FLOOR = 0.1
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose declared language (if any) their text does not contradict.

    Null and empty texts have no letters and go. A null language, or one that no document teaches, contradicts nothing. Repeated rows share
    their fate, ids do not matter, an empty table stays empty, columns beside those of documents are dropped.
    """
    known = langid.profiles(docs.where(~langid.held_out(F.col("doc_id"))))
    names = F.array(*[F.lit(k) for k in known]) if known else F.array().cast("array<string>")
    found = langid.identify(docs, known)
    place = F.array_position(names, F.col("lang"))
    own = F.when(place > 0, F.try_element_at("cosines", place.cast("int")))
    contradicted = F.coalesce((F.col("score") >= FLOOR) & (own < LEAST_SHARE * F.col("score")), F.lit(False))
    # Where no language is known at all, all texts are `und`.
    letters = F.col("lang_pred") != langid.UNKNOWN if known else F.col("text").rlike(r"\p{L}")
    return found.where(letters & ~contradicted).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest id: null ids are smaller than others, null text is empty, of rows
    repeated with one id one stays. An empty table stays empty."""
    return dedup.exact_dedup(docs).where("kept").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id, see simhash.near_dedup for nulls and repeated ids. Texts without
    words are each other's copies. An empty table stays empty."""
    return simhash.near_dedup(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all that is left in sequences of 4096 tokens: null text is the end mark alone, repeated rows and null ids are documents of
    their own, an empty table gives no rows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("pack", pack)]

#: A classifier, fingerprints and a tokenizer are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
