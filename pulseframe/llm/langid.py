"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches

#: Length of the random vectors.
DIM = 1024
#: Letter classes: 0 is the gap between words, Latin letters have one each, others share the rest by a hash.
LETTERS = 128
SEED = 7
UNKNOWN = "und"
#: The driver holds a vector for each language, so there are no more of them.
MOST_LANGUAGES = 5_000
#: Characters of documents that are scored at a time, and n-grams whose vectors are held at a time.
CHUNK, SLICE = 400_000, 4096


@cache
def _classes() -> np.ndarray:
    """Code point -> letter class of its lower-case form."""
    latin = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ")}
    free = LETTERS - 1 - len(latin)
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()[0]
            table[i] = latin.get(low) or 1 + len(latin) + (ord(low) * 2654435761 >> 8) % free
    return table


@cache
def _vectors() -> tuple[np.ndarray, ...]:
    """The letters' random vectors of +1 and -1, permuted for the first, second and third place of an n-gram."""
    v = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (LETTERS, DIM))
    return np.roll(v, 2, 1), np.roll(v, 1, 1), v


def ngrams(text: str | None) -> np.ndarray:
    """The numbers of the text's letter trigrams, a single gap between and around words; none without letters."""
    if not text:
        return np.zeros(0, np.int64)
    x = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    x = np.concatenate(([0], x, [0]))
    x = x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))]  # a run of gaps is one gap
    return (x[:-2] * LETTERS + x[1:-1]) * LETTERS + x[2:] if len(x) > 2 else np.zeros(0, np.int64)


def _bound(keys: np.ndarray) -> np.ndarray:
    """The n-grams' vectors: the product of the permuted letter vectors."""
    first, second, third = _vectors()
    return (first[keys // LETTERS**2] * second[keys // LETTERS % LETTERS] * third[keys % LETTERS]).astype(np.float32)


def bundled(rows: list[np.ndarray]) -> np.ndarray:
    """The sum of the n-gram vectors of each document."""
    out = np.zeros((len(rows), DIM), np.float32)
    if not (lengths := np.array([len(r) for r in rows])).sum():
        return out
    keys = np.concatenate(rows)
    seen = np.flatnonzero(np.bincount(keys, minlength=LETTERS**3))
    place = np.zeros(LETTERS**3, np.int64)
    place[seen] = np.arange(len(seen))
    counts = np.bincount(np.repeat(np.arange(len(rows)), lengths) * len(seen) + place[keys], minlength=len(rows) * len(seen)).reshape(len(rows), -1)
    for at in range(0, len(seen), SLICE):
        out += counts[:, at : at + SLICE].astype(np.float32) @ _bound(seen[at : at + SLICE])
    return out


def _chunks(texts: pd.Series) -> Iterator[list[np.ndarray]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(row := ngrams(text))
        size += len(row)
        if size > CHUNK or len(chunk) == 256:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def profiles(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """The language prototypes: the bundled n-gram vectors of all documents of each non-null language.

    Each task sums its documents per language, Spark sums the tasks' vectors. What reaches the driver is
    a vector per language (4 KB), of which there are MOST_LANGUAGES at most; more are an error, as the column then holds no languages.
    Documents without letters add nothing, repeated rows count again; an empty table gives no prototype.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang", sort=False)["text"]:
                for chunk in _chunks(texts):
                    joined = [np.concatenate(chunk)]
                    total[lang] = total.get(lang, 0) + bundled(joined)[0].astype(np.float64)
        yield pd.DataFrame([(k, i, v) for k, x in total.items() for i, v in enumerate(x)], columns=["lang", "i", "v"])

    named = small_batches(docs).select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where("lang is not null and text is not null")
    # Counts are whole numbers below 2**53, so the sums do not depend on the order of tasks.
    parts = named.mapInPandas(sums, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found: dict[str, np.ndarray] = {}
    for lang, i, v in parts.toLocalIterator():
        if lang not in found and len(found) == MOST_LANGUAGES:
            raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values")
        found.setdefault(lang, np.zeros(DIM))[i] = v
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(found.items()) if np.linalg.norm(v)}


def predicted(text: Column, known: dict[str, np.ndarray]) -> Column:
    """text -> struct(lang, score, second): the prototype with the largest cosine, that cosine from 0 to 1, and
    a map of all. `und` and zero if the text is null or has no letter, or no language is known."""
    names = list(known)
    matrix = np.stack([known[k] for k in names]).T if names else np.zeros((DIM, 0), np.float32)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores, all_scores = [], [], []
            for chunk in _chunks(batch):
                docs = bundled(chunk)
                cosines = np.clip(docs @ matrix / np.maximum(np.linalg.norm(docs, axis=1, keepdims=True), 1e-9), 0, 1).astype(float)
                for row, own in zip(chunk, cosines, strict=True):
                    known_one = bool(len(row)) and bool(names)
                    best = int(own.argmax()) if known_one else 0
                    langs.append(names[best] if known_one else UNKNOWN)
                    scores.append(float(own[best]) if known_one else 0.0)
                    all_scores.append(own.tolist() if known_one else [])
            yield pd.DataFrame({"lang": langs, "score": scores, "cosines": all_scores})

    return F.pandas_udf(score, "lang string, score double, cosines array<double>")(text)


def held_out(ident: Column) -> Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame, known: dict[str, np.ndarray], *, text_col: str = "text") -> DataFrame:
    """Adds lang_pred (a known language or `und`), score (0 to 1) and cosines (in the order of known's keys)
    to every row; columns of docs with these names are replaced.

    Null and letterless texts are `und` with score zero and no cosines. Of languages with one cosine the first by name wins, so repeated
    rows have equal results. Texts of any length are counted whole, several at a time up to CHUNK n-grams. An empty table gives no rows.
    """
    docs = small_batches(docs).drop("lang_pred", "score", "cosines")
    got = fresh(docs, "got")
    out = docs.withColumn(got, predicted(F.col(f"`{text_col}`"), known))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{got}.lang").alias("lang_pred"), F.col(f"{got}.score").alias("score"), F.col(f"{got}.cosines").alias("cosines"))
