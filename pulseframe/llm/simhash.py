"""Near duplicates by SimHash, searched through a segment-popcount embedding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, joined, small_batches, written
from .graph import components

SHINGLE, SEED = 3, 42
#: Segments of four bits: a count from 0 to 4 takes three bits of a grid cell's number.
SEGMENTS, WIDTH = 16, 4
#: Shingles whose bits are counted at a time, which bounds memory on very long texts.
CHUNK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text, as a signed integer; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words)) - 1
    starts, ends = starts[: len(words) - k].tolist(), ends[k:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for some in texts:
        yield pd.Series([fingerprint(x) for x in some], dtype="int64")


def _cells(prints: DataFrame) -> DataFrame:
    """(p) -> (cell, p, k): the grid point of p's segment counts (k = 0) and all points one step away.

    Two prints whose counts differ by 2 or less in sum share one of these points. k is 1 + i for a
    step down in segment i, 1 + SEGMENTS + i for a step up.
    """
    counts = [F.bit_count(F.shiftrightunsigned("p", WIDTH * i).bitwiseAND(F.lit(2**WIDTH - 1))).cast("long") for i in range(SEGMENTS)]
    named = prints.select("p", *[c.alias(f"n{i}") for i, c in enumerate(counts)])
    own = sum((F.shiftleft(F.col(f"n{i}"), 3 * i) for i in range(SEGMENTS)), F.lit(0).cast("long"))
    at = named.select("*", own.alias("own"))
    points = [F.col("own"), *[F.when(F.col(f"n{i}") > 0, F.col("own") - 2 ** (3 * i)) for i in range(SEGMENTS)], *[F.when(F.col(f"n{i}") < WIDTH, F.col("own") + 2 ** (3 * i)) for i in range(SEGMENTS)]]
    return at.select("p", F.posexplode(F.array(*points)).alias("k", "cell")).where("cell is not null")


def links(prints: DataFrame) -> DataFrame:
    """Distinct prints (p: long) -> links (a, b) that join all prints at 2 or fewer differing bits.

    The counts of bits in 16 segments embed a print in a grid; the Manhattan distance of two points
    is at most the number of differing bits. So only prints that meet at a grid point within one
    step of both can be close. A point where two meet gives one candidate pair, which is verified. Where more
    meet, each print is refined to the 64-bit values one flip away that have the counts of that
    point: those that share a value differ in 2 bits at most, there are 65 of them at most, and a
    star over them connects them, so that no group emits all its pairs.
    """
    cells = _cells(prints)
    met = written(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("a"), F.max("p").alias("b")).where("n > 1"), "cells")
    pairs = met.where("n = 2").select("a", "b")
    crowd = cells.join(met.where("n > 2").select("cell"), "cell")
    segment = F.pmod(F.col("k") - 1, F.lit(SEGMENTS))
    bits = [F.expr(f"shiftleft(1L, cast({WIDTH} * segment + {i} as int))") for i in range(WIDTH)]
    wanted = F.when(F.col("k") <= SEGMENTS, F.col("p")).otherwise(F.bitwise_not("p"))
    flips = F.array(*[F.when(wanted.bitwiseAND(b) != 0, F.col("p").bitwiseXOR(b)) for b in bits])
    near = crowd.withColumn("segment", segment).select("p", F.explode(F.when(F.col("k") == 0, F.array("p")).otherwise(flips)).alias("value")).where("value is not null")
    stars = near.groupBy("value").agg(F.collect_set("p").alias("ps")).where(F.size("ps") > 1)  # 65 at most, see above
    stars = stars.select(F.array_min("ps").alias("a"), F.explode("ps").alias("b")).where("a <> b")
    return pairs.unionByName(stars).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).distinct()


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs -> (i, p, component, component_id), a row for each row; component is a fingerprint that names the component.

    Equal fingerprints are taken together first, so a large group of copies is one row in the search, and rows of a frequent one
    get their component where they are.
    """
    hashed = F.pandas_udf(fingerprints, "long")
    rows = written(small_batches(docs).select(F.col(f"`{id_col}`").alias("i"), hashed(F.col(f"`{text_col}`")).alias("p")), "prints")
    prints = written(rows.groupBy("p").agg(F.min("i").alias("low"), F.count(F.lit(1)).alias("rows")), "prints")
    linked = written(prints.join(components(links(prints.select("p"))).withColumnRenamed("node", "p"), "p").select("p", "root", "low"), "linked")
    least = written(linked.groupBy("root").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("rows")), "least")
    own = joined(linked.drop("low"), least, "root")
    named = prints.join(own, "p", "left").select("p", F.coalesce("root", "p").alias("component"), F.coalesce("least", "low").alias("component_id"), "rows")
    return joined(rows, written(named, "named"), "p").select("i", "p", "component", "component_id")


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (id_col, fingerprint, component_id), a row for each row.

    Fingerprints: 3-word shingles of the A-Z-lower-cased words (white space of ASCII), repeats
    included; XXH64, seed 42; a bit is set if it is in over half the hashes. Fingerprints link at
    2 or fewer differing bits; component_id is the smallest id reachable through links. Null or
    empty text has fingerprint zero, which links like any other. Null ids get their component's
    smallest id, null if it has none. Repeated rows have equal results; texts of any length are
    hashed CHUNK shingles at a time; an empty table gives no rows; columns of docs of any name do not matter.
    """
    found = _found(docs, id_col, text_col)
    return found.select(F.col("i").alias(id_col), F.lpad(F.lower(F.hex("p")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near copies: of each component the row with the smallest id stays.

    Rows that repeat an id are rows of their own: each is judged by its own text. Of rows with one id in one component those with the
    smallest fingerprint stay. Rows with a null id stay only in a component without ids. Columns of docs are kept as they are.
    """
    found = written(_found(docs, id_col, text_col), "found")
    heads = found.where("i <=> component_id").groupBy("component").agg(F.min("p").alias("head"))
    stays = F.col("i").eqNullSafe(F.col("component_id")) & F.col("p").eqNullSafe(F.col("head"))
    judged = written(found.join(heads, "component", "left").groupBy("i", "p").agg(F.bool_or(stays).alias("stays")), "judged")
    # An id goes where none of its rows stays. Ids of which only some stay are rare; their rows alone are hashed again.
    per = written(judged.groupBy("i").agg(F.bool_or("stays").alias("some"), F.bool_and("stays").alias("all")).where("not all"), "gone")
    ident, print_, head = (fresh(docs, x) for x in ("ident", "print", "head"))
    same = lambda name: F.col(f"`{id_col}`").eqNullSafe(F.col(name))
    rest = docs.join(per.select(F.col("i").alias(ident)), same(ident), "left_anti")
    mixed = per.where("some").select(F.col("i").alias(ident))
    own = judged.where("stays").select(F.col("i").alias(ident), F.col("p").alias(head))
    hashed = F.pandas_udf(fingerprints, "long")
    some = docs.join(mixed, same(ident), "left_semi").withColumn(print_, hashed(F.col(f"`{text_col}`")))
    return rest.unionByName(some.join(own, same(ident) & (F.col(print_) == F.col(head)), "left_semi").drop(print_))
