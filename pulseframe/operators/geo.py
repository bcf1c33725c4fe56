"""Addresses of both families to places, by the longest prefix among ranges that may be nested."""

from __future__ import annotations

import ipaddress
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prefixes that are broadcast at most, of some 100 bytes each; with more, addresses are shuffled to them.
MOST_BROADCAST = 200_000
#: Prefixes may be so many times the ranges' blocks, so that there are few lengths to look up.
MOST_EXPANSION = 4
#: An address in more than such a part of all rows is hot; there are fewer of them than this.
MOST_HOT = 1_000
#: Addresses are numbers of 128 bits; those of the fourth version stand where the sixth maps them.
BITS, MAPPED = 128, 0xFFFF << 32


def address(ip: Column) -> Column:
    """A dotted address, or one with colons, as 32 hexadecimal digits, in whose order addresses are; null where it is neither."""
    text = F.lower(F.trim(ip))
    octets = F.split(F.regexp_extract(text, r"((?:\d{1,3}\.){3}\d{1,3})$", 1), r"\.")
    octet = lambda k: F.get(octets, F.lit(k)).try_cast("int")
    small = F.coalesce(F.greatest(*[octet(k) for k in range(4)]) <= 255, F.lit(False))
    two = lambda k: F.lpad(F.lower(F.hex(octet(k) * 256 + octet(k + 1))), 4, "0")
    dotted, tail = text.rlike(r"^(\d{1,3}\.){3}\d{1,3}$"), text.rlike(r":(\d{1,3}\.){3}\d{1,3}$")
    groups = F.when(tail & small, F.concat(F.regexp_replace(text, r"(\d{1,3}\.){3}\d{1,3}$", ""), two(0), F.lit(":"), two(2))).otherwise(text)
    halves = F.split(groups, "::", -1)
    half = lambda k: F.transform(F.filter(F.split(F.coalesce(F.get(halves, F.lit(k)), F.lit("")), ":", -1), lambda x: x != ""), lambda x: F.lpad(x, 4, "0"))
    left, right = half(0), half(1)
    missing = 8 - F.size(left) - F.size(right)
    whole = groups.rlike(r"^[0-9a-f:]*:[0-9a-f:]*$") & ~groups.rlike(r":::|^:[^:]|[^:]:$|[0-9a-f]{5}") & F.when(F.size(halves) == 2, missing >= 1).otherwise((F.size(halves) == 1) & (missing == 0))
    long = F.concat(F.array_join(left, ""), F.repeat(F.lit("0000"), F.greatest(missing, F.lit(0))), F.array_join(right, ""))
    return F.when(dotted & small, F.concat(F.lit("0" * 20 + "ffff"), two(0), two(2))).when(whole, long)


def prefix(digits: Column, length: int) -> Column:
    """The first length bits of an address, as the digits that hold them."""
    whole, rest = divmod(length, 4)
    if not rest:
        return F.left(digits, F.lit(whole))
    mask = 15 << (4 - rest) & 15
    return F.concat(F.left(digits, F.lit(whole)), F.translate(F.substring(digits, whole + 1, 1), "0123456789abcdef", "".join(f"{k & mask:x}" for k in range(16))))


def _number(value: object) -> int | None:
    if value is None or isinstance(value, float) and value != value:
        return None
    try:
        at = ipaddress.ip_address(value.strip() if isinstance(value, str) else int(value))  # type: ignore[arg-type]
    except ValueError:
        return None
    return int(at) | MAPPED if at.version == 4 else int(at)


def blocks_of(first: int, last: int) -> Iterator[tuple[int, int]]:
    """The fewest aligned blocks (begin, length of their prefix) that make up a range."""
    while first <= last:
        bits = min((first & -first).bit_length() - 1 if first else BITS, (last - first + 1).bit_length() - 1)
        yield first, BITS - bits
        first += 1 << bits


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for first, last, country, city in batch[["first", "last", "country", "city"]].itertuples(index=False, name=None):
            a, b = _number(first), _number(last)
            if a is not None and b is not None:
                rows += [(length, f"{begin:032x}", f"{b - a:032x}", country, city) for begin, length in blocks_of(a, b)]
        yield pd.DataFrame(rows, columns=["length", "begin", "span", "country", "city"])


def levels_of(counts: dict[int, int], most: int = MOST_EXPANSION) -> list[int]:
    """The fewest prefix lengths to which blocks can be split without becoming more than most times their number. counts: blocks by
    length. A block goes to the next length that is not shorter than its own; the best choice of each number of lengths is found by
    dynamic programming."""
    lengths, total = sorted(counts), sum(counts.values())
    cost = lambda a, b: sum(counts[x] << (lengths[b] - x) for x in lengths[a : b + 1])
    best = [(cost(0, b), [lengths[b]]) for b in range(len(lengths))]
    while best and best[-1][0] > most * total:
        best = [min([best[b], *[(best[a][0] + cost(a + 1, b), [*best[a][1], lengths[b]]) for a in range(b)]], key=lambda x: x[0]) for b in range(len(lengths))]
    return best[-1][1] if best else []


def _prefixes(blocks: DataFrame, levels: list[int]) -> DataFrame:
    """(level, key, place): one place for each prefix, that of the longest block; of equal blocks that of the smallest range."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for length, begin, *rest in batch.itertuples(index=False, name=None):
                level = next(x for x in levels if x >= length)
                base = int(begin, 16)
                rows += [(level, f"{base + (k << (BITS - level)):032x}"[: -(-level // 4)], length, *rest) for k in range(1 << (level - length))]
            yield pd.DataFrame(rows, columns=["level", "key", "length", "span", "country", "city"])

    keyed = blocks.mapInPandas(split, "level int, key string, length int, span string, country string, city string")
    return keyed.groupBy("level", "key").agg(F.min_by(F.struct("country", "city"), F.struct(-F.col("length"), F.col("span"), F.col("country"), F.col("city"))).alias("place"))


def _by_broadcast(asked: DataFrame, prefixes: DataFrame, levels: list[int], at: str, out: str) -> DataFrame:
    """A lookup for each length, longest first, in tables that tasks hold: no row is shuffled."""
    own = asked.columns
    for level in reversed(levels):
        table = F.broadcast(prefixes.where(F.col("level") == level).select(F.col("key").alias("_key"), F.col("place").alias(f"_{level}")))
        asked = asked.join(table, prefix(F.col(at), level) == F.col("_key"), "left").drop("_key")
    places = [F.col(f"_{level}") for level in reversed(levels)]
    return asked.select(*[F.col(f"`{c}`") for c in own], (F.coalesce(*places) if places else F.lit(None).cast("struct<country:string,city:string>")).alias(out))


def _by_shuffle(asked: DataFrame, prefixes: DataFrame, levels: list[int], at: str, out: str) -> DataFrame:
    """Each address is looked up once, with all its prefixes at once. Rows with a hot address get its place by broadcast."""
    seen = asked.where(F.col(at).isNotNull()).groupBy(F.col(at).alias("_at")).agg(F.count(F.lit(1)).alias("_rows"))
    keys = F.array(*[F.struct(F.lit(level).alias("level"), prefix(F.col("_at"), level).alias("key")) for level in levels])
    met = seen.select("_at", "_rows", F.inline(keys)).join(prefixes, ["level", "key"], "left")
    found = met.groupBy("_at", "_rows").agg(F.max_by("place", F.when(F.col("place").isNotNull(), F.col("level"))).alias(out)).persist()
    every = found.agg(F.sum("_rows")).first()[0] or 0
    large = F.col("_rows") * MOST_HOT > every
    hot, rest = F.broadcast(found.where(large).drop("_rows")), found.where(~large).drop("_rows")
    same = F.col(at) == F.col("_at")
    return asked.join(hot, same).unionByName(asked.join(hot.select("_at"), same, "left_anti").join(rest, same, "left")).drop("_at")


def locate_first(df: DataFrame, ranges: DataFrame, ips: list[str], *, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Adds country and city: of each the first that is known for one of the addresses in the columns ips, in their order; `??` where none is.

    ranges: first and last (addresses as texts of one family, or numbers of the fourth version), country, city. Ranges may be nested, and of
    those that hold an address the most specific one counts: ranges are cut into aligned blocks, the longest block that holds an address wins,
    and of equal blocks that of the smallest range. Blocks are split to a few prefix lengths that follow from their density (levels_of), each of which
    is one equality join: by broadcast of up to most_broadcast prefixes, without a shuffle of df; beyond that, distinct addresses are
    shuffled. Ranges without a valid first or last, or with last before first, are void; addresses that are null or none have no place; repeated
    rows stay; without ranges all is `??`. Columns of df named country or city are replaced.
    """
    blocks = ranges.select("first", "last", F.col("country").cast("string"), F.col("city").cast("string")).mapInPandas(_cut, "length int, begin string, span string, country string, city string").persist()
    levels = levels_of({r["length"]: r["count"] for r in blocks.groupBy("length").count().collect()})  # 129 lengths at most
    prefixes = _prefixes(blocks, levels).persist() if levels else None
    small = prefixes is None or prefixes.count() <= most_broadcast
    own = df.drop("country", "city")
    asked = own.select("*", *[address(F.col(f"`{c}`")).alias(f"_at{k}") for k, c in enumerate(ips)])
    for k in range(len(ips)):
        asked = (_by_broadcast if small else _by_shuffle)(asked, prefixes, levels, f"_at{k}", f"_place{k}")
    first = lambda field: F.coalesce(*[F.col(f"_place{k}.{field}") for k in range(len(ips))], F.lit("??")).alias(field)
    return asked.select(*[F.col(f"`{c}`") for c in own.columns], first("country"), first("city"))


def locate(df: DataFrame, ranges: DataFrame, ip: str = "ip", *, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Adds country and city of the address in column ip, see locate_first."""
    return locate_first(df, ranges, [ip], most_broadcast=most_broadcast)
