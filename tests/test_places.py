"""Addresses of both families in nested ranges, against the standard library and brute force."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import decode, geo

ADDRESSES = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "", None, "::", "::1", "1::", "2001:db8::8a2e:370:7334", "2001:0DB8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::2::3", ":::", ":1", "1:", "12345::", "g::", "::ffff:10.0.0.1", "64:ff9b::300.2.33.1", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.4", "1.2.3.4:", "fe80::1%eth0", "a", ":", "1:2:3:4:5:6:7:8:9"]


def number(text):
    if text and "%" in text:
        return None  # a scope is no part of an address
    try:
        at = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(at) | 0xFFFF << 32 if at.version == 4 else int(at)


def test_addresses(spark):
    got = {r.ip: r.at for r in spark.createDataFrame([(x,) for x in ADDRESSES], "ip string").select("ip", geo.address(F.col("ip")).alias("at")).collect()}
    for text in ADDRESSES:
        n = number(text)
        assert got[text] == (None if n is None else f"{n:032x}"), text


def test_prefixes(spark):
    rng = random.Random(1)
    numbers = [rng.getrandbits(128) for _ in range(5)]
    df = spark.createDataFrame([(f"{n:032x}",) for n in numbers], "d string")
    for length in (0, 1, 2, 3, 4, 7, 63, 64, 127, 128):
        got = {r.d: r.p for r in df.select("d", geo.prefix(F.col("d"), length).alias("p")).collect()}
        for n in numbers:
            masked = n >> (128 - length) << (128 - length)
            assert got[f"{n:032x}"] == f"{masked:032x}"[: -(-length // 4)]


def test_blocks_are_the_ranges():
    rng = random.Random(2)
    for _ in range(200):
        a = rng.randrange(5000)
        b = a + rng.randrange(-1, 400)
        blocks = list(geo.blocks_of(a, b))
        assert [x for begin, length in blocks for x in range(begin, begin + (1 << (128 - length)))] == list(range(a, b + 1))
        assert all(begin % (1 << (128 - length)) == 0 for begin, length in blocks)


def test_levels():
    assert geo.levels_of({}) == [] and geo.levels_of({24: 7}) == [24]
    assert geo.levels_of({24: 100, 23: 10, 22: 3}) == [24]  # 132 prefixes of one length
    assert geo.levels_of({8: 100, 128: 1}) == [8, 128]
    rng = random.Random(3)
    for _ in range(20):
        counts = {rng.randrange(129): rng.randrange(1, 1000) for _ in range(12)}
        levels = geo.levels_of(counts)
        assert levels[-1] == max(counts) and sum(n << (next(x for x in levels if x >= k) - k) for k, n in counts.items()) <= 4 * sum(counts.values())


def random_ranges(rng):
    """Nested in each other, some with the same begin or end, two equal ones, one of all addresses, and void ones."""
    text = lambda n, six: str(ipaddress.IPv6Address(0x20010DB8 << 96 | n)) if six else str(ipaddress.IPv4Address(0x0A000000 + n))
    rows, k = [("::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "all", None), ("10.0.0.9", "10.0.0.1", "void", "v"), ("x", "10.0.0.1", "void", "v"), (None, None, "void", "v")], 0
    for six in (False, True):
        todo = [(0, 60_000)]
        while todo:
            a, b = todo.pop()
            k += 1
            rows.append((text(a, six), text(b, six), f"n{k}", None if k % 4 == 0 else f"c{k}"))
            if b - a > 40 and k < 120:
                x, y = sorted(rng.sample(range(a, b + 1), 2))
                todo += [(x, y)] if y - x < (b - a) * 0.9 else [(a, x)]
                if y + 3 < b:
                    todo.append((y + 1, b))
    return rows


@pytest.mark.parametrize(("seed", "most"), [(1, 10**6), (2, 10**6), (1, 0)])  # the last: nothing is broadcast
def test_nested_ranges(spark, seed, most):
    rng = random.Random(seed)
    ranges = random_ranges(rng)
    asked = [str(ipaddress.IPv4Address(0x0A000000 + rng.randrange(70_000))) for _ in range(300)] + [str(ipaddress.IPv6Address(0x20010DB8 << 96 | rng.randrange(70_000))) for _ in range(300)] + ["10.0.0.7"] * 900 + [None, "", "nowhere", "2001:db8::1", "::"]
    df = spark.createDataFrame([(k, ip, "old") for k, ip in enumerate(asked)], "k long, ip string, city string")
    got = {r.k: (r.country, r.city) for r in geo.locate(df, spark.createDataFrame(ranges, "first string, last string, country string, city string"), most_broadcast=most).collect()}
    assert len(got) == len(asked)
    known = [(number(a), number(b), c, t) for a, b, c, t in ranges if a and number(a) is not None]
    for k, ip in enumerate(asked):
        n = number(ip) if ip else None
        held = [x for x in known if n is not None and x[0] <= n <= x[1]]
        best = min(held, key=lambda x: x[1] - x[0], default=(0, 0, None, None))
        assert got[k] == (best[2] or "??", best[3] or "??"), ip


def test_no_ranges(spark):
    df = spark.createDataFrame([("1.1.1.1",), (None,)], "ip string")
    none = spark.createDataFrame([], "first long, last long, country string, city string")
    assert [(r.country, r.city) for r in geo.locate(df, none).collect()] == [("??", "??")] * 2
    assert geo.locate(df.limit(0), none).count() == 0


def test_small_ranges_shuffle_no_row(spark):
    ranges = spark.createDataFrame([("10.0.0.0", "10.255.255.255", "A", "a"), ("10.1.0.0", "10.1.0.255", "B", "b")], "first string, last string, country string, city string")
    plan = geo.locate(spark.range(10).select(F.concat(F.lit("10.1.0."), "id").alias("ip")), ranges)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_place_falls_back_field_by_field(spark):
    """Each field of the first forwarded address, or else of the remote one."""
    rows = [("192.168.1.5, 9.9.9.9", "9.9.9.9"), ("10.0.0.3", "9.9.9.9"), ("10.0.0.9, 10.0.0.3", "9.9.9.9"), (None, "9.9.9.9"), (", ", "10.0.0.3"), ("10.0.0.9", None), ("8.8.8.8", "7.7.7.7"), (None, None), ("2001:db8::5", "9.9.9.9")]
    raw = spark.createDataFrame([(f"/submit/telemetry/{k}", "{}", a, b) for k, (a, b) in enumerate(rows)], "path string, payload string, forwarded_for string, remote_addr string").withColumn("ts", F.timestamp_seconds(F.lit(0)))
    names = spark.createDataFrame([("telemetry", 99, 99, ["a"])], "namespace string, max_data_length int, max_path_length int, dims array<string>")
    ranges = spark.createDataFrame([("10.0.0.0", "10.0.0.7", "AA", "a"), ("10.0.0.8", "10.0.0.15", "AC", None), ("9.9.9.0", "9.9.9.255", "BB", "b"), ("2001:db8::", "2001:db8::ff", "SX", "six")], "first string, last string, country string, city string")
    landfill, _, _ = decode.route_submissions(raw, names, ranges)
    got = {r.path[-1]: (r.geo_country, r.geo_city) for r in landfill.collect()}
    assert got == {"0": ("BB", "b"), "1": ("AA", "a"), "2": ("AC", "b"), "3": ("BB", "b"), "4": ("AA", "a"), "5": ("AC", "??"), "6": ("??", "??"), "7": ("??", "??"), "8": ("SX", "six")}
    assert not {"ip", "remote_addr", "forwarded_for"} & set(landfill.columns)
