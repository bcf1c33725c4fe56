"""Column expressions that normalise raw submission fields. All are built-in functions."""

from __future__ import annotations

import zoneinfo
from collections.abc import Iterable
from functools import cache
from importlib import resources
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER = "Other"
DAY_S = 86_400
#: Longer subsessions than this are not believed.
MOST_USAGE_S = 180 * DAY_S
#: Stability reports clamp a session to this.
MOST_SESSION_S = 25 * 3600

# The dimension names, in the order of their ids.
CHANNELS = ("Other", "release", "beta", "nightly", "aurora")
SYSTEMS = ("Other", "Windows", "Mac", "Linux")
WINDOWS = ("Other", "Windows 10", "Windows 8", "Windows 7")
# The countries that reports name.
TOP_COUNTRIES = ("US", "CA", "BR", "MX", "FR", "ES", "IT", "PL", "TR", "RU", "DE", "IN", "ID", "CN", "JP", "GB")
# Android's code names by API level.
ANDROID = {8: "Froyo", 9: "Gingerbread", 10: "Gingerbread", 11: "Honeycomb", 12: "Honeycomb", 13: "Honeycomb", 14: "ICS", 15: "ICS", 16: "JellyBean", 17: "JellyBean", 18: "JellyBean", 19: "KitKat", 20: "KitKat Watch", 21: "Lollipop", 22: "Lollipop", 23: "Marshmallow"}
#: Substrings by which a search key counts for an engine; any other key counts for the last.
ENGINES = ("google", "bing", "yahoo", "other")


@cache
def iso_countries() -> tuple[str, ...]:
    """The two-letter country codes of ISO 3166-1, as the time zone database lists them."""
    places = [Path(p) / "iso3166.tab" for p in zoneinfo.TZPATH] + [resources.files("tzdata") / "zoneinfo" / "iso3166.tab"]
    table = next(p for p in places if p.is_file())
    return tuple(sorted(line[:2] for line in table.read_text(encoding="utf-8").splitlines() if line and line[0] != "#"))


def norm_channel(c: Column) -> Column:
    """release; a prefix beta; nightly or a prefix nightly-cck-; aurora; Other for all else, null included."""
    return F.when(c == "release", "release").when(c.startswith("beta"), "beta").when((c == "nightly") | c.startswith("nightly-cck-"), "nightly").when(c == "aurora", "aurora").otherwise(OTHER)


def norm_os(c: Column) -> Column:
    return F.when(c.startswith("Windows") | c.startswith("WINNT"), "Windows").when(c.startswith("Darwin"), "Mac").when(c.rlike("Linux|BSD|SunOS"), "Linux").otherwise(OTHER)


def norm_country(c: Column, codes: Iterable[str]) -> Column:
    """The code in upper case if it is one of codes (see iso_countries), else Other."""
    up = F.upper(c)
    return F.when(up.isin(list(codes)), up).otherwise(OTHER)


def win_version_bucket(c: Column) -> Column:
    v = c.try_cast("double")
    return F.when((v >= 10) & (v < 11), "Windows 10").when(v.isin(6.2, 6.3), "Windows 8").when(v == 6.1, "Windows 7").otherwise(OTHER)


def dimension_id(name: Column, names: Iterable[str]) -> Column:
    """The place of a name, 0 (Other) for names that are not there."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), name)
    return F.coalesce(F.greatest(place - 1, F.lit(0)), F.lit(0)).cast("int")


def dimension_name(ident: Column, names: Iterable[str]) -> Column:
    array = F.array(*[F.lit(n) for n in names])
    return F.coalesce(F.when(ident >= 0, F.get(array, ident.cast("int"))), F.lit(OTHER))


def activity_ts(text: Column, creation: Column) -> Column:
    """An RFC 3339 text, else a date, else the creation time."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")), creation)


def usage_hours(seconds: Column, least: int = 0) -> Column:
    return F.when((seconds >= least) & (seconds < MOST_USAGE_S), seconds / 3600).otherwise(0.0)


def search_counts(searches: Column) -> dict[str, Column]:
    """A map of search key -> struct(sum) to the sums by engine, by the first match in ENGINES' order."""

    def engine(key: Column) -> Column:
        low, out = F.lower(key), F.lit(ENGINES[-1])
        for name in reversed(ENGINES[:-1]):
            out = F.when(low.contains(name), name).otherwise(out)
        return out

    def total(name: str) -> Column:
        own = F.map_values(F.map_filter(searches, lambda k, v: (engine(k) == name) & (v["sum"] > 0)))
        return F.coalesce(F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x["sum"]), F.lit(0).cast("long"))

    return {name: total(name) for name in ENGINES}


def khist_sum(histograms: Column, section: str, key: str) -> Column:
    """The positive sum of a keyed histogram, else null."""
    value = F.try_element_at(F.try_element_at(histograms, F.lit(section)), F.lit(key))["sum"]
    return F.when(value > 0, value)


def flash_version(plugins: Column) -> Column:
    """The greatest four-part version among plugins (name, version) called Shockwave Flash, by components."""
    own = F.filter(plugins, lambda p: (p["name"] == "Shockwave Flash") & p["version"].rlike(r"^\d+\.\d+\.\d+\.\d+$"))
    parts = F.transform(own, lambda p: F.transform(F.split(p["version"], r"\."), lambda x: x.cast("int")))
    return F.array_join(F.array_max(parts).cast("array<string>"), ".")


def num_active_addons(addons: Column) -> Column:
    return F.when(addons.isNull(), 0).otherwise(F.size(addons))


def profile_creation_ts(days: Column) -> Column:
    """Days since the epoch as a timestamp, the epoch itself where they are not positive."""
    return F.timestamp_seconds(F.when(days > 0, days.cast("long") * DAY_S).otherwise(0))


def sample_id(client: Column) -> Column:
    return (F.crc32(client.cast("binary")) % 100).cast("int")


def sampled(key: Column, fraction: float, seed: str = "") -> Column:
    """Whether a key is in a sample of that share of keys: whether its hash, with the seed before it, is under the share of all hashes. The same
    keys in any table, however it is laid out; null keys are not."""
    return F.coalesce(F.conv(F.left(F.md5(F.concat(F.lit(seed), key).cast("binary")), F.lit(8)), 16, 10).cast("long") < int(fraction * 2**32), F.lit(False))


def build_date(build: Column) -> Column:
    """The first eight characters where they are digits, else null."""
    return F.nullif(F.regexp_extract(build, r"^(\d{8})", 1), F.lit(""))


def doc_type3(c: Column) -> Column:
    return F.when(c.isin("main", "saved-session"), c).otherwise("other")


def android_version(level: Column) -> Column:
    names = F.create_map(*[x for k, v in ANDROID.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(names, level.try_cast("int")), F.lit(OTHER))


def top_country(c: Column, names: Iterable[str] = TOP_COUNTRIES) -> Column:
    return F.when(c.isin(list(names)), c).otherwise(OTHER)


def clamp_session(seconds: Column) -> Column:
    """0 for less, 25 hours for more, null for null."""
    return F.when(seconds < 0, 0).when(seconds > MOST_SESSION_S, MOST_SESSION_S).otherwise(seconds)


def split_path(path: Column) -> Column:
    """The parts of a path; repeated, leading and trailing slashes make none."""
    return F.filter(F.split(path, "/"), lambda x: x != "")


def hex_to_long(text: Column) -> Column:
    return F.conv(F.regexp_replace(text, "^0[xX]", ""), 16, 10).try_cast("long")


def one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?|\n", "|")


def parsed_time(text: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")))


def flag(c: Column) -> Column:
    """A boolean, false where it is none."""
    return F.coalesce(c.try_cast("boolean"), F.lit(False))


def first_forwarded_ip(forwarded: Column, remote: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(forwarded, r"^[, ]*([^, ]+)", 1), F.lit("")), remote)


def ns_timestamp(ns: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp."""
    return F.timestamp_micros(F.floor(ns / 1000).cast("long"))


def sunday_week(day: Column) -> Column:
    """The Sunday on or before a day."""
    return F.date_sub(F.date_trunc("week", F.date_add(day, 1)).cast("date"), 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def last_complete_week(day: Column) -> Column:
    """The Sunday that began the last week which is over."""
    return F.date_sub(sunday_week(day), 7)


def last_complete_month(day: Column) -> Column:
    return F.add_months(month_start(day), -1)


def previous_wednesday(day: Column) -> Column:
    """The Wednesday on or before a day."""
    return F.next_day(F.date_sub(day, 7), "WED")


def day_number(text: Column) -> Column:
    """Days since the epoch of a yyyymmdd text, null if it is none."""
    return F.unix_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def fixed(x: Column, digits: int) -> Column:
    """A double with so many digits as C's printf writes it: the double itself rounded, half to even. Java's format rounds the shortest decimal
    that names the double, and half up.

    The part behind the point is split at its 26th binary digit, so that all products are exact.
    """
    scale, split = 10**digits, float(1 << 26)
    size = F.abs(x)
    part = size - F.floor(size)
    high = F.floor(part * split) / split
    low, whole = (part - high) * scale, F.floor(high * scale)
    half = 0.5 - (high * scale - whole)
    up = (low > half) | ((low == half) & (whole % 2 == 1))
    n = whole + F.when(up, 1).otherwise(0)  # scale, where all digits are nines
    text = F.concat(F.when(x < 0, "-").otherwise(""), (F.floor(size) + F.floor(n / scale)).cast("string"), F.lit("."), F.lpad((n % scale).cast("string"), digits, "0"))
    return F.when(size < float(1 << 53), text).otherwise(F.format_string(f"%.{digits}f", x))


def percent(actual: Column, expected: Column) -> Column:
    return F.concat(fixed(100.0 * actual / expected, 1), F.lit("%"))


def gigabytes(n: Column) -> Column:
    return F.concat(fixed(n / float(1 << 30), 2), F.lit("GB"))


def pretty_size(n: Column) -> Column:
    """Bytes as a short text, in units of 1024."""
    size = lambda bits, unit: F.concat(fixed(n / float(1 << bits), 2), F.lit(unit))
    out = size(40, "TB")
    for bits, unit in ((30, "GB"), (20, "MB"), (10, "KB")):
        out = F.when(n < float(1 << (bits + 10)), size(bits, unit)).otherwise(out)
    return F.when(n < 1024, F.format_string("%sB", n.cast("string"))).otherwise(out)
