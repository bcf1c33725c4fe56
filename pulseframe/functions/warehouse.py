"""The declared warehouse types: how a value is fitted to them, and how it is written as text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECLARED = re.compile(r"([A-Z ]+?)(?:\((\d+)(?:,\s*(\d+))?\))?$")
MOST_TEXT = 65_535


def spark_type(declared: str) -> T.DataType:
    kind = _DECLARED.match(declared.upper())[1]
    simple = {"TIMESTAMP": T.TimestampType(), "DATE": T.DateType(), "SMALLINT": T.ShortType(), "INTEGER": T.IntegerType(), "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType()}
    if kind in ("DOUBLE PRECISION", "REAL", "DECIMAL"):
        return T.DoubleType()
    return simple.get(kind, T.StringType())


def fitted(value: Column, declared: str) -> Column:
    """A value as its declared type: what does not fit is null, texts are cut."""
    m = _DECLARED.match(declared.upper())
    kind, size = m[1], int(m[2]) if m[2] else MOST_TEXT
    if kind == "TIMESTAMP":
        t = value.try_cast("timestamp")
        return F.when(t.between(F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(4294967296))), t)
    if kind in ("SMALLINT", "INTEGER"):
        most = 32_767 if kind == "SMALLINT" else 2_147_483_647
        v = value.try_cast("double")
        return F.when(F.abs(v) <= most, F.floor(v)).cast("short" if kind == "SMALLINT" else "int")
    if kind == "BIGINT":
        return F.floor(value.try_cast("decimal(38,6)")).try_cast("long")
    if kind == "CHAR":
        return F.left(F.regexp_replace(value.cast("string"), "[^ -~]", "?"), F.lit(size))
    if kind == "VARCHAR":
        return F.left(F.split_part(value.cast("string"), F.lit("\0"), F.lit(1)), F.lit(size))
    return value.try_cast(spark_type(declared))


def text(value: Column, declared: str, *, null: str = "") -> Column:
    """A fitted value as it stands in a delimited file."""
    kind = _DECLARED.match(declared.upper())[1]
    if kind == "TIMESTAMP":
        out = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif kind == "BOOLEAN":
        out = F.when(value, "TRUE").when(~value, "FALSE")
    elif kind in ("DOUBLE PRECISION", "REAL", "DECIMAL"):
        out = F.when(F.isnan(value), "NaN").otherwise(value.cast("string"))
    else:
        out = value.cast("string")
    return F.coalesce(out, F.lit(null))


def escaped(value: Column, delimiter: str) -> Column:
    """Backslashes, delimiters and line breaks with a backslash before them (tab-separated: by letter)."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    if delimiter == "\t":
        for c, letter in (("\t", "t"), ("\r", "r"), ("\n", "n")):
            out = F.replace(out, F.lit(c), F.lit("\\" + letter))
        return out
    for c in (delimiter, "\r", "\n"):
        out = F.replace(out, F.lit(c), F.lit("\\" + c))
    return out
