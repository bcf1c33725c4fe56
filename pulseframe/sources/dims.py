"""Dimension specifications: which values each partition dimension may have."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN, OTHER = "UNKNOWN", "OTHER"
#: Any value ("*"), one value, a list, or a range with min, max or both.
Allowed = "str | list[str] | dict[str, str]"


def parsed(spec: str | dict) -> list[tuple[str, Allowed]]:
    """The dimensions in order, of a specification as JSON text or as a dictionary."""
    spec = json.loads(spec) if isinstance(spec, str) else spec
    out = []
    for d in spec["dimensions"]:
        allowed = d["allowed_values"]
        if not isinstance(d["field_name"], str) or not isinstance(allowed, (str, list, dict)) or isinstance(allowed, dict) and not set(allowed) & {"min", "max"}:
            raise ValueError(f"not a dimension: {d}")
        out.append((d["field_name"], allowed))
    return out


def matches(value: Column, allowed: Allowed) -> Column:
    """Whether a value is allowed. Ranges include their ends and compare as text."""
    if isinstance(allowed, str):
        return F.lit(True) if allowed == "*" else value == allowed
    if isinstance(allowed, list):
        return value.isin(allowed)
    tests = [value >= allowed["min"]] if "min" in allowed else []
    tests += [value <= allowed["max"]] if "max" in allowed else []
    return reduce(Column.__and__, tests)


def predicate(dims: Iterable[tuple[str, Allowed]]) -> Column:
    """All dimensions allowed: a filter on partition columns, by which files are left out."""
    return reduce(Column.__and__, [matches(F.col(f"`{n}`"), a) for n, a in dims if a != "*"], F.lit(True))


def sanitised(value: Column) -> Column:
    return F.regexp_replace(value, "[^a-zA-Z0-9_.]", "_")


def dimension(value: Column, allowed: Allowed) -> Column:
    """A value as its partition's name: UNKNOWN where missing or empty, OTHER where not allowed."""
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), UNKNOWN).when(matches(text, allowed), sanitised(text)).otherwise(OTHER)
