"""User code in the plan: row transforms and aggregates that no expression states."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def transform_rows(df: DataFrame, fn: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """One row in, any number out, in batches of a task's own rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([out for row in batch.to_dict("records") for out in fn(row)])

    names = [c.strip().split()[0] for c in schema.split(",")]
    return df.mapInPandas(lambda batches: (b.reindex(columns=names) for b in run(batches)), schema)


def aggregate_rows(df: DataFrame, keys: list[str], zero: Callable[[], dict], seq: Callable[[dict, dict], dict], comb: Callable[[dict, dict], dict], finish: Callable[[tuple, dict], dict], state_schema: str, schema: str) -> DataFrame:
    """An aggregate of user code (zero, seq, comb, finish): states are made within each task first, so that what is shuffled
    is a state for each task and key, and no group's rows come together."""
    states = [c.strip().split()[0] for c in state_schema.split(",")]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[tuple, dict] = {}
        for batch in batches:
            for row in batch.to_dict("records"):
                key = tuple(row[k] for k in keys)
                own[key] = seq(own.get(key) or zero(), row)
        yield pd.DataFrame([dict(zip(keys, k, strict=True)) | s for k, s in own.items()], columns=[*keys, *states])

    def final(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = zero()
        for row in rows[states].to_dict("records"):
            total = comb(total, row)
        return pd.DataFrame([finish(key, total)])

    types = dict(df.dtypes)
    parts = df.mapInPandas(partial, ", ".join(f"{k} {types[k]}" for k in keys) + ", " + state_schema)
    return parts.groupBy(*keys).applyInPandas(final, schema)
