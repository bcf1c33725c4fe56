"""User state with timers: rows in order of event time, and aggregates that are emitted when their time is over.

Each function takes a streaming DataFrame with a column `ts` and returns one, for a query in append mode (`update` for last_seen) that is started within
state_store().
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Alerts of one source are so many seconds apart at least.
THROTTLE_S = 3600
#: Clients idle for so many days are forgotten.
TTL_DAYS = 42
#: Keys whose rows are put in order share so many states.
GROUPS = 1024
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession):
    """Queries that are started within keep their state in RocksDB, which list and map state and timers need. A query copies the setting
    as it starts, so the session has its own again afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


Step = Callable[[tuple, Any, tuple], tuple[Any, list[tuple]]]


def _plain(row: tuple) -> tuple:
    """Values as state keeps them."""
    return tuple(None if x is None or x is pd.NA or x != x else x.item() if hasattr(x, "item") else x for x in row)


def _order(row: tuple) -> tuple:
    """By the values in turn, nulls last."""
    return tuple((x is None, 0 if x is None else x) for x in row)


def _values(part: pd.DataFrame, names: list[str]) -> list[tuple]:
    rows = zip(*[part[c].tolist() for c in names], strict=True)
    return [_plain(r) for r in rows] if part[names].isna().any(axis=None) else list(rows)


def _stepped(names: list[str], columns: list[str], step: Step, slice_us: int, idle_us: int):
    """Rows of a group of keys (names, the key last) wait in the group's state; those that the watermark has passed, to the end of their slice, are
    taken, in order, through step. The state (rows that wait, by key the newest time and what step keeps) comes and goes once for each
    group and micro-batch, and by a timeout where none of the group's rows comes."""

    def run(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, kept = pickle.loads(state.get[0]) if state.exists else ([], {})
        for part in parts:
            waiting += _values(part, names)
        now = max(0, state.getCurrentWatermarkMs()) * 1000 // slice_us * slice_us
        due, rest, out = [r for r in waiting if r[0] < now], [r for r in waiting if r[0] >= now], []
        try:
            due.sort()
        except TypeError:
            due.sort(key=_order)  # some are null
        for *row, key in due:
            newest, own = kept.get(key, (row[0], None))
            if row[0] >= newest + idle_us:
                own = None  # idle for that long before it came back
            own, more = step((key,), own, tuple(row))
            out += more
            kept[key] = (row[0], own)
        # Keys are forgotten a slice's end after their time; one that has rows waiting is judged with them.
        kept = {k: v for k, v in kept.items() if v[0] + idle_us > now}
        if rest or kept:
            wake = min(r[0] for r in rest) if rest else min(v[0] for v in kept.values()) + idle_us - 1
            state.update((pickle.dumps((rest, kept)),))
            state.setTimeoutTimestamp((wake // slice_us + 1) * slice_us // 1000 - 1)  # the watermark has to be past it, not at it
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=columns)

    return run


def names_of(schema: str) -> list[str]:
    return [c.strip().split()[0] for c in schema.split(",")]


def in_order(df: DataFrame, key: str, columns: list[str], step: Step, *, schema: str, delay: str = "1 hour", slice_s: int = 60, idle_s: int, groups: int = GROUPS) -> DataFrame:
    """Takes each key's rows through step in order of event time, in whatever micro-batches they come.

    step gets (key, state, row) and gives (state, rows of the result): row is (micros, *columns), ordered by that, state is what it gave for the
    key's last row, None at first and after idle_s without a row, when a key is forgotten. A row waits until the watermark, delay behind
    the newest row of all, passes the end of its slice; rows later than that are dropped. Keys share a state by groups, so that calls and
    timeouts are as many as groups, however many keys there are. A task holds what one group, which is a key at least, has in a micro-batch and within the
    delay and a slice, and each key's state, never its history. A query's number of groups stays with its checkpoint. Rows with a null key or time take no part.
    """
    own = df.where(F.col(key).isNotNull() & F.col("ts").isNotNull()).withWatermark("ts", delay)
    own = own.select(F.pmod(F.xxhash64(key), F.lit(groups)).alias("_group"), "ts", F.unix_micros("ts").alias("us"), *columns, F.col(key).alias("_key"))
    run = _stepped(["us", *columns, "_key"], names_of(schema), step, slice_s * 1_000_000, idle_s * 1_000_000)
    return own.groupBy("_group").applyInPandasWithState(run, schema, "state binary", "append", GroupStateTimeout.EventTimeTimeout)


def channel_events(df: DataFrame, *, ttl_days: int = TTL_DAYS, delay: str = "1 hour") -> DataFrame:
    """Per client: new, in and out, as its channel is first seen and changes, in order of event time. A client idle for ttl_days is
    forgotten, and new when it comes back. Of rows with one time the smaller event_id is the first; a null channel takes no part."""

    def step(key: tuple, state: tuple | None, row: tuple) -> tuple[tuple, list[tuple]]:
        us, _, channel = row
        before = state[0] if state else None
        if before == channel:
            return state, []
        events = [(before, "out"), (channel, "in")] if state else [(channel, "new")]
        return (channel,), [(us, name, kind, key[0]) for name, kind in events]

    own = df.where("channel is not null")
    out = in_order(own, "client_id", ["event_id", "channel"], step, schema="us long, channel string, kind string, client_id string", delay=delay, idle_s=ttl_days * 86_400)
    return out.select(F.timestamp_micros("us").cast("date").alias("day"), "channel", "kind", "client_id")


def throttled(alerts: DataFrame, *, seconds: int = THROTTLE_S, delay: str = "1 hour") -> DataFrame:
    """Alerts (source, ts, event_id, alert): those that come seconds or more after the source's last one that passed, in order of event time."""

    def step(key: tuple, state: tuple | None, row: tuple) -> tuple[tuple, list[tuple]]:
        us, _, alert = row
        if state and us - state[0] < seconds * 1_000_000:
            return state, []
        return (us,), [(key[0], us, alert)]

    out = in_order(alerts, "source", ["event_id", "alert"], step, schema="source string, us long, alert string", delay=delay, idle_s=2 * seconds)
    return out.select("source", F.timestamp_micros("us").alias("ts"), "alert")


class _LastSeen(StatefulProcessor):
    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.newest = handle, handle.getValueState("newest", "us long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.newest.get()[0] if self.newest.exists() else None
        first, most = None, before
        for p in rows:
            low, high = int(p["us"].min()), int(p["us"].max())
            first, most = low if first is None else min(first, low), high if most is None else max(most, high)
        out = []
        if before is not None and first >= before + self.ttl_us:
            out.append((key[0], before, True))  # it came back in the micro-batch in which its timer expires
        if most != before:
            if before is not None:
                self.handle.deleteTimer(self._end(before))
            self.newest.update((most,))
            self.handle.registerTimer(self._end(most))
        yield pd.DataFrame([*out, (key[0], most, False)], columns=["client_id", "us", "forgotten"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        most = self.newest.get()[0]
        self.newest.clear()
        yield pd.DataFrame({"client_id": [key[0]], "us": [most], "forgotten": [True]})

    def _end(self, us: int) -> int:
        return -(-(us + self.ttl_us) // 1000)

    def close(self) -> None:
        pass


def last_seen(df: DataFrame, *, ttl_days: float = TTL_DAYS, delay: str = "1 hour") -> DataFrame:
    """Per client the newest time seen, with each micro-batch that has rows of it. A client idle for ttl_days of event time is forgotten by a timer, which
    is a row too (forgotten is true); one that comes back later starts anew. The state is a time, and batches are read in parts."""
    own = df.where("client_id is not null and ts is not null").withWatermark("ts", delay).select("client_id", "ts", F.unix_micros("ts").alias("us"))
    out = own.groupBy("client_id").transformWithStateInPandas(_LastSeen(int(ttl_days * 86_400_000_000)), "client_id string, us long, forgotten boolean", "Update", "EventTime")
    return out.select("client_id", F.timestamp_micros("us").alias("last_seen"), "forgotten")


State = dict[str, Any]


class _OnTimer(StatefulProcessor):
    """States by tick in map state, each emitted by a timer at its end."""

    def __init__(self, keys: list[str], state_schema: str, columns: list[str], zero, comb, finish, running: bool):
        self.keys, self.state_schema, self.columns, self.zero, self.comb, self.finish, self.running = keys, state_schema, columns, zero, comb, finish, running
        self.states = names_of(state_schema)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ticks = handle.getMapState("ticks", "until long", self.state_schema)
        self.total = handle.getValueState("total", self.state_schema)

    def _dict(self, values: tuple) -> State:
        return dict(zip(self.states, values, strict=True))

    def _tuple(self, state: State) -> tuple:
        return tuple(state[c].item() if hasattr(state[c], "item") else state[c] for c in self.states)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            for until, *values in part[["until_ms", *self.states]].itertuples(index=False, name=None):
                at = (int(until),)
                if self.ticks.containsKey(at):
                    state = self.comb(self._dict(self.ticks.getValue(at)), self._dict(tuple(values)))
                else:
                    state = self._dict(tuple(values))
                    self.handle.registerTimer(int(until))
                self.ticks.updateValue(at, self._tuple(state))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        state = self._dict(self.ticks.getValue((until,)))
        self.ticks.removeKey((until,))
        if self.running:
            state = self.comb(self._dict(self.total.get()), state) if self.total.exists() else state
            self.total.update(self._tuple(state))
        yield pd.DataFrame([self.finish(key, until, state)], columns=self.columns)

    def close(self) -> None:
        pass


def aggregate_on_timer(df: DataFrame, keys: list[str], zero: Callable[[], State], seq: Callable[[State, dict], State], comb: Callable[[State, State], State], finish: Callable[[tuple, int, State], dict], state_schema: str, schema: str, *, every_s: int, delay_s: int = 3600, running: bool = False) -> DataFrame:
    """An aggregate of user code whose result for each key and tick of every_s seconds leaves by a timer at the tick's end.

    Rows are added to states (zero, seq) within their task first, so that a key's rows never come together; states of a key and tick are added to each
    other (comb) in map state. When the watermark, delay_s behind the newest tick's begin at most, passes the tick's end, finish makes a row of (key, the
    end in milliseconds, the state); running adds the state to those of all ticks before it first. A row counts if its tick is still open, however
    late it is itself. Keys that have no row in a tick emit nothing for it. Rows with a null time take no part; a null key is a key.
    """
    states, types = names_of(state_schema), dict(df.dtypes)
    tick = every_s * 1000

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[tuple, State] = {}
        for batch in batches:
            for found, rows in batch.groupby([*keys, "until_ms"], sort=False, dropna=False):
                at = _plain(found)
                state = own[at] if at in own else zero()
                for row in rows.to_dict("records"):
                    state = seq(state, row)
                own[at] = state
        yield pd.DataFrame([(*k, *[s[c] for c in states]) for k, s in own.items()], columns=[*keys, "until_ms", *states])

    cut = df.where("ts is not null").withColumn("until_ms", (F.floor(F.unix_millis("ts") / tick) + 1) * tick)
    key_schema = ", ".join(f"{k} {types[k]}" for k in keys)
    parts = cut.mapInPandas(partial, f"{key_schema}, until_ms long, {state_schema}")
    # The newest tick's end less a tick is no later than the newest row.
    own = parts.withColumn("until", F.timestamp_millis("until_ms")).withWatermark("until", f"{delay_s + every_s} seconds")
    return own.groupBy(*keys).transformWithStateInPandas(_OnTimer(keys, state_schema, names_of(schema), zero, comb, finish, running), schema, "Append", "EventTime")
