"""Deduplication as stateful streaming operators.

Both need event-time order only up to the watermark and free a key's state once it
can no longer matter. A hot key costs one task at most a row for each millisecond that its rows of
one micro-batch span.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from pulseloom.operators import dedup

# Python workers need not have this package installed: the processor travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1024  # groups that keys are dealt into; fixed for the life of a checkpoint


def tumbling(stream: DataFrame, keys: Sequence[str] | None = None, time: str = "timestamp",
             order: str = "msg_id", seconds: int = dedup.SECONDS,
             watermark: str = "10 seconds", clock: DataFrame | None = None) -> DataFrame:
    """First row per key and window, sent when the watermark closes the window.

    An aggregation rather than ``dropDuplicates``: it promises the earliest row, and it
    combines rows of a key before the exchange.

    Without new rows the watermark stands still and the newest windows stay open. ``clock``
    is a stream of times (its first column) that moves the watermark on as well and gives
    no rows: ``clocks.heartbeat`` closes the windows of an idle stream, ``clocks.ending``
    those of an input that has ended.
    """
    keys = list(keys or dedup.key_columns(stream))
    rows = stream.withColumn("_clock", F.lit(False))
    if clock is not None:
        ticks = clock.select(F.col(clock.columns[0]).cast("timestamp").alias(time), F.lit(True).alias("_clock"))
        rows = rows.unionByName(ticks, allowMissingColumns=True)
    rest = [c for c in stream.columns if c not in keys]
    window = F.window(time, f"{seconds} seconds")
    first = (
        rows.withWatermark(time, watermark).groupBy(*keys, "_clock", window.alias("_window"))
        .agg(F.min_by(F.struct(*rest), F.struct(time, order)).alias("_row"), F.max("_clock").alias("_tick"))
    ).filter(~F.col("_tick"))  # on the result: below the watermark the filter would take the times out as well
    return first.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in stream.columns])


class _Throttle(StatefulProcessor):
    """Last passes of the keys of a bucket; one is forgotten once it cannot suppress anything."""

    COLUMNS = ("key", "tick", "micros", "place", "record")

    def __init__(self, millis: int, keep: int):
        self.millis, self.keep = millis, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.marks = handle.getListState("marks", "key string, tick bigint")

    def _first(self, parts: list[pd.DataFrame]) -> pd.DataFrame:
        """Of rows of a key in the same millisecond only the first can pass."""
        rows = pd.concat(parts).sort_values(["key", "tick", "micros", "place"], kind="stable")
        return rows.drop_duplicates(["key", "tick"])

    def _passes(self, held: pd.DataFrame) -> list[int]:
        """Places of the rows that pass, from pass to pass; the rows between them are not looked at."""
        keys, ticks, passes = held["key"].to_numpy(), held["tick"].tolist(), []
        begins = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(ticks)]
        for at, end in zip(begins, begins[1:]):
            while at < end:
                passes.append(at)
                at = bisect_left(ticks, ticks[at] + self.millis, at + 1, end)
        return passes

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        marks = dict(self.marks.get())
        before = max(marks.values(), default=None)
        parts, size, least = [], 0, 0
        for frame in rows:
            part = frame[list(self.COLUMNS)]
            if marks:
                last = part["key"].map(marks)  # no mark: NaN, which nothing is less than
                part = part[~(part["tick"] < last + self.millis)]
            parts.append(part)
            size += len(part)
            if size > 2 * least + 20_000:
                parts = [self._first(parts)]
                size = least = len(parts[0])
        if not size:
            return
        held = self._first(parts)
        passed = held.iloc[self._passes(held)]
        marks.update(zip(passed["key"].tolist(), passed["tick"].tolist()))
        watermark = timerValues.getCurrentWatermarkInMs()
        self.marks.put([(k, t) for k, t in marks.items() if t + self.keep > watermark])
        last = max(marks.values())
        if last != before:
            if before is not None:
                self.handle.deleteTimer(before + self.keep)
            self.handle.registerTimer(last + self.keep)
        yield passed[["record"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # a later pass has armed its own timer
        if all(tick + self.keep <= expiredTimerInfo.getExpiryTimeInMs() for _, tick in self.marks.get()):
            self.marks.clear()
        return iter(())

    def close(self) -> None:
        pass


def throttle(stream: DataFrame, keys: Sequence[str] | None = None, time: str = "timestamp",
             order: str = "msg_id", seconds: int = dedup.SECONDS,
             watermark: str = "10 seconds", expire_after: int | None = None,
             buckets: int = BUCKETS) -> DataFrame:
    """Rows at least ``seconds`` after the last pass of their key, sent at once.

    ``expire_after`` seconds after its last pass a key is forgotten. It only frees state,
    so the default is the earliest time that changes nothing: ``seconds``.

    Spark has no built-in operator for this rule, so it is a ``transformWithState`` processor.
    Almost every reading is a key of its own, and a call of the processor costs milliseconds:
    it is called for one of ``buckets`` groups of keys instead. It takes the group's rows of a
    micro-batch in Arrow frames, keeps one row a key and millisecond of those that the last
    passes do not rule out, and then goes from pass to pass. What a task holds is that of one
    group: of a hot key one row for each millisecond that its rows of one batch span, and the
    marks of keys that have passed lately, which a batch writes anew for the groups it names.
    Rows cross to Python as one JSON text each.
    """
    keys = list(keys or dedup.key_columns(stream))
    times = [f.name for f in stream.schema.fields if f.dataType.typeName() == "timestamp"]
    plain = [(F.unix_micros(c) if c in times else F.col(c)).alias(c) for c in stream.columns]
    shape = StructType([StructField(f.name, LongType() if f.name in times else f.dataType) for f in stream.schema.fields])
    # one text as the key: pandas would turn nulls of number columns into NaN, which equals nothing
    zeros = [(F.col(c) + 0.0 if stream.schema[c].dataType.typeName() in ("float", "double") else
              F.unix_micros(c) if c in times else F.col(c)).alias(c) for c in keys]
    key = F.to_json(F.struct(*zeros))
    timed = stream.withWatermark(time, watermark).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), key.alias("key"), F.col(time).alias("at"), F.unix_millis(time).alias("tick"),
        F.unix_micros(time).alias("micros"), F.col(order).alias("place"), F.to_json(F.struct(*plain)).alias("record"))
    passed = timed.groupBy("bucket").transformWithStateInPandas(
        _Throttle(seconds * 1000, max(expire_after or 0, seconds) * 1000), "record string", "Append", "EventTime")
    rows = passed.select(F.from_json("record", shape).alias("r"))
    return rows.select(*[(F.timestamp_micros(F.col("r")[c]) if c in times else F.col("r")[c]).alias(c)
                         for c in stream.columns])


METHODS = {"tumbling": tumbling, "throttle": throttle}
