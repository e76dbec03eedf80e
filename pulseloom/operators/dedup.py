"""Removing repeats of a reading.

A key is the message type, the gateway, the device and its readings, compared
exactly (null-safe), not by a hash. Two rules exist:

* ``tumbling``: the first row per key in each aligned window ``[T, T+n)``;
* ``throttle``: a row passes when its key is unseen or last *passed* at least n
  seconds ago; suppressed rows do not move that clock.

Both use event time and are global, so batch, stream and reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Readings that make two messages of a device the same.
VITAL_READINGS = ("heart_rate", "sp_o2", "bp_systolic", "bp_diastolic", "skin_temp", "room_temp",
                  "steps", "battery_level")
DIAPER_READINGS = ("temperature", "humidity", "button", "battery_level")
LEGACY_KEY = ("device_id", "gateway_id", "heart_rate", "spo2", "bp_systolic", "bp_diastolic",
              "skin_temp", "room_temp", "steps", "battery_level")

SECONDS = 5
WATERMARK = 600  # seconds of arrival that marks of passed rows are kept for late ones
# Cells of n seconds per bucket: bounds what one task holds of a key (see throttle).
CELLS_PER_BUCKET = 144


def key_columns(df: DataFrame) -> list[str]:
    """Key of typed records: readings the frame lacks belong to the other message type."""
    readings = dict.fromkeys((*VITAL_READINGS, *DIAPER_READINGS))
    return ["message_type", "gateway_id", "mac", *[c for c in readings if c in df.columns]]


def window_start(time: str, seconds: int) -> Column:
    return F.window(F.col(time), f"{seconds} seconds").getField("start")


def with_window(df: DataFrame, time: str = "timestamp", seconds: int = SECONDS) -> DataFrame:
    """Add the epoch-aligned ``window_start`` of each row."""
    return df.withColumn("window_start", window_start(time, seconds))


def first_by(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """First row per key.

    Planned as a group limit below and above the exchange, so each map task sends at
    most one row per key and a key that floods the input does not flood a reducer.
    """
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_n") == 1).drop("_n")


def tumbling(df: DataFrame, keys: Sequence[str] | None = None, time: str = "timestamp",
             order: Sequence[str | Column] = ("msg_id",), seconds: int = SECONDS,
             enabled: bool = True) -> DataFrame:
    """First row per key and window, ties by ``order``. One exchange."""
    if not enabled:
        return df
    keys = list(keys or key_columns(df))
    return first_by(with_window(df, time, seconds), [*keys, "window_start"], time, *order).drop(
        "window_start")


def _emitted(rows: Column, carry: Column, millis: int) -> Column:
    """Rows of a sorted array that pass, given the last pass before the array."""
    start = F.struct(carry.alias("last"), F.slice(rows, 1, 0).alias("kept"))

    def step(state: Column, row: Column) -> Column:
        passes = state["last"].isNull() | (row["tick"] - state["last"] >= millis)
        return F.when(passes, F.struct(
            row["tick"].alias("last"), F.concat(state["kept"], F.array(row)).alias("kept"))
        ).otherwise(state)

    return F.aggregate(rows, start, step, lambda state: state["kept"])


def _last_emitted(ticks: Column, first: Column, millis: int) -> Column:
    """Last pass of a sorted array when ``first`` is its first pass."""
    def step(last: Column, tick: Column) -> Column:
        passes = (tick >= first) & (last.isNull() | (tick - last >= millis))
        return F.when(passes, tick).otherwise(last)

    return F.aggregate(ticks, F.lit(None).cast("bigint"), step)


def _exits(ticks: Column, start: Column, millis: int) -> Column:
    """Last pass of a bucket for every possible first pass, as sorted (first, last) pairs.

    Only a tick in the bucket's first n seconds, or the next one after them, can pass
    first. First passes that end alike are kept once, under the latest of them.
    """
    early = F.filter(ticks, lambda t: t < start + millis)
    late = F.slice(F.filter(ticks, lambda t: t >= start + millis), 1, 1)
    pairs = F.transform(F.concat(early, late), lambda first: F.struct(
        first.alias("first"), _last_emitted(ticks, first, millis).alias("last")))

    def merge(kept: Column, pair: Column) -> Column:
        size = F.size(kept)
        same = (size > 0) & (F.get(kept, size - 1)["last"] == pair["last"])
        head = F.when(same, F.slice(kept, 1, F.greatest(size - 1, F.lit(0)))).otherwise(kept)
        return F.concat(head, F.array(pair))

    return F.aggregate(pairs, F.slice(pairs, 1, 0), merge)


def _carries(edges: DataFrame, millis: int) -> DataFrame:
    """Last pass before each bucket that continues the bucket before it.

    One small row per bucket of a key comes together here, so a key contributes at most
    the number of buckets its time range spans, however many messages it sent.
    """
    chain = F.array_sort(F.collect_list(F.struct("_bucket", "needs", "exits")))
    start = F.struct(
        F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("bigint").alias("last"),
        F.array().cast("array<struct<bucket:bigint,carry:bigint>>").alias("out"))

    def step(state: Column, edge: Column) -> Column:
        linked = edge["needs"] & (state["bucket"] == edge["_bucket"] - 1)
        carry = F.when(linked, state["last"])
        reachable = F.filter(
            edge["exits"], lambda pair: carry.isNull() | (pair["first"] >= carry + millis))
        return F.struct(
            edge["_bucket"].alias("bucket"), F.get(reachable, F.lit(0))["last"].alias("last"),
            F.when(carry.isNotNull(), F.concat(state["out"], F.array(F.struct(
                edge["_bucket"].alias("bucket"), carry.alias("carry"))))
            ).otherwise(state["out"]).alias("out"))

    folded = edges.groupBy("_key").agg(F.aggregate(chain, start, step, lambda s: s["out"]).alias("out"))
    return folded.select("_key", F.inline("out").alias("_bucket", "carry"))


def throttle(df: DataFrame, keys: Sequence[str] | None = None, time: str = "timestamp",
             order: Sequence[str | Column] = ("msg_id",), seconds: int = SECONDS,
             enabled: bool = True, cells: int = CELLS_PER_BUCKET) -> DataFrame:
    """Rows at least ``seconds`` after the last row that passed for their key.

    Each pass depends on the one before, yet a key may hold a large share of all rows,
    so a key is never gathered whole:

    1. Of rows of a key in the same millisecond only the first can pass; the rest go
       before the exchange.
    2. A key is cut into buckets of ``cells * seconds``; a bucket holds at most one row
       per millisecond and is decided on its own with an array fold.
    3. A bucket depends on the one before only if rows lie within ``seconds`` on both
       sides of the cut. For those few, each possible first pass is mapped to the last
       pass of its bucket, and the maps are chained per key (small rows only).
    """
    if not enabled:
        return df
    keys = list(keys or key_columns(df))
    rest = [c for c in df.columns if c not in keys]
    millis, span = seconds * 1000, seconds * 1000 * cells
    ticks = df.select(F.struct(*keys).alias("_key"), F.unix_millis(time).alias("tick"), *rest)
    distinct = first_by(ticks, ["_key", "tick"], time, *order)
    bucket = F.floor(F.col("tick") / span)
    grouped = distinct.groupBy("_key", bucket.alias("_bucket")).agg(
        F.array_sort(F.collect_list(F.struct("tick", *rest))).alias("rows"))
    start = F.col("_bucket") * span
    first, last = F.get("rows", F.lit(0))["tick"], F.element_at("rows", -1)["tick"]
    needs, gives = first < start + millis, last > start + span - millis
    ticks_only = F.transform("rows", lambda r: r["tick"])
    exits = F.when(gives, _exits(ticks_only, start, millis))
    edges = grouped.filter(needs | gives).select(
        "_key", "_bucket", needs.alias("needs"), exits.alias("exits"))
    carried = grouped.join(_carries(edges, millis), ["_key", "_bucket"], "left")
    passed = carried.select("_key", F.explode(_emitted(F.col("rows"), F.col("carry"), millis)).alias("r"))
    return passed.select(
        *[F.col("_key")[c].alias(c) if c in keys else F.col("r")[c].alias(c) for c in df.columns])


def recent(passed: DataFrame, now: Column, keys: Sequence[str], time: str = "timestamp",
           seconds: int = SECONDS, clock: str = "received_ts", watermark: int = WATERMARK) -> DataFrame:
    """Key, time and arrival of passed rows that may still suppress another one.

    A row may follow its device's last one by up to ``watermark`` seconds of arrival, so
    marks live that much longer than ``seconds``. Their age is judged by ``clock``, the
    arrival: event times of different devices say nothing about each other.
    """
    young = F.unix_millis(now) - F.unix_millis(clock) < (seconds + watermark) * 1000
    return passed.filter(young).select(*keys, *dict.fromkeys((time, clock)))


def continued(df: DataFrame, seen: DataFrame | None, method: str = "throttle",
              time: str = "timestamp", seconds: int = SECONDS) -> DataFrame:
    """Deduplicate a batch that follows earlier ones.

    ``seen`` holds the ``recent`` rows of what has passed before; they take part as
    marks and are taken out again.
    """
    rows = df.withColumn("_seen", F.lit(False))
    if seen is not None:
        rows = rows.unionByName(seen.withColumn("_seen", F.lit(True)), allowMissingColumns=True)
    passed = METHODS[method](rows, key_columns(df), time, (F.desc("_seen"), "msg_id"), seconds)
    return passed.filter(~F.col("_seen")).drop("_seen")


METHODS = {"tumbling": tumbling, "throttle": throttle}


def dedup(df: DataFrame, method: str = "throttle", **options) -> DataFrame:
    return METHODS[method](df, **options)
