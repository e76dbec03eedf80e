"""Hot views: latest record, bounded recent series and devices per gateway.

A hot entry lives ``ttl`` seconds after its last write, as a whole: every write
renews all of it, and a silence of ``ttl`` erases what came before. ``as_of`` may be
a datetime or a column; without it expiry is not applied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseloom.functions import keys
from pulseloom.operators.dedup import first_by

# Lifetime in seconds and points per series.
TTL = 3600
CAP = 720

ENTRY = ("message_type", "device_id")
_NOT_IN_RECORD = ("msg_id", "received_ts", "payload", "route", "reasons")


def _millis(time) -> Column:
    return F.unix_millis(F.lit(time) if not isinstance(time, (Column, str)) else time)


def alive(last_write: Column | str, as_of, ttl: int = TTL) -> Column:
    return _millis(as_of) - _millis(last_write) < ttl * 1000


def record_columns(records: DataFrame) -> list[str]:
    return [c for c in records.columns if c not in _NOT_IN_RECORD]


def as_json(records: DataFrame, *columns: str) -> Column:
    """A record as the JSON text a hot entry holds; null fields are left out."""
    return F.to_json(F.struct(*(columns or record_columns(records))))


def key_column(profile: str = "typed", what: str = "latest") -> Column:
    name = {"latest": keys.latest_key, "series": keys.series_key}[what]
    return name(F.col("message_type"), F.col("device_id"), profile)


def entries(records: DataFrame, profile: str = "typed", ttl: int = TTL, cap: int = CAP,
            time: str = "timestamp") -> DataFrame:
    """What an external hot store is told about each record.

    The record as JSON under its latest key; the same text in the series under its score,
    trimmed to ``cap``; the device in its gateway's set; all for ``ttl`` seconds. A record
    without a time has no score and belongs in no series.
    """
    gateway = keys.gateway_key(F.col("gateway_id")) if "gateway_id" in records.columns else F.lit(None).cast("string")
    return records.select(
        key_column(profile).alias("latest_key"),
        F.when(F.col(time).isNotNull(), key_column(profile, "series")).alias("series_key"),
        gateway.alias("gateway_key"), "device_id",
        F.unix_millis(time).alias("score"), as_json(records).alias("value"),
        F.lit(ttl).alias("ttl_seconds"), F.lit(cap).alias("cap"))


def newest_written(records: DataFrame, as_of, ttl: int = TTL, time: str = "timestamp", order: str = "event",
                   written: str = "last_write", entry: Sequence[str] = ENTRY) -> DataFrame:
    """``latest`` with a life that counts from the last write of an entry by arrival.

    ``written`` is the arrival of a record, or the last write of an entry of an earlier
    snapshot. A record may carry any time, even a far-future one: it moves no other
    entry's life. Both answers come from one partial aggregation.
    """
    clock = F.struct(F.col({"event": time, "arrival": "received_ts"}[order]), F.col("msg_id"))
    rest = [c for c in records.columns if c not in entry and c != written]
    newest = records.groupBy(*entry).agg(
        F.max_by(F.struct(*rest), clock).alias("_r"), F.max(written).alias(written))
    live = newest.filter(alive(written, as_of, ttl))
    return live.select(*[F.col(c) if c in entry or c == written else F.col("_r")[c].alias(c) for c in records.columns])


def latest(records: DataFrame, as_of=None, ttl: int = TTL, time: str = "timestamp",
           order: str = "event", entry: Sequence[str] = ENTRY) -> DataFrame:
    """Newest record per message type and device.

    ``order='arrival'`` lets the last message to arrive win, whatever time it carries.
    Records without a time lose to all others but still make an entry.
    """
    clock = {"event": time, "arrival": "received_ts"}[order]
    newest = first_by(records, entry, F.desc_nulls_last(clock), F.desc("msg_id"))
    if as_of is None:
        return newest
    return newest.filter(alive(F.coalesce(clock, "received_ts"), as_of, ttl))


def series(records: DataFrame, cap: int = CAP, ttl: int | None = None, as_of=None,
           time: str = "timestamp", entry: Sequence[str] = ENTRY, collapse: bool = True,
           clock: str | None = None) -> DataFrame:
    """Newest ``cap`` points per message type and device, ranked by ``position`` from 1.

    Equal records at one time are one point (``collapse=False`` when the input is
    already deduplicated, which saves an exchange). The rank is limited below the
    exchange, so a device sends at most ``cap`` rows per map task. ``ttl`` then drops
    what a silence erased: the surviving points are always the newest, so looking at
    the limited rows is enough. Silence is judged by ``clock``, the event time unless
    told otherwise.
    """
    points = records.filter(F.col(time).isNotNull())
    if collapse:
        points = first_by(points, record_columns(points), F.desc("msg_id"))
    newest_first = Window.partitionBy(*entry).orderBy(F.desc(time), F.desc("msg_id"))
    points = points.withColumn("position", F.row_number().over(newest_first)).filter(
        F.col("position") <= cap)
    if ttl is None:
        return points
    clock = clock or time
    if clock != time:
        newest_first = Window.partitionBy(*entry).orderBy(F.desc(clock), F.desc("msg_id"))
    newer = F.lag(clock).over(newest_first)
    silence = F.coalesce(_millis(newer) - _millis(clock) >= ttl * 1000, F.lit(False))
    points = points.withColumn("_silent", silence.cast("int")).withColumn(
        "_erased", F.sum("_silent").over(newest_first.rowsBetween(Window.unboundedPreceding, 0)))
    points = points.withColumn("_last", F.first(clock).over(newest_first)).filter(F.col("_erased") == 0)
    if as_of is not None:
        points = points.filter(alive("_last", as_of, ttl))
    return points.drop("_silent", "_erased", "_last")


def spans(writes: DataFrame, *by: str, ttl: int = TTL, time: str = "timestamp") -> DataFrame:
    """Writes per key as ``(lo, hi)`` spans, one per ``ttl``-wide ``cell``.

    Two writes of a cell are never a silence apart, so spans lose nothing. They are
    partially aggregated: a key sends one row per cell and map task, not one per write.
    """
    cell = F.floor(_millis(time) / (ttl * 1000))
    return writes.filter(F.col(time).isNotNull()).groupBy(*by, cell.alias("cell")).agg(
        F.min(time).alias("lo"), F.max(time).alias("hi"))


def last_island(pieces: DataFrame, by: str, ttl: int = TTL) -> DataFrame:
    """Start and end of the writes since the last silence, per key of ``(lo, hi)`` spans."""
    order = Window.partitionBy(by).orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = before.isNull() | (_millis("lo") - _millis(before) >= ttl * 1000)
    return pieces.withColumn("_start", F.when(fresh, F.col("lo"))).groupBy(by).agg(
        F.max("_start").alias("island_start"), F.max("hi").alias("last_write"))


def gateway_index(records: DataFrame, as_of=None, ttl: int = TTL, time: str = "timestamp") -> DataFrame:
    """Devices of each gateway, one row per member of the set.

    A device stays while any sibling keeps the gateway's set alive.
    """
    # both sides start from one aggregation, whose exchange is shared as long as they need the same columns of it
    pieces = spans(records, "gateway_id", "device_id", ttl=ttl, time=time)
    merged = pieces.groupBy("gateway_id", "cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    islands = last_island(merged, "gateway_id", ttl)
    if as_of is not None:
        islands = islands.filter(alive("last_write", as_of, ttl))
    members = pieces.groupBy("gateway_id", "device_id").agg(
        F.min("lo").alias("first_seen"), F.max("hi").alias("last_seen"))
    return members.join(islands, "gateway_id").filter(
        (F.col("last_seen") >= F.col("island_start")) & (F.col("first_seen") <= F.col("last_write"))).select(
        "gateway_id", "device_id", "last_seen", "island_start", "last_write")


def gateway_sets(index: DataFrame) -> DataFrame:
    """The index with each set as one sorted array."""
    return index.groupBy("gateway_id").agg(F.array_sort(F.collect_set("device_id")).alias("devices"))
