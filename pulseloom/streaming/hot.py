"""Hot views as keyed state: a batch changes the devices and gateways it names, no others.

The state of a streaming query is the view: points are appended to a device's list, members
put into a gateway's map, and timers erase what has fallen silent. ``series_view`` and
``gateway_view`` read the state of the last committed batch beside the running query. With
changelog checkpoints (``session.REQUIRED``) what a batch writes follows its own rows.

Rows may be out of order up to the watermark: nothing is erased before the watermark says
that no row in time can change that, so any split into batches gives the same view.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from pulseloom.operators import serving

# Python workers need not have this package installed: the processors travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLACK = 180  # points beyond the cap that a list may hold before it is trimmed
FRAME = 10_000  # rows of a device that are held before only the newest points are kept
ASKED = 500  # members of a gateway that a batch asks the state for one by one
CELLS = 60  # writes of a device are combined within this share of the lifetime


def _newest(points: Iterable[tuple], cap: int) -> list[tuple]:
    """The newest ``cap`` distinct points; equal records at one time are one, under the highest id."""
    found: dict[str, tuple] = {}
    for point in sorted(points, reverse=True):
        found.setdefault(point[-1], point)
        if len(found) == cap:
            break
    return list(found.values())


class _Series(StatefulProcessor):
    """Newest points of a device. The list is appended to and trimmed now and then.

    Most devices have few rows in a batch, so rows come as they are: a frame for each device
    would cost more than all else.
    """

    SHAPE = "tick bigint, msg_id bigint, clock bigint, record string"
    COLUMNS = ("tick", "msg_id", "clock", "record")

    def __init__(self, entry: Sequence[str], cap: int, ttl: int, slack: int):
        self.entry, self.cap, self.ttl, self.slack = tuple(entry), cap, ttl, slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getListState("points", self.SHAPE)
        self.about = handle.getValueState("about", "held int, last bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new, last = [], None
        for row in rows:
            new.append(tuple(row[c] for c in self.COLUMNS))
            last = row["clock"] if last is None else max(last, row["clock"])
            if len(new) >= self.cap + FRAME:  # never more than so many beside the newest points
                new = _newest(new, self.cap)
        if last is None:
            return
        new = _newest(new, self.cap)
        state = self.about.get()
        held, before = state if state is not None else (0, None)
        last = last if before is None else max(last, before)
        if held + len(new) > self.cap + self.slack:
            new = _newest([*map(tuple, self.points.get()), *new], self.cap)
            self.points.put(new)
            held = len(new)
        else:
            self.points.appendList(new)
            held += len(new)
        self.about.update((held, last))
        if last != before:
            if before is not None:
                self.handle.deleteTimer(before + self.ttl)
            self.handle.registerTimer(last + self.ttl)
        yield self._told(key, held, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.about.get()
        if state is not None and state[1] + self.ttl <= expiredTimerInfo.getExpiryTimeInMs():
            self.points.clear()
            self.about.clear()
            yield self._told(key, 0, state[1])

    def _told(self, key, held: int, last: int) -> Row:
        return Row(**dict(zip(self.entry, key)), held=held, last_ms=last)

    def close(self) -> None:
        pass


def _shape(records: DataFrame) -> StructType:
    """The record as it lies in the state: moments as whole microseconds."""
    own = serving.record_columns(records)
    return StructType([StructField(f.name, LongType() if f.dataType.typeName() == "timestamp" else f.dataType)
                       for f in records.schema.fields if f.name in own])


def series(records: DataFrame, cap: int = serving.CAP, ttl: int = serving.TTL, time: str = "timestamp",
           clock: str | None = None, watermark: str = "10 minutes", slack: int = SLACK,
           entry: Sequence[str] = serving.ENTRY) -> DataFrame:
    """Keep the newest points of every device of a stream; one small row per changed device.

    The rows tell how many points the list holds and the device's last write; 0 points is a
    device that has been erased. A device that sends much in one batch is read frame by frame.
    ``clock`` (by default ``time``) decides what is silent and which rows are late.
    """
    clock = clock or time
    moments = [f.name for f in records.schema.fields if f.dataType.typeName() == "timestamp"]
    # a record names its repeats: equal readings at one time, whatever message brought them
    same = [(F.unix_micros(c) if c in moments else F.col(c)).alias(c) for c in serving.record_columns(records)]
    rows = records.filter(F.col(time).isNotNull() & F.col(clock).isNotNull()).withWatermark(clock, watermark).select(
        *entry, clock, F.unix_micros(time).alias("tick"), "msg_id", F.unix_millis(clock).alias("_clock"),
        F.to_json(F.struct(*same)).alias("record"))
    rows = rows.withColumnRenamed(clock, "_at").withColumnRenamed("_clock", "clock")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in records.select(*entry).schema.fields)
    return rows.groupBy(*entry).transformWithState(
        _Series(entry, cap, ttl * 1000, slack), f"{kinds}, held int, last_ms bigint", "Update", "EventTime")


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()


def series_view(spark: SparkSession, checkpoint: str, like: DataFrame, cap: int = serving.CAP,
                ttl: int = serving.TTL, as_of=None, time: str = "timestamp", clock: str | None = None) -> DataFrame:
    """The series in the state of a ``series`` query, ranked by ``position`` as ``serving.series`` does.

    ``like`` has the columns of the records (a frame of any rows); only ``msg_id`` and those of
    ``serving.record_columns`` are kept.
    """
    shape = _shape(like)
    point = _state(spark, checkpoint, "points").select("list_element.*")
    rows = point.select("msg_id", F.from_json("record", shape).alias("r"), "clock")
    moments = {f.name for f in like.schema.fields if f.dataType.typeName() == "timestamp"}
    fields = [(F.timestamp_micros(F.col("r")[c]) if c in moments else F.col("r")[c]).alias(c) for c in shape.names]
    records = rows.select("msg_id", *fields, F.timestamp_millis("clock").alias("_silence"))
    found = serving.series(records.drop("_silence") if clock in (None, time) else records, cap, ttl, as_of, time,
                           clock=None if clock in (None, time) else "_silence")
    return found.drop("_silence")


class _Gateway(StatefulProcessor):
    """Members of a gateway's set and the spans in which any of them wrote."""

    def __init__(self, ttl: int, cell: int):
        self.ttl, self.cell = ttl, cell

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.members = handle.getMapState("members", "device_id string", "last_seen bigint")
        self.islands = handle.getListState("islands", "lo bigint, hi bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        spans, seen = list(map(tuple, self.islands.get())), {}
        before = max((hi for _, hi in spans), default=None)
        for frame in rows:
            spans = self._merged(spans + list(zip(frame["lo"].tolist(), frame["hi"].tolist())))
            for device, hi in frame.groupby("device_id")["hi"].max().items():
                seen[device] = max(int(hi), seen.get(device, 0))
        if not spans:
            return
        held = self._held(seen)
        for device, hi in seen.items():
            if device not in held or held[device] < hi:
                self.members.updateValue((device,), (hi,))
        # an earlier island is over once no row in time can reach back to it
        watermark = timerValues.getCurrentWatermarkInMs()
        over = [n for n, (lo, _) in enumerate(spans) if n and lo // 1000 + self.cell <= watermark]
        if over:
            spans = spans[over[-1]:]
            for device, last in [(k[0], v[0]) for k, v in self.members.iterator()]:
                if last < spans[0][0]:
                    self.members.removeKey((device,))
        self.islands.put([(int(lo), int(hi)) for lo, hi in spans])
        last = spans[-1][1]
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._end(before))
            self.handle.registerTimer(self._end(last))
        yield pd.DataFrame({"gateway_id": [key[0]], "changed": [len(seen)], "last_ms": [last // 1000]})

    def _held(self, seen: Iterable[str]) -> dict[str, int]:
        """Last writes of these members that the state knows.

        Every member asked for is a call to the state; a read of all comes in frames. Members are
        asked for one by one only as long as they are few.
        """
        wanted = set(seen)
        if len(wanted) <= ASKED:
            found = {device: self.members.getValue((device,)) for device in wanted}
            return {device: value[0] for device, value in found.items() if value is not None}
        return {key[0]: value[0] for key, value in self.members.iterator() if key[0] in wanted}

    def _end(self, hi: int) -> int:
        return hi // 1000 + self.ttl + self.cell

    def _merged(self, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for lo, hi in sorted(spans):
            if out and lo // 1000 - out[-1][1] // 1000 < self.ttl:
                out[-1] = (out[-1][0], max(hi, out[-1][1]))
            else:
                out.append((lo, hi))
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = max((hi for _, hi in self.islands.get()), default=None)
        if last is not None and self._end(last) <= expiredTimerInfo.getExpiryTimeInMs():
            self.members.clear()
            self.islands.clear()
            yield pd.DataFrame({"gateway_id": [key[0]], "changed": [0], "last_ms": [last // 1000]})

    def close(self) -> None:
        pass


def _combined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Writes of one device in one cell as a span, before anything is shuffled."""
    for frame in frames:
        spans = frame.groupby(["gateway_id", "device_id", "cell"], as_index=False).agg(lo=("tick", "min"), hi=("tick", "max"))
        yield spans.drop(columns="cell")


def gateways(records: DataFrame, ttl: int = serving.TTL, time: str = "timestamp",
             watermark: str = "10 minutes") -> DataFrame:
    """Keep every gateway's set of devices; one small row per changed gateway.

    Map tasks first combine the writes of a device within a sixtieth of the lifetime, so a
    gateway that floods the input sends few rows. A set is erased as a whole, by one timer,
    ``ttl`` after the last write of any member; ``changed`` is 0 then.
    """
    cell = max(ttl * 1000 // CELLS, 1)
    fine = F.col("gateway_id").isNotNull() & F.col("device_id").isNotNull() & F.col(time).isNotNull()
    ticks = records.filter(fine).select(
        "gateway_id", "device_id", F.unix_micros(time).alias("tick"), F.floor(F.unix_millis(time) / cell).alias("cell"))
    spans = ticks.mapInPandas(_combined, "gateway_id string, device_id string, lo bigint, hi bigint")
    timed = spans.withColumn("_at", F.timestamp_micros("hi")).withWatermark("_at", watermark)
    return timed.groupBy("gateway_id").transformWithStateInPandas(
        _Gateway(ttl * 1000, cell), "gateway_id string, changed int, last_ms bigint", "Update", "EventTime")


def gateway_view(spark: SparkSession, checkpoint: str, ttl: int = serving.TTL, as_of=None) -> DataFrame:
    """The members in the state of a ``gateways`` query, as ``serving.gateway_index`` gives them."""
    spans = _state(spark, checkpoint, "islands").select(
        F.col("key.gateway_id").alias("gateway_id"), "list_element.lo", "list_element.hi")
    islands = spans.groupBy("gateway_id").agg(
        F.timestamp_micros(F.max("lo")).alias("island_start"), F.timestamp_micros(F.max("hi")).alias("last_write"))
    if as_of is not None:
        islands = islands.filter(serving.alive("last_write", as_of, ttl))
    members = _state(spark, checkpoint, "members").select(
        F.col("key.gateway_id").alias("gateway_id"), F.col("user_map_key.device_id").alias("device_id"),
        F.timestamp_micros("user_map_value.last_seen").alias("last_seen"))
    return members.join(islands, "gateway_id").filter(F.col("last_seen") >= F.col("island_start")).select(
        "gateway_id", "device_id", "last_seen", "island_start", "last_write")


def start(changes: DataFrame, checkpoint: str, root: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Run ``series`` or ``gateways``; with ``root`` the change rows are appended there by batch."""
    def batch(df: DataFrame, batch_id: int) -> None:
        if root is None:
            df.write.format("noop").mode("overwrite").save()
        else:
            df.write.mode("overwrite").json(f"{root}/batch_id={batch_id}")

    writer = changes.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()
