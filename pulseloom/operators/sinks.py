"""Writing history tables, dead letters and hot snapshots.

History goes to tables with a commit list (``live``). Everything else a batch writes goes
to a folder named after the batch and replaces it, so a retried batch leaves the same files.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import time as timing
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from pulseloom.functions.classify import DIAPER, VITAL, check_profile
from pulseloom.operators import live, parse, serving

# executors need not have this package installed to push
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEAD_LETTERS = "dead_letters"
FLUSH_SIZE = 100
PUSHES = "pushes"
VIEWS = ("latest", "series", "gateways")
RETENTION_DAYS = 30

TABLE_COLUMNS = {
    "typed": {VITAL: parse.VITAL_COLUMNS, DIAPER: parse.DIAPER_COLUMNS},
    "lenient": {VITAL: parse.LENIENT_VITAL_COLUMNS, DIAPER: parse.LENIENT_DIAPER_COLUMNS},
}


def write_history(parsed: DataFrame, root: str, batch_id: int | None = None, profile: str = "typed",
                  writer: str = "stream") -> None:
    """Append routed records to one day-partitioned table per message type (see ``live``)."""
    for kind, columns in TABLE_COLUMNS[check_profile(profile)].items():
        table = parse.records(parsed, kind, columns, "msg_id", "received_ts")
        live.append(table, f"{root}/{kind.table}", batch_id, writer)


def write_rejects(parsed: DataFrame, root: str, batch_id: int = 0, profile: str = "typed") -> None:
    parse.rejects(parsed, profile).write.mode("overwrite").parquet(
        f"{root}/{DEAD_LETTERS}/batch_id={batch_id}")


# --- folders -----------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _children(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(folder) if s.isDirectory()]


def _delete(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def retained(table: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of the last ``days`` days; a row without a day ages from its arrival."""
    oldest = F.date_sub(F.to_date(F.lit(as_of)), days)
    young = F.col("event_date") > oldest
    if "received_ts" in table.columns:
        young = young | (F.col("event_date").isNull() & (F.to_date("received_ts") > oldest))
    return table.filter(young)


def expire(spark: SparkSession, root: str, table: str, as_of: dt.datetime,
           days: int = RETENTION_DAYS) -> list[str]:
    """Delete day partitions older than ``days``; returns the deleted days.

    Rows without a day go together, when the newest of them arrived that long ago.
    """
    path, oldest = f"{root}/{table}", as_of.date() - dt.timedelta(days=days)
    known = live.load(spark, path)["days"]
    gone = [day for day in known if day != live.UNDATED and dt.date.fromisoformat(day) <= oldest]
    if live.UNDATED in known:
        undated = live.read(spark, path).filter(F.col("event_date").isNull())
        newest = undated.agg(F.max(F.to_date("received_ts"))).first()[0]
        if newest is None or newest <= oldest:
            gone.append(live.UNDATED)
    live.drop_days(spark, path, gone)
    return sorted(gone)


# --- hot snapshots -----------------------------------------------------------

def _snapshots(spark: SparkSession, path: str) -> list[int]:
    fs, _ = _folder(spark, path)
    done = []
    for name, full in _children(spark, path):
        # a snapshot counts once its write has been committed
        if name.startswith("batch_id=") and fs.exists(
                spark._jvm.org.apache.hadoop.fs.Path(f"{full}/_SUCCESS")):
            done.append(int(name.removeprefix("batch_id=")))
    return sorted(done)


def read_snapshot(spark: SparkSession, root: str, view: str, before: int | None = None) -> DataFrame | None:
    """Newest complete snapshot of a hot view."""
    versions = [v for v in _snapshots(spark, f"{root}/{view}") if before is None or v < before]
    return spark.read.parquet(f"{root}/{view}/batch_id={versions[-1]}") if versions else None


def trim(spark: SparkSession, root: str, view: str, batch_id: int, keep: int = 2) -> None:
    """Delete all but the newest snapshots, so their number does not grow with time."""
    for version in _snapshots(spark, f"{root}/{view}")[:-keep]:
        if version < batch_id:
            _delete(spark, f"{root}/{view}/batch_id={version}")


def _merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.unionByName(new, allowMissingColumns=True)


def write_serving(records: DataFrame, root: str, batch_id: int = 0, ttl: int = serving.TTL,
                  cap: int = serving.CAP, time: str = "timestamp", keep: int = 2, order: str = "event",
                  clock: str = "received_ts", views: Sequence[str] = VIEWS) -> None:
    """Fold a batch of records into the hot views and write them as new snapshots.

    ``clock`` decides what is alive: by default the arrival, so a device with a wrong
    clock neither erases nor prolongs the entries of others. ``time`` orders the points;
    ``order='arrival'`` lets the last message to arrive be the latest.

    A snapshot holds only live entries (at most ``cap`` points each), so the cost of a
    batch follows the number of live devices, not the length of history. ``views`` leaves
    out series or gateways that are kept as streaming state instead (``streaming.hot``).
    """
    spark = records.sparkSession
    points = records.filter(F.col(time).isNotNull())

    def previous(view: str) -> DataFrame | None:
        return read_snapshot(spark, root, view, before=batch_id)

    def write(view: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{view}/batch_id={batch_id}")

    newest = _merge(previous("latest"), records.withColumn("last_write", F.col(clock)))
    now = newest.agg(F.max("last_write")).scalar()
    write("latest", serving.newest_written(newest, now, ttl, time, order))
    if "series" in views:
        pool = _merge(previous("series"), points)
        write("series", serving.series(pool, cap, ttl, now, time, clock=clock).drop("position"))
    if "gateways" in views and "gateway_id" in records.columns:
        write("gateways", _gateways(previous("gateways"), points, ttl, now, clock))
    for view in VIEWS:
        trim(spark, root, view, batch_id, keep)


def _gateways(old: DataFrame | None, points: DataFrame, ttl: int, now, time: str) -> DataFrame:
    """Gateway sets of an earlier snapshot and new writes; the old island is one span."""
    pieces = serving.spans(points, "gateway_id", ttl=ttl, time=time).drop("cell")
    seen = points.select("gateway_id", "device_id", F.col(time).alias("last_seen"))
    if old is not None:
        pieces = pieces.unionByName(old.select(
            "gateway_id", F.col("island_start").alias("lo"), F.col("last_write").alias("hi")).distinct())
        seen = seen.unionByName(old.select("gateway_id", "device_id", "last_seen"))
    islands = serving.last_island(pieces, "gateway_id", ttl).filter(
        serving.alive("last_write", now, ttl))
    members = seen.groupBy("gateway_id", "device_id").agg(F.max("last_seen").alias("last_seen"))
    return members.join(islands, "gateway_id").filter(F.col("last_seen") >= F.col("island_start"))


class Flush(NamedTuple):
    """Name of a flush: the same one after a retried task or batch, so a store can skip repeats."""

    epoch: int
    partition: int
    number: int


PUSHED = "epoch bigint, partition int, flush int, entries int, attempts int, error string, failed array<string>"


def push_serving(entries: DataFrame, connect: Callable[[], Callable[[Flush, list[Row]], None]], root: str, epoch: int = 0,
                 size: int = FLUSH_SIZE, attempts: int = 3, wait: float = 1.0, parallel: int | None = None) -> DataFrame:
    """Send ``serving.entries`` to an external hot store, ``size`` at a time; returns the outcome.

    ``connect`` runs once per partition and returns the function that sends one flush. Entries
    are dealt out by device and ordered, so a flush holds the same entries whenever its task is
    run again; a store that remembers the names of its last flushes applies none twice. A flush
    that fails is tried again up to ``attempts`` times, each after a longer wait; then its
    entries become dead letters in ``root`` (see ``failed_entries``) and the rest goes on. Only
    one flush is held. ``epoch`` is the batch, whose outcome a retried batch replaces.
    """
    spark = entries.sparkSession
    names = entries.columns
    parts = parallel or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a number of partitions of its own, which adaptive execution leaves alone
    dealt = entries.repartition(parts, "device_id").sortWithinPartitions("device_id", *[c for c in names if c != "device_id"])

    def push(batches):
        send, record = None, Row(*names)
        partition, number, waiting = TaskContext.get().partitionId(), 0, []

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal send, number
            error = None
            for attempt in range(1, attempts + 1):
                try:
                    if send is None:
                        send = connect()
                    send(Flush(epoch, partition, number), [record(*r) for r in rows])
                    error = None
                    break
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}"
                    if attempt < attempts:
                        timing.sleep(wait * attempt)
            failed = None if error is None else [json.dumps(dict(zip(names, r)), default=str) for r in rows]
            number += 1
            told = (epoch, partition, number - 1, len(rows), attempt, error, failed)
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(told, kinds)], names=columns)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                waiting.append(row)
                if len(waiting) == size:
                    yield flush(waiting)
                    waiting = []
        if waiting:
            yield flush(waiting)

    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string())]
    columns = [c.split()[0] for c in PUSHED.split(", ")]
    folder = f"{root}/{PUSHES}/epoch_no={epoch}"
    dealt.mapInArrow(push, PUSHED).write.mode("overwrite").parquet(folder)
    return spark.read.schema(PUSHED).parquet(folder)


def failed_entries(pushed: DataFrame) -> DataFrame:
    """Dead letters of the flushes that failed for good: one row for each entry."""
    bad = pushed.filter(F.col("error").isNotNull())
    return bad.select("epoch", "partition", "flush", F.explode("failed").alias("entry"), "error")


def push_counts(pushed: DataFrame) -> DataFrame:
    """Entries sent, sent only after a retry, and failed, by epoch."""
    failed = F.col("error").isNotNull()
    n = F.col("entries")
    return pushed.groupBy("epoch").agg(
        F.sum(F.when(~failed, n).otherwise(0)).alias("sent"),
        F.sum(F.when(~failed & (F.col("attempts") > 1), n).otherwise(0)).alias("sent_late"),
        F.sum(F.when(failed, n).otherwise(0)).alias("failed"))
