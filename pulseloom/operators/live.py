"""Day-partitioned tables whose live folders a commit list names.

A table is ``path/event_date=<day>/batch=<name>/*.parquet`` beside ``path/_live/<version>.json``.
The newest list names the folders that count, so folders of unfinished or replaced writes are
never seen, a compaction swaps many small folders for one by a single rename, and readers go
on with the list they have started from. Lists and folders are plain files; days without a
date keep Spark's name of a null partition.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from pulseloom.sources.history import prune

LISTS = "_live"
UNDATED = "__HIVE_DEFAULT_PARTITION__"
KEEP = 3  # newest lists whose folders stay


class Conflict(Exception):
    """The folders a change builds on are no longer live."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, f"{path}/{LISTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))


def _list_file(path: str, version: int) -> str:
    return f"{path}/{LISTS}/{version:012d}.json"


def load(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """A commit list: ``version``, ``schema``, ``writers`` (last batch of each), ``days`` with
    their folders, and ``rows``, how many have ever been added."""
    known = versions(spark, path)
    if not known:
        return {"version": -1, "schema": None, "writers": {}, "days": {}, "rows": 0}
    fs, file = _fs(spark, _list_file(path, known[-1] if version is None else version))
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, state: dict) -> bool:
    """Write a list under its version; False if another writer has taken that version."""
    jvm = spark._jvm
    made, target = f"{path}/{LISTS}/.{uuid.uuid4().hex}", _list_file(path, state["version"])
    fs, temporary = _fs(spark, made)
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(temporary, jvm.org.apache.hadoop.fs.Path(target), options)
    except Exception as error:  # py4j wraps what the file system throws
        fs.delete(temporary, False)
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def commit(spark: SparkSession, path: str, change: Callable[[dict], None]) -> dict:
    """Apply ``change`` to the newest list and publish it; again if somebody else was first."""
    while True:
        state = load(spark, path)
        change(state)
        state["version"] += 1
        if _publish(spark, path, state):
            return state


def _written(spark: SparkSession, path: str, name: str) -> list[str]:
    """Days that have a folder of this name."""
    fs, pattern = _fs(spark, f"{path}/event_date=*/batch={name}")
    return [s.getPath().getParent().getName().removeprefix("event_date=") for s in fs.globStatus(pattern) or []]


def by_day(records: DataFrame, time: str = "timestamp") -> DataFrame:
    """Add ``event_date`` and lay rows out for a partitioned write.

    A rebalance instead of a repartition on the day: adaptive execution splits a day
    that is too big for one task and merges days that are too small. Sorting by device
    lets readers skip row groups.
    """
    day = records.withColumn("event_date", F.to_date(time))
    return day.hint("rebalance", "event_date").sortWithinPartitions("event_date", "device_id", time)


def _write(rows: DataFrame, path: str, name: str) -> None:
    """Write the days of one batch; a folder left by a failed attempt is replaced."""
    rows.withColumn("batch", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "event_date", "batch").parquet(path)


def append(records: DataFrame, path: str, batch_id: int | None = None, writer: str = "stream",
           time: str = "timestamp") -> bool:
    """Add records as one batch; False if the writer's batch was already live.

    Batches of a writer are numbered upwards, so a retried one is either not yet listed and
    written again under its name, or listed and left alone, even after a compaction.
    """
    spark = records.sparkSession
    if batch_id is not None and batch_id <= load(spark, path)["writers"].get(writer, -1):
        return False
    name = f"a{uuid.uuid4().hex}" if batch_id is None else f"b{batch_id:012d}-{uuid.uuid5(uuid.NAMESPACE_URL, writer).hex[:8]}"
    _write(by_day(records, time), path, name)
    days = _written(spark, path, name)
    schema = records.schema.json()
    # from the files' footers: what is written is what counts
    added = _folders(spark, path, {"schema": schema}, {day: [name] for day in days}).count()

    def change(state: dict) -> None:
        state["schema"] = schema
        for day in days:
            live = state["days"].setdefault(day, [])
            if name not in live:
                live.append(name)
        if batch_id is not None:
            state["writers"][writer] = max(batch_id, state["writers"].get(writer, -1))
        state["rows"] = state.get("rows", 0) + added

    commit(spark, path, change)
    return True


def _wanted(day: str, start, end) -> bool:
    """Whether a day can hold times of ``[start, end)``; anything but datetimes excludes none."""
    if day == UNDATED:
        return not isinstance(start, dt.datetime) and not isinstance(end, dt.datetime)
    date = dt.date.fromisoformat(day)
    return not (isinstance(start, dt.datetime) and date < start.date()) and not (
        isinstance(end, dt.datetime) and date > end.date())


def _folders(spark: SparkSession, path: str, state: dict, days: dict[str, list[str]]) -> DataFrame:
    fields = StructType.fromJson(json.loads(state["schema"]))
    schema = StructType([*fields.fields, StructField("event_date", DateType()), StructField("batch", StringType())])
    paths = [f"{path}/event_date={day}/batch={name}" for day, names in sorted(days.items()) for name in names]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def read(spark: SparkSession, path: str, start=None, end=None, time: str = "timestamp",
         version: int | None = None) -> DataFrame:
    """The live rows with their ``event_date``, narrowed to ``start <= time < end``.

    Bounds given as datetimes leave days out before anything is listed; bounds given as
    columns prune partitions when the query runs. ``version`` reads an older list.
    """
    state = load(spark, path, version)
    if state["schema"] is None:
        raise FileNotFoundError(f"{path} has no commit list")
    days = {day: names for day, names in state["days"].items() if _wanted(day, start, end)}
    return prune(_folders(spark, path, state, days).drop("batch"), start, end, time)


def compact(spark: SparkSession, path: str, most: int = 1, time: str = "timestamp") -> list[str]:
    """Rewrite the days that have more than ``most`` folders into one each; returns them.

    Rows are rebalanced by day, so a large day gives several files of the advisory size. Until
    the new list is published readers see the old folders, afterwards the new ones. Batches
    that arrive meanwhile stay beside them; a day whose folders somebody else has replaced
    is left to the next run.
    """
    state = load(spark, path)
    days = {day: names for day, names in state["days"].items() if len(names) > most}
    if not days:
        return []
    name = f"c{uuid.uuid4().hex}"
    rows = _folders(spark, path, state, days).drop("batch", "event_date")
    _write(by_day(rows, time), path, name)
    done: list[str] = []

    def change(now: dict) -> None:
        done.clear()
        for day, names in days.items():
            live = now["days"].get(day, [])
            if set(names) <= set(live):
                now["days"][day] = [name, *[n for n in live if n not in names]]
                done.append(day)
        if not done:
            raise Conflict(path)

    try:
        commit(spark, path, change)
    except Conflict:
        return []
    return sorted(done)


def vacuum(spark: SparkSession, path: str, keep: int = KEEP, grace: float = 3600.0) -> int:
    """Delete lists but for the newest ``keep``, and folders that none of those names.

    Folders younger than ``grace`` seconds stay: their batch may be about to be listed.
    Returns the number of deleted folders.
    """
    known = versions(spark, path)
    live = {(day, name) for v in known[-keep:] for day, names in load(spark, path, v)["days"].items() for name in names}
    fs, pattern = _fs(spark, f"{path}/event_date=*/batch=*")
    oldest = (dt.datetime.now().timestamp() - grace) * 1000
    gone = 0
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        place = (folder.getParent().getName().removeprefix("event_date="), folder.getName().removeprefix("batch="))
        if place not in live and status.getModificationTime() <= oldest:
            fs.delete(folder, True)
            gone += 1
    for version in known[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(_list_file(path, version)), False)
    return gone


def drop_days(spark: SparkSession, path: str, days: list[str]) -> None:
    """Take days out of the list, then delete their folders."""
    if not days:
        return

    def change(state: dict) -> None:
        for day in days:
            state["days"].pop(day, None)

    commit(spark, path, change)
    for day in days:
        fs, folder = _fs(spark, f"{path}/event_date={day}")
        fs.delete(folder, True)
