"""Running the streaming jobs over stored events, until all of them are read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import telemetry
from pulseloom.operators import live, parse, sinks
from pulseloom.plans import checks
from pulseloom.session import shared_dir
from pulseloom.sources import raw
from pulseloom.sources.history import read_history
from pulseloom.streaming import clocks, dedup, hot, late, pipeline

SLICES = 4
DISORDER = 3500  # seconds that a message of the sliced files may be out of place
FILE_ROWS = 100_000  # messages of a file of a slice, or fewer
BATCHES = 3


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/replay-{uuid.uuid4().hex}"


def sliced(spark: SparkSession, folder: str, out: str) -> str:
    """The messages as slices of files that arrive one after the other and are out of order.

    A message is up to ``DISORDER`` seconds out of place, within a slice and between two. All
    slices have equally many files, more of them for more messages, so that neither writing nor
    parsing a slice is the work of one task.
    """
    messages = f"{out}/messages"
    place = F.unix_seconds("received_ts") + F.col("msg_id") * 7919 % DISORDER
    rows = telemetry.raw_messages(spark, folder).withColumn("_place", place)
    low, high, count = rows.agg(F.min("_place"), F.max("_place"), F.count("*")).first()
    if low is None:
        low = high = 0
    files = max(1, min(count // (SLICES * FILE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for n in range(SLICES):
        begin, end = (low + (high + 1 - low) * i // SLICES for i in (n, n + 1))
        part = rows.filter((F.col("_place") >= begin) & (F.col("_place") < end)).drop("_place")
        part.coalesce(files).write.mode("append").parquet(messages)
        # tasks without a message write no file: empty ones stand in, or slices would shift
        for _ in range((n + 1) * files - len(spark.read.parquet(messages).inputFiles())):
            part.limit(0).coalesce(1).write.mode("append").parquet(messages)
    return messages


def _arriving(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """The sliced messages as a stream whose micro-batches are the slices."""
    messages = sliced(spark, folder, out)
    files = len(spark.read.parquet(messages).inputFiles()) // SLICES
    return raw.read_raw(spark, messages, streaming=True, maxFilesPerTrigger=str(files))


def _valid(stream: DataFrame) -> DataFrame:
    return parse.typed(stream).filter(F.col("route") != parse.INVALID).drop("payload", "reasons", "route")


def _finish(rows: DataFrame, out: str) -> None:
    rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").option(
        "path", f"{out}/rows").trigger(availableNow=True).start().awaitTermination()


def throttled(spark: SparkSession, folder: str) -> DataFrame:
    """Valid records of the derived stream after streaming throttle deduplication."""
    out = _run_folder(spark)
    valid = _valid(telemetry.raw_stream(spark, folder))
    _finish(dedup.throttle(valid, watermark="0 seconds"), out)
    return spark.read.schema(valid.schema).parquet(f"{out}/rows")


def tumbled(spark: SparkSession, folder: str) -> DataFrame:
    """Valid records after streaming tumbling deduplication of files out of order.

    When all files are read, the end of the input is announced and the query goes on from
    its checkpoint to close the windows that are still open.
    """
    out = _run_folder(spark)
    valid = _valid(_arriving(spark, folder, out))
    unique = dedup.tumbling(valid, watermark=f"{DISORDER} seconds", clock=clocks.ending(spark, f"{out}/ending"))
    _finish(unique, out)
    clocks.end(spark, f"{out}/ending")
    _finish(unique, out)
    return spark.read.schema(valid.schema).parquet(f"{out}/rows")


def _records(spark: SparkSession, folder: str, out: str) -> DataFrame:
    return _valid(_arriving(spark, folder, out))


def keyed_series(spark: SparkSession, folder: str, cap: int, ttl: int, as_of) -> DataFrame:
    """Series kept as state over files out of order, read from that state."""
    out = _run_folder(spark)
    records = _records(spark, folder, out)
    changes = hot.series(records, cap, ttl, watermark=f"{DISORDER} seconds", slack=2)
    hot.start(changes, f"{out}/series", trigger={"availableNow": True}).awaitTermination()
    return hot.series_view(spark, f"{out}/series", records, cap, ttl, as_of)


def keyed_gateways(spark: SparkSession, folder: str, ttl: int, as_of) -> DataFrame:
    """Gateway members kept as state over files out of order, read from that state."""
    out = _run_folder(spark)
    changes = hot.gateways(_records(spark, folder, out), ttl, watermark=f"{DISORDER} seconds")
    hot.start(changes, f"{out}/gateways", trigger={"availableNow": True}).awaitTermination()
    return hot.gateway_view(spark, f"{out}/gateways", ttl, as_of)


def pipeline_counts(spark: SparkSession, folder: str, profile: str = "typed") -> DataFrame:
    """Rows per table after the whole pipeline has run over the derived stream."""
    out = _run_folder(spark)
    pipeline.run(telemetry.raw_stream(spark, folder), f"{out}/tables", f"{out}/checkpoint", profile,
                 trigger={"availableNow": True}).awaitTermination()
    names = [kind.table for kind in sinks.TABLE_COLUMNS[profile]] + [sinks.DEAD_LETTERS]
    counts = None
    for name in names:
        table = spark.read.parquet(f"{out}/tables/{name}") if name == sinks.DEAD_LETTERS else read_history(
            spark, f"{out}/tables", name)
        rows = table.select(F.lit(name).alias("table_name"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts.groupBy("table_name").agg(F.count("*").alias("row_count"))


def late_windows(spark: SparkSession, folder: str, lateness: int, window: str) -> DataFrame:
    """Late rows by window after the pipeline has read files out of order."""
    out = _run_folder(spark)
    pipeline.run(_arriving(spark, folder, out), f"{out}/tables", f"{out}/checkpoint", trigger={"availableNow": True}, method=None,
                 lateness=lateness, views=()).awaitTermination()
    return late.per_window(spark, f"{out}/tables", window)


def _batches(spark: SparkSession, folder: str, out: str) -> list[DataFrame]:
    """Valid records in three batches. They are parsed once; each table of a batch is read alone."""
    parsed = parse.typed(telemetry.raw_messages(spark, folder)).filter(F.col("route") != parse.INVALID)
    parsed = parsed.drop("payload", "reasons").withColumn("_batch", F.pmod("msg_id", F.lit(BATCHES)))
    parsed.write.partitionBy("_batch", "route").parquet(f"{out}/parsed")
    rows = spark.read.schema(parsed.schema).parquet(f"{out}/parsed")
    return [rows.filter(F.col("_batch") == n).drop("_batch") for n in range(BATCHES)]


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of a growing table: after its first batch, after two more of which one check
    failed before it was done, after a compaction, and after a repeated batch."""
    out = _run_folder(spark)
    root, mark, found = f"{out}/tables", f"{out}/mark", []
    path = f"{root}/diaper_status"
    batches = _batches(spark, folder, out)

    def add(batch: int) -> None:
        sinks.write_history(batches[batch], root, batch)

    def check(finish: bool = True) -> None:
        seen = checks.since_last(spark, path, mark)
        if finish:
            checks.done(spark, seen, mark)
            found.append(seen)

    add(0)
    check()
    add(1)
    check(finish=False)
    add(2)
    check()
    live.compact(spark, path)
    check()
    add(2)
    check()
    return checks.as_rows(spark, found)


def staged(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written once, for a plan that reads them several times."""
    path = f"{_run_folder(spark)}/rows"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


_STORES: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, folder: str) -> str:
    """Root of history tables written in three batches and then compacted, once a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORES:
        out = _run_folder(spark)
        root = f"{out}/tables"
        for number, batch in enumerate(_batches(spark, folder, out)):
            sinks.write_history(batch, root, number)
        for kind in sinks.TABLE_COLUMNS["typed"]:
            live.compact(spark, f"{root}/{kind.table}")
            live.vacuum(spark, f"{root}/{kind.table}")
        _STORES[key] = root
    return _STORES[key]
