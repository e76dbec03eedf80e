"""Rows that come later than a stream waits for: marked, counted and kept.

The watermark of a batch is what earlier batches have shown: the newest event time, held
back by ``lateness`` seconds. A device's clock that is ahead does not move it beyond the
arrival of its message. A late row goes to the dead letters with the reason ``late`` and is
counted by the window it belongs to; none is dropped without a trace.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseloom.operators import parse, sinks

CLOCK, WINDOWS = "watermark", "late_windows"
REASON = "late"
WINDOW = "1 minute"


def moment(time: str = "timestamp", arrival: str = "received_ts") -> Column:
    """What a row tells about the time of the stream."""
    return F.least(time, arrival)


def known(spark: SparkSession, root: str, batch_id: int) -> dt.datetime | None:
    """The newest time of the batches before this one."""
    before = sinks.read_snapshot(spark, root, CLOCK, before=batch_id)
    return None if before is None else before.first()[0]


def mark(parsed: DataFrame, newest: dt.datetime | None, lateness: int, time: str = "timestamp") -> DataFrame:
    """Rows to be stored that are older than the watermark get route and reason ``late``."""
    if newest is None:
        return parsed
    stored = ~F.col("route").isin(parse.INVALID, parse.DROPPED)
    old = stored & (F.unix_micros(time) < F.unix_micros(F.lit(newest)) - lateness * 1_000_000)
    old = F.coalesce(old, F.lit(False))
    return parsed.withColumns({
        "reasons": F.when(old, F.array(F.lit(REASON))).otherwise(F.col("reasons")),
        "route": F.when(old, parse.LATE).otherwise(F.col("route"))})


def write(marked: DataFrame, root: str, batch_id: int, newest: dt.datetime | None, time: str = "timestamp",
          window: str = WINDOW) -> None:
    """Counts of late rows by window, and the clock for the next batch."""
    spark = marked.sparkSession
    counts = marked.filter(F.col("route") == parse.LATE).groupBy(F.window(time, window)["start"].alias("window_start")).agg(
        F.count("*").alias("late_rows"), F.max(F.unix_seconds(F.lit(newest)) - F.unix_seconds(time)).alias("most_seconds"))
    counts.write.mode("overwrite").parquet(f"{root}/{WINDOWS}/batch_id={batch_id}")
    valid = marked.filter(~F.col("route").isin(parse.INVALID, parse.DROPPED))
    clock = valid.agg(F.greatest(F.max(moment(time)), F.lit(newest).cast("timestamp")).alias("newest"))
    clock.write.mode("overwrite").parquet(f"{root}/{CLOCK}/batch_id={batch_id}")
    sinks.trim(spark, root, CLOCK, batch_id)


def per_window(spark: SparkSession, root: str, window: str = WINDOW) -> DataFrame:
    """Late rows by window over all batches: their number and how far behind the newest time they were."""
    counts = spark.read.parquet(f"{root}/{WINDOWS}")
    return counts.groupBy(F.window("window_start", window)["start"].alias("window_start")).agg(
        F.sum("late_rows").alias("late_rows"), F.max("most_seconds").alias("most_seconds"))
