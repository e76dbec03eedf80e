"""Alerts that last: bad windows in a row, and latencies whose quantiles can be merged.

A sketch is a table of (window, bucket, count). Buckets keep the leading bits of a value, so
sketches of any windows add up to that of a longer one, and a quantile is at most one part in
``2 ** BITS`` too low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseloom.plans import quality

BITS = 6
ERROR_HOLD, LATENCY_HOLD = 2, 5  # minutes that a state must last to alert


def bucket(value: Column, bits: int = BITS) -> Column:
    """The smallest whole number with the same leading bits; negative values count as 0, null stays null."""
    v = F.when(value.isNotNull(), F.greatest(value.cast("long"), F.lit(0).cast("long")))
    spare = F.greatest(F.length(F.bin(v)) - (bits + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, spare), spare)


def _windowed(time: str, minutes: int) -> Column:
    return F.window(time, f"{minutes} minutes")["start"].alias("window_start")


def sketch(records: DataFrame, value: Column, minutes: int = 1, time: str = "timestamp",
           by: Sequence[str] = ()) -> DataFrame:
    """Counts of a value by window and bucket; null values are left out.

    Partially aggregated: a window sends at most as many rows per task as it has buckets.
    """
    rows = records.select(*by, time, bucket(value).alias("bucket")).filter(F.col("bucket").isNotNull())
    return rows.groupBy(*by, _windowed(time, minutes), "bucket").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, minutes: int, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of longer windows from those of shorter ones that divide them."""
    return sketches.groupBy(*by, _windowed("window_start", minutes), "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, *shares: float, by: Sequence[str] = ()) -> DataFrame:
    """The value that so large a share of each window does not exceed, as ``p50`` or ``p99``."""
    order = Window.partitionBy(*by, "window_start").orderBy("bucket")
    whole = Window.partitionBy(*by, "window_start")
    ranked = sketches.withColumns({"_upto": F.sum("n").over(order), "_all": F.sum("n").over(whole)})
    found = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(share)), F.col("bucket"))).alias(
        f"p{round(share * 100)}") for share in shares]
    return ranked.groupBy(*by, "window_start").agg(F.sum("n").alias("messages"), *found)


def sustained(windows: DataFrame, bad: Column, value: str, minutes: int, hold: int,
              by: Sequence[str] = ()) -> DataFrame:
    """Runs of bad windows that last at least ``hold`` minutes, with their peak.

    A window without rows ends a run: nothing is known of it. Only bad windows are ranked,
    one row each, after aggregation.
    """
    width = minutes * 60
    rows = windows.filter(bad).withColumn("_at", F.unix_seconds("window_start"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_at"))
    runs = rows.withColumn("_run", F.col("_at") - place * width).groupBy(*by, "_run").agg(
        F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.count("*").alias("bad_windows"),
        F.max(value).alias("peak"))
    return runs.filter(F.col("_to") + width - F.col("_from") >= hold * 60).select(
        *by, F.timestamp_seconds("_from").alias("started"), F.timestamp_seconds(F.col("_to") + width).alias("ended"),
        "bad_windows", "peak")


def error_alerts(routed: DataFrame, minutes: int = 1, hold: int = ERROR_HOLD, time: str = "received_ts",
                 limit: float = quality.ERROR_RATE_LIMIT) -> DataFrame:
    """When more than ``limit`` of the messages failed for ``hold`` minutes."""
    rates = quality.window_error_rate(routed, minutes, time, limit)
    return sustained(rates, F.col("alert"), "error_rate", minutes, hold)


def latency_alerts(sketches: DataFrame, minutes: int = 1, hold: int = LATENCY_HOLD, share: float = 0.99,
                   limit: int = quality.LATENCY_LIMIT_MS) -> DataFrame:
    """When the quantile of ``merged`` latency sketches passed ``limit`` ms for ``hold`` minutes."""
    name = f"p{round(share * 100)}"
    found = quantiles(merged(sketches, minutes), share)
    return sustained(found, F.col(name) > limit, name, minutes, hold)
