"""Checks of the message flow: completeness, mix, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseloom.operators.parse import INVALID

ERROR_RATE_LIMIT = 0.05
LATENCY_LIMIT_MS = 1000


def reconcile(source: DataFrame, history: DataFrame, device: str = "device_id") -> DataFrame:
    """Devices seen at the source, in history or in both.

    Both sides are reduced to distinct devices before they meet.
    """
    left = source.select(device).filter(F.col(device).isNotNull()).distinct().withColumn("at_source", F.lit(True))
    right = history.select(device).filter(F.col(device).isNotNull()).distinct().withColumn("stored", F.lit(True))
    both = left.join(right, device, "full_outer")
    status = (F.when(F.col("stored").isNull(), "source_only")
              .when(F.col("at_source").isNull(), "history_only").otherwise("matched"))
    return both.select(device, status.alias("status"))


def missing_devices(source: DataFrame, history: DataFrame, device: str = "device_id") -> DataFrame:
    return source.select(device).distinct().join(history.select(device).distinct(), device, "left_anti")


def new_per_interval(messages: DataFrame, minutes: int = 60, time: str = "received_ts") -> DataFrame:
    """Messages per interval, their running total and the change to the interval before.

    The ranking window runs over one row per interval, after aggregation.
    """
    counts = messages.groupBy(F.window(time, f"{minutes} minutes")["start"].alias("interval_start")).agg(
        F.count("*").alias("new_messages"))
    order = Window.orderBy("interval_start")
    return counts.withColumns({
        "total": F.sum("new_messages").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "change": F.col("new_messages") - F.lag("new_messages").over(order),
    })


def message_mix(messages: DataFrame) -> DataFrame:
    return messages.groupBy("content").agg(F.count("*").alias("messages"))


def _share(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def route_rates(routed: DataFrame) -> DataFrame:
    """Received, forwarded and failed messages with the success rate in percent."""
    failed = F.count_if(F.col("route") == INVALID)
    return routed.agg(
        F.count("*").alias("received"), (F.count("*") - failed).alias("forwarded"),
        failed.alias("errors"), (_share(F.count("*") - failed, F.count("*")) * 100).alias("success_rate"))


def window_error_rate(routed: DataFrame, minutes: int = 2, time: str = "received_ts",
                      limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Share of failed messages per window and whether it passes the alert limit."""
    failed = F.count_if(F.col("route") == INVALID)
    return routed.groupBy(F.window(time, f"{minutes} minutes")["start"].alias("window_start")).agg(
        F.count("*").alias("messages"), failed.alias("errors"),
        _share(failed, F.count("*")).alias("error_rate")
    ).withColumn("alert", F.col("error_rate") > limit)


def window_latency(records: DataFrame, done: str, minutes: int = 5, time: str = "timestamp",
                   exact: bool = False, limit: int = LATENCY_LIMIT_MS) -> DataFrame:
    """Latency p50 and p99 per window and whether p99 passes the alert limit.

    Approximate percentiles keep a bounded sketch per window; exact ones keep a count
    per distinct latency.
    """
    millis = F.unix_millis(done) - F.unix_millis(time)
    rank = F.percentile if exact else F.percentile_approx
    return records.groupBy(F.window(time, f"{minutes} minutes")["start"].alias("window_start")).agg(
        F.count("*").alias("messages"), rank(millis, F.lit(0.5)).alias("p50_ms"),
        rank(millis, F.lit(0.99)).alias("p99_ms")
    ).withColumn("alert", F.col("p99_ms") > limit)
