"""Reads of the hot views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulseloom.operators import serving
from pulseloom.operators.dedup import first_by
from pulseloom.sources.history import prune


def latest_lookup(latest: DataFrame, *device_ids: str, kind: str | None = None) -> DataFrame:
    """Latest records of one or many devices."""
    found = latest.filter(F.col("device_id").isin(*device_ids))
    return found if kind is None else found.filter(F.col("message_type") == kind)


def series_tail(series: DataFrame, points: int = 10) -> DataFrame:
    """The last points of each series, with their score in epoch milliseconds."""
    return series.filter(F.col("position") <= points).withColumn(
        "score", F.unix_millis("timestamp"))


def series_length(series: DataFrame) -> DataFrame:
    return series.groupBy(*serving.ENTRY).agg(F.count("*").alias("points"))


def gateway_lookup(index: DataFrame, *gateway_ids: str) -> DataFrame:
    return index.filter(F.col("gateway_id").isin(*gateway_ids)).select("gateway_id", "device_id")


def latest_ttl(latest: DataFrame, as_of, ttl: int = serving.TTL, time: str = "timestamp") -> DataFrame:
    """Whole seconds an entry has left."""
    age = F.unix_millis(F.lit(as_of)) - F.unix_millis(time)
    left = F.ceil((F.lit(ttl * 1000) - age) / 1000)
    return latest.select(*serving.ENTRY, left.cast("bigint").alias("ttl_seconds"))


def live_devices(latest: DataFrame) -> DataFrame:
    """Live entries by message type."""
    return latest.groupBy("message_type").agg(F.count("*").alias("devices"))


def tiered_range(series: DataFrame, history: DataFrame, start, as_of, ttl: int = serving.TTL,
                 time: str = "timestamp", cap: int = serving.CAP) -> DataFrame:
    """Rows since ``start``: the last ``ttl`` seconds from the hot series, older from history.

    A series of ``cap`` points is full and may have lost older ones: history answers for
    its device up to the oldest point, and that point's time as well. Equal records are
    one row in history as they are one point in a series.
    """
    cut = F.lit(as_of) - F.make_dt_interval(secs=F.lit(ttl))
    columns = [c for c in history.columns if c in series.columns]
    by, known = Window.partitionBy(*serving.ENTRY), F.lit(True)
    for key in serving.ENTRY:  # a null one finds no history to answer for it
        known = known & F.col(key).isNotNull()
    held = series.withColumn("_oldest", F.when(known & (F.count("*").over(by) >= cap), F.min(time).over(by)))
    after = F.coalesce(F.col(time) > F.col("_oldest"), F.lit(True))
    hot = held.filter((F.col(time) >= cut) & (F.col(time) >= F.lit(start))).filter(after)
    full = held.filter(F.col("_oldest").isNotNull()).groupBy(*serving.ENTRY).agg(F.min("_oldest").alias("_oldest"))
    # one read of the history: what lies behind the cut, and what a full series has lost
    lost = (F.col(time) < cut) | F.coalesce(F.col(time) <= F.col("_oldest"), F.lit(False))
    cold = prune(history, start, None, time).join(full, list(serving.ENTRY), "left").filter(lost).select(history.columns)
    cold = first_by(cold, serving.record_columns(cold), F.desc("msg_id"))
    return hot.select(*columns, F.lit("hot").alias("tier")).unionByName(
        cold.select(*columns, F.lit("history").alias("tier")))
