"""Questions over history tables.

``as_of`` stands for the current time and may be a datetime or a column, such as a
scalar subquery. Tables with an ``event_date`` column are narrowed to the days asked
for. Top-k answers break ties by ``msg_id`` so that they are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseloom.functions import derive
from pulseloom.sources.history import prune


def _back(as_of, **interval: int) -> Column:
    return F.lit(as_of) - F.make_dt_interval(**{k: F.lit(v) for k, v in interval.items()})


def since(table: DataFrame, as_of, time: str = "timestamp", inclusive: bool = False,
          **interval: int) -> DataFrame:
    """Rows of the last days / hours / mins / secs before ``as_of``."""
    start = _back(as_of, **interval)
    table = prune(table, start=start, time=time, partition="event_date" if time == "timestamp" else None)
    return table if inclusive else table.filter(F.col(time) > start)


def _spo2(table: DataFrame) -> Column:
    return F.col("spo2" if "spo2" in table.columns else "sp_o2")


def _systolic(table: DataFrame) -> Column:
    return F.col("systolic_bp" if "systolic_bp" in table.columns else "bp_systolic")


def newest(table: DataFrame, limit: int, time: str = "timestamp") -> DataFrame:
    """The newest rows, planned as a top-k per task and one merge of k rows."""
    return table.orderBy(F.desc_nulls_last(time), F.desc("msg_id")).limit(limit)


def recent_vitals(vitals: DataFrame, as_of, hours: int = 1, limit: int = 100) -> DataFrame:
    rows = newest(since(vitals, as_of, hours=hours), limit)
    return rows.select("msg_id", "device_id", "heart_rate", _spo2(rows).alias("spo2"), "timestamp")


def of_day(rows: DataFrame, as_of) -> DataFrame:
    """Rows of the day of ``as_of``; to be taken before anything is ranked."""
    day = F.to_date(F.lit(as_of))
    return prune(rows, start=day.cast("timestamp")).filter(F.to_date("timestamp") == day)


def device_day_stats(vitals: DataFrame, as_of) -> DataFrame:
    """Per device of the day of ``as_of``, busiest first."""
    today = of_day(vitals, as_of)
    return today.groupBy("device_id").agg(
        F.count("*").alias("count"), F.avg("heart_rate").alias("avg_hr"),
        F.avg(_spo2(vitals)).alias("avg_spo2")).orderBy(F.desc("count"), "device_id")


def device_avg_hr(vitals: DataFrame, as_of, hours: int = 1) -> DataFrame:
    return since(vitals, as_of, hours=hours).groupBy("device_id").agg(
        F.avg("heart_rate").alias("avg_hr"))


def daily_vitals(vitals: DataFrame, as_of, days: int = 1) -> DataFrame:
    return since(vitals, as_of, inclusive=True, days=days).groupBy(
        F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("count"), F.avg("heart_rate").alias("avg_hr"),
        F.avg(_spo2(vitals)).alias("avg_spo2")).orderBy(F.desc("date"))


def daily_diaper(diapers: DataFrame, as_of, days: int = 1) -> DataFrame:
    return since(diapers, as_of, inclusive=True, days=days).groupBy(
        F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("count"), F.avg("humidity").alias("avg_humidity"),
        F.avg("temperature").alias("avg_temp")).orderBy(F.desc("date"))


def device_activity(table: DataFrame, as_of, mins: int = 5, time: str = "processed_at") -> DataFrame:
    return since(table, as_of, time, mins=mins).groupBy("device_id").agg(
        F.count("*").alias("count"), F.max(time).alias("last_time"))


def device_history(table: DataFrame, device_id: str, limit: int = 10) -> DataFrame:
    return newest(table.filter(F.col("device_id") == device_id), limit)


def device_inventory(table: DataFrame) -> DataFrame:
    return table.groupBy("device_id").agg(
        F.count("*").alias("record_count"), F.max("timestamp").alias("last_seen")
    ).orderBy(F.desc("last_seen"), "device_id")


def latest_rows(vitals: DataFrame, limit: int = 10) -> DataFrame:
    rows = newest(vitals, limit)
    return rows.select("msg_id", "device_id", derive.date_time(F.col("timestamp")).alias("time"),
                       "heart_rate", _systolic(rows).alias("systolic_bp"), _spo2(rows).alias("spo2"))


def timestamped_rows(vitals: DataFrame, limit: int = 10) -> DataFrame:
    rows = newest(vitals.filter(F.col("timestamp").isNotNull()), limit)
    return rows.select("msg_id", "device_id", derive.clock_time(F.col("timestamp")).alias("data_time"),
                       "heart_rate", _systolic(rows).alias("systolic_bp"),
                       _spo2(rows).alias("spo2"), "battery_level")


def missing_device_share(table: DataFrame, as_of, mins: int = 10, time: str = "processed_at") -> DataFrame:
    no_device = F.col("device_id").isNull() | (F.col("device_id") == "unknown")
    return since(table, as_of, time, inclusive=True, mins=mins).agg(
        F.count("*").alias("total"), F.count_if(no_device).alias("invalid_count"))


def avg_latency(table: DataFrame, as_of, mins: int = 5, done: str = "processing_time") -> DataFrame:
    millis = derive.millis_between(F.col(done), F.col("timestamp"))
    return since(table, as_of, mins=mins).agg(F.avg(millis).alias("avg_latency_ms"))


def recent_rows(table: DataFrame, as_of, mins: int = 10, time: str = "processed_at",
                limit: int | None = None) -> DataFrame:
    """Rows processed lately, newest first; ``limit`` is the documented top-k form."""
    rows = since(table, as_of, time, mins=mins)
    if limit is not None:
        return newest(rows, limit, time)
    return rows.orderBy(F.desc(time), F.desc("msg_id"))


def device_minute_count(table: DataFrame, device_id: str, as_of, mins: int = 1) -> DataFrame:
    return since(table, as_of, inclusive=True, mins=mins).filter(
        F.col("device_id") == device_id).agg(F.count("*").alias("count"))


def table_counts(records: DataFrame) -> DataFrame:
    """Rows per history table of routed messages."""
    return records.groupBy(F.col("route").alias("table_name")).agg(F.count("*").alias("row_count"))


def by_serial(table: DataFrame, serial_no: int, limit: int = 1) -> DataFrame:
    return newest(table.filter(F.col("serial_no") == serial_no), limit)


def newest_rows(table: DataFrame, limit: int = 5) -> DataFrame:
    return newest(table, limit)
