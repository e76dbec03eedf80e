"""Reading day-partitioned history tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _date(moment: dt.datetime | Column) -> Column:
    return F.to_date(F.lit(moment))


def prune(table: DataFrame, start: dt.datetime | Column | None = None,
          end: dt.datetime | Column | None = None, time: str = "timestamp",
          partition: str | None = "event_date") -> DataFrame:
    """Rows with ``start <= time < end``.

    Spark does not derive a partition filter from a filter on the time column, so
    the same bounds are stated for the partition column when the table has one.
    """
    for bound, low in ((start, True), (end, False)):
        if bound is None:
            continue
        at = F.lit(bound)
        table = table.filter(F.col(time) >= at if low else F.col(time) < at)
        if partition and partition in table.columns:
            day = F.col(partition)
            table = table.filter(day >= _date(bound) if low else day <= _date(bound))
    return table


def read_history(spark: SparkSession, root: str, table: str, start=None, end=None) -> DataFrame:
    """The live rows of one history table, narrowed to a time range before any file is listed."""
    from pulseloom.operators import live  # which builds on this module

    return live.read(spark, f"{root}/{table}", start, end)
