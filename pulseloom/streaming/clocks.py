"""Streams of times that move a watermark on when the data does not."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "timestamp timestamp"
END = dt.datetime(9999, 1, 1)  # beyond every reading


def heartbeat(spark: SparkSession, idle: str = "60 seconds") -> DataFrame:
    """The time ``idle`` before now, every second.

    For live streams whose event times follow the wall clock: a row that is later than
    ``idle`` and the watermark's delay together counts as late, as if data had moved on.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return ticks.select((F.col("timestamp") - F.expr(f"INTERVAL {idle}")).alias("timestamp"))


def ending(spark: SparkSession, folder: str) -> DataFrame:
    """A stream without a row until ``end`` says in ``folder`` that the input has ended."""
    _folder(spark, folder)
    return spark.readStream.schema(SCHEMA).parquet(folder)


def end(spark: SparkSession, folder: str) -> None:
    """Nothing more will come: the next batch closes everything that is still open.

    The query then needs one more run with its own checkpoint, or must still be running.
    Rows that do come after it are late.
    """
    spark.createDataFrame([(END,)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
