"""Jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from pulseloom.llm import common

# fixed values of the published hash (Lamping and Veach, 2014)
_MULTIPLIER = np.uint64(2862933555777941757)
_TOP = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key; with one more shard, keys only move into the new one."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    bucket = np.zeros(len(state), np.int64)
    todo = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(todo):
            state[todo] = state[todo] * _MULTIPLIER + np.uint64(1)
            step = _TOP / ((state[todo] >> np.uint64(33)).astype(np.float64) + 1.0)
            after = ((bucket[todo] + 1) * step).astype(np.int64)
            inside = after < shards
            todo = todo[inside]
            bucket[todo] = after[inside]
    return bucket.astype(np.int32)


def assign(df: DataFrame, key: str, shards: int, into: str = "shard") -> DataFrame:
    """Add the shard of every row.

    ``key`` is an integer column, or any other type, which is hashed first. A null key
    is a key like any other: all such rows share one shard. Only the key goes to Python.
    """
    value = F.col(f"`{key}`")
    if df.schema[key].dataType.typeName() not in ("long", "integer", "short", "byte"):
        value = F.xxhash64(value)
    where = pandas_udf(lambda keys: pd.Series(jump(keys.to_numpy(), shards)), "int")
    return df.withColumn(into, where(F.coalesce(value.cast("long"), F.lit(-1))))


def slots(df: DataFrame, shard: str = "shard") -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard, without gathering a shard anywhere.

    Rows are numbered within (input partition, shard); a table with one row for each such
    pair supplies where its numbers begin. The columns ``slot``, ``_part`` and ``_row``
    must not exist. The frame is staged, so the numbers never change afterwards.
    """
    spark = df.sparkSession
    fixed = common.staged(
        df.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        common.run_dir(spark, "slots"))
    earlier = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begin = (fixed.groupBy("_part", shard).agg(F.count("*").alias("_rows"))
             .withColumn("_begin", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows"))
    within = Window.partitionBy("_part", shard).orderBy("_row")
    numbered = fixed.withColumn("_nth", F.row_number().over(within) - 1)
    return (numbered.join(begin, ["_part", shard])
            .withColumn("slot", (F.col("_begin") + F.col("_nth")).cast("long"))
            .drop("_part", "_row", "_begin", "_nth"))


def write(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """One folder per shard with all columns of its documents."""
    assign(docs, key, shards).write.partitionBy("shard").parquet(path)


def place(docs: DataFrame, shards: int) -> DataFrame:
    """Digest of a placement: size, checksum, shard, slot and the shard after growth by one.

    A null text has size 8 and checksum 0; a null id is a key of its own; repeated rows are
    placed alike with a slot each; an empty table gives no rows; other columns are ignored.
    """
    text = F.col("text")
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        common.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"))
    placed = assign(assign(sized, "doc_id", shards), "doc_id", shards + 1, "grown_shard")
    return slots(placed).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                                "slot", "grown_shard")
