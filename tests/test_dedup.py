"""Deduplication against brute force, at bucket cuts, with hot keys and across batches."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pulseloom.operators import dedup

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "msg_id bigint, k string, timestamp timestamp"


def rows_at(*millis, key="a", start=0):
    return [(start + i, key, BASE + dt.timedelta(milliseconds=m)) for i, m in enumerate(millis)]


def by_throttle(rows, seconds=5):
    kept, last = set(), {}
    for msg, key, time in sorted(rows, key=lambda r: (r[2], r[0])):
        if key not in last or (time - last[key]).total_seconds() >= seconds:
            kept.add(msg)
            last[key] = time
    return kept


def by_window(rows, seconds=5):
    kept = {}
    for msg, key, time in sorted(rows, key=lambda r: (r[2], r[0])):
        kept.setdefault((key, int((time - BASE).total_seconds() // seconds)), msg)
    return set(kept.values())


def ids(df):
    return {r.msg_id for r in df.select("msg_id").collect()}


def test_rules_differ(spark):
    first = spark.createDataFrame(rows_at(0, 3000, 5000, 9000, 10000), SCHEMA)
    assert ids(dedup.tumbling(first, ["k"])) == ids(dedup.throttle(first, ["k"])) == {0, 2, 4}
    second = spark.createDataFrame(rows_at(3000, 6000, 9000), SCHEMA)
    assert ids(dedup.tumbling(second, ["k"])) == {0, 1}
    assert ids(dedup.throttle(second, ["k"])) == {0, 2}
    assert ids(dedup.throttle(second, ["k"], enabled=False)) == {0, 1, 2}
    assert ids(dedup.throttle(second, ["k"], seconds=3)) == {0, 1, 2}


@pytest.mark.parametrize("cells", [1, 2, 3, 144])
def test_throttle_brute_force(spark, cells):
    random.seed(cells)
    rows = []
    for key, gap in (("a", 400), ("b", 1000), ("c", 3000), ("d", 7000), (None, 2000)):
        at = 0
        for _ in range(800):
            at += random.choice([0, gap, gap, int(gap * random.random()), gap + random.choice([0, 5000])])
            rows.append((len(rows), key, BASE + dt.timedelta(milliseconds=at)))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert ids(dedup.throttle(df, ["k"], cells=cells)) == by_throttle(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.integers(1, 3))
def test_throttle_property(spark, steps, cells):
    at, rows = 0, []
    for i, step in enumerate(steps):
        at += step * 250
        rows.append((i, "a", BASE + dt.timedelta(milliseconds=at)))
    df = spark.createDataFrame(rows, SCHEMA)
    assert ids(dedup.throttle(df, ["k"], cells=cells)) == by_throttle(rows)


def test_hot_key(spark):
    """One key has most rows, many of them in the same millisecond and across many buckets."""
    hot = spark.range(60_000).select(
        F.col("id").alias("msg_id"), F.lit("hot").alias("k"),
        F.timestamp_millis(F.floor(F.col("id") / 20) * 700).alias("timestamp"))
    cold = spark.range(30_000).select(
        (F.col("id") + 60_000).alias("msg_id"), F.col("id").cast("string").alias("k"),
        F.timestamp_millis(F.col("id") * 1000).alias("timestamp"))
    rows = hot.unionByName(cold)
    expected = by_throttle([tuple(r) for r in rows.collect()])
    assert ids(dedup.throttle(rows, ["k"])) == expected


def test_null_readings_and_types_make_keys(spark):
    df = spark.createDataFrame(
        [(0, "VITAL_SIGN", "g", "m", 70, None), (1, "VITAL_SIGN", "g", "m", 70, None),
         (2, "VITAL_SIGN", "g", "m", 70, 5), (3, "DIAPER", "g", "m", 70, None), (4, "VITAL_SIGN", None, "m", 70, None)],
        "msg_id bigint, message_type string, gateway_id string, mac string, heart_rate int, steps int"
    ).withColumn("timestamp", F.lit(BASE))
    assert dedup.key_columns(df) == ["message_type", "gateway_id", "mac", "heart_rate", "steps"]
    for method in dedup.METHODS:
        assert ids(dedup.dedup(df, method)) == {0, 2, 3, 4}


@pytest.mark.parametrize("method, rule", [("throttle", by_throttle), ("tumbling", by_window)])
def test_batches_continue(spark, method, rule):
    rows = rows_at(*[i * 1300 for i in range(40)])
    seen, got = None, set()
    for part in range(0, 40, 7):
        df = spark.createDataFrame(rows[part:part + 7], SCHEMA).withColumnRenamed("k", "mac").withColumns(
            {"message_type": F.lit("VITAL_SIGN"), "gateway_id": F.lit("g"),
             # messages arrive behind their own time, not all equally late
             "received_ts": F.col("timestamp") + F.make_dt_interval(secs=20 + F.col("msg_id") % 3)})
        keys = dedup.key_columns(df)
        passed = dedup.continued(df, seen, method)
        got |= ids(passed)
        marks = passed.select(*keys, "timestamp", "received_ts")
        marks = marks if seen is None else marks.unionByName(seen)
        now = df.agg(F.max("received_ts")).scalar()
        seen = spark.createDataFrame(dedup.recent(marks, now, keys).collect(), marks.schema)
    assert got == rule(rows)


def test_plans(spark):
    df = spark.createDataFrame(rows_at(0, 1), SCHEMA)
    tumbling = dedup.tumbling(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert tumbling.count("Exchange hashpartitioning") == 1
    assert tumbling.count("WindowGroupLimit") == 2
    dense = spark.range(2000).select(
        F.col("id").alias("msg_id"), F.lit("a").alias("k"), F.timestamp_millis(F.col("id") * 1000).alias("timestamp"))
    throttle = dedup.throttle(dense, ["k"])
    assert throttle.count() == len(throttle.collect()) == 400
    final = throttle._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final and "Python" not in final
