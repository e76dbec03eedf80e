"""Lasting alerts, mergeable latency sketches and checks that count every row once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import live
from pulseloom.plans import alerts, checks

BASE = dt.datetime(2024, 1, 1)


def at(minute, second=0):
    return BASE + dt.timedelta(minutes=minute, seconds=second)


def test_runs_of_bad_windows(spark):
    bad = {0: 6, 1: 9, 2: 7, 4: 50, 7: 8, 8: 6, 10: 6, 11: 10}  # errors of 100; minute 9 has no messages
    rows = [(at(m, i % 60), "invalid" if i < bad.get(m, 3) else "vital_signs") for m in range(13) if m != 9 for i in range(100)]
    routed = spark.createDataFrame(rows, "received_ts timestamp, route string")
    got = sorted(map(tuple, alerts.error_alerts(routed).collect()))
    assert got == [(at(0), at(3), 3, 0.09), (at(7), at(9), 2, 0.08), (at(10), at(12), 2, 0.1)]
    assert [r.started for r in alerts.error_alerts(routed, hold=3).collect()] == [at(0)]
    assert alerts.error_alerts(routed.filter("false")).count() == 0


def test_runs_by_group(spark):
    rows = [(g, at(m), v) for g, minutes in (("a", (0, 1, 2)), ("b", (1, 3))) for m, v in zip(minutes, (5, 9, 7))]
    windows = spark.createDataFrame(rows, "gateway string, window_start timestamp, value int")
    got = alerts.sustained(windows, F.col("value") > 1, "value", 1, 2, ["gateway"]).collect()
    assert list(map(tuple, got)) == [("a", at(0), at(3), 3, 9)]


def test_sketches_merge(spark):
    chosen = random.Random(4)
    rows = [(at(chosen.randrange(120)), int(chosen.lognormvariate(6, 2))) for _ in range(4000)]
    rows += [(at(5), None), (at(5), -3), (at(5), 0), (at(5), 2**52 + 1)]
    df = spark.createDataFrame(rows, "timestamp timestamp, ms bigint")
    small = alerts.sketch(df, F.col("ms"), 1)
    hours = sorted(map(tuple, alerts.quantiles(alerts.merged(small, 60), 0.5, 0.99).collect()))
    assert hours == sorted(map(tuple, alerts.quantiles(alerts.sketch(df, F.col("ms"), 60), 0.5, 0.99).collect()))
    for (start, n, *found), first in zip(hours, (0, 60)):
        values = sorted(max(v, 0) for t, v in rows if v is not None and at(first) <= t < at(first + 60))
        assert start == at(first) and n == len(values)
        for share, value in zip((0.5, 0.99), found):
            exact = values[-(-len(values) * round(share * 100) // 100) - 1]
            assert value <= exact <= value * (1 + 2 ** -alerts.BITS) + 1


@pytest.mark.parametrize("value", [0, 1, 127, 128, 129, 255, 256, 1000, 2**40 + 12345])
def test_buckets(spark, value):
    got = spark.range(1).select(alerts.bucket(F.lit(value)).alias("b")).first().b
    spare = max(value.bit_length() - 7, 0)
    assert got == value >> spare << spare


def test_latency_alerts(spark):
    slow = {3: 1500, 4: 1600, 5: 1700, 6: 1500, 7: 1400, 9: 9000}
    rows = [(at(m, i % 60), slow.get(m, 100) if i % 50 == 0 else 100) for m in range(12) for i in range(200)]
    df = spark.createDataFrame(rows, "timestamp timestamp, ms bigint")
    got = alerts.latency_alerts(alerts.sketch(df, F.col("ms"))).collect()
    assert [(r.started, r.ended, r.bad_windows) for r in got] == [(at(3), at(8), 5)]
    assert 1700 * 63 / 64 <= got[0].peak <= 1700


def test_checks_count_once(spark, tmp_path):
    path, mark = str(tmp_path / "t"), str(tmp_path / "mark")
    frame = lambda n: spark.range(n).select(
        F.col("id").alias("msg_id"), F.lit("d").alias("device_id"), F.lit(BASE).alias("timestamp"))
    assert checks.since_last(spark, path, mark).new == 0
    live.append(frame(5), path, 0)
    first = checks.since_last(spark, path, mark)
    live.append(frame(3), path, 1)  # arrives while the check is at work
    checks.done(spark, first, mark)
    second = checks.since_last(spark, path, mark)
    assert (first.new, second.new) == (5, 3)
    # the second check fails before it is done: its rows are counted by the next one
    live.append(frame(3), path, 1)
    live.append(frame(2), path)
    live.compact(spark, path)
    third = checks.since_last(spark, path, mark)
    checks.done(spark, third, mark)
    checks.done(spark, second, mark)  # too late to take the mark back
    assert third.new == 5 and checks.since_last(spark, path, mark).new == 0
    live.drop_days(spark, path, ["2024-01-01"])
    assert checks.since_last(spark, path, mark).new == 0
