"""Hot views kept as streaming state against the batch views, over any split into batches."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import serving
from pulseloom.streaming import hot

BASE = dt.datetime(2024, 1, 1)
SCHEMA = ("msg_id bigint, message_type string, device_id string, gateway_id string, heart_rate int, skin_temp double, "
          "timestamp timestamp, received_ts timestamp")
TTL = 600


def record(i, device, second, gateway="g", rate=None, arrived=None):
    at = None if second is None else BASE + dt.timedelta(seconds=second)
    return (i, "VITAL_SIGN", device, gateway, rate, 36.5 if i % 3 else None, at, arrived or at or BASE)


def replayed(spark, batches, folder, changes_of):
    """Write the batches one after the other and run the query after each of them."""
    source = f"{folder}/source"
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        hot.start(changes_of(stream), f"{folder}/state", f"{folder}/changes", {"availableNow": True}).awaitTermination()
    return spark.createDataFrame([r for rows in batches for r in rows], SCHEMA)


def series_rows(df):
    return sorted((r.device_id, r.position, r.msg_id, r.timestamp, r.heart_rate, r.skin_temp) for r in df.select(
        "device_id", "position", "msg_id", "timestamp", "heart_rate", "skin_temp").fillna(-1).collect())


def gateway_rows(df):
    return sorted(map(tuple, df.collect()))


def noise(seed, n=160, hours=6):
    chosen = random.Random(seed)
    rows = [record(i, f"d{chosen.randrange(5)}", chosen.randrange(hours * 3600), f"g{chosen.randrange(3)}",
                   chosen.choice([60, 61, None])) for i in range(n)]
    rows += [record(n + i, r[2], (r[6] - BASE).total_seconds(), r[3], r[4])[:5] + r[5:] for i, r in enumerate(rows[:15])]
    return [*rows, record(900, "d1", None), (901, "VITAL_SIGN", "d2", None, 60, 1.5, BASE, BASE)]


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 4), (3, 6)])
def test_random_splits(spark, tmp_path, seed, parts):
    rows = noise(seed)
    random.Random(seed).shuffle(rows)
    batches = [rows[i::parts] for i in range(parts)]
    now = BASE + dt.timedelta(hours=6)
    whole = replayed(spark, batches, str(tmp_path / "s"),
                     lambda s: hot.series(s, cap=7, ttl=TTL, watermark="1 day", slack=3))
    view = hot.series_view(spark, str(tmp_path / "s" / "state"), whole, 7, TTL, now)
    assert series_rows(view) == series_rows(serving.series(whole, 7, TTL, now))
    assert series_rows(hot.series_view(spark, str(tmp_path / "s" / "state"), whole, 7, 10**6)) == series_rows(
        serving.series(whole, 7, 10**6))
    replayed(spark, batches, str(tmp_path / "g"), lambda s: hot.gateways(s, ttl=TTL, watermark="1 day"))
    for as_of in (now, None):
        index = serving.gateway_index(whole.filter("gateway_id is not null"), as_of, TTL)
        assert gateway_rows(hot.gateway_view(spark, str(tmp_path / "g" / "state"), TTL, as_of)) == gateway_rows(index)


def state_of(spark, folder, variable):
    return hot._state(spark, f"{folder}/state", variable)


def test_silence_erases_and_siblings_keep_alive(spark, tmp_path):
    folder = str(tmp_path)
    batches = [
        [record(1, "quiet", 0, "a"), record(2, "busy", 10, "a"), record(3, "lone", 20, "b")],
        [record(4, "busy", 400, "a")],
        [record(5, "busy", 900, "a")],
        [record(6, "busy", 1400, "a"), record(7, "busy", 1500, "c")],
    ]
    whole = replayed(spark, batches, f"{folder}/g", lambda s: hot.gateways(s, ttl=TTL, watermark="1 second"))
    now = BASE + dt.timedelta(seconds=1500)
    got = gateway_rows(hot.gateway_view(spark, f"{folder}/g/state", TTL, now))
    assert got == gateway_rows(serving.gateway_index(whole, now, TTL))
    assert [r[:2] for r in got] == [("a", "busy"), ("a", "quiet"), ("c", "busy")]
    held = {r.g for r in state_of(spark, f"{folder}/g", "members").select(F.col("key.gateway_id").alias("g")).collect()}
    assert held == {"a", "c"}  # the set of b was erased by its timer
    replayed(spark, batches, f"{folder}/s", lambda s: hot.series(s, ttl=TTL, watermark="1 second"))
    view = hot.series_view(spark, f"{folder}/s/state", whole, ttl=TTL, as_of=now)
    assert series_rows(view) == series_rows(serving.series(whole, ttl=TTL, as_of=now))
    held = {r.d for r in state_of(spark, f"{folder}/s", "about").select(F.col("key.device_id").alias("d")).collect()}
    assert held == {"busy"}
    told = spark.read.json(f"{folder}/s/changes").select("device_id", "held", "batch_id").collect()
    assert {r.device_id for r in told if r.held == 0} == {"quiet", "lone"}


def test_islands_that_are_over_leave_the_state(spark, tmp_path):
    folder = str(tmp_path)
    batches = [[record(1, "old", 0, "a"), record(2, "new", 30, "a")], [record(3, "new", 700, "a")],
               [record(4, "new", 900, "a")], [record(5, "other", 950, "a")]]
    whole = replayed(spark, batches, folder, lambda s: hot.gateways(s, ttl=TTL, watermark="0 seconds"))
    assert gateway_rows(hot.gateway_view(spark, f"{folder}/state", TTL)) == gateway_rows(
        serving.gateway_index(whole, None, TTL))
    assert state_of(spark, folder, "islands").count() == 1
    assert {r.user_map_key.device_id for r in state_of(spark, folder, "members").collect()} == {"new", "other"}


def test_arrival_clock(spark, tmp_path):
    """A device with a wrong clock is judged by when its messages arrive."""
    arrived = [BASE + dt.timedelta(seconds=s) for s in (0, 100, 200, 2000)]
    rows = [record(1, "ahead", 10**7, arrived=arrived[0]), record(2, "right", 100, arrived=arrived[1]),
            record(3, "ahead", 10**7 + 5, arrived=arrived[2]), record(4, "right", 2000, arrived=arrived[3])]
    whole = replayed(spark, [rows[:2], rows[2:3], rows[3:]], str(tmp_path), lambda s: hot.series(
        s, ttl=TTL, clock="received_ts", watermark="1 second"))
    view = hot.series_view(spark, str(tmp_path / "state"), whole, ttl=TTL, as_of=arrived[3], clock="received_ts")
    expected = serving.series(whole, ttl=TTL, as_of=arrived[3], clock="received_ts")
    assert series_rows(view) == series_rows(expected) and [r.msg_id for r in view.collect()] == [4]


def test_written_bytes_follow_the_batch(spark, tmp_path):
    many = [record(i, f"d{i % 300}", i, f"g{i % 20}") for i in range(6000)]
    few = [record(9000 + i, f"d{i}", 6100 + i) for i in range(3)]

    def written():
        files = glob.glob(f"{tmp_path}/state/state/**/*", recursive=True)
        return sum(os.path.getsize(f) for f in files if f.endswith((".changelog", ".zip", ".sst")))

    replayed(spark, [many], str(tmp_path), lambda s: hot.series(s, cap=15, watermark="1 day", ttl=10**6))
    first = written()
    replayed(spark, [few], str(tmp_path), lambda s: hot.series(s, cap=15, watermark="1 day", ttl=10**6))
    assert 0 < written() - first < first / 5
