"""Streaming queries on many files and many keys: the work is spread, the result stays."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

import replay
import telemetry
from conftest import SMALL
from pulseloom.operators import dedup, parse, serving
from pulseloom.plans import lookups
from pulseloom.streaming import dedup as stream_dedup, hot


def test_slices_of_many_files(spark, tmp_path, monkeypatch):
    """Many files a slice; each slice is one micro-batch, also where a slice fills fewer files."""
    monkeypatch.setattr(replay, "FILE_ROWS", 100)
    made = sorted(glob.glob(f"{replay.sliced(spark, SMALL, str(tmp_path))}/*.parquet"), key=os.path.getmtime)
    size = len(made) // replay.SLICES
    assert size > 1 and len(made) == size * replay.SLICES
    ends = [spark.read.parquet(*made[n * size:(n + 1) * size]).agg(F.min("received_ts"), F.max("received_ts")).first()
            for n in range(replay.SLICES)]
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(ends, ends[1:]))
    sparse = str(tmp_path / "sparse")
    events = spark.createDataFrame([(n, dt.datetime(2024, 1, 1 + n // 1000), 1, "view", 1.0, "{}") for n in range(1003)],
                                   telemetry.EVENTS_SCHEMA)
    events.coalesce(1).write.parquet(f"{sparse}/events.parquet")
    made = sorted(glob.glob(f"{replay.sliced(spark, sparse, str(tmp_path / 'out'))}/*.parquet"), key=os.path.getmtime)
    size = len(made) // replay.SLICES
    counts = [spark.read.parquet(*made[n * size:(n + 1) * size]).count() for n in range(replay.SLICES)]
    assert size > 1 and len(made) == size * replay.SLICES
    assert sum(counts) == telemetry.raw_messages(spark, sparse).count() and counts[1] == 0 < counts[3] < 10


def test_queries_over_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "FILE_ROWS", 100)
    records = parse.typed(telemetry.raw_messages(spark, SMALL)).filter("route != 'invalid'").drop("payload", "reasons", "route")
    got = replay.tumbled(spark, SMALL).select("msg_id").collect()
    assert sorted(r.msg_id for r in got) == sorted(r.msg_id for r in dedup.tumbling(records).select("msg_id").collect())
    now = telemetry.raw_messages(spark, SMALL).agg(F.max("received_ts")).first()[0]
    got = replay.keyed_series(spark, SMALL, 5, 10**6, now).select("msg_id").collect()
    expected = serving.series(records, 5, 10**6, now).select("msg_id").collect()
    assert sorted(r.msg_id for r in got) == sorted(r.msg_id for r in expected) != []


def test_stream_is_dealt_out(spark):
    """One event file is one split: without an exchange one task would parse the whole stream."""
    plan = telemetry.raw_stream(spark, SMALL)._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression" in plan


def test_throttle_state_is_kept_by_bucket(spark, tmp_path):
    """Many keys share a few groups, over batches, expiry included, against the plain rule."""
    base, schema = 1_700_000_000_000, "msg_id bigint, k string, timestamp timestamp"
    rows = [(n, f"k{n * 31 % 997 if n % 4 else 7}", base + n * 17 - n % 5 * 900) for n in range(6000)]
    for start in range(0, 6000, 2000):
        part = [(n, k, dt.datetime.fromtimestamp(t / 1000)) for n, k, t in rows[start:start + 2000]]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    passed = stream_dedup.throttle(source, ["k"], watermark="10 minutes", buckets=8)
    passed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option(
        "path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    expected, last = [], {}
    for part in (rows[n:n + 2000] for n in range(0, 6000, 2000)):
        for n, k, t in sorted(part, key=lambda r: (r[2], r[0])):
            if k not in last or t - last[k] >= 5000:
                last[k] = t
                expected.append(n)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.msg_id for r in got) == sorted(expected) and len(expected) < 5000
    marks = hot._state(spark, str(tmp_path / "state"), "marks")
    assert marks.select("key").distinct().count() == 8
    held = marks.select(F.get_json_object("list_element.key", "$.k").alias("k"), "list_element.tick").collect()
    assert len(held) == len(last) and {r.k: r.tick for r in held} == last


def test_series_of_many_points_in_one_batch(spark, tmp_path, monkeypatch):
    """Of a device's flood only the newest points are held; repeats and order do not matter."""
    monkeypatch.setattr(hot, "FRAME", 50)
    schema = "msg_id bigint, message_type string, device_id string, heart_rate int, timestamp timestamp"
    i = F.col("id")
    spark.range(5000).select(
        i.alias("msg_id"), F.lit("VITAL_SIGN").alias("message_type"), F.concat(F.lit("d"), i % 3).alias("device_id"),
        (i % 2).cast("int").alias("heart_rate"), F.timestamp_seconds(1_700_000_000 + i * 7919 % 1000).alias("timestamp"),
    ).write.parquet(str(tmp_path / "in"))
    records = spark.read.parquet(str(tmp_path / "in"))
    hot.start(hot.series(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), cap=20, ttl=10**6),
              str(tmp_path / "state"), trigger={"availableNow": True}).awaitTermination()
    view = hot.series_view(spark, str(tmp_path / "state"), records, 20, 10**6)
    columns = ["device_id", "position", "msg_id", "heart_rate", "timestamp"]
    assert sorted(map(tuple, view.select(columns).collect())) == sorted(
        map(tuple, serving.series(records, 20, 10**6).select(columns).collect()))


def test_batches_are_parsed_once(spark, tmp_path):
    """Each table of a batch reads its own files of one parsed copy, and together they are everything."""
    batches = replay._batches(spark, SMALL, str(tmp_path))
    plans = [b.filter("route = 'vital_signs'")._jdf.queryExecution().executedPlan().toString() for b in batches]
    assert len(plans) == replay.BATCHES and all("PartitionFilters: [isnotnull(_batch" in p and "from_json" not in p for p in plans)
    records = parse.typed(telemetry.raw_messages(spark, SMALL)).filter("route != 'invalid'")
    assert sorted(r.msg_id for b in batches for r in b.select("msg_id").collect()) == sorted(
        r.msg_id for r in records.select("msg_id").collect())


def test_tiered_range_reads_history_once(spark, tmp_path):
    """What a full series has lost comes from the one read; rows without a device stay in one tier each."""
    start = dt.datetime(2024, 1, 1)
    rows = [(n, "VITAL_SIGN", ("a", "b", None)[n % 3], 60 + n, start + dt.timedelta(minutes=n * (1 if n % 3 else 7)))
            for n in range(60)]
    spark.createDataFrame(rows, "msg_id bigint, message_type string, device_id string, heart_rate int, timestamp timestamp"
                          ).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    now = start + dt.timedelta(minutes=60)
    hot_rows = serving.series(spark.createDataFrame(history.collect(), history.schema), 4, as_of=now)
    got = lookups.tiered_range(hot_rows, history, start + dt.timedelta(minutes=10), now, 1800, cap=4)
    tiers = {r.msg_id: r.tier for r in got.select("msg_id", "tier").collect()}
    expected = {}
    for device in ("a", "b", None):
        points = sorted((r for r in rows if r[2] == device), key=lambda r: r[4])
        for r in points:
            if r[4] >= start + dt.timedelta(minutes=10):
                if r[4] < start + dt.timedelta(minutes=30):
                    expected[r[0]] = "history"
                elif device is not None and r[4] <= points[-4][4]:
                    expected[r[0]] = "history"  # a full series answers after its oldest point only
                elif r in points[-4:]:
                    expected[r[0]] = "hot"
    assert tiers == expected and got.count() == len(expected)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_gateway_sets_parse_once(spark):
    """Members and lifetimes of gateways come from one aggregation: its exchange is reused."""
    records = parse.typed(telemetry.raw_messages(spark, SMALL)).filter("route != 'invalid'")
    sets = serving.gateway_sets(serving.gateway_index(records, ttl=3 * 3600))
    assert len(sets.collect()) == 10
    final = sets._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("explode(array(cast(from_json") == 1 and "ReusedExchange" in final
