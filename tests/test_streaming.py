"""Streaming jobs over several files against the batch result."""

import datetime as dt
import glob
import json
import os
import subprocess
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import replay
import telemetry
from conftest import SMALL
from pulseloom.operators import dedup, parse, serving, sinks
from pulseloom.sources import raw as raw_source
from pulseloom.streaming import clocks, dedup as stream_dedup, hot, late, pipeline


@pytest.fixture(scope="module")
def raw(spark):
    return telemetry.raw_messages(spark, SMALL).orderBy("received_ts", "msg_id").collect()


@pytest.fixture(scope="module")
def folder(spark, raw, tmp_path_factory):
    """The messages of the derived stream in four files, in time order."""
    path = tmp_path_factory.mktemp("stream")
    size = len(raw) // 4 + 1
    for i in range(4):
        part = spark.createDataFrame(raw[i * size:(i + 1) * size], raw_source.RAW_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def stream(spark, folder):
    return raw_source.read_raw(spark, folder, streaming=True, maxFilesPerTrigger="1")


def valid(frame):
    return parse.typed(frame).filter("route != 'invalid'").drop("payload", "reasons", "route")


def run(df, tmp_path, name="out"):
    query = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-state")).option(
        "path", str(tmp_path / name)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.mark.parametrize("method", ["tumbling", "throttle"])
def test_stream_equals_batch(spark, folder, tmp_path, method):
    columns = ["msg_id", "message_type", "mac", "heart_rate", "timestamp"]
    options = {"clock": clocks.ending(spark, str(tmp_path / "ending"))} if method == "tumbling" else {}
    unique = stream_dedup.METHODS[method](valid(stream(spark, folder)), **options)
    query = run(unique, tmp_path)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 4
    if method == "tumbling":  # the newest windows are open until the input is said to have ended
        open_ = spark.read.parquet(str(tmp_path / "out")).count()
        clocks.end(spark, str(tmp_path / "ending"))
        run(unique, tmp_path)
        assert spark.read.parquet(str(tmp_path / "out")).count() > open_
    batch = dedup.METHODS[method](valid(spark.read.schema(raw_source.RAW_SCHEMA).parquet(folder)))
    got = spark.read.parquet(str(tmp_path / "out")).select(columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.select(columns).collect()))


def test_hot_key_in_one_batch(spark, tmp_path):
    """A million rows of one key and some of others in one micro-batch against the plain rule."""
    i = F.col("id")
    for half in range(2):
        spark.range(half * 500_000, half * 500_000 + 500_000).select(
            i.alias("msg_id"), F.when(i % 1000 == 0, F.concat(F.lit("d"), i % 7)).otherwise("hot").alias("k"),
            F.when(i % 3 > 0, i / 7).alias("value"), F.when(i % 5 > 0, "a \"text\"").alias("note"),
            F.timestamp_millis(1_700_000_000_000 + i * 2 - i % 11 * 300).alias("timestamp")).repartition(4).coalesce(
            1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = "msg_id bigint, k string, value double, note string, timestamp timestamp"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    query = run(stream_dedup.throttle(source, ["k"], watermark="1 minute"), tmp_path)
    assert max(p["numInputRows"] for p in query.recentProgress) == 1_000_000
    expected, last = [], {}
    rows = [(1_700_000_000_000 + n * 2 - n % 11 * 300, n) for n in range(1_000_000)]
    for tick, n in sorted(rows):
        key = f"d{n % 7}" if n % 1000 == 0 else "hot"
        if key not in last or tick - last[key] >= 5000:
            last[key] = tick
            expected.append((n, key, n / 7 if n % 3 else None, 'a "text"' if n % 5 else None,
                             dt.datetime.fromtimestamp(tick / 1000, dt.timezone.utc).replace(tzinfo=None)))
    got = spark.read.parquet(str(tmp_path / "out")).select("msg_id", "k", "value", "note", F.col("timestamp").cast("timestamp_ntz"))
    assert sorted(map(tuple, got.collect())) == sorted(expected) and len(expected) > 500


def test_files_out_of_order_lose_nothing(spark, tmp_path):
    """Rows that jump between files by less than the watermark all take part, and every window closes."""
    parts = replay.sliced(spark, SMALL, str(tmp_path))
    times = [spark.read.parquet(f).agg(F.min("received_ts"), F.max("received_ts")).first()
             for f in sorted(glob.glob(f"{parts}/*.parquet"), key=os.path.getmtime)]
    assert len(times) == replay.SLICES and any(b[0] < a[1] for a, b in zip(times, times[1:]))
    everything = valid(spark.read.schema(raw_source.RAW_SCHEMA).parquet(parts))
    expected = sorted(r.msg_id for r in dedup.tumbling(everything).select("msg_id").collect())
    assert sorted(r.msg_id for r in replay.tumbled(spark, SMALL).select("msg_id").collect()) == expected


def test_idle_stream_closes_its_windows(spark, tmp_path):
    """A heartbeat moves the watermark past the last rows although none follow; it gives no rows itself."""
    source = str(tmp_path / "idle")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(seconds=60)
    schema = "msg_id bigint, mac string, timestamp timestamp"
    spark.createDataFrame([(1, "a", now), (2, None, now)], schema).write.parquet(source)
    rows = spark.readStream.schema(schema).parquet(source)
    unique = stream_dedup.tumbling(rows, ["mac"], watermark="1 seconds", clock=clocks.heartbeat(spark, "20 seconds"))
    query = unique.writeStream.format("memory").queryName("idle_rows").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "state")).start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table("idle_rows").count():
                break
        assert sorted(r.msg_id for r in spark.table("idle_rows").collect()) == [1, 2]
    finally:
        query.stop()


def test_late_rows_are_counted(spark, tmp_path):
    source = tmp_path / "late"
    for second in (0, 100, 200, 1):
        spark.createDataFrame([(second, "a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second))],
                              "msg_id bigint, mac string, timestamp timestamp").coalesce(1).write.mode(
            "append").parquet(str(source))
    rows = spark.readStream.schema("msg_id bigint, mac string, timestamp timestamp").option(
        "maxFilesPerTrigger", 1).parquet(str(source))
    query = run(stream_dedup.tumbling(rows, ["mac"], watermark="10 seconds"), tmp_path)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    got = sorted(r.msg_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert dropped == 1 and got == [0, 100]


def test_pipeline(spark, folder, raw, tmp_path):
    root = str(tmp_path / "tables")
    pipeline.run(stream(spark, folder), root, str(tmp_path / "state"),
                 trigger={"availableNow": True}, ttl=12 * 3600, cap=3).awaitTermination()
    parsed = parse.typed(spark.createDataFrame(raw, raw_source.RAW_SCHEMA))
    unique = dedup.throttle(parsed.filter("route != 'invalid'").drop("payload", "reasons"))
    stored = spark.read.parquet(f"{root}/vital_signs").unionByName(
        spark.read.parquet(f"{root}/diaper_status"), allowMissingColumns=True)
    assert sorted(r.msg_id for r in stored.select("msg_id").collect()) == sorted(
        r.msg_id for r in unique.select("msg_id").collect())
    rejects = spark.read.parquet(f"{root}/{sinks.DEAD_LETTERS}")
    assert rejects.count() == parsed.filter("route = 'invalid'").count()
    assert rejects.filter(F.size("reasons") == 0).count() == 0
    now = unique.agg(F.max("timestamp")).first()[0]
    for view, expected in (("latest", serving.latest(unique, now, 12 * 3600)),
                           ("series", serving.series(unique, 3, 12 * 3600, now))):
        assert sorted(r.msg_id for r in sinks.read_snapshot(spark, root, view).collect()) == sorted(
            r.msg_id for r in expected.collect())
    metrics = spark.read.parquet(f"{root}/{pipeline.METRICS}")
    assert metrics.agg(F.sum("messages")).first()[0] == len(raw)
    assert metrics.filter("serving_failed > 0").count() == 0


def test_retried_batch_changes_nothing(spark, raw, tmp_path):
    root = str(tmp_path)
    first, second = raw[:400], raw[400:900]

    def counts():
        return [spark.read.parquet(f"{root}/{t}").count() for t in ("vital_signs", "diaper_status", sinks.DEAD_LETTERS)]

    pipeline.write_batch(spark.createDataFrame(first, raw_source.RAW_SCHEMA), 0, root)
    pipeline.write_batch(spark.createDataFrame(second, raw_source.RAW_SCHEMA), 1, root)
    before = counts()
    pipeline.write_batch(spark.createDataFrame(second, raw_source.RAW_SCHEMA), 1, root)
    assert counts() == before


def test_devices_with_different_clocks(spark, tmp_path):
    """A repeat is found although another device's clock is ahead of its own; state stays small."""
    start = dt.datetime(2025, 1, 1)

    def batch(number, *rows):
        data = [(i, start + dt.timedelta(seconds=60 * number), json.dumps(
            {"content": "300B", "gateway id": "g", "MAC": mac, "hr": 70, "timestamp": 1735689600000 + ms}))
            for i, mac, ms in rows]
        pipeline.write_batch(spark.createDataFrame(data, raw_source.RAW_SCHEMA), number, str(tmp_path))

    batch(0, (1, "ahead", 10_000), (2, "behind", 0))
    batch(1, (3, "behind", 2_000))
    batch(2, (4, "behind", 6_000), (5, "ahead", 13_000))
    stored = spark.read.parquet(f"{tmp_path}/vital_signs")
    assert sorted(r.msg_id for r in stored.select("msg_id").collect()) == [1, 2, 4]
    assert len(list((tmp_path / pipeline.PASSES).glob("batch_id=*"))) == 2


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    """Late rows are dead letters with a reason; a clock that is ahead makes nobody late."""
    root, start = str(tmp_path), dt.datetime(2025, 1, 1)

    def batch(number, *rows):
        data = [(i, start + dt.timedelta(seconds=arrived), json.dumps(
            {"content": "300B", "gateway id": "g", "MAC": f"m{i}", "hr": 70, "timestamp": 1735689600000 + 1000 * second}))
            for i, arrived, second in rows]
        pipeline.write_batch(spark.createDataFrame(data, raw_source.RAW_SCHEMA), number, root, lateness=60, views=())

    batch(0, (1, 0, 0), (2, 10, 86_400))  # the second one's clock is a day ahead
    batch(1, (3, 200, 195), (4, 201, 1))
    batch(1, (3, 200, 195), (4, 201, 1))  # a retry changes nothing
    batch(2, (5, 210, 134), (6, 211, 135), (7, 212, 1), (8, 213, 2))
    batch(3)
    stored = spark.read.parquet(f"{root}/vital_signs")
    assert sorted(r.msg_id for r in stored.select("msg_id").collect()) == [1, 2, 3, 4, 6]
    letters = spark.read.parquet(f"{root}/{sinks.DEAD_LETTERS}")
    assert sorted((r.msg_id, r.route, tuple(r.reasons)) for r in letters.collect()) == [
        (5, "late", ("late",)), (7, "late", ("late",)), (8, "late", ("late",))]
    counts = late.per_window(spark, root, "1 minute").collect()
    assert sorted((r.window_start, r.late_rows, r.most_seconds) for r in counts) == [
        (start, 2, 194), (start + dt.timedelta(minutes=2), 1, 61)]
    routes = spark.read.parquet(f"{root}/{pipeline.METRICS}").filter("batch_id = 2")
    assert {r.route: r.messages for r in routes.collect()} == {"late": 3, "vital_signs": 1}
    assert not (tmp_path / "series").exists() and (tmp_path / "latest").exists()


def test_hot_queries_beside_the_pipeline(spark, folder, raw, tmp_path):
    started = pipeline.run_hot(stream(spark, folder), str(tmp_path), trigger={"availableNow": True}, ttl=12 * 3600, cap=3)
    for query in started.values():
        query.awaitTermination()
    records = valid(spark.createDataFrame(raw, raw_source.RAW_SCHEMA))
    now = records.agg(F.max("received_ts")).first()[0]
    got = hot.series_view(spark, f"{tmp_path}/series", records, 3, 12 * 3600, now, clock="received_ts")
    expected = serving.series(records, 3, 12 * 3600, now, clock="received_ts")
    assert sorted(r.msg_id for r in got.collect()) == sorted(r.msg_id for r in expected.collect()) != []
    got = hot.gateway_view(spark, f"{tmp_path}/gateways", 12 * 3600, now)
    expected = serving.gateway_index(records, now, 12 * 3600, "received_ts")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect())) != []


def test_hot_failure_does_not_stop_history(spark, raw, tmp_path, monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("store is down")

    monkeypatch.setattr(sinks, "write_serving", fail)
    pipeline.write_batch(spark.createDataFrame(raw[:200], raw_source.RAW_SCHEMA), 0, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/vital_signs").count() > 0
    assert spark.read.parquet(f"{tmp_path}/{pipeline.METRICS}").first().serving_failed == 1


def test_lenient_pipeline(spark, folder, raw, tmp_path):
    root = str(tmp_path / "tables")
    pipeline.run(stream(spark, folder), root, str(tmp_path / "state"), "lenient",
                 trigger={"availableNow": True}).awaitTermination()
    parsed = parse.lenient(spark.createDataFrame(raw, raw_source.RAW_SCHEMA))
    for name in ("vital_signs", "diaper_status"):
        assert spark.read.parquet(f"{root}/{name}").count() == parsed.filter(F.col("route") == name).count()
    assert spark.read.parquet(f"{root}/{sinks.DEAD_LETTERS}").count() == parsed.filter("route = 'invalid'").count()


def test_processor_travels_without_the_package(tmp_path):
    blob = cloudpickle.dumps(stream_dedup._Throttle(5000, 5000))
    load = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read()).millis); assert 'pulseloom' not in sys.modules"
    done = subprocess.run([sys.executable, "-c", load], input=blob, cwd=tmp_path, capture_output=True, timeout=60)
    assert done.stdout.strip().endswith(b"5000"), done.stderr
