"""Hot views: limits, expiry as a whole key, snapshots across batches."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import serving, sinks
from pulseloom.plans import lookups

BASE = dt.datetime(2024, 1, 1)
SCHEMA = ("msg_id bigint, received_ts timestamp, message_type string, gateway_id string, device_id string, "
          "heart_rate int, timestamp timestamp")


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def writes(spark, *entries):
    """Entries of (seconds or None, device, gateway)."""
    rows = [(i, at(0 if s is None else s), "VITAL_SIGN", g, d, i, None if s is None else at(s))
            for i, (s, d, g) in enumerate(entries)]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r.msg_id for r in df.select("msg_id").collect())


def test_series_cap(spark):
    df = spark.range(721).select(
        F.col("id").alias("msg_id"), F.lit("VITAL_SIGN").alias("message_type"), (F.col("id") % 1).alias("device_id"),
        F.col("id").cast("int").alias("heart_rate"), F.timestamp_seconds(F.col("id") * 5).alias("timestamp"))
    assert ids(serving.series(df)) == list(range(1, 721))
    plan = serving.series(df, collapse=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("silence, kept", [(3600, [1]), (3599, [0, 1])])
def test_series_silence(spark, silence, kept):
    df = writes(spark, (0, "d", "g"), (silence, "d", "g"))
    assert ids(serving.series(df, ttl=3600)) == kept
    assert ids(serving.series(df, ttl=3600, as_of=at(silence + 3599))) == kept
    assert ids(serving.series(df, ttl=3600, as_of=at(silence + 3600))) == []


def test_equal_records_are_one_point(spark):
    df = writes(spark, (0, "d", "g"), (5, "d", "g")).withColumn("heart_rate", F.lit(70)).withColumn("timestamp", F.lit(BASE))
    assert ids(serving.series(df)) == [1]
    assert ids(serving.series(df, collapse=False)) == [0, 1]


def test_record_without_time(spark):
    df = writes(spark, (None, "d", "g"), (None, "e", "g"), (5, "e", "g"))
    assert ids(serving.latest(df)) == [0, 2]
    assert ids(serving.series(df)) == [2]


def test_latest_orders_and_expiry(spark):
    df = writes(spark, (100, "d", "g"), (50, "d", "g"), (10, "e", "g")).withColumn(
        "received_ts", F.timestamp_seconds(F.unix_seconds(F.lit(BASE)) + F.col("msg_id")))
    assert ids(serving.latest(df)) == [0, 2]
    assert ids(serving.latest(df, order="arrival")) == [1, 2]
    assert ids(serving.latest(df, as_of=at(3610), ttl=3600)) == [0]
    left = lookups.latest_ttl(serving.latest(df), at(110)).collect()
    assert {r.device_id: r.ttl_seconds for r in left} == {"d": 3590, "e": 3500}


def test_sibling_keeps_a_gateway_alive(spark):
    entries = [(0, "quiet", "g")] + [(s, "busy", "g") for s in range(1800, 9000, 1800)] + [(0, "gone", "h")]
    df = writes(spark, *entries)
    got = {(r.gateway_id, r.device_id) for r in serving.gateway_index(df, as_of=at(9000)).collect()}
    assert got == {("g", "quiet"), ("g", "busy")}
    broken = writes(spark, (0, "quiet", "g"), (3600, "busy", "g"))
    assert [r.device_id for r in serving.gateway_index(broken).collect()] == ["busy"]


def test_spans_match_single_writes(spark):
    """Spans per cell find the same islands as looking at every write."""
    import random
    random.seed(5)
    seconds = sorted(random.choice([random.randrange(40_000), random.randrange(4_000)]) for _ in range(60))
    df = writes(spark, *[(s, f"d{s % 7}", "g") for s in seconds])
    start = seconds[0]
    for a, b in zip(seconds, seconds[1:]):
        start = b if b - a >= 3600 else start
    got = serving.gateway_index(df).first()
    assert (got.island_start, got.last_write) == (at(start), at(seconds[-1]))


def test_snapshots_equal_one_batch(spark, tmp_path):
    """Hot views built batch by batch equal those built from all records at once."""
    entries = [(s * 700 % 9000 + (8000 if s % 3 else 0), f"d{s % 4}", f"g{s % 2}") for s in range(40)]
    df = writes(spark, *entries)
    ordered = df.orderBy("timestamp", "msg_id").collect()
    root = str(tmp_path)
    for batch in range(4):
        part = spark.createDataFrame(ordered[batch * 10:batch * 10 + 10], SCHEMA)
        for _ in range(2 if batch == 2 else 1):  # a retried batch changes nothing
            sinks.write_serving(part, root, batch, cap=3)
    now = max(r.timestamp for r in ordered)
    assert ids(sinks.read_snapshot(spark, root, "latest")) == ids(serving.latest(df, as_of=now))
    assert ids(sinks.read_snapshot(spark, root, "series")) == ids(serving.series(df, 3, 3600, now))
    columns = ["gateway_id", "device_id", "last_seen", "island_start", "last_write"]
    expected = serving.gateway_index(df, as_of=now).select(columns)
    assert sorted(map(tuple, sinks.read_snapshot(spark, root, "gateways").select(columns).collect())) == sorted(
        map(tuple, expected.collect()))
    assert len(list((tmp_path / "latest").iterdir())) == 2


def test_tiers_do_not_overlap(spark):
    df = writes(spark, *[(s, "d", "g") for s in range(0, 12_000, 1000)])
    now = at(11_000)
    hot = serving.series(df, ttl=3600, as_of=now)
    got = lookups.tiered_range(hot, df, at(2000), now)
    assert ids(got) == list(range(2, 12))
    assert ids(got.filter("tier = 'hot'")) == [8, 9, 10, 11]


def test_tiers_at_the_cap(spark):
    """What a full series has lost comes from history, and nothing twice."""
    df = writes(spark, *[(s, "d", "g") for s in range(1000)], *[(s, "few", "g") for s in (0, 500)])
    hot = serving.series(df, 10, ttl=3600, as_of=at(999))
    got = lookups.tiered_range(hot, df, at(0), at(999), cap=10)
    assert ids(got) == list(range(1002))
    assert got.filter("tier = 'hot' AND device_id = 'd'").count() == 9


def test_wrong_clock_leaves_others_alone(spark, tmp_path):
    """A record dated 2099 moves no other device's life; silence counts by arrival."""
    df = writes(spark, (0, "a", "g"), (10, "b", "g"), (20, "a", "h"), (30, "c", "g"))
    wrong = df.withColumn("timestamp", F.when(F.col("device_id") == "c", F.lit(dt.datetime(2099, 1, 1))).otherwise(
        F.col("timestamp")))
    for batch, some in enumerate((wrong.filter("msg_id < 2"), wrong.filter("msg_id >= 2"))):
        sinks.write_serving(some, str(tmp_path), batch)
    latest, series = (sinks.read_snapshot(spark, str(tmp_path), v) for v in ("latest", "series"))
    assert ids(latest) == [1, 2, 3] and ids(series) == [0, 1, 2, 3]
    sinks.write_serving(writes(spark, (4000, "a", "g")), str(tmp_path), 2)
    assert sinks.read_snapshot(spark, str(tmp_path), "latest").count() == 1


def pushes(spark, tmp_path, broken=(), **options):
    """Push 250 entries with a store that remembers flushes; ``broken`` flushes fail that often."""
    folder, broken = str(tmp_path / "store"), dict(broken)
    os.makedirs(folder, exist_ok=True)
    rows = [(f"d{i % 7}", None if i % 10 == 0 else i, f"value {i}") for i in range(250)]
    entries = spark.createDataFrame(rows, "device_id string, score bigint, value string").repartition(3)

    def connect():
        tried = {}

        def send(flush, entries):
            tried[flush] = tried.get(flush, 0) + 1
            if tried[flush] <= broken.get(flush.number, 0):
                raise OSError(f"flush {flush.number} refused")
            assert len(entries) <= 40 and entries[0].device_id
            with open(f"{folder}/{'-'.join(map(str, flush))}", "w", encoding="utf-8") as out:
                json.dump([list(e) for e in entries], out)

        return send

    told = sinks.push_serving(entries, connect, str(tmp_path), size=40, wait=0.01, parallel=2, **options)
    sent = [tuple(e) for f in glob.glob(f"{folder}/*") for e in json.load(open(f, encoding="utf-8"))]
    return rows, sent, told


def test_push_in_flushes(spark, tmp_path):
    rows, sent, told = pushes(spark, tmp_path, epoch=4)
    assert sorted(sent, key=repr) == sorted(rows, key=repr)
    assert tuple(sinks.push_counts(told).first()) == (4, 250, 0, 0)
    # a retried batch sends the same flushes under the same names
    names = sorted(glob.glob(f"{tmp_path}/store/*"))
    held = {n: open(n, encoding="utf-8").read() for n in names}
    pushes(spark, tmp_path, epoch=4)
    assert {n: open(n, encoding="utf-8").read() for n in sorted(glob.glob(f"{tmp_path}/store/*"))} == held


def test_failing_store(spark, tmp_path):
    """One flush of a partition succeeds when tried again, another never does and becomes dead letters."""
    rows, sent, told = pushes(spark, tmp_path, broken={0: 2, 1: 9})
    counts = sinks.push_counts(told).first()
    assert counts.sent == len(sent) and counts.sent + counts.failed == 250
    by_flush = {n: sum(r.entries for r in told.collect() if r.flush == n) for n in (0, 1)}
    assert (counts.sent_late, counts.failed) == (by_flush[0], by_flush[1])
    letters = sinks.failed_entries(told).collect()
    lost = [tuple(json.loads(r.entry).values()) for r in letters]
    assert sorted(sent + lost, key=repr) == sorted(rows, key=repr)
    assert {r.error for r in letters} == {"OSError: flush 1 refused"}


def test_unreachable_store(spark, tmp_path):
    def connect():
        raise ConnectionError("no route")

    entries = spark.createDataFrame([("d", 1)], "device_id string, score bigint")
    told = sinks.push_serving(entries, connect, str(tmp_path), wait=0)
    assert sinks.push_counts(told).first().failed == 1
    empty = sinks.push_serving(entries.limit(0), connect, str(tmp_path), epoch=1)
    assert empty.count() == 0
