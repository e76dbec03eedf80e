"""History tables with a commit list: retries, compaction under readers, crashes, expiry."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import telemetry
from conftest import SMALL
from pulseloom.operators import live, parse
from pulseloom.plans import history

SCHEMA = "msg_id bigint, device_id string, heart_rate int, timestamp timestamp, received_ts timestamp"
START = dt.datetime(2024, 1, 1, 12)


def batch(spark, *numbers, days=3):
    rows = [(i, f"d{i % 5}", 60 + i % 40, START + dt.timedelta(days=i % days, seconds=i), START) for i in numbers]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def ids(df):
    return sorted(r.msg_id for r in df.select("msg_id").collect())


def files(path):
    return [f for f in glob.glob(f"{path}/event_date=*/batch=*/*.parquet")]


def test_batches_and_retries(spark, tmp_path):
    path = str(tmp_path / "t")
    assert live.append(batch(spark, *range(30)), path, 0)
    assert live.append(batch(spark, *range(30, 50)), path, 1)
    assert not live.append(batch(spark, *range(30, 50)), path, 1)
    assert live.append(batch(spark, 90, 91), path, 0, writer="another")
    assert live.append(batch(spark, 95), path) and live.append(batch(spark, 96), path)
    assert ids(live.read(spark, path)) == [*range(50), 90, 91, 95, 96]
    assert live.read(spark, path).columns == [*batch(spark, 1).columns, "event_date"]
    live.compact(spark, path)
    assert not live.append(batch(spark, *range(30)), path, 0)  # a retry after its files were merged
    assert ids(live.read(spark, path)) == [*range(50), 90, 91, 95, 96]
    with pytest.raises(FileNotFoundError):
        live.read(spark, str(tmp_path / "none"))


def test_compaction_bounds_files_and_spares_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        live.append(batch(spark, *range(n * 40, n * 40 + 40)), path, n)
    before = live.read(spark, path)
    small = len(files(path))
    assert live.compact(spark, path) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert ids(before) == ids(live.read(spark, path)) == list(range(240))  # the older reader still has its files
    assert live.vacuum(spark, path, keep=1, grace=0) == 18
    assert len(files(path)) == 3 < small
    assert ids(live.read(spark, path)) == list(range(240))
    assert live.compact(spark, path) == [] and len(live.versions(spark, path)) == 1
    live.append(batch(spark, 500), path, 6)
    assert ids(live.read(spark, path)) == [*range(240), 500]


def test_crash_between_write_and_swap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(3):
        live.append(batch(spark, *range(n * 10, n * 10 + 10)), path, n)
    whole = live._publish

    def crash(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(live, "_publish", crash)
    with pytest.raises(RuntimeError):
        live.compact(spark, path)
    with pytest.raises(RuntimeError):
        live.append(batch(spark, 77), path, 3)
    assert ids(live.read(spark, path)) == list(range(30))
    monkeypatch.setattr(live, "_publish", whole)
    live.append(batch(spark, 77), path, 3)
    live.compact(spark, path)
    live.vacuum(spark, path, keep=1, grace=0)
    assert ids(live.read(spark, path)) == [*range(30), 77] and len(files(path)) == 3


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    """Whoever comes second applies the change to the newer list; a replaced day is left alone."""
    path = str(tmp_path / "t")
    for n in range(2):
        live.append(batch(spark, *range(n * 10, n * 10 + 10)), path, n)
    whole, between = live._publish, []

    def late(spark_, at, state):
        if not between:
            between.append(1)
            live.append(batch(spark, 60, 61), path, 2)
        return whole(spark_, at, state)

    monkeypatch.setattr(live, "_publish", late)
    assert len(live.compact(spark, path)) == 3
    assert ids(live.read(spark, path)) == [*range(20), 60, 61]

    def rival(spark_, at, state):
        if len(between) == 1:
            between.append(2)
            live.compact(spark, path)
        return whole(spark_, at, state)

    monkeypatch.setattr(live, "_publish", rival)
    assert live.compact(spark, path) == []
    assert ids(live.read(spark, path)) == [*range(20), 60, 61]


def test_undated_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    live.append(batch(spark, 1, 2).withColumn("timestamp", F.when(F.col("msg_id") == 1, F.col("timestamp"))), path, 0)
    live.append(batch(spark, 3).withColumn("timestamp", F.lit(None).cast("timestamp")), path, 1)
    live.compact(spark, path)
    rows = {r.msg_id: r.event_date for r in live.read(spark, path).collect()}
    assert rows == {1: dt.date(2024, 1, 2), 2: None, 3: None}
    assert ids(live.read(spark, path, start=START)) == [1]
    live.append(batch(spark), path, 2)
    assert len(rows) == 3 and live.load(spark, path)["writers"] == {"stream": 2}


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [")[1].split("]")[0]


def test_questions_prune_days(spark, tmp_path):
    path = str(tmp_path / "t")
    valid = parse.typed(telemetry.raw_messages(spark, SMALL)).filter("route = 'vital_signs'")
    live.append(parse.vitals(valid, "msg_id", "received_ts"), path, 0)
    everything = live.read(spark, path)
    now = everything.agg(F.max("received_ts")).first()[0]
    for question in (lambda t: history.recent_vitals(t, now, hours=24), lambda t: history.device_avg_hr(t, now, hours=24),
                     lambda t: history.daily_vitals(t, now, days=2), lambda t: history.device_day_stats(t, now)):
        assert "event_date" in partition_filters(question(everything))
    narrow = live.read(spark, path, start=now - dt.timedelta(days=2))
    assert len(narrow.inputFiles()) < len(everything.inputFiles()) / 5
    expected = everything.filter(F.col("timestamp") >= F.lit(now - dt.timedelta(days=2))).count()
    assert narrow.count() == expected > 0


@pytest.mark.parametrize("name", ["stored_recent_vitals", "stored_device_avg_hr", "stored_daily_vitals"])
def test_registered_queries_prune(spark, name):
    assert "event_date" in partition_filters(entry_module.queries()[name](spark, SMALL))
