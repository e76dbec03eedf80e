"""Sources, history layout, pruning and retention."""

import datetime as dt
import json

from pyspark.sql import functions as F

import telemetry
from conftest import SMALL
from pulseloom.operators import parse, sinks
from pulseloom.plans import history
from pulseloom.sources import history as history_source, raw as raw_source


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_pruned_by_day(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_history(parse.typed(telemetry.raw_messages(spark, SMALL)), root)
    start, end = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12)
    rows = history_source.read_history(spark, root, "vital_signs", start, end)
    plan = plan_of(rows)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in filters and "PushedFilters: [IsNotNull(timestamp)" in plan
    everything = spark.read.parquet(f"{root}/vital_signs")
    expected = everything.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end)).count()
    assert rows.count() == expected > 0

    as_of = everything.agg(F.max("timestamp")).first()[0]
    recent = history.recent_vitals(everything, as_of, hours=24)
    assert "TakeOrderedAndProject" in plan_of(recent)
    assert "event_date" in plan_of(recent).split("PartitionFilters: [")[1].split("]")[0]
    narrow = history.device_avg_hr(everything, as_of, hours=24)
    assert "ReadSchema: struct<device_id:string,heart_rate:int,timestamp:timestamp>" in plan_of(narrow)


def test_expire(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_history(parse.typed(telemetry.raw_messages(spark, SMALL)), root)
    table = spark.read.parquet(f"{root}/vital_signs")
    as_of = dt.datetime(2024, 1, 30, 12)
    kept = sinks.retained(table, as_of, 7).count()
    gone = sinks.expire(spark, root, "vital_signs", as_of, 7)
    assert gone[0] == "2024-01-01" and gone[-1] == "2024-01-23"
    assert spark.read.parquet(f"{root}/vital_signs").count() == kept > 0


def test_reading_files(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1), '{"content":"300B"}')]
    df = spark.createDataFrame(rows, raw_source.RAW_SCHEMA)
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j"))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text('{"content":"300B"}\n{"content":"dv1"}\n', encoding="utf-8")
    assert [tuple(r) for r in raw_source.read_raw(spark, str(tmp_path / "p")).collect()] == rows
    assert [tuple(r) for r in raw_source.read_raw(spark, str(tmp_path / "j"), "json").collect()] == rows
    text = raw_source.read_raw(spark, str(tmp_path / "t"), "text")
    assert text.columns == ["msg_id", "received_ts", "payload"]
    assert text.select("msg_id").distinct().count() == 2
    assert raw_source.decode(df.withColumn("payload", F.encode("payload", "utf-8"))).first().payload == rows[0][2]


def test_stamped_payload(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{}",), (' {"b":"}"} ',)], "payload string")
    stamped = df.select(raw_source.stamped_payload(F.lit(dt.datetime(2024, 1, 1, 2)), F.col("payload")).alias("p"))
    docs = [json.loads(r.p) for r in stamped.collect()]
    assert docs == [{"a": 1, "receivedAt": "2024-01-01T02:00:00.000000Z"}, {"receivedAt": "2024-01-01T02:00:00.000000Z"},
                    {"b": "}", "receivedAt": "2024-01-01T02:00:00.000000Z"}]


def test_topics(spark):
    df = spark.createDataFrame([("UWB/GWn4_Health",), ("UWB/a_b_Loca",), ("x/GW_Health",)], "topic string")
    got = [(r.topic_gateway, r.topic_kind) for r in raw_source.split_topic(df).collect()]
    assert got == [("GWn4", "Health"), ("a_b", "Loca"), ("", "")]
