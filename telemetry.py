"""A telemetry stream derived from the ``events`` table.

Every event becomes one message; every third is repeated 3 seconds later and
every seventh 6 seconds later. The event number picks one of twenty payload
forms, so all shapes, faults and range violations occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

# (copy number, seconds of delay, every how many events)
_COPIES = ((0, 0, 1), (1, 3, 3), (2, 6, 7))


def _text(value: Column) -> Column:
    return value.cast("string")


def _template(form: str, fields: dict[str, Column]) -> Column:
    """Fill ``<name>`` marks of a JSON template with columns."""
    parts: list[Column] = []
    for piece in form.split("<"):
        name, mark, tail = piece.partition(">")
        if mark:
            parts += [fields[name], F.lit(tail)]
        else:
            parts.append(F.lit(piece))
    return F.concat(*parts)


# Payload forms by upper bound of ``event_id % 20``.
_FORMS = (
    (8, '{"content":"300B","gateway id":"<gw>","MAC":"<mac>","hr":<hr>,"spO2":<spo2>,'
        '"bp syst":<sys>,"bp diast":<dia>,"skin temp":<skin>,"battery level":<batt>}'),
    (10, '{"content":"300B","gateway id":"<gw>","MAC":"<mac>","hr":<hr>,"Spo2":<spo2>,'
         '"bp_syst":<sys>,"bp_diast":<dia>,"skin_temp":<skin>,"battery_level":<batt>}'),
    (11, '{"content":"300B","device_id":"<mac>","data":{"heart_rate":<hr>,"systolic_bp":<sys>,'
         '"diastolic_bp":<dia>,"spo2":<spo2>,"temperature":<skin>}}'),
    (14, '{"content":"diaper DV1","gateway id":"<gw>","MAC":"<mac>","temp":<skin>,'
         '"humi":<humi>,"button":<btn>,"battery level":<batt>}'),
    (15, '{"content":"DV1","gateway id":"<gw>","MAC":"<mac>","humi":<humi>}'),
    (16, '{"content":"Diaper DV1","device_id":"<mac>","data":{"humidity":<humi>,'
         '"temperature":<skin>,"button_status":"0x0<btn>"}}'),
    (17, '{"content":"location","gateway id":"<gw>","MAC":"<mac>"}'),
    (18, '{"gateway id":"<gw>","MAC":"<mac>","hr":<hr>}'),
    (19, '{"content":"300B","gateway id":"<gw>","hr":<hr>}'),
    (20, '{"content":"300B","MAC":"<mac>'),
)


def from_events(events: DataFrame) -> DataFrame:
    """Raw messages of an ``events`` frame, batch or streaming.

    The copies are an ``explode`` of a per-row array, so the table is scanned once.
    """
    e = F.col("event_id")
    lags = [F.when(e % every == 0, F.struct(F.lit(n).alias("n"), F.lit(lag).alias("lag")))
            for n, lag, every in _COPIES]
    copies = (
        events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"),
                      F.explode(F.array(*lags)).alias("copy"))
        .filter(F.col("copy").isNotNull())
    )
    fields = {
        "mac": F.concat(F.lit("MAC"), F.lpad(_text(F.col("user_id")), 6, "0")),
        "gw": F.concat(F.lit("GW"), F.lpad(_text(F.col("user_id") % 10), 4, "0")),
        "hr": _text(25 + (e * 7) % 210),
        "spo2": _text(68 + e % 35),
        "sys": _text(45 + e % 215),
        "dia": _text(25 + e % 130),
        "skin": F.concat(_text(29 + e % 18), F.lit("."), _text(e % 10)),
        "humi": _text(e % 105),
        "btn": _text(e % 4),
        "batt": _text(e % 101),
    }
    payload = F.lit(None).cast("string")
    for bound, form in reversed(_FORMS):
        payload = F.when(e % 20 < bound, _template(form, fields)).otherwise(payload)
    return copies.select(
        (e * 10 + F.col("copy.n")).alias("msg_id"),
        (F.date_trunc("second", "ts") + F.make_dt_interval(secs=F.col("copy.lag"))).alias("received_ts"),
        payload.alias("payload"),
    )


def _dealt(events: DataFrame) -> DataFrame:
    """Events dealt out by id: one file may be a single split."""
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return events.select("event_id", "ts", "user_id").repartition(parts, "event_id")


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of the event table."""
    return from_events(_dealt(spark.read.parquet(f"{folder}/events.parquet")))


def raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages as a stream over the event files of a folder."""
    events = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{folder}/events*.parquet")
    return from_events(_dealt(events))
