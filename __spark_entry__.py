"""

Every query runs over the message stream derived from the whole ``events`` table.
Devices of that stream report about every ten hours, so time ranges are given in days
where the library's defaults are minutes. "Now" is the newest arrival, as a scalar
subquery inside the plan.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import oracles
import replay
import telemetry
from pulseloom.functions import classify, derive, keys
from pulseloom.operators import dedup, parse, serving, sinks, validate
from pulseloom.plans import alerts, history, lookups, quality
from pulseloom.session import configure
from pulseloom.sources import history as history_source, raw as raw_source

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

DAY = 24 * 60
DEVICE, GATEWAY = oracles.DEVICE, oracles.GATEWAY


def query(fn: Query) -> Query:
    """Register a query; timestamps leave as zone-less UTC, reasons as text."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        result = fn(spark, folder)
        shown = []
        for field in result.schema.fields:
            value = F.col(f"`{field.name}`")
            if field.dataType.typeName() == "timestamp":
                value = value.cast("timestamp_ntz")
            elif field.dataType.typeName() == "array":
                value = F.concat_ws(",", value)
            shown.append(value.alias(field.name))
        return result.select(*shown)

    _QUERIES[fn.__name__] = run
    return run


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.raw_messages(spark, folder)


def _now(spark: SparkSession, folder: str) -> Column:
    return _raw(spark, folder).agg(F.max("received_ts")).scalar()


def _typed(spark, folder) -> DataFrame:
    return parse.typed(_raw(spark, folder))


def _lenient(spark, folder) -> DataFrame:
    return parse.lenient(_raw(spark, folder))


def _vitals(spark, folder) -> DataFrame:
    return parse.vitals(_typed(spark, folder), "msg_id", "received_ts")


def _diapers(spark, folder) -> DataFrame:
    return parse.diapers(_typed(spark, folder), "msg_id", "received_ts")


def _lenient_vitals(spark, folder) -> DataFrame:
    return parse.lenient_vitals(_lenient(spark, folder), "msg_id")


def _lenient_diapers(spark, folder) -> DataFrame:
    return parse.lenient_diapers(_lenient(spark, folder), "msg_id")


def _valid(spark, folder) -> DataFrame:
    """Valid records of both types."""
    return _typed(spark, folder).filter(F.col("route") != parse.INVALID).drop("payload", "reasons", "route")


def _short(records: DataFrame) -> DataFrame:
    return records.select("msg_id", "message_type", "gateway_id", "device_id", "timestamp")


# --- sources -----------------------------------------------------------------

@query
def raw_messages(spark, folder):
    return _raw(spark, folder)


@query
def topic_parts(spark, folder):
    # broker topics of the messages: a gateway's by what they are about, others under their device
    rows = _typed(spark, folder)
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in oracles.TOPICS.items() for x in pair]),
                                   F.coalesce("message_type", F.lit(""))), F.lit("Loca"))
    topic = F.when(F.col("gateway_id").isNotNull(), F.concat(F.lit("UWB/"), "gateway_id", F.lit("_"), kind)).otherwise(
        F.concat(F.lit("OTHER/"), F.coalesce("mac", F.lit("?")), F.lit("_"), kind))
    return raw_source.split_topic(rows.select("msg_id", topic.alias("topic")))


@query
def stamped_payloads(spark, folder):
    raw = _raw(spark, folder)
    return raw.select("msg_id", raw_source.stamped_payload(F.col("received_ts"), F.col("payload")).alias("payload"))


def _bytes(spark, folder) -> DataFrame:
    """Payloads as bytes; every thirteenth event's have a byte that no UTF-8 text holds."""
    stray = F.when(F.floor(F.col("msg_id") / 10) % 13 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    return _raw(spark, folder).withColumn("payload", F.concat(F.encode("payload", "UTF-8"), stray))


@query
def undecodable_messages(spark, folder):
    return raw_source.undecodable(_bytes(spark, folder))


@query
def decodable_messages(spark, folder):
    return raw_source.decodable(_bytes(spark, folder))


# --- classification ----------------------------------------------------------

@query
def classify_typed(spark, folder):
    return parse.classified(_raw(spark, folder)).select("msg_id", "content", "message_type")


@query
def classify_lenient(spark, folder):
    return parse.classified(_raw(spark, folder), "lenient").select("msg_id", "content", "message_type")


@query
def payload_shape(spark, folder):
    return parse.classified(_raw(spark, folder)).select("msg_id", "shape")


@query
def malformed_messages(spark, folder):
    return parse.classified(_raw(spark, folder)).filter(~F.col("is_json")).select(
        "msg_id", "received_ts", "payload")


@query
def route_split(spark, folder):
    return _typed(spark, folder).select("msg_id", "message_type", "route")


@query
def route_split_lenient(spark, folder):
    return _lenient(spark, folder).select("msg_id", "message_type", "route")


@query
def table_routing(spark, folder):
    return _valid(spark, folder).groupBy("message_type").agg(
        F.first(classify.table_of(F.col("message_type"))).alias("table_name"), F.count("*").alias("row_count"))


@query
def lenient_dropped(spark, folder):
    return _lenient(spark, folder).filter(F.col("route") == parse.DROPPED).select(
        "msg_id", "received_ts", "payload")


# --- parsing -----------------------------------------------------------------

@query
def parse_vitals_typed(spark, folder):
    return _vitals(spark, folder).drop("received_ts")


@query
def parse_diaper_typed(spark, folder):
    return _diapers(spark, folder).drop("received_ts")


def _by_shape(spark, folder, table, nested: bool) -> DataFrame:
    # nested payloads of the stream carry device_id instead of MAC
    rows = table(_lenient(spark, folder), "msg_id", "payload")
    return rows.filter(F.col("payload").contains('"data":{') == nested).drop("payload")


@query
def parse_vitals_nested(spark, folder):
    return _by_shape(spark, folder, parse.lenient_vitals, True)


@query
def parse_vitals_flat(spark, folder):
    return _by_shape(spark, folder, parse.lenient_vitals, False)


@query
def parse_diaper_flat(spark, folder):
    return _by_shape(spark, folder, parse.lenient_diapers, False)


@query
def parse_diaper_nested(spark, folder):
    return _by_shape(spark, folder, parse.lenient_diapers, True)


@query
def alias_lookup(spark, folder):
    return _lenient_vitals(spark, folder).select("msg_id", "systolic_bp", "diastolic_bp", "spo2", "battery_level")


@query
def event_time(spark, folder):
    rows = _lenient(spark, folder).filter(F.col("route").isin("vital_signs", "diaper_status"))
    return rows.select("msg_id", "timestamp", "processed_at")


@query
def unified_spo2(spark, folder):
    parsed = parse.typed(_raw(spark, folder), unified_spo2=True)
    return parse.vitals(parsed, "msg_id").select("msg_id", "sp_o2")


@query
def lenient_to_typed(spark, folder):
    rows = _lenient(spark, folder).filter(F.col("route").isin("vital_signs", "diaper_status"))
    return parse.lenient_as_typed(rows).select(
        "msg_id", "message_type", "mac", "sp_o2", "bp_systolic", "skin_temp", "humidity", "button",
        "button_status")


@query
def flatten_patient_data(spark, folder):
    # the stream has no serial numbers: the battery level stands in for one
    vitals = _vitals(spark, folder).withColumn("serial_no", F.col("battery_level"))
    flat = parse.flattened(vitals)
    rules = validate.legacy_rules()
    return validate.check(flat, rules).select(
        "device_id", "device_type", "gateway_id", "mac", "serial_no", "content", "heart_rate", "spo2",
        "bp_systolic", "bp_diastolic", "skin_temp", "battery_level", "timestamp", "processing_time",
        "is_valid")


@query
def serving_keys(spark, folder):
    kind, device = F.col("message_type"), F.col("device_id")
    return _valid(spark, folder).select(
        kind, device, "gateway_id",
        keys.latest_key(kind, device).alias("latest_key"),
        keys.series_key(kind, device).alias("series_key"),
        keys.latest_key(kind, device, "lenient").alias("lenient_latest_key"),
        keys.series_key(kind, device, "lenient").alias("lenient_series_key"),
        keys.gateway_key(F.col("gateway_id")).alias("gateway_key"),
        keys.flattened_key(F.lit("gateway"), device).alias("flattened_key")).distinct()


# --- derived values ----------------------------------------------------------

def _sent_diapers(spark, folder) -> DataFrame:
    """Diaper messages as sent, valid or not."""
    return _typed(spark, folder).filter(F.col("message_type") == "DIAPER")


@query
def button_status(spark, folder):
    return _sent_diapers(spark, folder).select(
        "msg_id", "button", derive.button_label(F.col("button")).alias("button_status"))


@query
def diaper_status5(spark, folder):
    return _sent_diapers(spark, folder).select(
        "msg_id", "humidity", derive.diaper_label(F.col("humidity")).alias("diaper_status"))


@query
def diaper_status3(spark, folder):
    return _sent_diapers(spark, folder).select(
        "msg_id", "humidity", derive.diaper_level(F.col("humidity")).alias("diaper_status"))


@query
def hex_button(spark, folder):
    # the first of these that a payload has, read as hexadecimal; an address is none
    paths = ("$.data.button_status", "$.button", "$.hr", "$.MAC")
    text = F.coalesce(*[F.get_json_object("payload", path) for path in paths])
    return _raw(spark, folder).select(
        "msg_id", text.alias("button_text"), derive.hex_to_int(text).cast("bigint").alias("button"))


# --- validation --------------------------------------------------------------

@query
def validate_vitals(spark, folder):
    return _typed(spark, folder).filter(F.col("message_type") == "VITAL_SIGN").select(
        "msg_id", (F.col("route") != parse.INVALID).alias("is_valid"))


@query
def validate_diaper(spark, folder):
    return _typed(spark, folder).filter(F.col("message_type") == "DIAPER").select(
        "msg_id", (F.col("route") != parse.INVALID).alias("is_valid"))


@query
def mac_length(spark, folder):
    # addresses as some gateways shorten them, without zeros
    short = _typed(spark, folder).filter(F.col("mac").isNotNull()).select(
        "msg_id", F.regexp_replace("mac", "0", "").alias("mac"))
    return short.select("msg_id", "mac", (~validate.mac_too_short()).alias("is_valid"))


@query
def reject_reasons(spark, folder):
    return parse.rejects(_typed(spark, folder)).select("msg_id", "reasons")


# --- deduplication -----------------------------------------------------------

@query
def dedup_windows(spark, folder):
    return dedup.with_window(_short(_valid(spark, folder)))


@query
def dedup_tumbling(spark, folder):
    return _short(dedup.tumbling(_valid(spark, folder)))


@query
def dedup_throttle(spark, folder):
    return _short(dedup.throttle(_valid(spark, folder)))


@query
def dedup_throttle_payload(spark, folder):
    raw = _raw(spark, folder)
    return dedup.throttle(raw, ["payload"], time="received_ts").select("msg_id", "received_ts")


@query
def dedup_flattened(spark, folder):
    vitals = _vitals(spark, folder).withColumn("serial_no", F.col("battery_level"))
    flat = parse.flattened(vitals, "received_ts", "msg_id")
    return dedup.tumbling(flat, dedup.LEGACY_KEY).select("msg_id", "device_id", "gateway_id", "timestamp")


@query
def stream_tumbling(spark, folder):
    return _short(replay.tumbled(spark, folder))


@query
def stream_throttle(spark, folder):
    return _short(replay.throttled(spark, folder))


@query
def late_rows(spark, folder):
    return replay.late_windows(spark, folder, oracles.LATENESS, "1 hour")


@query
def stream_pipeline(spark, folder):
    return replay.pipeline_counts(spark, folder)


# --- hot views ---------------------------------------------------------------

HALF_DAY = 12 * 3600


def _latest(spark, folder) -> DataFrame:
    return serving.latest(_valid(spark, folder), _now(spark, folder), 10 * HALF_DAY)


def _series(spark, folder) -> DataFrame:
    return serving.series(_valid(spark, folder))


@query
def latest_per_device(spark, folder):
    newest = _latest(spark, folder)
    return newest.select(
        "msg_id", "message_type", "device_id", "timestamp",
        serving.key_column().alias("hot_key"),
        serving.as_json(newest, "device_id", "heart_rate", "humidity", "battery_level").alias("value"))


@query
def hot_entries(spark, folder):
    return serving.entries(_valid(spark, folder)).drop("value")


@query
def hot_series(spark, folder):
    return _series(spark, folder).select("msg_id", "message_type", "device_id", "timestamp", "position")


@query
def hot_series_ttl(spark, folder):
    return serving.series(_valid(spark, folder), cap=5, ttl=HALF_DAY, as_of=_now(spark, folder)).select(
        "msg_id", "message_type", "device_id", "timestamp", "position")


@query
def stream_hot_series(spark, folder):
    rows = replay.keyed_series(spark, folder, 5, HALF_DAY, _now(spark, folder))
    return rows.select("msg_id", "message_type", "device_id", "timestamp", "position")


@query
def stream_gateway_devices(spark, folder):
    return replay.keyed_gateways(spark, folder, 3 * 3600, _now(spark, folder)).select(
        "gateway_id", "device_id", "last_seen")


@query
def gateway_devices(spark, folder):
    return serving.gateway_index(_valid(spark, folder), _now(spark, folder), 3 * 3600).select(
        "gateway_id", "device_id", "last_seen")


@query
def gateway_sets(spark, folder):
    return serving.gateway_sets(
        serving.gateway_index(_valid(spark, folder), _now(spark, folder), 3 * 3600))


@query
def latest_lookup(spark, folder):
    return lookups.latest_lookup(_latest(spark, folder), DEVICE, "MAC000002").select(
        "msg_id", "message_type", "device_id", "timestamp")


@query
def series_tail(spark, folder):
    return lookups.series_tail(_series(spark, folder)).select(
        "message_type", "device_id", "position", "score")


@query
def series_length(spark, folder):
    return lookups.series_length(_series(spark, folder))


@query
def gateway_lookup(spark, folder):
    index = serving.gateway_index(_valid(spark, folder), _now(spark, folder), 3 * 3600)
    return lookups.gateway_lookup(index, GATEWAY, "GW0003")


@query
def latest_ttl(spark, folder):
    return lookups.latest_ttl(_latest(spark, folder), _now(spark, folder), 10 * HALF_DAY)


@query
def live_devices(spark, folder):
    return lookups.live_devices(_latest(spark, folder))


@query
def tiered_range(spark, folder):
    now = _now(spark, folder)
    start = now - F.expr("INTERVAL 5 DAYS")
    vitals = replay.staged(spark, _vitals(spark, folder))
    hot = serving.series(vitals, oracles.TIER_CAP, ttl=10 * HALF_DAY, as_of=now)
    rows = lookups.tiered_range(hot, vitals, start, now, HALF_DAY, cap=oracles.TIER_CAP)
    return rows.select("msg_id", "device_id", "heart_rate", "timestamp", "tier")


# --- history -----------------------------------------------------------------

@query
def dead_letters(spark, folder):
    return parse.rejects(_typed(spark, folder))


@query
def retained_days(spark, folder):
    rows = _vitals(spark, folder).withColumn("event_date", F.to_date("timestamp"))
    return sinks.retained(rows, _now(spark, folder), 7).groupBy("event_date").agg(F.count("*").alias("row_count"))


@query
def recent_vitals(spark, folder):
    return history.recent_vitals(_vitals(spark, folder), _now(spark, folder), hours=48)


@query
def device_day_stats(spark, folder):
    # the day before deduplication: five-second windows never cross midnight
    now = _now(spark, folder)
    return history.device_day_stats(dedup.tumbling(history.of_day(_vitals(spark, folder), now)), now)


@query
def device_avg_hr(spark, folder):
    return history.device_avg_hr(_vitals(spark, folder), _now(spark, folder), hours=48)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def daily_vitals(spark, folder):
    return history.daily_vitals(_vitals(spark, folder), _now(spark, folder), days=10)


@query
def daily_diaper(spark, folder):
    daily = history.daily_diaper(_diapers(spark, folder), _now(spark, folder), days=10)
    return _rounded(daily, "avg_humidity", "avg_temp")


@query
def device_activity(spark, folder):
    return history.device_activity(_lenient_vitals(spark, folder), _now(spark, folder), mins=DAY)


@query
def device_history(spark, folder):
    return history.device_history(_vitals(spark, folder), DEVICE).select(
        "msg_id", "device_id", "heart_rate", "sp_o2", "timestamp")


@query
def device_inventory(spark, folder):
    return history.device_inventory(_vitals(spark, folder))


@query
def latest_rows(spark, folder):
    return history.latest_rows(_lenient_vitals(spark, folder))


@query
def timestamped_rows(spark, folder):
    return history.timestamped_rows(_lenient_vitals(spark, folder))


@query
def missing_device_share(spark, folder):
    # counted before the lenient profile drops such records
    rows = _lenient(spark, folder).filter(F.col("message_type").isNotNull())
    return history.missing_device_share(rows, _now(spark, folder), mins=10 * DAY)


@query
def avg_latency(spark, folder):
    # processing ends with the five-second window a message arrives in
    done = F.window("received_ts", "5 seconds")["end"]
    vitals = _vitals(spark, folder).withColumn("done_ts", done)
    flat = parse.flattened(vitals, "done_ts")
    return _rounded(history.avg_latency(flat, _now(spark, folder), mins=10 * DAY), "avg_latency_ms")


@query
def recent_rows(spark, folder):
    return history.recent_rows(_lenient_diapers(spark, folder), _now(spark, folder), mins=2 * DAY)


@query
def device_minute_count(spark, folder):
    return history.device_minute_count(_vitals(spark, folder), DEVICE, _now(spark, folder), mins=20 * DAY)


@query
def table_counts(spark, folder):
    return history.table_counts(_typed(spark, folder))


@query
def by_serial(spark, folder):
    vitals = _vitals(spark, folder).withColumn("serial_no", F.col("battery_level"))
    return history.by_serial(vitals, 50, 3).select("msg_id", "device_id", "serial_no", "timestamp")


@query
def newest_rows(spark, folder):
    return history.newest_rows(_diapers(spark, folder)).drop("received_ts")


# --- questions over stored tables ---------------------------------------------

def _stored(spark, folder, table, **back) -> tuple[DataFrame, object]:
    """A stored history table from so long before the newest arrival on, and that arrival."""
    now = _raw(spark, folder).agg(F.max("received_ts")).first()[0]
    start = now and now - datetime.timedelta(**back)
    return history_source.read_history(spark, replay.stored(spark, folder), table, start), now


@query
def stored_recent_vitals(spark, folder):
    table, now = _stored(spark, folder, "vital_signs", hours=48)
    return history.recent_vitals(table, now, hours=48)


@query
def stored_device_avg_hr(spark, folder):
    table, now = _stored(spark, folder, "vital_signs", hours=48)
    return history.device_avg_hr(table, now, hours=48)


@query
def stored_daily_vitals(spark, folder):
    table, now = _stored(spark, folder, "vital_signs", days=10)
    return history.daily_vitals(table, now, days=10)


@query
def stored_daily_diaper(spark, folder):
    table, now = _stored(spark, folder, "diaper_status", days=10)
    return _rounded(history.daily_diaper(table, now, days=10), "avg_humidity", "avg_temp")


@query
def stored_day_counts(spark, folder):
    table = history_source.read_history(spark, replay.stored(spark, folder), "diaper_status")
    return table.groupBy("event_date").agg(F.count("*").alias("row_count"))


# --- message flow ------------------------------------------------------------

@query
def reconcile_devices(spark, folder):
    sent = spark.read.parquet(f"{folder}/events.parquet").select(
        F.concat(F.lit("MAC"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("device_id"))
    stored = history.since(_diapers(spark, folder), _now(spark, folder), mins=5 * DAY)
    return quality.reconcile(sent, stored)


@query
def missing_devices(spark, folder):
    sent = spark.read.parquet(f"{folder}/events.parquet").select(
        F.concat(F.lit("MAC"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("device_id"))
    stored = history.since(_diapers(spark, folder), _now(spark, folder), mins=5 * DAY)
    return quality.missing_devices(sent, stored)


@query
def new_per_interval(spark, folder):
    return quality.new_per_interval(_raw(spark, folder))


@query
def message_mix(spark, folder):
    return quality.message_mix(parse.classified(_raw(spark, folder)))


@query
def route_rates(spark, folder):
    return _rounded(quality.route_rates(_typed(spark, folder)), "success_rate")


@query
def window_error_rate(spark, folder):
    return _rounded(quality.window_error_rate(_typed(spark, folder), minutes=60), "error_rate")


@query
def window_latency(spark, folder):
    done = F.window("received_ts", "5 seconds")["end"]
    rows = _vitals(spark, folder).withColumn("done_ts", done)
    return _rounded(quality.window_latency(rows, "done_ts", minutes=DAY, exact=True), "p50_ms", "p99_ms")


@query
def new_since_check(spark, folder):
    return replay.checked(spark, folder)


@query
def error_alerts(spark, folder):
    return _rounded(alerts.error_alerts(_typed(spark, folder), minutes=60, hold=120), "peak")


def _latency_sketch(spark, folder) -> DataFrame:
    done = F.window("received_ts", "5 seconds")["end"]
    latency = F.unix_millis(done) - F.unix_millis("timestamp")
    return alerts.sketch(_vitals(spark, folder), latency, minutes=60)


@query
def latency_sketch(spark, folder):
    return alerts.quantiles(alerts.merged(_latency_sketch(spark, folder), DAY), 0.5, 0.99)


@query
def latency_alerts(spark, folder):
    return alerts.latency_alerts(_latency_sketch(spark, folder), minutes=6 * 60, hold=DAY, limit=4000)


# --- operators for training data, where they are installed ---

_SQL: dict[str, str] = {}
try:
    import corpus_pipeline
    from pulseloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # both are optional together; anything else that is missing is an error
    if missing.name not in ("corpus_pipeline", "pulseloom.llm"):
        raise
else:
    _QUERIES |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    _SQL |= llm_queries.SQL
    if corpus_pipeline.ORACLE_SQL:
        _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


# --- contract ----------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Per-device statistics of the newest day after parsing, validation and deduplication."""
    return _QUERIES["device_day_stats"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in (oracles.all_sql() | _SQL).items() if name in _QUERIES}
