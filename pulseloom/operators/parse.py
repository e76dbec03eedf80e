"""Raw messages to records, one parse per message.

Both profiles add a ``route`` and the columns of both record kinds to each
message. A sink then filters on ``route`` and selects its columns; nothing is
parsed a second time.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from pulseloom.functions import classify, derive, document as d, times
from pulseloom.functions.classify import DIAPER, VITAL
from pulseloom.functions.document import Keys
from pulseloom.operators import validate

INVALID, DROPPED, LATE = "invalid", "dropped", "late"

# Fixed values: (column, JSON key, type) of the typed records.
SHARED_FIELDS = (
    ("battery_level", "battery level", "int"),
    ("serial_no", "serial no", "int"),
)
VITAL_FIELDS = (
    ("sos", "SOS", "int"),
    ("heart_rate", "hr", "int"),
    ("sp_o2", "spO2", "int"),
    ("bp_systolic", "bp syst", "int"),
    ("bp_diastolic", "bp diast", "int"),
    ("skin_temp", "skin temp", "double"),
    ("room_temp", "room temp", "double"),
    ("steps", "steps", "int"),
    ("sleep_time", "sleep time", "string"),
    ("wake_time", "wake time", "string"),
    ("light_sleep_min", "light sleep (min)", "int"),
    ("deep_sleep_min", "deep sleep (min)", "int"),
    ("move", "move", "int"),
    ("wear", "wear", "int"),
)
DIAPER_FIELDS = (
    ("name", "name", "string"),
    ("firmware_version", "fw ver", "string"),
    ("temperature", "temp", "double"),
    ("humidity", "humi", "double"),
    ("button", "button", "int"),
    ("message_index", "mssg idx", "int"),
    ("acknowledgement", "ack", "int"),
)

# Column order of the tables.
VITAL_COLUMNS = (
    "content", "gateway_id", "device_id", "mac", "sos", "heart_rate", "sp_o2", "bp_systolic",
    "bp_diastolic", "skin_temp", "room_temp", "steps", "sleep_time", "wake_time",
    "light_sleep_min", "deep_sleep_min", "move", "wear", "battery_level", "serial_no",
    "timestamp", "message_type",
)
DIAPER_COLUMNS = (
    "content", "gateway_id", "device_id", "mac", "name", "firmware_version", "temperature",
    "humidity", "button", "button_status", "diaper_status", "message_index", "acknowledgement",
    "battery_level", "serial_no", "timestamp", "message_type",
)
LENIENT_VITAL_COLUMNS = (
    "device_id", "timestamp", "heart_rate", "systolic_bp", "diastolic_bp", "spo2", "body_temp",
    "steps", "battery_level", "processed_at",
)
LENIENT_DIAPER_COLUMNS = (
    "device_id", "timestamp", "humidity", "button_status", "battery_level", "diaper_status",
    "processed_at",
)
FLATTENED_COLUMNS = (
    "device_id", "device_type", "gateway_id", "mac", "serial_no", "content", "sos", "heart_rate",
    "spo2", "bp_systolic", "bp_diastolic", "skin_temp", "room_temp", "steps", "sleep_time",
    "wake_time", "light_sleep_min", "deep_sleep_min", "move", "wear", "battery_level",
    "timestamp", "processing_time",
)

# Opt-in: every spelling of blood oxygen seen in device messages.
ALL_SPO2_KEYS = ("spO2", "SpO2", "Spo2")


def classified(raw: DataFrame, profile: str = "typed") -> DataFrame:
    """Add ``is_json``, ``content``, ``message_type`` and ``shape`` to raw messages."""
    keys, is_json = Keys("content", "data"), F.col("_is_json")
    content = F.when(is_json, d.scalar_text(keys["content"]))
    parsed = keys.read(raw, whole_text=classify.check_profile(profile) == "lenient")
    return keys.drop(d.fence(parsed, {
        "is_json": is_json,
        "content": content,
        "message_type": classify.message_type(content, profile),
        "shape": F.when(is_json, classify.shape(keys["data"])),
    }))


# --- typed profile -----------------------------------------------------------

_TYPED_KEYS = Keys(
    "content", "gateway id", "MAC", "timestamp",
    *[key for _, key, _ in (*VITAL_FIELDS, *DIAPER_FIELDS, *SHARED_FIELDS)], *ALL_SPO2_KEYS)


def _value(node: Column, data_type: str) -> Column:
    return d.scalar_text(node) if data_type == "string" else d.as_type(node, data_type)


def _bad_type(column: str, node: Column, data_type: str) -> Column:
    """A node holds a value its column could not take.

    Null, and blank text for a number, read as no value; true and false are not numbers.
    """
    value = F.col(column)
    lost = value.isNull() & d.has_value(node)
    if data_type == "string":
        return lost
    not_blank = F.coalesce(F.length(F.trim(d.as_text(node))), F.lit(1)) > 0
    flag = value.isin(0, 1) & (d.kind(node) == "BOOLEAN")
    return (lost & not_blank) | F.coalesce(flag, F.lit(False))


# Columns are not tied to a frame. Building these takes thousands of calls into the JVM,
# so each variant is built once per process.

@cache
def _typed_values(unified_spo2: bool) -> tuple[dict[str, Column], dict[str, validate.Rules]]:
    """Columns of both tables, and per message type what makes a value unreadable."""
    keys, kind = _TYPED_KEYS, F.col("message_type")
    stamp = keys["timestamp"]
    values: dict[str, Column] = {
        "gateway_id": d.scalar_text(keys["gateway id"]),
        "mac": d.scalar_text(keys["MAC"]),
        "timestamp": F.when(stamp.isNull(), F.col("received_ts")).otherwise(
            times.from_millis(d.as_type(stamp, "bigint"))),
    }
    bad_time = F.col("timestamp").isNull() | F.coalesce(d.kind(stamp) == "BOOLEAN", F.lit(False))
    bad = {VITAL.name: {"bad_timestamp": bad_time}, DIAPER.name: {"bad_timestamp": bad_time}}
    groups = ((VITAL_FIELDS, (VITAL.name,)), (DIAPER_FIELDS, (DIAPER.name,)),
              (SHARED_FIELDS, (VITAL.name, DIAPER.name)))
    for fields, kinds in groups:
        for column, key, data_type in fields:
            node = keys[key]
            if column == "sp_o2" and unified_spo2:
                node = keys.first_present(*ALL_SPO2_KEYS)
            values[column] = F.when(kind.isin(*kinds), _value(node, data_type))
            unreadable = _bad_type(column, node, data_type)
            for name in kinds:
                bad[name][f"bad_{column}"] = unreadable
    return values, bad


@cache
def _typed_outcome(mac_length: bool, unified_spo2: bool) -> tuple[Column, dict[str, Column]]:
    """Why a message is invalid (null when it is not), and the columns that follow from it."""
    _, bad = _typed_values(unified_spo2)
    kind, is_json = F.col("message_type"), F.col("_is_json")
    is_vital, is_diaper = kind == VITAL.name, kind == DIAPER.name
    unknown = {
        "malformed_json": ~is_json,
        "missing_content": is_json & F.col("content").isNull(),
        "unknown_content": F.col("content").isNotNull() & kind.isNull(),
    }
    missing = {"missing_gateway_id": F.col("gateway_id").isNull(),
               "missing_mac": F.col("mac").isNull()}

    def rules(base: validate.Rules) -> validate.Rules:
        # an absent id is reported once, as missing
        present = {name: rule & F.col(name.removeprefix("blank_")).isNotNull()
                   for name, rule in base.items() if name.startswith("blank_")}
        return {**missing, **base, **present}

    checks = {VITAL.name: rules(validate.vitals_rules(mac_length)),
              DIAPER.name: rules(validate.diaper_rules(mac_length))}

    def by_kind(rule_sets: dict[str, validate.Rules], what) -> Column:
        return F.when(is_vital, what(rule_sets[VITAL.name])).when(
            is_diaper, what(rule_sets[DIAPER.name]))

    # a value of the wrong type stops the reading of a record, so its ranges are not judged
    verdict = (F.when(kind.isNull(), "unknown")
               .when(by_kind(bad, validate.any_failed), "type")
               .when(by_kind(checks, validate.any_failed), "rule"))
    found = F.col("_verdict")
    return verdict, {
        "route": F.when(found.isNotNull(), INVALID).otherwise(classify.table_of(kind)),
        "reasons": F.when(found == "unknown", validate.failed_names(unknown))
        .when(found == "type", by_kind(bad, validate.failed_names))
        .when(found == "rule", by_kind(checks, validate.failed_names))
        .otherwise(F.array().cast("array<string>")),
        "device_id": F.col("mac"),
        "button_status": F.when(is_diaper, derive.button_label(F.col("button"))),
        "diaper_status": F.when(is_diaper, derive.diaper_label(F.col("humidity"))),
    }


def typed(raw: DataFrame, mac_length: bool = False, unified_spo2: bool = False) -> DataFrame:
    """Typed profile: parse, convert and validate every message.

    Adds ``route`` (a history table or ``invalid``), ``reasons`` and the columns of
    both typed tables. "Now" is the arrival time, so a rerun gives the same rows.
    """
    content = d.scalar_text(_TYPED_KEYS["content"])
    messages = _TYPED_KEYS.read(raw).withColumn("content", content).withColumn(
        "message_type", classify.message_type(F.col("content")))
    values, _ = _typed_values(unified_spo2)
    verdict, outcome = _typed_outcome(mac_length, unified_spo2)
    judged = d.fence(messages.withColumns(values), {"_verdict": verdict})
    return _TYPED_KEYS.drop(judged.withColumns(outcome)).drop("_verdict")


# --- lenient profile ---------------------------------------------------------

_LENIENT_KEYS = Keys(
    "content", "data", "device_id", "MAC", "receivedAt", "timestamp", "hr", "bp syst", "bp_syst",
    "bp diast", "bp_diast", "skin temp", "skin_temp", "room temp", "room_temp", "steps",
    "battery level", "battery_level", "humi", "humidity", "button", "button_status",
    *ALL_SPO2_KEYS)


def _not_a_number(value: Column) -> Column:
    """A present value that cannot be compared with a number."""
    return F.coalesce(d.kind(value).rlike("^(STRING|VOID|OBJECT|ARRAY)"), F.lit(False))


@cache
def _lenient_values(unified_spo2: bool) -> dict[str, Column]:
    keys, data = _LENIENT_KEYS, _LENIENT_KEYS["data"]
    content, kind = F.col("content"), F.col("message_type")
    nested = data.isNotNull()
    vital, diaper = kind == VITAL.name, kind == DIAPER.name
    spo2_keys = ALL_SPO2_KEYS if unified_spo2 else ("SpO2", "Spo2")

    def inner(*names: str) -> Column:
        return d.child(data, *names)

    def either(inside: Column, outside: Column) -> Column:
        return F.when(nested, inside).otherwise(outside)

    def with_default(node: Column, data_type: str, default: Column) -> Column:
        """Flat records fill an absent key; a JSON null there stays empty."""
        return F.when(~nested & node.isNull(), default).otherwise(d.as_type(node, data_type))

    device = either(keys["device_id"], keys.first_present("MAC", "device_id"))
    stamp = times.stamp_node(keys["receivedAt"], keys["timestamp"])
    sent = keys["timestamp"]
    humidity = either(inner("humidity"), keys.first_present("humi", "humidity"))
    text_humidity = diaper & _not_a_number(humidity)
    level = F.when(~text_humidity, F.coalesce(d.as_type(humidity, "double"), F.lit(0.0)))
    button = either(inner("button_status"), keys.first_present("button", "button_status"))
    text_button = nested & d.is_text(button)
    body_temp = either(inner("temperature", "body_temp"),
                       keys.first_present("skin temp", "skin_temp", "room temp", "room_temp"))
    steps = either(inner("steps"), keys["steps"])
    nodes = {
        "heart_rate": either(inner("heart_rate"), keys["hr"]),
        "systolic_bp": either(inner("systolic_bp"), keys.first_present("bp syst", "bp_syst")),
        "diastolic_bp": either(inner("diastolic_bp"), keys.first_present("bp diast", "bp_diast")),
        "spo2": either(inner("spo2"), keys.first_present(*spo2_keys)),
        "battery_level": either(inner("battery_level"), keys.first_present("battery level", "battery_level")),
    }
    numbers = {name: d.as_type(node, "int") for name, node in nodes.items()}
    pressed = F.when(text_button, derive.hex_to_int(d.as_text(button))).otherwise(d.as_type(button, "int"))

    def lost(node: Column, value: Column, of: Column) -> Column:
        """A present value that has no number of its own: kept as a reject, not as a null."""
        present = node.isNotNull() & ~d.kind(node).startswith("VOID")
        return F.coalesce(of & present & value.isNull(), F.lit(False))

    unusable = {
        "malformed_json": ~F.col("_is_json"),
        "missing_content": F.col("_is_json") & content.isNull(),
        "unknown_content": content.isNotNull() & kind.isNull(),
        "bad_data": nested & ~d.is_object(data),
        "bad_timestamp": ~nested & stamp.isNotNull() & ~d.is_text(stamp),
        "bad_humidity": F.coalesce(text_humidity, F.lit(False)),
        **{f"bad_{name}": lost(node, numbers[name], vital if name != "battery_level" else vital | diaper)
           for name, node in nodes.items()},
        "bad_body_temp": lost(body_temp, d.as_type(body_temp, "double"), vital),
        "bad_steps": lost(steps, d.as_type(steps, "int"), vital),
        "bad_button_status": lost(button, pressed, diaper),
    }
    no_device = ~nested & (~d.truthy(device) | (d.as_text(device) == "unknown"))
    values = {
        "reasons": validate.reasons(validate.any_failed(unusable), unusable),
        "no_device": F.coalesce(no_device, F.lit(False)),
        "device_id": d.as_text(device),
        "timestamp": either(
            F.when(d.is_text(sent), times.from_text(d.as_text(sent))),
            times.event_time(F.when(d.is_text(stamp) | stamp.isNull(), stamp), F.col("received_ts"))),
        **numbers,
        "body_temp": with_default(body_temp, "double", F.lit(0.0)),
        "steps": with_default(steps, "int", F.lit(0)),
        "humidity": F.when(~(nested & humidity.isNull()), level.cast("int")),
        "diaper_status": derive.diaper_level(level),
        "button_status": pressed,
    }
    only_vital = ("heart_rate", "systolic_bp", "diastolic_bp", "spo2", "body_temp", "steps")
    only_diaper = ("humidity", "diaper_status", "button_status")
    for column in only_vital:
        values[column] = F.when(vital, values[column])
    for column in only_diaper:
        values[column] = F.when(diaper, values[column])
    return values


def lenient(raw: DataFrame, unified_spo2: bool = False) -> DataFrame:
    """Lenient profile: spaced, underscored and nested payloads, no range checks.

    Routes: a history table, ``invalid``, or ``dropped`` for a flat record without a
    usable device id, which the history tables and the dead letters both leave out.
    """
    keys = _LENIENT_KEYS
    text = F.when(F.col("_is_json"), d.scalar_text(keys["content"]))
    messages = keys.read(raw, whole_text=True).withColumn("content", text).withColumn(
        "message_type", classify.message_type(F.col("content"), "lenient"))
    records = keys.drop(d.fence(messages, _lenient_values(unified_spo2)))
    route = F.when(F.size("reasons") > 0, INVALID).when(F.col("no_device"), DROPPED).otherwise(
        classify.table_of(F.col("message_type")))
    return records.withColumns({"route": route, "processed_at": F.col("received_ts")}).drop("no_device")


def parse(raw: DataFrame, profile: str = "typed", **options) -> DataFrame:
    return (lenient if classify.check_profile(profile) == "lenient" else typed)(raw, **options)


# --- record tables -----------------------------------------------------------

def records(parsed: DataFrame, kind: classify.MessageKind, columns: tuple[str, ...],
            *extra: str) -> DataFrame:
    """Rows routed to one history table, with that table's columns."""
    return parsed.filter(F.col("route") == kind.table).select(*extra, *columns)


def vitals(parsed: DataFrame, *extra: str) -> DataFrame:
    return records(parsed, VITAL, VITAL_COLUMNS, *extra)


def diapers(parsed: DataFrame, *extra: str) -> DataFrame:
    return records(parsed, DIAPER, DIAPER_COLUMNS, *extra)


def lenient_vitals(parsed: DataFrame, *extra: str) -> DataFrame:
    return records(parsed, VITAL, LENIENT_VITAL_COLUMNS, *extra)


def lenient_diapers(parsed: DataFrame, *extra: str) -> DataFrame:
    return records(parsed, DIAPER, LENIENT_DIAPER_COLUMNS, *extra)


def rejects(parsed: DataFrame, profile: str = "typed") -> DataFrame:
    """Dead letters with the reasons of their rejection."""
    return parsed.filter(F.col("route").isin(INVALID, LATE)).select(
        "msg_id", "received_ts", "payload", F.lit(profile).alias("profile"), "route", "reasons")


def lenient_as_typed(parsed: DataFrame) -> DataFrame:
    """Lenient rows under typed names; columns the profile does not read are null."""
    renamed = {
        "mac": F.col("device_id"), "sp_o2": F.col("spo2"), "bp_systolic": F.col("systolic_bp"),
        "bp_diastolic": F.col("diastolic_bp"), "skin_temp": F.col("body_temp"),
        "humidity": F.col("humidity").cast("double"), "button": F.col("button_status"),
        "button_status": F.when(F.col("message_type") == DIAPER.name,
                                derive.button_label(F.col("button_status"))),
    }
    absent = [("gateway_id", "string")] + [
        (c, t) for c, _, t in (*VITAL_FIELDS, *DIAPER_FIELDS, *SHARED_FIELDS)
        if c not in renamed and c not in parsed.columns]
    return parsed.withColumns({**renamed, **{c: F.lit(None).cast(t) for c, t in absent}})


def flattened(vital_records: DataFrame, processed: str = "received_ts", *extra: str) -> DataFrame:
    """Legacy flat record: the serial number is the device, every device a gateway's."""
    return vital_records.withColumns({
        "device_id": F.col("serial_no").cast("string"),
        "device_type": F.lit("gateway"),
        "spo2": F.col("sp_o2"),
        "processing_time": F.col(processed),
    }).select(*extra, *FLATTENED_COLUMNS)
