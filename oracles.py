"""DuckDB counterparts of the registered queries, written independently of the library."""

from __future__ import annotations

DEVICE, GATEWAY = "MAC000001", "GW0001"
TIER_CAP = 5  # a series so short that devices fill it within the hot tier
LATENESS = 60  # seconds that the pipeline waits for rows out of order
TOPICS = {"VITAL_SIGN": "Health", "DIAPER": "Message"}  # other messages: Loca

RAW = """
copies AS (
  SELECT event_id, ts, user_id, 0 AS copy_no, 0 AS lag_s FROM events
  UNION ALL SELECT event_id, ts, user_id, 1, 3 FROM events WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, ts, user_id, 2, 6 FROM events WHERE event_id % 7 = 0
), base AS (
  SELECT event_id * 10 + copy_no AS msg_id,
         date_trunc('second', ts) + lag_s * INTERVAL '1' SECOND AS received_ts,
         event_id % 20 AS kind,
         concat('MAC', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS mac,
         concat('GW', lpad(CAST(user_id % 10 AS VARCHAR), 4, '0')) AS gateway_id,
         CAST(25 + (event_id * 7) % 210 AS VARCHAR) AS hr,
         CAST(68 + event_id % 35 AS VARCHAR) AS spo2,
         CAST(45 + event_id % 215 AS VARCHAR) AS sys,
         CAST(25 + event_id % 130 AS VARCHAR) AS dia,
         concat(CAST(29 + event_id % 18 AS VARCHAR), '.', CAST(event_id % 10 AS VARCHAR)) AS skin,
         CAST(event_id % 105 AS VARCHAR) AS humi,
         CAST(event_id % 4 AS VARCHAR) AS btn,
         CAST(event_id % 101 AS VARCHAR) AS batt
  FROM copies
), raw AS (
SELECT msg_id, received_ts, CASE
  WHEN kind < 8 THEN concat('{"content":"300B","gateway id":"', gateway_id, '","MAC":"', mac, '","hr":', hr, ',"spO2":', spo2, ',"bp syst":', sys, ',"bp diast":', dia, ',"skin temp":', skin, ',"battery level":', batt, '}')
  WHEN kind < 10 THEN concat('{"content":"300B","gateway id":"', gateway_id, '","MAC":"', mac, '","hr":', hr, ',"Spo2":', spo2, ',"bp_syst":', sys, ',"bp_diast":', dia, ',"skin_temp":', skin, ',"battery_level":', batt, '}')
  WHEN kind = 10 THEN concat('{"content":"300B","device_id":"', mac, '","data":{"heart_rate":', hr, ',"systolic_bp":', sys, ',"diastolic_bp":', dia, ',"spo2":', spo2, ',"temperature":', skin, '}}')
  WHEN kind < 14 THEN concat('{"content":"diaper DV1","gateway id":"', gateway_id, '","MAC":"', mac, '","temp":', skin, ',"humi":', humi, ',"button":', btn, ',"battery level":', batt, '}')
  WHEN kind = 14 THEN concat('{"content":"DV1","gateway id":"', gateway_id, '","MAC":"', mac, '","humi":', humi, '}')
  WHEN kind = 15 THEN concat('{"content":"Diaper DV1","device_id":"', mac, '","data":{"humidity":', humi, ',"temperature":', skin, ',"button_status":"0x0', btn, '"}}')
  WHEN kind = 16 THEN concat('{"content":"location","gateway id":"', gateway_id, '","MAC":"', mac, '"}')
  WHEN kind = 17 THEN concat('{"gateway id":"', gateway_id, '","MAC":"', mac, '","hr":', hr, '}')
  WHEN kind = 18 THEN concat('{"content":"300B","gateway id":"', gateway_id, '","hr":', hr, '}')
  ELSE concat('{"content":"300B","MAC":"', mac) END AS payload
FROM base
), clock AS (SELECT max(received_ts) AS now FROM raw)
, doc AS (
  SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM raw
)"""


def _int(key: str) -> str:
    return f"CAST(trunc(CAST(j->>'$.\"{key}\"' AS DOUBLE)) AS INTEGER)"


def _double(key: str) -> str:
    return f"CAST(j->>'$.\"{key}\"' AS DOUBLE)"


def _text(key: str) -> str:
    return f"(j->>'$.\"{key}\"')"


_TYPED_COLUMNS = [
    ("gateway_id", _text("gateway id"), None), ("mac", _text("MAC"), None),
    ("battery_level", _int("battery level"), None), ("serial_no", _int("serial no"), None),
    ("sos", _int("SOS"), "v"), ("heart_rate", _int("hr"), "v"), ("sp_o2", _int("spO2"), "v"),
    ("bp_systolic", _int("bp syst"), "v"), ("bp_diastolic", _int("bp diast"), "v"),
    ("skin_temp", _double("skin temp"), "v"), ("room_temp", _double("room temp"), "v"),
    ("steps", _int("steps"), "v"), ("sleep_time", _text("sleep time"), "v"),
    ("wake_time", _text("wake time"), "v"), ("light_sleep_min", _int("light sleep (min)"), "v"),
    ("deep_sleep_min", _int("deep sleep (min)"), "v"), ("move", _int("move"), "v"),
    ("wear", _int("wear"), "v"),
    ("name", _text("name"), "d"), ("firmware_version", _text("fw ver"), "d"),
    ("temperature", _double("temp"), "d"), ("humidity", _double("humi"), "d"),
    ("button", _int("button"), "d"), ("message_index", _int("mssg idx"), "d"),
    ("acknowledgement", _int("ack"), "d"),
]


def _typed_select() -> str:
    test = {"v": "message_type = 'VITAL_SIGN'", "d": "message_type = 'DIAPER'"}
    return ", ".join(
        f"{sql} AS {name}" if kind is None else f"CASE WHEN {test[kind]} THEN {sql} END AS {name}"
        for name, sql, kind in _TYPED_COLUMNS)


_MISSING = ["CASE WHEN gateway_id IS NULL THEN 'missing_gateway_id' END",
            "CASE WHEN mac IS NULL THEN 'missing_mac' END",
            "CASE WHEN trim(gateway_id) = '' THEN 'blank_gateway_id' END",
            "CASE WHEN trim(mac) = '' THEN 'blank_mac' END"]


def _ranges(*ranges: tuple[str, float, float]) -> list[str]:
    return [f"CASE WHEN {c} < {low} OR {c} > {high} THEN '{c}_range' END" for c, low, high in ranges]


_VITAL_RULES = _MISSING + [
    "CASE WHEN coalesce(heart_rate, sp_o2, bp_systolic, steps) IS NULL THEN 'no_vital' END"
] + _ranges(("heart_rate", 30, 220), ("sp_o2", 70, 100), ("bp_systolic", 50, 250),
            ("bp_diastolic", 30, 150), ("skin_temp", 30, 45))
_DIAPER_RULES = _MISSING + [
    "CASE WHEN coalesce(temperature, humidity) IS NULL THEN 'no_reading' END"
] + _ranges(("temperature", 0, 60), ("humidity", 0, 100), ("button", 0, 2))

_BUTTON = ("CASE {0} WHEN 0 THEN '未按下' WHEN 1 THEN '短按' WHEN 2 THEN '长按' ELSE '未知' END")
_LEVEL5 = ("CASE WHEN {0} IS NULL THEN '未知' WHEN {0} < 40 THEN '干燥' WHEN {0} < 60 THEN '正常' "
           "WHEN {0} < 80 THEN '潮湿' ELSE '需要更换' END")
_LEVEL3 = ("CASE WHEN coalesce({0}, 0) > 60 THEN 'wet' WHEN coalesce({0}, 0) > 40 THEN 'damp' "
           "ELSE 'dry' END")

TYPED = RAW + f"""
, named AS (
  SELECT *, (j->>'$.content') AS content,
    CASE WHEN contains(lower(j->>'$.content'), '300b') THEN 'VITAL_SIGN'
         WHEN contains(lower(j->>'$.content'), 'diaper dv1') THEN 'DIAPER' END AS message_type
  FROM doc
), fields AS (
  SELECT msg_id, received_ts, payload, j, content, message_type, received_ts AS "timestamp",
    {_typed_select()} FROM named
), judged AS (
  SELECT *, mac AS device_id,
    CASE WHEN message_type = 'DIAPER' THEN {_BUTTON.format('button')} END AS button_status,
    CASE WHEN message_type = 'DIAPER' THEN {_LEVEL5.format('humidity')} END AS diaper_status,
    CASE WHEN j IS NULL THEN 'malformed_json'
      WHEN content IS NULL THEN 'missing_content'
      WHEN message_type IS NULL THEN 'unknown_content'
      WHEN message_type = 'VITAL_SIGN' THEN concat_ws(',', {', '.join(_VITAL_RULES)})
      ELSE concat_ws(',', {', '.join(_DIAPER_RULES)}) END AS reasons
  FROM fields
), typed AS (
  SELECT *, CASE WHEN reasons <> '' THEN 'invalid' WHEN message_type = 'VITAL_SIGN' THEN 'vital_signs'
    ELSE 'diaper_status' END AS route FROM judged
), valid AS (SELECT * FROM typed WHERE route <> 'invalid')
, vitals AS (SELECT * FROM typed WHERE route = 'vital_signs')
, diapers AS (SELECT * FROM typed WHERE route = 'diaper_status')"""

LENIENT = RAW + f"""
, named AS (
  SELECT *, (j->>'$.content') AS content, (j->'$.data') IS NOT NULL AS nested,
    CASE WHEN (j->>'$.content') = '300B' THEN 'VITAL_SIGN'
         WHEN lower(j->>'$.content') IN ('dv1', 'diaper dv1', 'diaper_dv1') THEN 'DIAPER' END AS message_type
  FROM doc
), fields AS (
  SELECT msg_id, received_ts, payload, message_type, content, nested,
    CASE WHEN nested THEN (j->>'$.device_id') ELSE coalesce(j->>'$.MAC', (j->>'$.device_id')) END AS device_id,
    CASE WHEN nested THEN NULL ELSE received_ts END AS "timestamp",
    CAST(CASE WHEN nested THEN (j->>'$.data.heart_rate') ELSE (j->>'$.hr') END AS INTEGER) AS heart_rate,
    CAST(CASE WHEN nested THEN (j->>'$.data.systolic_bp') ELSE coalesce(j->>'$."bp syst"', (j->>'$.bp_syst')) END AS INTEGER) AS systolic_bp,
    CAST(CASE WHEN nested THEN (j->>'$.data.diastolic_bp') ELSE coalesce(j->>'$."bp diast"', (j->>'$.bp_diast')) END AS INTEGER) AS diastolic_bp,
    CAST(CASE WHEN nested THEN (j->>'$.data.spo2') ELSE coalesce(j->>'$.SpO2', (j->>'$.Spo2')) END AS INTEGER) AS spo2,
    CAST(CASE WHEN nested THEN (j->>'$.data.temperature') ELSE coalesce(j->>'$."skin temp"', (j->>'$.skin_temp'), '0') END AS DOUBLE) AS body_temp,
    CASE WHEN nested THEN NULL ELSE 0 END AS steps,
    CAST(CASE WHEN nested THEN NULL ELSE coalesce(j->>'$."battery level"', (j->>'$.battery_level')) END AS INTEGER) AS battery_level,
    CAST(CASE WHEN nested THEN (j->>'$.data.humidity') ELSE coalesce(j->>'$.humi', '0') END AS INTEGER) AS humidity,
    CASE WHEN nested THEN CAST(right(j->>'$.data.button_status', 1) AS INTEGER)
         ELSE CAST(j->>'$.button' AS INTEGER) END AS button_status,
    received_ts AS processed_at
  FROM named
), lenient AS (
  SELECT *, {_LEVEL3.format('humidity')} AS diaper_status,
    CASE WHEN message_type IS NULL THEN 'invalid'
         WHEN NOT nested AND (device_id IS NULL OR device_id IN ('', 'unknown')) THEN 'dropped'
         WHEN message_type = 'VITAL_SIGN' THEN 'vital_signs' ELSE 'diaper_status' END AS route
  FROM fields
), lvitals AS (SELECT * FROM lenient WHERE route = 'vital_signs')
, ldiapers AS (SELECT * FROM lenient WHERE route = 'diaper_status')"""

_KEY = ("message_type, gateway_id, mac, heart_rate, sp_o2, bp_systolic, bp_diastolic, skin_temp, "
        "room_temp, steps, battery_level, temperature, humidity, button")
_VITAL_TABLE = ('content, gateway_id, device_id, mac, sos, heart_rate, sp_o2, bp_systolic, bp_diastolic, '
                'skin_temp, room_temp, steps, sleep_time, wake_time, light_sleep_min, deep_sleep_min, '
                'move, wear, battery_level, serial_no, "timestamp", message_type')
_DIAPER_TABLE = ('content, gateway_id, device_id, mac, name, firmware_version, temperature, humidity, '
                 'button, button_status, diaper_status, message_index, acknowledgement, battery_level, '
                 'serial_no, "timestamp", message_type')
_LVITAL_TABLE = ('device_id, "timestamp", heart_rate, systolic_bp, diastolic_bp, spo2, body_temp, steps, '
                 'battery_level, processed_at')
_LDIAPER_TABLE = ('device_id, "timestamp", humidity, button_status, battery_level, diaper_status, '
                  'processed_at')
_SHORT = 'msg_id, message_type, gateway_id, device_id, "timestamp"'
_NEWEST = 'ORDER BY "timestamp" DESC, msg_id DESC'

TUMBLED = f"""
, tumbled AS (
  SELECT * FROM valid QUALIFY row_number() OVER (
    PARTITION BY {_KEY}, time_bucket(INTERVAL '5 seconds', "timestamp") ORDER BY "timestamp", msg_id) = 1
)"""


def _throttled(source: str, key: str, time: str) -> str:
    return f"""
, keyed AS (SELECT *, {time} AS seen_at, dense_rank() OVER (ORDER BY {key}) AS key_id FROM {source})
, queued AS (SELECT *, row_number() OVER (PARTITION BY key_id ORDER BY seen_at, msg_id) AS place FROM keyed)
, walk AS (
  SELECT key_id, place, msg_id, seen_at AS last_pass, true AS passes FROM queued WHERE place = 1
  UNION ALL
  SELECT q.key_id, q.place, q.msg_id,
    CASE WHEN q.seen_at - w.last_pass >= INTERVAL '5 seconds' THEN q.seen_at ELSE w.last_pass END,
    q.seen_at - w.last_pass >= INTERVAL '5 seconds'
  FROM walk w JOIN queued q ON q.key_id = w.key_id AND q.place = w.place + 1
), throttled AS (SELECT q.* FROM queued q JOIN walk w USING (msg_id) WHERE w.passes)"""


LATEST = """
, newest AS (
  SELECT * FROM valid QUALIFY row_number() OVER (
    PARTITION BY message_type, device_id ORDER BY "timestamp" DESC, msg_id DESC) = 1
), latest AS (
  SELECT newest.* FROM newest, clock WHERE now - "timestamp" < INTERVAL '5 days'
)"""

SERIES = """
, ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY message_type, device_id ORDER BY "timestamp" DESC, msg_id DESC) AS position FROM valid
), series AS (SELECT * FROM ranked WHERE position <= 720)"""

GATEWAYS = """
, gaps AS (
  SELECT gateway_id, "timestamp", coalesce("timestamp" - lag("timestamp") OVER (
    PARTITION BY gateway_id ORDER BY "timestamp", msg_id) >= INTERVAL '3 hours', true) AS fresh FROM valid
), islands AS (
  SELECT gateway_id, max("timestamp") FILTER (WHERE fresh) AS island_start, max("timestamp") AS last_write
  FROM gaps GROUP BY gateway_id
), members AS (
  SELECT v.gateway_id, v.device_id, max(v."timestamp") AS last_seen
  FROM valid v JOIN islands i ON v.gateway_id = i.gateway_id AND v."timestamp" >= i.island_start, clock
  WHERE now - i.last_write < INTERVAL '3 hours' GROUP BY v.gateway_id, v.device_id
)"""

_TOPIC = ("concat(CASE WHEN gateway_id IS NULL THEN concat('OTHER/', coalesce(mac, '?')) ELSE concat('UWB/', gateway_id) END, "
          "CASE message_type WHEN 'VITAL_SIGN' THEN '_Health' WHEN 'DIAPER' THEN '_Message' ELSE '_Loca' END)")
_SENT = "SELECT DISTINCT concat('MAC', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS device_id FROM events"
_STORED = "SELECT DISTINCT device_id FROM diapers, clock WHERE \"timestamp\" > now - INTERVAL '5 days'"
_WINDOW_END = "time_bucket(INTERVAL '5 seconds', received_ts) + INTERVAL '5 seconds'"


def _own() -> dict[str, str]:
    raw, typed, lenient = f"WITH {RAW} ", f"WITH {TYPED} ", f"WITH {LENIENT} "
    tumbled = f"WITH {TYPED}{TUMBLED} "
    throttled = f"WITH RECURSIVE {TYPED}{_throttled('valid', _KEY, chr(34) + 'timestamp' + chr(34))} "
    latest, series = f"WITH {TYPED}{LATEST} ", f"WITH {TYPED}{SERIES} "
    gateways = f"WITH {TYPED}{GATEWAYS} "
    late = typed + f""", ms AS (SELECT "timestamp", epoch_ms({_WINDOW_END}) - epoch_ms("timestamp") AS v FROM vitals), late AS (
        SELECT "timestamp", v >> greatest(length(bin(v)) - 7, 0) << greatest(length(bin(v)) - 7, 0) AS bucket FROM ms) """
    return {
        "raw_messages": raw + "SELECT msg_id, received_ts, payload FROM raw",
        "topic_parts": typed + f"""SELECT msg_id, topic, regexp_extract(topic, '^UWB/(.+)_([^_]+)$', 1) AS topic_gateway,
            regexp_extract(topic, '^UWB/(.+)_([^_]+)$', 2) AS topic_kind FROM (SELECT msg_id, {_TOPIC} AS topic FROM typed)""",
        "stamped_payloads": raw + """SELECT msg_id, concat(
            CASE WHEN payload LIKE '{%}' THEN concat(left(payload, length(payload) - 1), ',') ELSE '{' END,
            '"receivedAt":"', strftime(received_ts, '%Y-%m-%dT%H:%M:%S.%fZ'), '"}') AS payload FROM raw""",
        "classify_typed": typed + "SELECT msg_id, content, message_type FROM typed",
        "classify_lenient": lenient + "SELECT msg_id, content, message_type FROM lenient",
        "payload_shape": raw + """SELECT msg_id, CASE WHEN j IS NULL THEN NULL
            WHEN (j->'$.data') IS NOT NULL THEN 'nested' ELSE 'flat' END AS shape FROM doc""",
        "malformed_messages": raw + "SELECT msg_id, received_ts, payload FROM doc WHERE j IS NULL",
        "route_split": typed + "SELECT msg_id, message_type, route FROM typed",
        "route_split_lenient": lenient + "SELECT msg_id, message_type, route FROM lenient",
        "table_routing": typed + """SELECT message_type, CASE message_type WHEN 'VITAL_SIGN' THEN 'vital_signs'
            ELSE 'diaper_status' END AS table_name, count(*) AS row_count FROM valid GROUP BY message_type""",
        "lenient_dropped": lenient + "SELECT msg_id, received_ts, payload FROM lenient WHERE route = 'dropped'",
        "parse_vitals_typed": typed + f"SELECT msg_id, {_VITAL_TABLE} FROM vitals",
        "parse_diaper_typed": typed + f"SELECT msg_id, {_DIAPER_TABLE} FROM diapers",
        "parse_vitals_nested": lenient + f"SELECT msg_id, {_LVITAL_TABLE} FROM lvitals WHERE nested",
        "parse_vitals_flat": lenient + f"SELECT msg_id, {_LVITAL_TABLE} FROM lvitals WHERE NOT nested",
        "parse_diaper_flat": lenient + f"SELECT msg_id, {_LDIAPER_TABLE} FROM ldiapers WHERE NOT nested",
        "parse_diaper_nested": lenient + f"SELECT msg_id, {_LDIAPER_TABLE} FROM ldiapers WHERE nested",
        "alias_lookup": lenient + "SELECT msg_id, systolic_bp, diastolic_bp, spo2, battery_level FROM lvitals",
        "event_time": lenient + """SELECT msg_id, "timestamp", processed_at FROM lenient
            WHERE route IN ('vital_signs', 'diaper_status')""",
        # the second spelling joins the value; its range is judged too
        "unified_spo2": typed.replace(
            f"CASE WHEN message_type = 'VITAL_SIGN' THEN {_int('spO2')} END",
            f"CASE WHEN message_type = 'VITAL_SIGN' THEN coalesce({_int('spO2')}, {_int('Spo2')}) END")
            + "SELECT msg_id, sp_o2 FROM vitals",
        "lenient_to_typed": lenient + f"""SELECT msg_id, message_type, device_id AS mac,
            CASE WHEN message_type = 'VITAL_SIGN' THEN spo2 END AS sp_o2,
            CASE WHEN message_type = 'VITAL_SIGN' THEN systolic_bp END AS bp_systolic,
            CASE WHEN message_type = 'VITAL_SIGN' THEN body_temp END AS skin_temp,
            CASE WHEN message_type = 'DIAPER' THEN CAST(humidity AS DOUBLE) END AS humidity,
            CASE WHEN message_type = 'DIAPER' THEN button_status END AS button,
            CASE WHEN message_type = 'DIAPER' THEN {_BUTTON.format('button_status')} END AS button_status
            FROM lenient WHERE route IN ('vital_signs', 'diaper_status')""",
        "flatten_patient_data": typed + """SELECT CAST(battery_level AS VARCHAR) AS device_id,
            'gateway' AS device_type, gateway_id, mac, battery_level AS serial_no, content, heart_rate,
            sp_o2 AS spo2, bp_systolic, bp_diastolic, skin_temp, battery_level, "timestamp",
            received_ts AS processing_time,
            battery_level IS NOT NULL AND (heart_rate IS NOT NULL OR sp_o2 IS NOT NULL) AS is_valid
            FROM vitals""",
        "serving_keys": typed + """SELECT DISTINCT message_type, device_id, gateway_id,
            concat(CASE message_type WHEN 'VITAL_SIGN' THEN 'vitals' ELSE 'diaper' END, ':', device_id) AS latest_key,
            concat('timeseries:', message_type, ':', device_id) AS series_key,
            concat(route, ':latest:', device_id) AS lenient_latest_key,
            concat(route, ':timeseries:', device_id) AS lenient_series_key,
            concat('gateway:', gateway_id, ':devices') AS gateway_key,
            concat('health:gateway:', device_id) AS flattened_key FROM valid""",
        "button_status": typed + f"""SELECT msg_id, button, {_BUTTON.format('button')} AS button_status FROM typed
            WHERE message_type = 'DIAPER'""",
        "diaper_status5": typed + f"""SELECT msg_id, humidity, {_LEVEL5.format('humidity')} AS diaper_status FROM typed
            WHERE message_type = 'DIAPER'""",
        "diaper_status3": typed + f"""SELECT msg_id, humidity, {_LEVEL3.format('humidity')} AS diaper_status FROM typed
            WHERE message_type = 'DIAPER'""",
        "hex_button": typed + """SELECT msg_id, t AS button_text, CASE WHEN t LIKE 'MAC%' THEN 0 WHEN t LIKE '0x%' THEN
            CAST(t AS BIGINT) ELSE CAST('0x' || t AS BIGINT) END AS button FROM (SELECT msg_id, coalesce(
              j->>'$.data.button_status', j->>'$.button', j->>'$.hr', j->>'$.MAC') AS t FROM doc)""",
        "validate_vitals": typed + """SELECT msg_id, route <> 'invalid' AS is_valid FROM typed
            WHERE message_type = 'VITAL_SIGN'""",
        "validate_diaper": typed + """SELECT msg_id, route <> 'invalid' AS is_valid FROM typed
            WHERE message_type = 'DIAPER'""",
        "mac_length": typed + """SELECT msg_id, replace(mac, '0', '') AS mac, length(replace(mac, '0', '')) >= 6 AS is_valid
            FROM typed WHERE mac IS NOT NULL""",
        "reject_reasons": typed + "SELECT msg_id, reasons FROM typed WHERE route = 'invalid'",
        "dedup_windows": typed + f"""SELECT {_SHORT},
            time_bucket(INTERVAL '5 seconds', "timestamp") AS window_start FROM valid""",
        "dedup_tumbling": tumbled + f"SELECT {_SHORT} FROM tumbled",
        "dedup_throttle": throttled + f"SELECT {_SHORT} FROM throttled",
        "dedup_throttle_payload": f"WITH RECURSIVE {RAW}{_throttled('raw', 'payload', 'received_ts')} "
                                  "SELECT msg_id, received_ts FROM throttled",
        "dedup_flattened": typed + """SELECT msg_id, CAST(battery_level AS VARCHAR) AS device_id, gateway_id,
            "timestamp" FROM vitals QUALIFY row_number() OVER (
              PARTITION BY battery_level, gateway_id, heart_rate, sp_o2, bp_systolic, bp_diastolic, skin_temp,
                room_temp, steps, time_bucket(INTERVAL '5 seconds', "timestamp")
              ORDER BY "timestamp", msg_id) = 1""",
        "stream_tumbling": tumbled + f"SELECT {_SHORT} FROM tumbled",
        # four files, each row up to 3500 seconds out of place; the watermark is that of earlier files
        "late_rows": typed + f""", placed AS (
              SELECT *, CAST(epoch(received_ts) AS BIGINT) + msg_id * 7919 % 3500 AS place FROM typed
            ), span AS (SELECT min(place) AS low, max(place) + 1 - min(place) AS width FROM placed
            ), filed AS (
              SELECT placed.*, CAST(place >= low + width * 1 // 4 AS INTEGER) + CAST(place >= low + width * 2 // 4 AS INTEGER)
                + CAST(place >= low + width * 3 // 4 AS INTEGER) AS file FROM placed, span
            ), newest AS (
              SELECT file, max(max("timestamp")) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
              FROM filed WHERE route <> 'invalid' GROUP BY file
            ) SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start, count(*) AS late_rows,
                CAST(max(epoch(seen) - epoch("timestamp")) AS BIGINT) AS most_seconds
              FROM filed JOIN newest USING (file)
              WHERE route <> 'invalid' AND "timestamp" < seen - INTERVAL '{LATENESS} seconds' GROUP BY 1""",
        "stream_throttle": throttled + f"SELECT {_SHORT} FROM throttled",
        "stream_pipeline": throttled + """SELECT route AS table_name, count(*) AS row_count FROM throttled
            GROUP BY route UNION ALL
            SELECT 'dead_letters', count(*) FROM typed WHERE route = 'invalid'""",
        "latest_per_device": latest + """SELECT msg_id, message_type, device_id, "timestamp",
            concat(CASE message_type WHEN 'VITAL_SIGN' THEN 'vitals' ELSE 'diaper' END, ':', device_id) AS hot_key,
            concat('{"device_id":"', device_id, '"',
              CASE WHEN heart_rate IS NOT NULL THEN concat(',"heart_rate":', heart_rate) ELSE '' END,
              CASE WHEN humidity IS NOT NULL THEN concat(',"humidity":', CAST(CAST(humidity AS INTEGER) AS VARCHAR), '.0') ELSE '' END,
              CASE WHEN battery_level IS NOT NULL THEN concat(',"battery_level":', battery_level) ELSE '' END,
              '}') AS value FROM latest""",
        "hot_entries": typed + """SELECT
            concat(CASE message_type WHEN 'VITAL_SIGN' THEN 'vitals' ELSE 'diaper' END, ':', device_id) AS latest_key,
            concat('timeseries:', message_type, ':', device_id) AS series_key,
            concat('gateway:', gateway_id, ':devices') AS gateway_key, device_id,
            epoch_ms("timestamp") AS score, 3600 AS ttl_seconds, 720 AS cap FROM valid""",
        "hot_series": series + 'SELECT msg_id, message_type, device_id, "timestamp", position FROM series',
        "hot_series_ttl": f"WITH {TYPED}" + """, gapped AS (
              SELECT *, coalesce("timestamp" - lag("timestamp") OVER device >= INTERVAL '12 hours', false) AS fresh
              FROM valid WINDOW device AS (PARTITION BY message_type, device_id ORDER BY "timestamp", msg_id)
            ), numbered AS (
              SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY message_type, device_id
                ORDER BY "timestamp", msg_id ROWS UNBOUNDED PRECEDING) AS island FROM gapped
            ), lasting AS (
              SELECT *, max(island) OVER (PARTITION BY message_type, device_id) AS last_island,
                max("timestamp") OVER (PARTITION BY message_type, device_id) AS last_write,
                row_number() OVER (PARTITION BY message_type, device_id
                  ORDER BY "timestamp" DESC, msg_id DESC) AS position FROM numbered
            ) SELECT msg_id, message_type, device_id, "timestamp", position FROM lasting, clock
            WHERE island = last_island AND position <= 5 AND now - last_write < INTERVAL '12 hours'""",
        "gateway_devices": gateways + "SELECT gateway_id, device_id, last_seen FROM members",
        "gateway_sets": gateways + """SELECT gateway_id, string_agg(device_id, ',' ORDER BY device_id) AS devices
            FROM members GROUP BY gateway_id""",
        "latest_lookup": latest + f"""SELECT msg_id, message_type, device_id, "timestamp" FROM latest
            WHERE device_id IN ('{DEVICE}', 'MAC000002')""",
        "series_tail": series + """SELECT message_type, device_id, position, epoch_ms("timestamp") AS score
            FROM series WHERE position <= 10""",
        "series_length": series + """SELECT message_type, device_id, count(*) AS points FROM series
            GROUP BY message_type, device_id""",
        "gateway_lookup": gateways + f"""SELECT gateway_id, device_id FROM members
            WHERE gateway_id IN ('{GATEWAY}', 'GW0003')""",
        "latest_ttl": latest + """SELECT message_type, device_id,
            CAST(432000 - (epoch_ms(now) - epoch_ms("timestamp")) // 1000 AS BIGINT) AS ttl_seconds
            FROM latest, clock""",
        "live_devices": latest + "SELECT message_type, count(*) AS devices FROM latest GROUP BY message_type",
        "tiered_range": typed + f""", ranked AS (
              SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY "timestamp" DESC, msg_id DESC) AS n FROM vitals
            ), oldest AS (
              SELECT device_id, max("timestamp") FILTER (WHERE n = {TIER_CAP}) AS full_from FROM ranked GROUP BY device_id
            ) SELECT msg_id, v.device_id, heart_rate, "timestamp",
                CASE WHEN "timestamp" >= now - INTERVAL '12 hours' AND (full_from IS NULL OR "timestamp" > full_from)
                     THEN 'hot' ELSE 'history' END AS tier
              FROM vitals v JOIN oldest USING (device_id), clock WHERE "timestamp" >= now - INTERVAL '5 days'""",
        "dead_letters": typed + """SELECT msg_id, received_ts, payload, 'typed' AS profile, route, reasons
            FROM typed WHERE route = 'invalid'""",
        "retained_days": typed + """SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS row_count
            FROM vitals, clock WHERE CAST("timestamp" AS DATE) > CAST(now AS DATE) - 7 GROUP BY 1""",
        "recent_vitals": typed + f"""SELECT msg_id, device_id, heart_rate, sp_o2 AS spo2, "timestamp"
            FROM vitals, clock WHERE "timestamp" > now - INTERVAL '48 hours' {_NEWEST} LIMIT 100""",
        "stored_day_counts": typed + """SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS row_count
            FROM diapers GROUP BY 1""",
        "device_day_stats": f"WITH {TYPED}{TUMBLED} " + """SELECT device_id, count(*) AS count,
            avg(heart_rate) AS avg_hr, avg(sp_o2) AS avg_spo2 FROM tumbled, clock
            WHERE message_type = 'VITAL_SIGN' AND CAST("timestamp" AS DATE) = CAST(now AS DATE) GROUP BY device_id""",
        "device_avg_hr": typed + """SELECT device_id, avg(heart_rate) AS avg_hr FROM vitals, clock
            WHERE "timestamp" > now - INTERVAL '48 hours' GROUP BY device_id""",
        "daily_vitals": typed + """SELECT CAST("timestamp" AS DATE) AS date, count(*) AS count,
            avg(heart_rate) AS avg_hr, avg(sp_o2) AS avg_spo2 FROM vitals, clock
            WHERE "timestamp" >= now - INTERVAL '10 days' GROUP BY 1""",
        "daily_diaper": typed + """SELECT CAST("timestamp" AS DATE) AS date, count(*) AS count,
            round(avg(humidity), 6) AS avg_humidity, round(avg(temperature), 6) AS avg_temp FROM diapers, clock
            WHERE "timestamp" >= now - INTERVAL '10 days' GROUP BY 1""",
        "device_activity": lenient + """SELECT device_id, count(*) AS count, max(processed_at) AS last_time
            FROM lvitals, clock WHERE processed_at > now - INTERVAL '1 day' GROUP BY device_id""",
        "device_history": typed + f"""SELECT msg_id, device_id, heart_rate, sp_o2, "timestamp" FROM vitals
            WHERE device_id = '{DEVICE}' {_NEWEST} LIMIT 10""",
        "device_inventory": typed + """SELECT device_id, count(*) AS record_count, max("timestamp") AS last_seen
            FROM vitals GROUP BY device_id""",
        "latest_rows": lenient + """SELECT msg_id, device_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS time,
            heart_rate, systolic_bp, spo2 FROM lvitals ORDER BY "timestamp" DESC NULLS LAST, msg_id DESC LIMIT 10""",
        "timestamped_rows": lenient + f"""SELECT msg_id, device_id, strftime("timestamp", '%H:%M:%S') AS data_time,
            heart_rate, systolic_bp, spo2, battery_level FROM lvitals WHERE "timestamp" IS NOT NULL {_NEWEST} LIMIT 10""",
        "missing_device_share": lenient + """SELECT count(*) AS total,
            count(*) FILTER (WHERE device_id IS NULL OR device_id = 'unknown') AS invalid_count
            FROM lenient, clock WHERE message_type IS NOT NULL AND processed_at >= now - INTERVAL '10 days'""",
        "avg_latency": typed + f"""SELECT round(avg(epoch_ms({_WINDOW_END}) - epoch_ms("timestamp")), 6)
            AS avg_latency_ms FROM vitals, clock WHERE "timestamp" > now - INTERVAL '10 days'""",
        "recent_rows": lenient + f"""SELECT msg_id, {_LDIAPER_TABLE} FROM ldiapers, clock
            WHERE processed_at > now - INTERVAL '2 days'""",
        "device_minute_count": typed + f"""SELECT count(*) AS count FROM vitals, clock
            WHERE device_id = '{DEVICE}' AND "timestamp" >= now - INTERVAL '20 days'""",
        "table_counts": typed + "SELECT route AS table_name, count(*) AS row_count FROM typed GROUP BY route",
        "by_serial": typed + f"""SELECT msg_id, device_id, battery_level AS serial_no, "timestamp" FROM vitals
            WHERE battery_level = 50 {_NEWEST} LIMIT 3""",
        "newest_rows": typed + f"SELECT msg_id, {_DIAPER_TABLE} FROM diapers {_NEWEST} LIMIT 5",
        "reconcile_devices": typed + f"""SELECT coalesce(s.device_id, h.device_id) AS device_id,
            CASE WHEN h.device_id IS NULL THEN 'source_only' WHEN s.device_id IS NULL THEN 'history_only'
            ELSE 'matched' END AS status FROM ({_SENT}) s FULL JOIN ({_STORED}) h ON s.device_id = h.device_id""",
        "missing_devices": typed + f"SELECT device_id FROM ({_SENT}) EXCEPT SELECT device_id FROM ({_STORED})",
        "new_per_interval": raw + """, counts AS (
              SELECT time_bucket(INTERVAL '1 hour', received_ts) AS interval_start, count(*) AS new_messages
              FROM raw GROUP BY 1
            ) SELECT interval_start, new_messages,
              CAST(sum(new_messages) OVER (ORDER BY interval_start) AS BIGINT) AS total,
              new_messages - lag(new_messages) OVER (ORDER BY interval_start) AS change FROM counts""",
        "message_mix": typed + "SELECT content, count(*) AS messages FROM typed GROUP BY content",
        "route_rates": typed + """SELECT count(*) AS received, count(*) FILTER (WHERE route <> 'invalid') AS forwarded,
            count(*) FILTER (WHERE route = 'invalid') AS errors,
            round(100.0::DOUBLE * count(*) FILTER (WHERE route <> 'invalid') / count(*), 6) AS success_rate FROM typed""",
        "window_error_rate": typed + """, rates AS (
              SELECT time_bucket(INTERVAL '1 hour', received_ts) AS window_start, count(*) AS messages,
                count(*) FILTER (WHERE route = 'invalid') AS errors FROM typed GROUP BY 1
            ) SELECT *, round(errors / messages, 6) AS error_rate, errors / messages > 0.05 AS alert FROM rates""",
        "undecodable_messages": raw + """SELECT msg_id, received_ts, base64(encode(payload) || '\\xFF'::BLOB) AS payload_base64,
            'invalid' AS route, 'invalid_utf8' AS reasons FROM raw WHERE msg_id // 10 % 13 = 0""",
        "decodable_messages": raw + "SELECT msg_id, received_ts, payload FROM raw WHERE msg_id // 10 % 13 <> 0",
        "new_since_check": typed + """, parts AS (SELECT count(*) FILTER (WHERE msg_id % 3 = 0) AS a, count(*) AS n FROM diapers)
            SELECT 0 AS check_no, a AS new_rows, a AS total FROM parts UNION ALL SELECT 1, n - a, n FROM parts
            UNION ALL SELECT 2, 0, n FROM parts UNION ALL SELECT 3, 0, n FROM parts""",
        "error_alerts": typed + """, rates AS (
              SELECT time_bucket(INTERVAL '1 hour', received_ts) AS w, count(*) FILTER (WHERE route = 'invalid') / count(*) AS rate
              FROM typed GROUP BY 1
            ), runs AS (
              SELECT w, rate, w - row_number() OVER (ORDER BY w) * INTERVAL '1 hour' AS run FROM rates WHERE rate > 0.05
            ) SELECT min(w) AS started, max(w) + INTERVAL '1 hour' AS ended, count(*) AS bad_windows, round(max(rate), 6) AS peak
              FROM runs GROUP BY run HAVING count(*) >= 2""",
        "latency_sketch": late + """SELECT w AS window_start, count(*) AS messages,
              quantile_disc(bucket, 0.5) AS p50, quantile_disc(bucket, 0.99) AS p99
            FROM (SELECT time_bucket(INTERVAL '1 day', "timestamp") AS w, bucket FROM late) GROUP BY 1""",
        "latency_alerts": late + """, tops AS (
              SELECT time_bucket(INTERVAL '6 hours', "timestamp") AS w, quantile_disc(bucket, 0.99) AS p99 FROM late GROUP BY 1
            ), runs AS (
              SELECT w, p99, w - row_number() OVER (ORDER BY w) * INTERVAL '6 hours' AS run FROM tops WHERE p99 > 4000
            ) SELECT min(w) AS started, max(w) + INTERVAL '6 hours' AS ended, count(*) AS bad_windows, max(p99) AS peak
              FROM runs GROUP BY run HAVING count(*) >= 4""",
        "window_latency": typed + f""", late AS (
              SELECT time_bucket(INTERVAL '1 day', "timestamp") AS window_start,
                epoch_ms({_WINDOW_END}) - epoch_ms("timestamp") AS ms FROM vitals
            ), ranks AS (
              SELECT window_start, count(*) AS messages, quantile_cont(ms, 0.5) AS p50, quantile_cont(ms, 0.99) AS p99
              FROM late GROUP BY 1
            ) SELECT window_start, messages, round(p50, 6) AS p50_ms, round(p99, 6) AS p99_ms, p99 > 1000 AS alert
              FROM ranks""",
    }


# the same questions over stored tables or streaming state instead of parsed messages
_SAME_AS = {"stream_hot_series": "hot_series_ttl", "stream_gateway_devices": "gateway_devices",
           "stored_recent_vitals": "recent_vitals", "stored_device_avg_hr": "device_avg_hr",
           "stored_daily_vitals": "daily_vitals", "stored_daily_diaper": "daily_diaper"}


def all_sql() -> dict[str, str]:
    own = _own()
    return own | {name: own[same] for name, same in _SAME_AS.items()}
