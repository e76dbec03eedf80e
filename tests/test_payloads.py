"""Known device payloads under both profiles, and values that are easy to misread."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import parse

SPACED = {
    "MAC": "77AB", "content": "300B", "gateway id": "north-4", "serial no": 4417, "battery level": 58,
    "hr": 62, "spO2": 97, "bp syst": 111, "bp diast": 69, "SOS": 1, "wear": 0, "move": 7, "steps": 812,
    "skin temp": 34.2, "room temp": 19.8, "wake time": "06:40:00", "sleep time": "23:05:00",
    "deep sleep (min)": 95, "light sleep (min)": 205,
}
UNDERSCORED = {
    "MAC": "02:11:22:33:44:55", "content": "300B", "gateway": "", "topic": "UWB/GWeast9_Health",
    "receivedAt": "2025-03-09T08:14:52.318Z", "battery_level": 47, "hr": 71, "Spo2": 94, "bp_syst": 125,
    "bp_diast": 81, "room_temp": 21.7, "skin_temp": 0, "steps": 640, "deep_sleep": 4, "light_sleep": 12,
}
NESTED = {
    "content": "300B", "device_id": "band-17", "timestamp": "2025-03-09T08:10:30Z",
    "data": {"temperature": 36.1, "heart_rate": 68, "spo2": 95, "diastolic_bp": 74, "systolic_bp": 119,
             "battery_level": 41},
}
DIAPER = {
    "MAC": "77AB", "content": "diaper DV1", "gateway id": "north-4", "serial no": 5523, "name": "pad 7",
    "humi": 52.6, "temp": 33.1, "button": 0, "battery level": 63, "ack": 0, "mssg idx": 88, "fw ver": "0.9.4",
}


def nested_diaper(humidity, button):
    return {"content": "diaper DV1", "device_id": "pad-3", "timestamp": "2025-03-09T08:12:11Z",
            "data": {"button_status": button, "humidity": humidity, "temperature": 31}}


def one(parsed):
    row, = parsed.collect()
    return row


# payload, route under typed, route under lenient
ROUTES = {
    "spaced": (SPACED, "vital_signs", "vital_signs"),
    "gateway_id": ({**{k: v for k, v in SPACED.items() if k != "gateway id"}, "gateway_id": "5150"},
                   "invalid", "vital_signs"),
    "vendor": ({**{k: v for k, v in SPACED.items() if k != "spO2"}, "gateway id": 5150, "SpO2": 93},
               "vital_signs", "vital_signs"),
    "underscored": (UNDERSCORED, "invalid", "vital_signs"),
    "nested": (NESTED, "invalid", "vital_signs"),
    "diaper": (DIAPER, "diaper_status", "diaper_status"),
    "nested diaper": (nested_diaper(71, "0x03"), "invalid", "diaper_status"),
    "ids inside data": ({"content": "300B", "data": {"device_id": "X", "heart_rate": 75}},
                        "invalid", "vital_signs"),
    "no MAC": ({"content": "diaper DV1", "humi": 50}, "invalid", "dropped"),
    "unknown device": ({"content": "300B", "MAC": "unknown", "hr": 60}, "invalid", "dropped"),
    "zero device": ({"content": "300B", "MAC": 0, "hr": 60}, "invalid", "dropped"),
    "text zero device": ({"content": "300B", "MAC": "0", "hr": 60}, "invalid", "vital_signs"),
    "other content": ({"content": "config"}, "invalid", "invalid"),
    "bare DV1": ({"content": "DV1", "MAC": "77AB", "humi": 50}, "invalid", "diaper_status"),
    "no content": ({"gateway_id": "P1", "hr": 75}, "invalid", "invalid"),
    "null content": ({"content": None, "MAC": "77AB"}, "invalid", "invalid"),
    "content inside": ({"content": {"x": "300B"}, "MAC": "1"}, "invalid", "invalid"),
    "longer content": ({**SPACED, "content": "dev-300b-v2"}, "vital_signs", "invalid"),
    "truncated": ('{"content":"300B","MAC":"13', "invalid", "invalid"),
    "array": ("[1]", "invalid", "invalid"),
    "number": ("5", "invalid", "invalid"),
    "empty": ("", "invalid", "invalid"),
    "null": (None, "invalid", "invalid"),
    "extra text": ('{"content":"300B","gateway id":"g","MAC":"77AB","hr":70} x', "vital_signs", "invalid"),
    "two objects": ('{"content":"300B","gateway id":"g","MAC":"77AB","hr":70},{"a":1}', "vital_signs", "invalid"),
    "closing bracket": ('{"content":"300B","gateway id":"g","MAC":"77AB","hr":70}]', "vital_signs", "invalid"),
    "repeated key": ('{"content":"300B","gateway id":"g","MAC":"77AB","hr":10,"hr":70}', "vital_signs", "vital_signs"),
    "data null": ({"content": "300B", "MAC": "77AB", "data": None}, "invalid", "invalid"),
    "data text": ({"content": "diaper DV1", "MAC": "77AB", "data": "{}"}, "invalid", "invalid"),
    "data empty": ({"content": "300B", "data": {}}, "invalid", "vital_signs"),
    "humidity null": ({"content": "dv1", "MAC": "77AB", "humi": None}, "invalid", "invalid"),
    "humidity text": ({"content": "dv1", "MAC": "77AB", "humi": "45"}, "invalid", "invalid"),
    "humidity absent": ({"content": "dv1", "MAC": "77AB"}, "invalid", "diaper_status"),
    "inner humidity null": (nested_diaper(None, 1), "invalid", "invalid"),
    "numeric time": ({"content": "300B", "MAC": "77AB", "timestamp": 1741508000000}, "invalid", "invalid"),
    "zero time": ({"content": "300B", "MAC": "77AB", "timestamp": 0}, "invalid", "vital_signs"),
    "empty receivedAt": ({"content": "300B", "MAC": "77AB", "receivedAt": "", "timestamp": "2025-01-02T03:04:05"},
                         "invalid", "vital_signs"),
}


@pytest.fixture(scope="module")
def routed(messages):
    raw = messages(*[p for p, _, _ in ROUTES.values()])
    return {profile: {r.msg_id: r for r in parse.parse(raw, profile).collect()}
            for profile in ("typed", "lenient")}


@pytest.mark.parametrize("name", ROUTES)
def test_routes(routed, name):
    i = list(ROUTES).index(name)
    _, typed, lenient = ROUTES[name]
    assert (routed["typed"][i].route, routed["lenient"][i].route) == (typed, lenient)
    for profile in routed.values():
        assert (profile[i].route == "invalid") == (len(profile[i].reasons) > 0)


def test_typed_vitals(messages):
    row = one(parse.vitals(parse.typed(messages(SPACED))))
    assert row.asDict() == {
        "content": "300B", "gateway_id": "north-4", "device_id": "77AB", "mac": "77AB", "sos": 1,
        "heart_rate": 62, "sp_o2": 97, "bp_systolic": 111, "bp_diastolic": 69, "skin_temp": 34.2,
        "room_temp": 19.8, "steps": 812, "sleep_time": "23:05:00", "wake_time": "06:40:00",
        "light_sleep_min": 205, "deep_sleep_min": 95, "move": 7, "wear": 0, "battery_level": 58,
        "serial_no": 4417, "timestamp": dt.datetime(2025, 1, 1), "message_type": "VITAL_SIGN",
    }


def test_typed_diaper(messages):
    row = one(parse.diapers(parse.typed(messages(DIAPER))))
    assert (row.name, row.firmware_version, row.temperature, row.humidity) == ("pad 7", "0.9.4", 33.1, 52.6)
    assert (row.button_status, row.diaper_status) == ("未按下", "正常")
    assert (row.message_index, row.acknowledgement, row.battery_level, row.serial_no) == (88, 0, 63, 5523)


def test_numeric_gateway_and_spo2_spellings(messages):
    vendor = ROUTES["vendor"][0]
    row = one(parse.vitals(parse.typed(messages(vendor))))
    assert (row.gateway_id, row.sp_o2) == ("5150", None)
    assert one(parse.vitals(parse.typed(messages(vendor), unified_spo2=True))).sp_o2 == 93
    assert one(parse.lenient_vitals(parse.lenient(messages(vendor)))).spo2 == 93
    assert one(parse.lenient_vitals(parse.lenient(messages(SPACED)))).spo2 is None
    assert one(parse.lenient_vitals(parse.lenient(messages(SPACED), unified_spo2=True))).spo2 == 97


def test_lenient_flat_vitals(messages):
    row = one(parse.lenient_vitals(parse.lenient(messages(UNDERSCORED))))
    assert row.timestamp == dt.datetime(2025, 3, 9, 8, 14, 52, 318000)
    assert (row.systolic_bp, row.diastolic_bp, row.spo2, row.battery_level) == (125, 81, 94, 47)
    assert row.body_temp == 0.0  # a present zero wins over the room temperature
    bare = one(parse.lenient_vitals(parse.lenient(messages({"content": "300B", "MAC": "a1"}))))
    assert (bare.steps, bare.body_temp, bare.heart_rate) == (0, 0.0, None)
    nulls = one(parse.lenient_vitals(parse.lenient(messages(
        {"content": "300B", "MAC": "a1", "steps": None, "bp syst": None, "bp_syst": 120, "skin temp": None}))))
    assert (nulls.steps, nulls.systolic_bp, nulls.body_temp) == (None, None, None)


def test_lenient_nested(messages):
    row = one(parse.lenient_vitals(parse.lenient(messages(NESTED))))
    assert (row.device_id, row.body_temp, row.heart_rate) == ("band-17", 36.1, 68)
    assert row.timestamp == dt.datetime(2025, 3, 9, 8, 10, 30)
    inside = one(parse.lenient_vitals(parse.lenient(messages(
        {"content": "300B", "data": {"device_id": "X", "timestamp": "2025-03-10T10:00:00Z", "body_temp": 36.5}}))))
    assert (inside.device_id, inside.timestamp, inside.body_temp) == (None, None, 36.5)


@pytest.mark.parametrize("humidity, button, expected", [
    (47, "0x02", (47, 2, "damp")), (71, "0x03", (71, 3, "wet")), (60, 1, (60, 1, "damp")),
    (60.5, "zz", (60, 0, "wet")), (40, "", (40, 0, "dry")), (41, "ff", (41, 255, "damp")),
    (10, " -0x0A ", (10, -10, "dry")), (10, "1_0", (10, 16, "dry")), (True, None, (1, None, "dry")),
])
def test_lenient_nested_diaper(messages, humidity, button, expected):
    row = one(parse.lenient_diapers(parse.lenient(messages(nested_diaper(humidity, button)))))
    assert (row.humidity, row.button_status, row.diaper_status) == expected


def test_lenient_flat_diaper(messages):
    row = one(parse.lenient_diapers(parse.lenient(messages(DIAPER))))
    assert (row.humidity, row.diaper_status, row.button_status, row.battery_level) == (52, "damp", 0, 63)
    bare = one(parse.lenient_diapers(parse.lenient(messages({"content": "DV1", "MAC": "a1"}))))
    assert (bare.humidity, bare.diaper_status, bare.button_status) == (0, "dry", None)


@pytest.mark.parametrize("change, reason", [
    ({"hr": "abc"}, "bad_heart_rate"), ({"hr": 3_000_000_000}, "bad_heart_rate"), ({"hr": None}, None),
    ({"steps": []}, "bad_steps"), ({"skin temp": "warm"}, "bad_body_temp"), ({"battery level": {}}, "bad_battery_level"),
    ({"hr": "71"}, None),
])
def test_lenient_values_are_not_lost(messages, change, reason):
    row = one(parse.lenient(messages({"content": "300B", "MAC": "a1", **change})))
    assert row.reasons == ([reason] if reason else [])


def test_lenient_button_beyond_its_column(messages):
    assert one(parse.lenient(messages(nested_diaper(50, "0xFFFFFFFF")))).reasons == ["bad_button_status"]


@pytest.mark.parametrize("text, expected", [
    ("2025-01-02T03:04:05", dt.datetime(2025, 1, 2, 3, 4, 5)),
    ("2025-01-02T03:04:05Z", dt.datetime(2025, 1, 2, 3, 4, 5)),
    ("2025-01-02T03:04:05+00:00", dt.datetime(2025, 1, 2, 3, 4, 5)),
    ("2025-01-02T11:04:05+08:00", dt.datetime(2025, 1, 2, 3, 4, 5)),
    ("2025-01-02 03:04:05", dt.datetime(2025, 1, 2, 3, 4, 5)),
    ("12:30", None), ("soon", None),
])
def test_text_times(messages, text, expected):
    row = one(parse.lenient(messages({"content": "300B", "MAC": "a1", "timestamp": text})))
    assert (row.route, row.timestamp) == ("vital_signs", expected)


BASE = {"content": "300B", "gateway id": "g", "MAC": "m", "hr": 70}


@pytest.mark.parametrize("change, reason", [
    ({"hr": "75"}, None), ({"hr": 75.9}, None), ({"hr": " 75 "}, None), ({"hr": "", "steps": 1}, None),
    ({"hr": "75.9"}, "bad_heart_rate"), ({"hr": True}, "bad_heart_rate"), ({"hr": "x"}, "bad_heart_rate"),
    ({"hr": {"v": 1}}, "bad_heart_rate"), ({"hr": [1]}, "bad_heart_rate"), ({"hr": 3_000_000_000}, "bad_heart_rate"),
    ({"skin temp": "36.5"}, None), ({"skin temp": False}, "bad_skin_temp"),
    ({"sleep time": 5}, None), ({"sleep time": {}}, "bad_sleep_time"),
    ({"name": {}}, None),  # not a field of vitals
    ({"gateway id": None}, "missing_gateway_id"), ({"gateway id": " \t"}, "blank_gateway_id"),
    ({"MAC": ""}, "blank_mac"), ({"MAC": ["m"]}, "missing_mac"),
    ({"timestamp": 1741508000000}, None), ({"timestamp": "1741508000000"}, None),
    ({"timestamp": None}, "bad_timestamp"), ({"timestamp": "2025-01-01T00:00:00Z"}, "bad_timestamp"),
    ({"timestamp": 10 ** 18}, "bad_timestamp"), ({"timestamp": True}, "bad_timestamp"),
])
def test_typed_values(messages, change, reason):
    row = one(parse.typed(messages({**BASE, **change})))
    assert row.reasons == ([reason] if reason else [])


def test_typed_value_results(messages):
    row = one(parse.typed(messages({**BASE, "hr": 75.9, "spO2": "98", "timestamp": 1741508000123})))
    assert (row.heart_rate, row.sp_o2) == (75, 98)
    assert row.timestamp == dt.datetime(2025, 3, 9, 8, 13, 20, 123000)


VITAL_BOUNDS = [("hr", 30, 220, "heart_rate"), ("spO2", 70, 100, "sp_o2"), ("bp syst", 50, 250, "bp_systolic"),
                ("bp diast", 30, 150, "bp_diastolic"), ("skin temp", 30, 45, "skin_temp")]
DIAPER_BOUNDS = [("temp", 0, 60, "temperature"), ("humi", 0, 100, "humidity"), ("button", 0, 2, "button")]


def test_bounds(messages):
    cases = []
    diaper = {"content": "diaper DV1", "gateway id": "g", "MAC": "m", "temp": 20}
    for base, bounds in ((BASE, VITAL_BOUNDS), (diaper, DIAPER_BOUNDS)):
        for key, low, high, column in bounds:
            for value, bad in ((low, False), (high, False), (low - 1, True), (high + 1, True), (None, False)):
                kept = {**base, "steps": 1} if base is BASE else {**base, "humi": 20}
                cases.append(({**kept, key: value}, [f"{column}_range"] if bad else []))
    rows = parse.typed(messages(*[c for c, _ in cases])).orderBy("msg_id").collect()
    assert [r.reasons for r in rows] == [expected for _, expected in cases]


def test_needs_a_reading_and_mac_length(messages):
    only_diastolic = {"content": "300B", "gateway id": "g", "MAC": "m", "bp diast": 80}
    no_reading = {"content": "diaper DV1", "gateway id": "g", "MAC": "m", "button": 1}
    rows = parse.typed(messages(only_diastolic, no_reading)).orderBy("msg_id").collect()
    assert [r.reasons for r in rows] == [["no_vital"], ["no_reading"]]
    assert one(parse.typed(messages(SPACED), mac_length=True)).reasons == ["short_mac"]


def test_diaper_labels(messages):
    levels = [(None, "未知"), (39.9, "干燥"), (40, "正常"), (40.1, "正常"), (59.9, "正常"), (60, "潮湿"),
              (60.1, "潮湿"), (79.9, "潮湿"), (80, "需要更换")]
    raw = messages(*[{"content": "diaper DV1", "gateway id": "g", "MAC": "m", "temp": 20, "humi": h} for h, _ in levels])
    rows = parse.typed(raw).orderBy("msg_id").collect()
    assert [r.diaper_status for r in rows] == [label for _, label in levels]


def test_flattened(messages):
    vitals = parse.vitals(parse.typed(messages(SPACED)), "received_ts")
    row = one(parse.flattened(vitals))
    assert (row.device_id, row.device_type, row.mac, row.spo2) == ("4417", "gateway", "77AB", 97)
    assert len(row) == 23


def test_message_is_parsed_once(messages):
    plan = parse.vitals(parse.typed(messages(SPACED)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    narrowed = parse.typed(messages(SPACED)).filter((F.col("heart_rate") > 5) & (F.col("route") == "vital_signs"))
    assert narrowed._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
