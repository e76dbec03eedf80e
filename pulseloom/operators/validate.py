"""Range and presence rules of typed records.

A rule is a name and the condition under which a record fails it. Range rules
only apply to non-null readings and include their bounds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Inclusive bounds per column.
VITAL_RANGES = {
    "heart_rate": (30, 220),
    "sp_o2": (70, 100),
    "bp_systolic": (50, 250),
    "bp_diastolic": (30, 150),
    "skin_temp": (30.0, 45.0),
}
DIAPER_RANGES = {
    "temperature": (0.0, 60.0),
    "humidity": (0.0, 100.0),
    "button": (0, 2),
}
VITAL_NEEDS_ONE_OF = ("heart_rate", "sp_o2", "bp_systolic", "steps")
DIAPER_NEEDS_ONE_OF = ("temperature", "humidity")
LEGACY_NEEDS_ONE_OF = ("heart_rate", "spo2", "steps")
MIN_MAC_LENGTH = 6

_WHITESPACE = " \t\n\r\f\v"

Rules = dict[str, Column]


def blank(column: str) -> Column:
    """Null, empty or whitespace only."""
    return F.coalesce(F.length(F.trim(F.col(column), F.lit(_WHITESPACE))) == 0, F.lit(True))


def _out_of_range(ranges: Mapping[str, tuple[float, float]]) -> Rules:
    return {f"{name}_range": F.coalesce(~F.col(name).between(low, high), F.lit(False))
            for name, (low, high) in ranges.items()}


def _none_of(columns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNull()


def mac_too_short(column: str = "mac") -> Column:
    return blank(column) | (F.length(column) < MIN_MAC_LENGTH)


def id_rules(mac_length: bool = False) -> Rules:
    rules = {"blank_gateway_id": blank("gateway_id"), "blank_mac": blank("mac")}
    if mac_length:
        rules["short_mac"] = mac_too_short()
    return rules


def vitals_rules(mac_length: bool = False) -> Rules:
    return {**id_rules(mac_length), "no_vital": _none_of(VITAL_NEEDS_ONE_OF),
            **_out_of_range(VITAL_RANGES)}


def diaper_rules(mac_length: bool = False) -> Rules:
    return {**id_rules(mac_length), "no_reading": _none_of(DIAPER_NEEDS_ONE_OF),
            **_out_of_range(DIAPER_RANGES)}


def legacy_rules() -> Rules:
    return {"blank_device_id": blank("device_id"), "blank_gateway_id": blank("gateway_id"),
            "no_vital": _none_of(LEGACY_NEEDS_ONE_OF)}


def any_failed(rules: Rules) -> Column:
    failed = F.lit(False)
    for condition in rules.values():
        failed = failed | condition
    return failed


def failed_names(rules: Rules) -> Column:
    """Names of the failed rules as ``array<string>``, in rule order.

    ``array_except`` rather than a lambda filter keeps the projection in codegen.
    """
    names = F.array(*[F.when(condition, name) for name, condition in rules.items()])
    return F.array_except(names, F.array(F.lit(None).cast("string")))


def reasons(failed: Column, rules: Rules) -> Column:
    """Failed names, worked out only for records that failed."""
    none = F.array().cast("array<string>")
    return F.when(failed, failed_names(rules)).otherwise(none)


def check(records: DataFrame, rules: Rules) -> DataFrame:
    """Add ``is_valid`` and ``reasons``."""
    failed = any_failed(rules)
    return records.withColumns({"is_valid": ~failed, "reasons": reasons(failed, rules)})
