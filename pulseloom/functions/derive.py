"""Derived values of diaper records and display formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels of the typed diaper record.
BUTTON_LABELS = {0: "未按下", 1: "短按", 2: "长按"}
UNKNOWN_LABEL = "未知"
HUMIDITY_LABELS = ((40.0, "干燥"), (60.0, "正常"), (80.0, "潮湿"))
HUMIDITY_TOP_LABEL = "需要更换"

# Three-level status of the lenient profile, strictly above.
WET_ABOVE, DAMP_ABOVE = 60, 40

_HEX = r"^[+-]?(0[xX]_?)?[0-9a-fA-F]+(_[0-9a-fA-F]+)*$"


def button_label(button: Column) -> Column:
    """Pressed / short / long label; anything else, null included, is unknown."""
    label = F.lit(UNKNOWN_LABEL)
    for code, text in BUTTON_LABELS.items():
        label = F.when(button == code, text).otherwise(label)
    return label


def diaper_label(humidity: Column) -> Column:
    """Five-level status; each bound belongs to the level above it."""
    label = F.when(humidity.isNull(), UNKNOWN_LABEL)
    for bound, text in HUMIDITY_LABELS:
        label = label.when(humidity < bound, text)
    return label.otherwise(HUMIDITY_TOP_LABEL)


def diaper_level(humidity: Column) -> Column:
    """Three-level status; a missing reading counts as zero."""
    value = F.coalesce(humidity, F.lit(0.0))
    return F.when(value > WET_ABOVE, "wet").when(value > DAMP_ABOVE, "damp").otherwise("dry")


def hex_to_int(text: Column) -> Column:
    """Integer of a hexadecimal text such as ``0x03``; 0 for text that is not one."""
    clean = F.trim(text)
    digits = F.regexp_replace(F.regexp_replace(clean, "_", ""), "^[+-]?(0[xX])?", "")
    size = F.conv(digits, 16, 10).try_cast("int")
    value = F.when(clean.startswith("-"), -size).otherwise(size)
    return F.when(clean.rlike(_HEX), value).otherwise(F.when(text.isNotNull(), 0))


def clock_time(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def date_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def millis_between(later: Column, earlier: Column) -> Column:
    return F.unix_millis(later) - F.unix_millis(earlier)
