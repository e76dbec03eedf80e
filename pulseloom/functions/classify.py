"""Message types and the shape of a payload."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from pulseloom.functions import document as d

PROFILES = ("typed", "lenient")


@dataclass(frozen=True)
class MessageKind:
    name: str
    keyword: str
    table: str
    hot_prefix: str


# The two message types, in matching order.
VITAL = MessageKind("VITAL_SIGN", "300B", "vital_signs", "vitals")
DIAPER = MessageKind("DIAPER", "diaper DV1", "diaper_status", "diaper")
KINDS = (VITAL, DIAPER)

# Lower-cased diaper names the lenient profile accepts.
LENIENT_DIAPER_NAMES = ("dv1", "diaper dv1", "diaper_dv1")


def check_profile(profile: str) -> str:
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
    return profile


def message_type(content: Column, profile: str = "typed") -> Column:
    """Message type of a ``content`` text, NULL when it matches none.

    typed: first type whose keyword occurs anywhere, ignoring case.
    lenient: exact vitals keyword, or one of the accepted diaper names ignoring case.
    """
    if check_profile(profile) == "lenient":
        return (
            F.when(content == VITAL.keyword, VITAL.name)
            .when(F.lower(content).isin(*LENIENT_DIAPER_NAMES), DIAPER.name)
        )
    found = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        found = F.when(F.lower(content).contains(kind.keyword.lower()), kind.name).otherwise(found)
    return found


def shape(data: Column) -> Column:
    """``nested`` when a top-level ``data`` key exists (even null), else ``flat``."""
    return F.when(data.isNotNull(), "nested").otherwise("flat")


def table_of(kind: Column) -> Column:
    """History table a message type is written to."""
    return F.when(kind == VITAL.name, VITAL.table).when(kind == DIAPER.name, DIAPER.table)
