"""Payload times to timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulseloom.functions import document as d

# Millisecond range that a timestamp column prints with four-digit years.
_MAX_MILLIS = 253402300799999
_MIN_MILLIS = -62135596800000


def from_millis(millis: Column) -> Column:
    """Epoch milliseconds to timestamp; NULL outside years 1 to 9999."""
    return F.when(millis.between(_MIN_MILLIS, _MAX_MILLIS), F.timestamp_millis(millis))


def from_text(text: Column) -> Column:
    """ISO text to timestamp; text without an offset is UTC, bad text is NULL.

    Offsets other than UTC are honoured. A leading date is required because a
    bare time of day would otherwise be read as today.
    """
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    iso = F.when(text.contains("T") & ~zoned, F.concat(text, F.lit("Z"))).otherwise(text)
    return F.when(text.rlike(r"^\s*\d{4}-\d"), iso.try_cast("timestamp"))


def stamp_node(received: Column, sent: Column) -> Column:
    """First of the ``receivedAt`` and ``timestamp`` nodes that is true in a truth test."""
    return F.when(d.truthy(received), received).when(d.truthy(sent), sent)


def event_time(stamp: Column, now: Column) -> Column:
    """Time of a flat lenient record: its stamp if it has one, else arrival."""
    return F.when(stamp.isNull(), now).otherwise(from_text(d.as_text(stamp)))
