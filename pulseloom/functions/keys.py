"""Keys under which hot-store entries are known."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulseloom.functions.classify import KINDS, check_profile, table_of


def _prefix(kind: Column) -> Column:
    found = F.lit(None).cast("string")
    for k in KINDS:
        found = F.when(kind == k.name, k.hot_prefix).otherwise(found)
    return found


def _key(*parts: Column | str) -> Column:
    # concat keeps a NULL part NULL, unlike concat_ws which would shift the rest
    joined = []
    for part in parts:
        joined += [F.lit(part) if isinstance(part, str) else part, F.lit(":")]
    return F.concat(*joined[:-1])


def latest_key(kind: Column, device: Column, profile: str = "typed") -> Column:
    if check_profile(profile) == "lenient":
        return _key(table_of(kind), "latest", device)
    return _key(_prefix(kind), device)


def series_key(kind: Column, device: Column, profile: str = "typed") -> Column:
    if check_profile(profile) == "lenient":
        return _key(table_of(kind), "timeseries", device)
    return _key("timeseries", kind, device)


def gateway_key(gateway: Column) -> Column:
    return _key("gateway", gateway, "devices")


def flattened_key(device_type: Column, device: Column) -> Column:
    return _key("health", device_type, device)
