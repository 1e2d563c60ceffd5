"""Small driver-side records: defaults, projector information, and their overlay."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Defaults by location, and for lane changes; fixed values.
DEFAULTS = {"urban": 50.0, "nonurban": 60.0, "private": 30.0}
LANE_CHANGE = "no"


def read_record(path: str) -> dict:
    """A YAML (or JSON) mapping; empty where there is no file, an error for anything but a mapping."""
    at = Path(path)
    if not at.exists():
        return {}
    text = at.read_text(encoding="utf-8")
    try:
        import yaml

        data = yaml.safe_load(text)
    except ImportError:
        data = json.loads(text) if text.strip() else {}
    data = {} if data is None else data
    if not isinstance(data, dict):
        raise ValueError(f"{path}: a mapping is expected, not {type(data).__name__}")
    return data


def speeds(record: dict) -> dict[str, float]:
    """The default speeds, with those a record gives in place of the built-in ones."""
    given = (record.get("autoware") or {}).get("default_speed_kmh") or {}
    return DEFAULTS | {k: float(v) for k, v in given.items() if k in DEFAULTS and v is not None}


def speed_kmh(text: Column, location: Column, defaults: dict[str, float] | None = None) -> Column:
    """A speed limit in km/h from a tag that may carry a unit; the location's default where there is no readable one."""
    value = F.nullif(F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(?:km/?h|kmh|mph)?\s*$", 1), F.lit("")).try_cast("double")
    value = F.when(F.lower(text).contains("mph"), value * 1.609344).otherwise(value)
    table = F.create_map(*[x for k, v in (defaults or DEFAULTS).items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(value, F.element_at(table, F.coalesce(location, F.lit("-"))))


def reference_numbers(text: str) -> dict[str, float]:
    """lat_0 and lon_0 anywhere in a document's text."""
    return {k: float(v) for k, v in re.findall(r"\+(lat_0|lon_0)=(-?[0-9.]+)", text)}
