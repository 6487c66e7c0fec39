"""Timestamps and durations carried as text.

Parsing goes through ``try_make_timestamp_ntz`` on fixed character positions. That
stays inside generated code, gives NULL for bad text under ANSI mode, and never
depends on the session time zone (``try_to_timestamp`` is zoned: a wall-clock time
inside a daylight-saving gap would move by an hour).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts the three feeds write.
DMY_SLASHED = "dd/MM/yyyy HH:mm:ss"
YMD_COMPACT = "yyyyMMddHHmmss"
MDY_COMPACT = "MMddyyyyHHmmss"
YMD_SLASHED = "yyyy/MM/dd HH:mm:ss"

_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column, layout: str) -> Column:
    """Fixed-width text to ``timestamp_ntz``; NULL when the text does not fit."""
    text = _col(c)
    shape = "^" + re.sub("[yMdHms]", r"\\d", layout) + "$"
    parts = [
        F.substring(text, layout.index(f) + 1, len(f)).try_cast("int") for f in _FIELDS
    ]
    return F.when(text.rlike(shape), F.try_make_timestamp_ntz(*parts))


def parse_ts_dmy(c: str | Column) -> Column:
    return parse_ts(c, DMY_SLASHED)


def parse_ts_compact(c: str | Column) -> Column:
    return parse_ts(c, YMD_COMPACT)


def parse_ts_mdy_compact(c: str | Column) -> Column:
    return parse_ts(c, MDY_COMPACT)


def parse_ts_created(c: str | Column) -> Column:
    """Record creation time of the message feed, which orders its re-emissions."""
    return parse_ts(c, YMD_SLASHED)


def duration_to_seconds(c: str | Column) -> Column:
    """``H:MM:SS`` to seconds; NULL when a part is missing or not a number."""
    parts = F.split(_col(c), ":")
    hours, minutes, seconds = (
        F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3)
    )
    return hours * 3600 + minutes * 60 + seconds
