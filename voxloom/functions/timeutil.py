"""Time arithmetic as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hms(seconds: Column) -> Column:
    """Seconds to HH:MM:SS: truncated, hours without a limit; null stays null."""
    s = seconds.cast("bigint")
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60))


def clock_seconds(text: Column) -> Column:
    """MM:SS or HH:MM:SS (seconds may have a fraction) to seconds; null for anything else."""
    p = F.split(F.trim(text), ":")
    part = lambda i: F.try_element_at(p, F.lit(i)).try_cast("double")
    return F.when(F.size(p) == 2, part(1) * 60 + part(2)).when(F.size(p) >= 3, part(1) * 3600 + part(2) * 60 + part(3))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Shared length of two intervals, 0 if they only touch; null if a bound is null (``least`` alone would skip it)."""
    known = a_start.isNotNull() & a_end.isNotNull() & b_start.isNotNull() & b_end.isNotNull()
    shared = F.least(a_end, b_end) - F.greatest(a_start, b_start)
    return F.when(known, F.when(shared > 0, shared).otherwise(shared * 0))
