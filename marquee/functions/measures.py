"""Splitting a mixed-unit text column into typed measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_measure(c, unit: str) -> Column:
    """First run of digits as INT when the text mentions ``unit``
    (case-insensitive substring), else NULL.  '93 min' -> 93 for 'min';
    '4 Seasons' -> 4 for 'season'; 'min' with no digits -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_extract(col, r"(\d+)", 1)
    return F.when(F.lower(col).contains(unit.lower()), digits.try_cast("int"))
