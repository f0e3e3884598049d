"""Rounding and ratios with the reference engine's binary-double semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c, n: int = 0) -> Column:
    """ROUND(x, n) on the binary double: scale, round half away from zero,
    unscale.  Spark's ``round`` rounds the decimal text instead, so
    ROUND(1.005, 2) would give 1.01 there and 1.0 here (and in the
    reference engine).  ``signum`` keeps the sign of zero (-0.3 -> -0.0)."""
    x = _col(c).cast("double")
    scale = float(10 ** n)
    scaled = x * F.lit(scale)
    return F.signum(scaled) * F.floor(F.abs(scaled) + F.lit(0.5)).cast("double") / F.lit(scale)


def safe_ratio(num, den) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL."""
    return _col(num).cast("double") / F.nullif(_col(den), F.lit(0)).cast("double")


def pct(num, den, n: int = 1) -> Column:
    """ROUND(100.0 * num / den, n) with DOUBLE arithmetic (``lit(100.0)``)."""
    return round_half_away(F.lit(100.0) * _col(num).cast("double") / _col(den).cast("double"), n)


# Fixed shape: an optionally signed ASCII number, with an optional fraction
# and exponent.  Digits of other scripts are not numbers here.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_int(c) -> Column:
    """Tolerant text -> INT: integers as written, and decimal or exponent
    notation rounded half away from zero ('2019.0' -> 2019, '2019.5' ->
    2020, '0.49999999999' -> 0, '1e3' -> 1000), as the reference engine casts;
    anything else, or a value outside INT, is NULL.  Hex and digit-separator
    forms are not read."""
    col = F.col(c) if isinstance(c, str) else c
    text = F.when(col.rlike(_NUMBER), col)
    rounded = F.round(text.try_cast("double"), 0).try_cast("int")
    return F.coalesce(text.try_cast("int"), rounded)
