"""Text cleaning: trim, blank-to-NULL, token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode "space separator" (Zs) characters that the
# reference engine's TRIM removes.  Tab and newline are *not* in the set.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """Trim Unicode space separators from both ends.

    Spark's plain ``trim`` strips only U+0020; ``btrim`` with the explicit
    character set keeps the expression codegen-friendly (no regex).
    """
    return F.btrim(_col(c), F.lit(SPACE_SEPARATORS))


def blank_to_null(c) -> Column:
    """``NULLIF(TRIM(x), '')``: absent stays NULL, blank becomes NULL."""
    return F.nullif(clean(c), F.lit(""))


def token_parts(c, sep: str = ",", strict: bool = True) -> Column:
    """Split a packed cell on ``sep`` into *trimmed* tokens, keeping blank
    tokens as '' so that a token's position is its index + 1 in the raw
    list.  A NULL cell gives an empty array.

    The trim happens on the whole string before the split (space separators
    next to a separator and at both ends are removed), which equals trimming
    every token, and keeps the expression codegen-friendly: no lambda.
    ``strict=False`` splits the raw text untouched (used only to build a
    deliberately broken model for the token assertion).
    """
    col = _col(c)
    if strict:
        # \p{Zs} is the same set as SPACE_SEPARATORS, and is matched much
        # faster than an explicit character class.
        text = clean(F.regexp_replace(col, r"\p{Zs}*" + sep + r"\p{Zs}*", sep))
    else:
        text = col
    return F.when(col.isNotNull(), F.split(text, sep, -1)).otherwise(
        F.array().cast("array<string>"))


def present_tokens(parts: Column, strict: bool = True) -> Column:
    """The non-blank tokens of ``token_parts`` in order (all of them when
    ``strict=False``)."""
    return F.array_remove(parts, "") if strict else parts
