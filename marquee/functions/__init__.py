"""Column-expression helpers.  Every function returns a ``Column`` built from
built-in Spark functions only, so all of it runs inside whole-stage codegen."""

from marquee.functions.text import (
    clean, blank_to_null, present_tokens, token_parts, SPACE_SEPARATORS,
)
from marquee.functions.numeric import round_half_away, pct, safe_ratio, to_int
from marquee.functions.dates import parse_month_day_year
from marquee.functions.codes import (
    RATING_BANDS, GENRE_NORMALISATION, TITLE_TYPES, audience_band, normalise_genre,
)
from marquee.functions.measures import unit_measure

__all__ = [
    "clean", "blank_to_null", "present_tokens", "token_parts",
    "SPACE_SEPARATORS",
    "round_half_away", "pct", "safe_ratio", "to_int", "parse_month_day_year",
    "RATING_BANDS", "GENRE_NORMALISATION", "TITLE_TYPES", "audience_band",
    "normalise_genre", "unit_measure",
]
