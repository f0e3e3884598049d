"""Code tables: rating -> audience band, genre label -> normalised genre."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import clean

# Fixed values (must equal the reference for equal results).
TITLE_TYPES = ("Movie", "TV Show")

# The 14 rating codes folded into 5 audience bands.
RATING_BANDS = {
    "Kids": ("G", "TV-G", "TV-Y"),
    "Older kids": ("PG", "TV-PG", "TV-Y7", "TV-Y7-FV"),
    "Teens": ("PG-13", "TV-14"),
    "Adults": ("R", "NC-17", "TV-MA"),
    "Unrated": ("NR", "UR"),
}

# Platform genre label -> normalised genre.  Labels not listed
# keep their own (trimmed) text.
GENRE_NORMALISATION = {
    "TV Dramas": "Dramas",
    "TV Comedies": "Comedies",
    "TV Action & Adventure": "Action & Adventure",
    "TV Horror": "Horror",
    "Horror Movies": "Horror",
    "TV Thrillers": "Thrillers",
    "TV Mysteries": "Mysteries",
    "TV Sci-Fi & Fantasy": "Sci-Fi & Fantasy",
    "Sci-Fi & Fantasy": "Sci-Fi & Fantasy",
    "Romantic TV Shows": "Romance",
    "Romantic Movies": "Romance",
    "International TV Shows": "International",
    "International Movies": "International",
    "Documentaries": "Documentary",
    "Docuseries": "Documentary",
    "Kids' TV": "Kids",
    "Children & Family Movies": "Kids",
    "Stand-Up Comedy & Talk Shows": "Stand-Up Comedy",
    "Independent Movies": "Independent",
    "Classic & Cult TV": "Classic & Cult",
    "Classic Movies": "Classic & Cult",
    "Cult Movies": "Classic & Cult",
    "Crime TV Shows": "Crime",
    "Music & Musicals": "Music",
}


def audience_band(rating) -> Column:
    """Trimmed rating code -> band; unknown or NULL -> NULL."""
    r = clean(F.col(rating) if isinstance(rating, str) else rating)
    expr = None
    for band, codes in RATING_BANDS.items():
        cond = r.isin(*codes)
        expr = F.when(cond, F.lit(band)) if expr is None else expr.when(cond, F.lit(band))
    return expr


def _genre_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(GENRE_NORMALISATION.items())])


def normalise_genre(label) -> Column:
    """Mapped label, or the label itself when unmapped.  ``try_element_at``
    returns NULL for a missing key even with ANSI mode on."""
    col = F.col(label) if isinstance(label, str) else label
    return F.coalesce(F.try_element_at(_genre_map(), col), col)
