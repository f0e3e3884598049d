"""Tolerant date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import clean

# Fixed value: the source writes dates as "March 15, 2019".
MONTH_DAY_YEAR = "MMMM d, yyyy"

# The reference engine's reading of that format: a space matches a run of
# ASCII whitespace, the day has 1-2 digits and the year 1-4 digits.
_ASCII_SPACE_RUN = r"[ \t\n\x0B\f\r]+"
_SHAPE = r"^[A-Za-z]+ [0-9]{1,2}, [0-9]{1,4}$"


def parse_month_day_year(c) -> Column:
    """'March 15, 2019' (outer spaces allowed) -> TIMESTAMP_NTZ; bad -> NULL.

    Whitespace runs inside are read as one space and a short year is
    zero-padded ('March 5, 19' is year 19), so the accepted forms equal the
    reference engine's; negative or 5-digit years are rejected.  Parsed as a
    DATE first, so the result never depends on the session time zone, then
    widened to TIMESTAMP_NTZ (midnight) like the reference.
    """
    col = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(clean(col), _ASCII_SPACE_RUN, " ")
    year = F.regexp_extract(text, r"([0-9]+)$", 1)
    padded = F.concat(F.regexp_extract(text, r"^(.*, )", 1), F.lpad(year, 4, "0"))
    parsed = F.try_to_date(padded, MONTH_DAY_YEAR).cast("timestamp_ntz")
    return F.when(text.rlike(_SHAPE), parsed)
