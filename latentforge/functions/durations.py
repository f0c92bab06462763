"""Durations as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# ``H:MM:SS`` (hours 0–23) or ``MM:SS``; minutes and seconds 0–59 with one or
# two digits.  Anything else parses to 0.
DURATION_PATTERN = r"^(?:([01]?\d|2[0-3]):)?([0-5]?\d):([0-5]?\d)$"


def _part(c: Column, idx: int) -> Column:
    g = F.regexp_extract(c, DURATION_PATTERN, idx)
    return F.coalesce(F.nullif(g, F.lit("")).cast("int"), F.lit(0))


def parse_duration(c) -> Column:
    """Seconds of a duration text; 0 when it does not parse."""
    c = col_(c)
    secs = _part(c, 1) * 3600 + _part(c, 2) * 60 + _part(c, 3)
    return F.when(c.rlike(DURATION_PATTERN), secs).otherwise(F.lit(0)).cast("int")


def format_duration(seconds) -> Column:
    """Whole seconds as ``H:MM:SS`` with a ``N day(s), `` prefix past 24 h.

    Truncates toward zero first; negative values get a negative day count
    and a positive clock, like Python's ``timedelta`` text.
    """
    t = col_(seconds).cast("double").cast("long")
    days = F.floor(t / F.lit(86400)).cast("long")
    rest = t - days * 86400
    clock = F.format_string("%d:%02d:%02d", F.floor(rest / 3600).cast("long"),
                            F.floor((rest % 3600) / 60).cast("long"), (rest % 60).cast("long"))
    prefix = F.when(days == 0, F.lit("")).otherwise(
        F.concat(days.cast("string"),
                 F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))))
    return F.concat(prefix, clock)
