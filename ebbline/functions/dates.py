"""Month labels, release strings and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbline.functions.text import strip

# The accepted spellings.
MONTH_FORMATS = ("MMMM yyyy", "MMM yyyy")
RELEASE_FORMATS = ("d MMM, yyyy", "MMM d, yyyy", "d MMMM, yyyy", "MMMM d, yyyy", "MMM yyyy", "MMMM yyyy", "yyyy-MM-dd")
NOT_RELEASED = ("coming soon", "tba", "to be announced")
TRAILING_WINDOW_LABEL = "last 30 days"


def _first_date(text: Column, formats: tuple[str, ...]) -> Column:
    text = F.regexp_replace(text, r"(?i)\bsept\b", "Sep")
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def parse_date(text: Column) -> Column:
    """Lenient calendar date; unknown spellings are NULL."""
    return _first_date(strip(text), RELEASE_FORMATS)


def parse_month(label: Column) -> Column:
    """``February 2024`` to the first of that month; the trailing-window row is NULL."""
    bare = strip(label)
    return F.when(F.lower(bare) != TRAILING_WINDOW_LABEL, F.trunc(_first_date(bare, MONTH_FORMATS), "MM"))


def parse_release_month(text: Column) -> Column:
    """Release string to the first of its month; announcements without a date are NULL."""
    pending = F.lit(False)
    for phrase in NOT_RELEASED:
        pending = pending | F.lower(text).contains(phrase)
    return F.when(~pending, F.trunc(parse_date(text), "MM"))


def months_between(start: Column, end: Column) -> Column:
    """Whole calendar months from start to end; negative when end is earlier."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
