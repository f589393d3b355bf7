"""Date parsing and reference-date helpers as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first year and day of setlist history that is kept.
MIN_SETLIST_YEAR = 2000
MIN_SETLIST_DATE = dt.date(2000, 1, 1)

# Fixed value: how far ahead listings are looked at.
LISTING_DAYS = 365


def iso_date(c: Column) -> Column:
    """'yyyy-MM-dd' text as a date; anything else is null, for the not-null check to find."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date"))


def mixed_date(c: Column) -> Column:
    """'dd-MM-yyyy' or ISO text as a date, else null.

    Turning the one form into the other first leaves a single parse that never throws;
    trying a date pattern on text of another form costs an exception per row.
    """
    return iso_date(F.regexp_replace(c, r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1"))


def setlist_year(c: Column) -> Column:
    """Year of a 'DD-MM-YYYY' text, null when it has another form."""
    parts = F.split(c, "-")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(2))).try_cast("int")


def leading_year(c: Column) -> Column:
    """Year of a partial date such as '1998' or '1998-05', else null."""
    return F.regexp_extract(c, r"^(\d{4})", 1).try_cast("bigint")


def day(as_of: dt.date | Column | None) -> Column:
    """A reference day: the one given, or today."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def moment(at: dt.datetime | Column | None) -> Column:
    """A reference time: the one given, or now."""
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")


def within_listing_window(event_date: Column, as_of: dt.date | Column | None) -> Column:
    start = day(as_of)
    return event_date.between(start, F.date_add(start, LISTING_DAYS))
