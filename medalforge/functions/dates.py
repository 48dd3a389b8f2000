"""Date helpers with the boundary-counting semantics of the reference.

A year (month) difference counts calendar boundaries crossed, not elapsed
time: Dec 31 → Jan 1 is one year and Jan 31 → Feb 1 one month. Spark's
``months_between`` / ``datediff`` measure elapsed time, so they are not used.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of) -> Column:
    """``None`` → today's date; a ``date`` or ISO string → that date literal."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, date):
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("date")


def years_between_boundary(start, end) -> Column:
    """Number of year boundaries between two dates (int)."""
    return F.year(_col(end)) - F.year(_col(start))


def months_between_boundary(start, end) -> Column:
    """Number of month boundaries between two dates (int)."""
    s, e = _col(start), _col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def month_start(d) -> Column:
    """First day of the month, kept as DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(_col(d), "MM")


def month_abbrev(d) -> Column:
    """Three-letter English month name (Jan … Dec)."""
    return F.date_format(_col(d), "MMM")


def age_days_based(birthdate, as_of=None) -> Column:
    """Completed years by elapsed days / 365.25, the precise alternative."""
    return F.floor(F.datediff(as_of_date(as_of), _col(birthdate)) / F.lit(365.25)).cast("int")
