"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first, last, sep: str = " ") -> Column:
    """Concatenate with NULL treated as empty, so a missing part keeps the separator."""
    return F.concat(F.coalesce(_col(first), F.lit("")), F.lit(sep),
                    F.coalesce(_col(last), F.lit("")))


def percent_text(share) -> Column:
    """A share already in percent → text with two decimals and a '%' sign."""
    return F.concat(_col(share).cast("decimal(18,2)").cast("string"), F.lit("%"))
