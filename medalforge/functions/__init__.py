"""Column-level helpers; each returns a ``Column`` built from Spark functions."""

from .bands import band, ratio_or, rounded_ratio, safe_ratio
from .dates import (age_days_based, month_abbrev, month_start, months_between_boundary,
                    years_between_boundary)
from .text import full_name, percent_text

__all__ = ["band", "safe_ratio", "ratio_or", "rounded_ratio", "age_days_based", "month_abbrev",
           "month_start", "months_between_boundary", "years_between_boundary",
           "full_name", "percent_text"]
