"""CASE-style banding and guarded ratios."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """First matching (condition, label) wins; NULL conditions fall through."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of a division-by-zero error."""
    d = _col(den)
    return _col(num) / F.when(d != 0, d)


def rounded_ratio(num, den, scale: int = 2, dtype: str | None = None) -> Column:
    """``num / NULLIF(den, 0)`` of exact numbers, rounded once, half away from zero, to ``scale`` places.

    The engine's quotient is itself rounded (at six places or more), so rounding
    it again can lift a value just under a tie; the rounded value times the
    denominator shows that exactly, and one unit is taken back.
    """
    n, d = _col(num), _col(den)
    d = F.when(d != 0, d)
    dtype = dtype or f"decimal(28,{scale})"
    rounded = F.abs(F.round(n / d, scale)).cast(dtype)
    excess = rounded * F.abs(d) - F.abs(n)
    unit = F.lit(Decimal(1).scaleb(-scale))
    size = F.when(excess * F.lit(2 * 10 ** scale) > F.abs(d), rounded - unit).otherwise(rounded)
    return F.when((n < 0) != (d < 0), -size).otherwise(size).cast(dtype)


def ratio_or(num, den, when_zero, scale: int = 2, dtype: str = "decimal(28,2)") -> Column:
    """``CASE WHEN den = 0 THEN when_zero ELSE num / den END``, rounded once to ``scale`` places."""
    return F.when(_col(den) == 0, when_zero.cast(dtype)).otherwise(rounded_ratio(num, den, scale, dtype))
