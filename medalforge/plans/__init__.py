"""Named analytic queries and reports."""

from . import explore, reports, trends

__all__ = ["explore", "reports", "trends"]
