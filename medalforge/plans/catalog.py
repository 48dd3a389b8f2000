"""Named analytic queries over the gold tables: ``name -> (gold, as_of) -> DataFrame``.

This is the list a user of the warehouse runs; it knows nothing of where the
gold tables came from. ``run`` looks a query up by name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import explore, reports, trends

Gold = dict[str, DataFrame]


def _f(g: Gold) -> DataFrame:
    return g["fact_sales"]


def _c(g: Gold) -> DataFrame:
    return g["dim_customer_info"]


def _p(g: Gold) -> DataFrame:
    return g["dim_product_info"]


ANALYTICS: dict[str, Callable[[Gold, object], DataFrame]] = {
    "distinct_countries": lambda g, a: explore.distinct_countries(_c(g)),
    "product_hierarchy": lambda g, a: explore.product_hierarchy(_p(g)),
    "order_date_range": lambda g, a: explore.order_date_range(_f(g)),
    "birthdate_range": lambda g, a: explore.birthdate_range(_c(g), a),
    "measure_summary": lambda g, a: explore.measure_summary(_f(g), _p(g), _c(g)),
    "customers_by_country": lambda g, a: explore.customers_by_country(_c(g)),
    "customers_by_gender": lambda g, a: explore.customers_by_gender(_c(g)),
    "products_by_category": lambda g, a: explore.products_by_category(_p(g)),
    "avg_cost_by_category": lambda g, a: explore.avg_cost_by_category(_p(g)),
    "revenue_by_category": lambda g, a: explore.revenue_by_category(_f(g), _p(g)),
    "revenue_by_customer": lambda g, a: explore.revenue_by_customer(_f(g), _c(g)),
    "items_sold_by_country": lambda g, a: explore.items_sold_by_country(_f(g), _c(g)),
    "top5_products": lambda g, a: explore.top_products(_f(g), _p(g), 5, best=True),
    "bottom5_products": lambda g, a: explore.top_products(_f(g), _p(g), 5, best=False),
    "sales_by_year_month": lambda g, a: trends.sales_by_year_month(_f(g)),
    "monthly_trend": lambda g, a: trends.monthly_trend(_f(g)),
    "product_year_trend": lambda g, a: trends.product_year_trend(_f(g), _p(g)),
    "category_contribution": lambda g, a: trends.category_contribution(_f(g), _p(g)),
    "product_cost_bands": lambda g, a: trends.product_cost_bands(_p(g)),
    "customer_value_segments": lambda g, a: trends.customer_value_segments(_f(g), _c(g)),
    "customer_360": lambda g, a: reports.customer_360(_f(g), _c(g), a),
    "product_360": lambda g, a: reports.product_360(_f(g), _p(g), a),
    "customer_360_top100": lambda g, a: reports.top_rows(
        reports.customer_360(_f(g), _c(g), a), "total_sales_amount", "customer_key"),
    "product_360_top100": lambda g, a: reports.top_rows(
        reports.product_360(_f(g), _p(g), a), "total_sales", "product_key"),
}


def run(name: str, gold: Gold, as_of=None) -> DataFrame:
    """The named query over ``gold``; ``as_of`` defaults to today's date."""
    if name not in ANALYTICS:
        raise KeyError(f"unknown query {name!r}; known: {sorted(ANALYTICS)}")
    return ANALYTICS[name](gold, as_of)
