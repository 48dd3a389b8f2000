"""The reports from merged partial aggregates (``operators.partials``): no fact row is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.partials import SalesPartials
from .reports import customer_report, product_report
from .trends import series_trend


def customer_360(partials: SalesPartials, dim_c: DataFrame, as_of=None, **options) -> DataFrame:
    agg = partials.summary("customer").select(
        "customer_key", F.col("n_products").alias("total_products"), F.col("n_orders").alias("total_sales"),
        F.col("sales").alias("total_sales_amount"), F.col("quantity").alias("total_quantity"), "first_order",
        F.col("latest_order").alias("latest_order_date"))
    return customer_report(agg, dim_c, as_of, **options)


def product_360(partials: SalesPartials, dim_p: DataFrame, as_of=None, **options) -> DataFrame:
    agg = partials.summary("product").select(
        "product_key", F.col("n_orders").alias("total_orders"), F.col("sales").alias("total_sales"),
        F.col("quantity").alias("total_quantity_sold"), F.col("n_customers").alias("total_customers_unique"),
        F.col("first_order").alias("first_sale_date"), F.col("latest_order").alias("latest_sale_date"))
    return product_report(agg, dim_p, as_of, **options)


def monthly_trend(partials: SalesPartials, window: int = 3) -> DataFrame:
    monthly = partials.summary("month").select(
        "order_month", F.col("sales").alias("total_sales"), F.col("quantity").alias("total_quantity"),
        F.col("n_orders").alias("total_units_solds"))
    return series_trend(monthly, window)
