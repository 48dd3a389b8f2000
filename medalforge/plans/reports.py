"""One-row-per-customer and one-row-per-product reports ("aggregate first, join second").

Stage 1 aggregates dated facts by the surrogate key: rows are shuffled once, by key, and its distinct values counted
where they lie; keys that may hold a large share of the rows go through Spark's own plan of several distinct
counts, which deals them out by value (``by_key``). Stage 2 joins the dimension to that aggregate, which
has at most one row per dimension member. Stage 3 is row-local arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import band, ratio_or
from ..functions.dates import (age_days_based, as_of_date, months_between_boundary,
                               years_between_boundary)
from ..functions.text import full_name
from ..operators.joins import heavy_candidates, measured_join

# Report labels, fixed values (they are the output). 'Dead' is the reference's
# label for the oldest band; pass other labels to change it.
AGE_BANDS = ("Not Adult", "Middle Age", "Old", "Dead")
CUSTOMER_SEGMENTS = ("VIP", "Regular", "New")
PRODUCT_SEGMENTS = ("High-Performer", "Mid-Range", "Low-Performer")
HEAVY_SHARE = 1e-3  # share of the rows from which a key is never left to one task


def by_key(rows: DataFrame, key: str, distinct: dict[str, str], *others: Column) -> DataFrame:
    """One row per ``key``: the ``others``, and per name in ``distinct`` the number of distinct values of a column.

    Spark's plan for several distinct counts copies each row per count and once for the rest, and shuffles first the copies, then
    their groups by value; with many keys hardly any rows of a task can be combined before either. Here rows are shuffled
    once, by key, and the values of a key are gathered where its rows lie. Keys that may hold ``HEAVY_SHARE`` of the
    rows (from a bounded summary) and NULL keep Spark's plan: they would be too much for one task.
    """
    heavy = heavy_candidates(rows, [key], HEAVY_SHARE)[1][key]
    apart = F.col(key).isNull()
    if heavy:
        apart = apart | F.col(key).cast("string").isin(heavy)
    light = rows.where(~apart).repartition(key).groupBy(key).agg(
        *[F.size(F.collect_set(c)).cast("long").alias(name) for name, c in distinct.items()], *others)
    return light.unionByName(rows.where(apart).groupBy(key).agg(
        *[F.count_distinct(c).alias(name) for name, c in distinct.items()], *others))


def customer_360(fact: DataFrame, dim_c: DataFrame, as_of=None, vip_on: str = "orders",
                 threshold: float = 5000, months: int = 12, age_labels=AGE_BANDS,
                 segment_labels=CUSTOMER_SEGMENTS, age: str = "boundary") -> DataFrame:
    """One row per buying customer (16 columns).

    ``vip_on="orders"`` tests the order count against ``threshold`` as the
    reference does; ``vip_on="amount"`` tests the revenue instead.
    ``age="boundary"`` counts calendar years crossed, as the reference does;
    ``age="days"`` gives completed years (elapsed days / 365.25).
    """
    agg = by_key(
        fact.where(F.col("order_date").isNotNull()), "customer_key",
        {"total_products": "product_key", "total_sales": "sales_order_number"},
        F.sum("sales_amount").alias("total_sales_amount"),
        F.sum("quantity").alias("total_quantity"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("latest_order_date"))
    return customer_report(agg, dim_c, as_of, vip_on, threshold, months, age_labels, segment_labels, age)


def customer_report(agg: DataFrame, dim_c: DataFrame, as_of=None, vip_on: str = "orders", threshold: float = 5000,
                    months: int = 12, age_labels=AGE_BANDS, segment_labels=CUSTOMER_SEGMENTS,
                    age: str = "boundary") -> DataFrame:
    """``customer_360`` from one row per customer key (however aggregated): total_products, total_sales (orders),
    total_sales_amount, total_quantity, first_order, latest_order_date."""
    if vip_on not in ("orders", "amount") or age not in ("boundary", "days"):
        raise ValueError("vip_on must be 'orders' or 'amount'; age 'boundary' or 'days'")
    d = dim_c.select(F.col("customer_key").alias("_dk"), "customer_number", "first_name",
                     "last_name", "customer_birthdate", "customer_gender")
    det = measured_join(agg, d, agg.customer_key == d._dk)
    today = as_of_date(as_of)
    det = det.withColumns({
        "customer_age": (years_between_boundary("customer_birthdate", today) if age == "boundary"
                         else age_days_based("customer_birthdate", today)),
        "lifespan": months_between_boundary("first_order", "latest_order_date"),
    })
    age, life = F.col("customer_age"), F.col("lifespan")
    metric = F.col("total_sales") if vip_on == "orders" else F.col("total_sales_amount")
    amount = F.col("total_sales_amount")
    return det.select(
        F.col("_dk").alias("customer_key"),
        "customer_number",
        full_name("first_name", "last_name").alias("customer_name"),
        "customer_age",
        band([(age < 18, age_labels[0]), (age.between(18, 40), age_labels[1]),
              (age.between(41, 70), age_labels[2])], age_labels[3]).alias("customer_situation"),
        "customer_gender",
        "total_products",
        "total_sales",
        "total_sales_amount",
        "total_quantity",
        ratio_or("total_sales_amount", "total_sales", F.lit(0)).alias("avg_num_of_order"),
        ratio_or("total_sales_amount", "lifespan", amount).alias("avg_monthly_spending"),
        "latest_order_date",
        months_between_boundary("latest_order_date", today).alias("recency"),
        "lifespan",
        band([((life >= months) & (metric > threshold), segment_labels[0]),
              ((life >= months) & (metric <= threshold), segment_labels[1])],
             segment_labels[2]).alias("customer_segment"),
    )


def product_360(fact: DataFrame, dim_p: DataFrame, as_of=None, high: float = 50000,
                mid_low: float = 10000, mid_high: float = 49999,
                labels=PRODUCT_SEGMENTS) -> DataFrame:
    """One row per sold product (15 columns).

    Mid-Range ends at ``mid_high`` = 49999 as in the reference, so a total of
    49999.50 falls to Low-Performer.
    """
    agg = by_key(
        fact.where(F.col("order_date").isNotNull()), "product_key",
        {"total_orders": "sales_order_number", "total_customers_unique": "customer_key"},
        F.sum("sales_amount").alias("total_sales"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("latest_sale_date"))
    return product_report(agg, dim_p, as_of, high, mid_low, mid_high, labels)


def product_report(agg: DataFrame, dim_p: DataFrame, as_of=None, high: float = 50000, mid_low: float = 10000,
                   mid_high: float = 49999, labels=PRODUCT_SEGMENTS) -> DataFrame:
    """``product_360`` from one row per product key: total_orders, total_sales, total_quantity_sold,
    total_customers_unique, first_sale_date, latest_sale_date."""
    agg = agg.withColumn("lifespan", months_between_boundary("first_sale_date", "latest_sale_date"))
    d = dim_p.select(F.col("product_key").alias("_dk"), "product_name",
                     F.col("category_name").alias("product_category"),
                     F.col("subcategory_name").alias("product_subcategory"), "product_cost")
    det = measured_join(agg, d, agg.product_key == d._dk)
    today = as_of_date(as_of)
    sales = F.col("total_sales")
    return det.select(
        F.col("_dk").alias("product_key"),
        "product_name", "product_category", "product_subcategory", "product_cost",
        "total_orders", "total_sales", "total_quantity_sold", "total_customers_unique",
        "lifespan", "latest_sale_date",
        months_between_boundary("latest_sale_date", today).alias("recency"),
        ratio_or("total_sales", "total_orders", F.lit(0)).alias("average_order_revenue"),
        ratio_or("total_sales", "lifespan", sales).alias("average_monthly_revenue"),
        band([(sales >= high, labels[0]), (sales.between(mid_low, mid_high), labels[1])],
             labels[2]).alias("product_performance_segment"),
    )


def top_rows(report: DataFrame, metric: str, key: str, n: int = 100) -> DataFrame:
    """Audit selection: the ``n`` rows with the largest ``metric``; ties by key."""
    return report.orderBy(F.col(metric).desc(), F.col(key).asc_nulls_first()).limit(n)
