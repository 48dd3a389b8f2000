"""Advanced analytics: monthly series, running and rolling windows, growth,
yearly product trend, share of total, cost bands and customer value segments.

Every window here runs on already aggregated rows (one per month, per
product-year or per category), never on fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import band, rounded_ratio
from ..functions.dates import month_abbrev, month_start, months_between_boundary
from ..functions.text import percent_text
from ..operators.joins import measured_join
from ..operators.rollup import rollup


def _dated(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("order_date").isNotNull())


def growth_pct(current, previous) -> Column:
    """(current - previous) / previous × 100, rounded to 2 places; NULL if previous is 0 or NULL."""
    cur = F.col(current) if isinstance(current, str) else current
    prev = F.col(previous) if isinstance(previous, str) else previous
    return rounded_ratio((cur - prev) * 100, prev, dtype="decimal(18,2)")


def sales_by_year_month(fact: DataFrame) -> DataFrame:
    d = F.col("order_date")
    g = _dated(fact).groupBy(F.year(d).alias("order_year"), F.month(d).alias("_m"),
                             month_abbrev(d).alias("order_month"))
    out = g.agg(F.sum("sales_amount").alias("total_sales"),
                F.sum("quantity").alias("total_quantity"),
                F.count_distinct("sales_order_number").alias("total_units_solds"))
    return out.orderBy(F.col("order_year").desc(), F.col("_m")).drop("_m")


def monthly_sales(fact: DataFrame, dense: bool = False) -> DataFrame:
    """One row per month with sales: total sales, quantity, distinct orders.

    ``dense=True`` adds the months between the first and the last one that
    had no sales, with zero totals, so that row offsets equal calendar months.
    The months in between come from the gap to the next monthly row, so the fact
    is read and aggregated once.
    """
    monthly = _dated(fact).groupBy(month_start("order_date").alias("order_month")).agg(
        F.sum("sales_amount").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.count_distinct("sales_order_number").alias("total_units_solds"))
    if not dense:
        return monthly
    following = F.lead("order_month").over(Window.orderBy("order_month"))  # one row per month
    until = F.coalesce(F.add_months("_next", -1), F.col("order_month"))
    spread = (monthly.withColumn("_next", following)
              .withColumn("_m", F.explode(F.sequence("order_month", until, F.expr("INTERVAL 1 MONTH")))))
    own = F.col("_m") == F.col("order_month")
    measures = ("total_sales", "total_quantity", "total_units_solds")
    return spread.select(F.col("_m").alias("order_month"), *[
        F.when(own, F.col(c)).otherwise(F.lit(0)).cast(monthly.schema[c].dataType).alias(c) for c in measures])


def monthly_trend(fact: DataFrame, window: int = 3, dense: bool = False) -> DataFrame:
    """Month series with running total, rolling mean, average price, AOV, MoM and YoY %.

    LAG 1 and LAG 12 are previous *rows*, as in the reference; months with no
    sales are absent unless ``dense=True``.
    """
    return series_trend(monthly_sales(fact, dense), window)


def series_trend(monthly: DataFrame, window: int = 3) -> DataFrame:
    """``monthly_trend`` from one row per month: order_month, total_sales, total_quantity, total_units_solds."""
    w = Window.orderBy("order_month")  # one row per month: a small, bounded series
    sales = F.col("total_sales")
    return monthly.select(
        "order_month",
        "total_sales",
        F.sum(sales).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         .alias("cumulative_total_sales"),
        F.avg(sales).over(w.rowsBetween(-(window - 1), Window.currentRow))
         .alias(f"rolling_{window}_month_avg_sales"),
        rounded_ratio(sales, "total_quantity", dtype="decimal(18,2)").alias("monthly_avg_price"),
        rounded_ratio(sales, "total_units_solds", dtype="decimal(18,2)").alias("average_order_value"),
        growth_pct(sales, F.lag(sales, 1).over(w)).alias("mom_growth_pct"),
        growth_pct(sales, F.lag(sales, 12).over(w)).alias("yoy_growth_pct"),
    ).orderBy("order_month")


def product_year_trend(fact: DataFrame, dim_p: DataFrame, corrected: bool = False) -> DataFrame:
    """Yearly sales per product name against the previous year and the product's mean.

    The reference labels a fall from the previous year 'Increasing' (and a
    rise 'Decreasing'); that is kept by default, ``corrected=True`` swaps it.
    """
    # Totals per (name, year) are combined map-side before any shuffle, so a
    # name shared by many products stays combined; the window sees one row per year.
    ps = rollup(_dated(fact), dim_p, "product_key", ["product_name"],
                {"current_year_sales": ("sum", "sales_amount")},
                fact_groups={"order_year": F.year("order_date")})
    ordered = Window.partitionBy("product_name").orderBy("order_year")
    whole = Window.partitionBy("product_name")
    cur = F.col("current_year_sales")
    ps = ps.withColumns({"previous_year_sales": F.lag(cur).over(ordered),
                         "avg_sales_per_year": F.avg(cur).over(whole)})
    prev, avg = F.col("previous_year_sales"), F.col("avg_sales_per_year")
    up, down = ("Decreasing", "Increasing") if corrected else ("Increasing", "Decreasing")
    return ps.select(
        "product_name", "order_year", "current_year_sales", "previous_year_sales",
        band([(prev > cur, up), (prev < cur, down)], "Stable").alias("sales_trend"),
        "avg_sales_per_year",
        band([(cur > avg, "Above Average"), (cur < avg, "Below Average")], "Average")
        .alias("sales_performance"),
    ).orderBy("product_name", "order_year")


def share_of_total(value: str, dtype: str = "decimal(28,2)") -> tuple[Column, Column]:
    """(overall total, share in percent rounded to 2 places) over all rows of a small frame."""
    overall = F.sum(value).over(Window.partitionBy())
    return overall, rounded_ratio(F.col(value).cast(dtype) * 100, overall.cast(dtype), dtype="decimal(18,2)")


def category_contribution(fact: DataFrame, dim_p: DataFrame, numeric: bool = False) -> DataFrame:
    """Per category: quantity, sales, cost and profit with overall totals and shares.

    Cost is the product cost summed once per sales row (not times quantity),
    as in the reference; a category whose costs are all NULL has NULL cost and
    NULL profit. Totals come from ``operators.rollup``. Shares are
    text with a '%' sign as in the reference; ``numeric=True`` adds each share
    as DECIMAL(18,2) too (``category_<measure>_share``).
    """
    cat = rollup(_dated(fact), dim_p, "product_key", ["category_name"],
                 {"total_quantity": ("sum", "quantity"), "total_sales": ("sum", "sales_amount")},
                 dim_measures={"total_product_cost": "product_cost"})
    cat = cat.withColumn("total_profit", F.col("total_sales") - F.col("total_product_cost"))
    cols = ["category_name"]
    for measure, label in (("total_quantity", "quantity"), ("total_sales", "sales"),
                           ("total_product_cost", "product_cost"), ("total_profit", "profit")):
        overall, share = share_of_total(measure)
        cols += [measure, overall.alias(f"overall_{measure}"),
                 percent_text(share).alias(f"category_{label}_percentage")]
        if numeric:
            cols.append(share.alias(f"category_{label}_share"))
    return cat.select(*cols).orderBy(F.col("total_sales").desc(),
                                     F.col("category_name").asc_nulls_first())


# Cost band labels, fixed values (they are the output).
COST_BANDS = ("Low Cost Under 200", "Medium Cost Between 200 and 1000", "High Cost Above 1000")


def product_cost_bands(dim_p: DataFrame, low: float = 200, high: float = 1000,
                       labels=COST_BANDS) -> DataFrame:
    cost = F.col("product_cost")
    banded = dim_p.withColumn("cost_category", band(
        [(cost < low, labels[0]), (cost.between(low, high), labels[1])], labels[2]))
    return banded.groupBy("cost_category").agg(F.count("product_key").alias("product_count"))


# Customer value segment labels, fixed values (they are the output).
VALUE_SEGMENTS = ("High Value Long-Term Customer", "Low Value Long-Term Customer", "New Customer")


def customer_value_segments(fact: DataFrame, dim_c: DataFrame, months: int = 12,
                            amount: float = 5000, labels=VALUE_SEGMENTS) -> DataFrame:
    per = _dated(fact).groupBy("customer_key").agg(
        F.sum("sales_amount").alias("_s"), F.min("order_date").alias("_f"),
        F.max("order_date").alias("_l"))
    d = dim_c.select(F.col("customer_key").alias("_dk"))
    # Re-key on the dimension: unmatched and NULL fact keys share the NULL group.
    life = (measured_join(per, d, per.customer_key == d._dk).groupBy("_dk")
               .agg(F.sum("_s").alias("total_sales"), F.min("_f").alias("_f"),
                    F.max("_l").alias("_l")))
    months_active = months_between_boundary("_f", "_l")
    total = F.col("total_sales")
    seg = band([((months_active >= months) & (total > amount), labels[0]),
                ((months_active >= months) & (total <= amount), labels[1])], labels[2])
    return (life.withColumn("customer_segment", seg).groupBy("customer_segment")
                .agg(F.count("_dk").alias("customer_count"))
                .select("customer_count", "customer_segment"))
