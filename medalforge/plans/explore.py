"""Exploration queries: dimensions, date ranges, headline measures, magnitudes, rankings.

Totals per dimension attribute go through ``operators.rollup``: join first
when the dimension is provably broadcastable (map-side, one shuffle of partial
totals per attribute), otherwise aggregate by key first, join, and merge. The
per-customer revenue aggregates by key first: its groups are the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import rounded_ratio
from ..functions.dates import as_of_date, years_between_boundary
from ..operators.joins import measured_join
from ..operators.rollup import rollup


def distinct_countries(dim_c: DataFrame) -> DataFrame:
    return dim_c.select("customer_country").distinct()


def product_hierarchy(dim_p: DataFrame) -> DataFrame:
    cols = ["category_name", "subcategory_name", "product_name"]
    return dim_p.select(*cols).distinct().orderBy(*cols)


def order_date_range(fact: DataFrame) -> DataFrame:
    r = fact.agg(F.min("order_date").alias("First_Order_Date"),
                 F.max("order_date").alias("Last_Order_Date"))
    return r.withColumn("Total_Years_Between_First_And_Last_Order",
                        years_between_boundary("First_Order_Date", "Last_Order_Date"))


def birthdate_range(dim_c: DataFrame, as_of=None) -> DataFrame:
    today = as_of_date(as_of)
    r = dim_c.agg(F.min("customer_birthdate").alias("oldest_Customer_Birthdate"),
                  F.max("customer_birthdate").alias("youngest_Customer_Birthdate"))
    return r.select(
        "oldest_Customer_Birthdate",
        years_between_boundary("oldest_Customer_Birthdate", today).alias("Age_Of_Oldest_Customer"),
        "youngest_Customer_Birthdate",
        years_between_boundary("youngest_Customer_Birthdate", today).alias("Age_Of_Youngest_Customer"),
        years_between_boundary("oldest_Customer_Birthdate", "youngest_Customer_Birthdate")
        .alias("Age_Diff_Between_Youngest_And_Oldest_Customer"),
    )


# Measure labels of the summary, fixed values (they are the output).
MEASURE_NAMES = (
    "Total Sales Amount",
    "Total Quantity Sold",
    "Average Unit Price",
    "Total Number Of Orders",
    "Total Number Products Sold",
    "Total Number Of Customers (With Orders)",
    "Total Number Of Products In Database",
    "Total Number Of Customers In Database",
)


def _stack(wide: DataFrame, names: list[str], cols: list[str], dtype: str) -> DataFrame:
    """One wide row of measures → (measure_name, measure_value) rows."""
    entries = []
    for n, c in zip(names, cols):
        entries += [F.lit(n), F.col(c).cast(dtype)]
    return wide.select(F.stack(F.lit(len(cols)), *entries).alias("measure_name", "measure_value"))


def measure_summary(fact: DataFrame, dim_p: DataFrame, dim_c: DataFrame,
                    dtype: str = "decimal(28,2)") -> DataFrame:
    """Eight headline measures as (measure_name, measure_value) rows.

    Every column is read once: one aggregate for the sums and the mean, and
    one single-distinct aggregate per counted column (Parquet is columnar, so
    separate scans of different columns read disjoint bytes). Unlike several
    distinct counts in one aggregate, this needs no row expansion. Values are
    DECIMAL(28,2) rather than (18,2), so sums cannot overflow.
    """
    names = list(MEASURE_NAMES)
    totals = fact.agg(F.sum("sales_amount").alias("m0"), F.sum("quantity").alias("m1"),
                      F.sum("unit_price").alias("p"), F.count("unit_price").alias("n"))
    totals = totals.withColumn("m2", rounded_ratio("p", "n"))
    parts = [_stack(totals, names[:3], ["m0", "m1", "m2"], dtype)]
    counted = [(fact, "sales_order_number"), (fact, "product_key"), (fact, "customer_key"),
               (dim_p, "product_key"), (dim_c, "customer_key")]
    for name, (df, col) in zip(names[3:], counted):
        parts.append(_stack(df.agg(F.count_distinct(col).alias("v")), [name], ["v"], dtype))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _desc_then(alias: str, attr: str) -> list:
    """Largest first; ties by the attribute, so the listing is deterministic."""
    return [F.col(alias).desc(), F.col(attr).asc_nulls_first()]


def _count_by(df: DataFrame, attr: str, key: str, alias: str) -> DataFrame:
    return df.groupBy(attr).agg(F.count(key).alias(alias)).orderBy(*_desc_then(alias, attr))


def customers_by_country(dim_c: DataFrame) -> DataFrame:
    return _count_by(dim_c, "customer_country", "customer_key", "Total_Customers_per_country")


def customers_by_gender(dim_c: DataFrame) -> DataFrame:
    return _count_by(dim_c, "customer_gender", "customer_key", "Total_Customers_per_gender")


def products_by_category(dim_p: DataFrame) -> DataFrame:
    return _count_by(dim_p, "category_name", "product_key", "Total_Products_per_category")


def avg_cost_by_category(dim_p: DataFrame) -> DataFrame:
    alias = "Average_Product_Cost_per_Category"
    return (dim_p.groupBy("category_name").agg(F.avg("product_cost").alias(alias))
            .orderBy(*_desc_then(alias, "category_name")))


def _by_key(fact: DataFrame, key: str, **aggs) -> DataFrame:
    return fact.groupBy(key).agg(*[expr.alias(name) for name, expr in aggs.items()])


def revenue_by_category(fact: DataFrame, dim_p: DataFrame) -> DataFrame:
    alias = "Total_revenue_per_Category"
    totals = rollup(fact, dim_p, "product_key", ["category_name"], {alias: ("sum", "sales_amount")})
    return totals.orderBy(*_desc_then(alias, "category_name"))


def revenue_by_customer(fact: DataFrame, dim_c: DataFrame) -> DataFrame:
    alias = "Total_revenue_per_Customer"
    per_customer = _by_key(fact, "customer_key", _rev=F.sum("sales_amount"))
    d = dim_c.select(F.col("customer_key").alias("_dk"), "first_name", "last_name")
    joined = measured_join(per_customer, d, per_customer.customer_key == d._dk)
    # Unmatched and NULL fact keys both end in the NULL dimension key group.
    # the key as tiebreak keeps the global sort splittable when many totals are equal
    return (joined.groupBy(F.col("_dk").alias("customer_key"), "first_name", "last_name")
            .agg(F.sum("_rev").alias(alias))
            .orderBy(F.col(alias).desc(), F.col("customer_key").asc_nulls_first()))


def items_sold_by_country(fact: DataFrame, dim_c: DataFrame) -> DataFrame:
    """Counts sales rows with a quantity (not the quantity summed), as the reference does."""
    alias = "Total_Products_Sold_per_Country"
    totals = rollup(fact, dim_c, "customer_key", ["customer_country"], {alias: ("count", "quantity")})
    return totals.orderBy(*_desc_then(alias, "customer_country"))


def top_products(fact: DataFrame, dim_p: DataFrame, n: int = 5, best: bool = True) -> DataFrame:
    """Best (or worst) ``n`` product names by revenue; ties broken by name."""
    alias = "Total_revenue_per_Product"
    by_name = rollup(fact, dim_p, "product_key", ["product_name"], {alias: ("sum", "sales_amount")})
    order = F.col(alias).desc() if best else F.col(alias).asc()
    return by_name.orderBy(order, F.col("product_name").asc_nulls_first()).limit(n)
