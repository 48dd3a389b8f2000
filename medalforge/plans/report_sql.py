"""Spark SQL text of the two reports, for catalogs that keep a view as its definition.

The text says what ``plans.reports`` says in DataFrame calls, over relations given by name, so a report defined
by it is computed when it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from .reports import AGE_BANDS, CUSTOMER_SEGMENTS, PRODUCT_SEGMENTS


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _day(as_of: str | None) -> str:
    return "current_date()" if as_of is None else f"DATE '{as_of}'"


def _months(start: str, end: str) -> str:
    return f"((year({end}) - year({start})) * 12 + month({end}) - month({start}))"


def _ratio(num: str, den: str, if_zero: str) -> str:
    """num / den rounded half up to cents by one rounding; ``if_zero`` where den is 0."""
    near = f"CAST(ABS(ROUND({num} / NULLIF({den}, 0), 2)) AS DECIMAL(28,2))"
    size = f"CASE WHEN ({near} * ABS({den}) - ABS({num})) * 200 > ABS({den}) THEN {near} - 0.01BD ELSE {near} END"
    signed = f"CASE WHEN ({num} < 0) <> ({den} < 0) THEN -({size}) ELSE {size} END"
    return f"CAST(CASE WHEN {den} = 0 THEN CAST({if_zero} AS DECIMAL(28,2)) ELSE {signed} END AS DECIMAL(28,2))"


def customer_360_sql(fact: str, dim: str, as_of: str | None = None, threshold: float = 5000, months: int = 12,
                     ages: Sequence[str] = AGE_BANDS, segments: Sequence[str] = CUSTOMER_SEGMENTS) -> str:
    today = _day(as_of)
    return f"""
WITH bought AS (
  SELECT customer_key, COUNT(DISTINCT product_key) AS total_products, COUNT(DISTINCT sales_order_number) AS total_sales,
         SUM(sales_amount) AS total_sales_amount, SUM(quantity) AS total_quantity,
         MIN(order_date) AS since, MAX(order_date) AS latest_order_date
  FROM {fact} WHERE order_date IS NOT NULL GROUP BY customer_key),
lived AS (
  SELECT b.*, d.customer_key AS own_key, d.customer_number, d.customer_gender,
         CONCAT(COALESCE(d.first_name, ''), ' ', COALESCE(d.last_name, '')) AS customer_name,
         year({today}) - year(d.customer_birthdate) AS customer_age, {_months('b.since', 'b.latest_order_date')} AS lifespan
  FROM bought b LEFT JOIN {dim} d ON d.customer_key = b.customer_key)
SELECT own_key AS customer_key, customer_number, customer_name, customer_age,
       CASE WHEN customer_age < 18 THEN {_text(ages[0])} WHEN customer_age BETWEEN 18 AND 40 THEN {_text(ages[1])}
            WHEN customer_age BETWEEN 41 AND 70 THEN {_text(ages[2])} ELSE {_text(ages[3])} END AS customer_situation,
       customer_gender, total_products, total_sales, total_sales_amount, total_quantity,
       {_ratio('total_sales_amount', 'total_sales', '0')} AS avg_num_of_order,
       {_ratio('total_sales_amount', 'lifespan', 'total_sales_amount')} AS avg_monthly_spending,
       latest_order_date, {_months('latest_order_date', today)} AS recency, lifespan,
       CASE WHEN lifespan >= {months} AND total_sales > {threshold} THEN {_text(segments[0])}
            WHEN lifespan >= {months} AND total_sales <= {threshold} THEN {_text(segments[1])}
            ELSE {_text(segments[2])} END AS customer_segment
FROM lived"""


def product_360_sql(fact: str, dim: str, as_of: str | None = None, high: float = 50000, mid_low: float = 10000,
                    mid_high: float = 49999, labels: Sequence[str] = PRODUCT_SEGMENTS) -> str:
    today = _day(as_of)
    return f"""
WITH sold AS (
  SELECT product_key, COUNT(DISTINCT sales_order_number) AS total_orders, SUM(sales_amount) AS total_sales,
         SUM(quantity) AS total_quantity_sold, COUNT(DISTINCT customer_key) AS total_customers_unique,
         {_months('MIN(order_date)', 'MAX(order_date)')} AS lifespan, MAX(order_date) AS latest_sale_date
  FROM {fact} WHERE order_date IS NOT NULL GROUP BY product_key)
SELECT d.product_key, d.product_name, d.category_name AS product_category, d.subcategory_name AS product_subcategory,
       d.product_cost, total_orders, total_sales, total_quantity_sold, total_customers_unique, lifespan, latest_sale_date,
       {_months('latest_sale_date', today)} AS recency,
       {_ratio('total_sales', 'total_orders', '0')} AS average_order_revenue,
       {_ratio('total_sales', 'lifespan', 'total_sales')} AS average_monthly_revenue,
       CASE WHEN total_sales >= {high} THEN {_text(labels[0])} WHEN total_sales BETWEEN {mid_low} AND {mid_high} THEN {_text(labels[1])}
            ELSE {_text(labels[2])} END AS product_performance_segment
FROM sold LEFT JOIN {dim} d ON d.product_key = sold.product_key"""
