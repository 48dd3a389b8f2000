"""Hand-made rows for behaviour the fixtures cannot reach."""

from datetime import date
from decimal import Decimal

import pytest

from medalforge.functions import (full_name, month_start, months_between_boundary,
                                  percent_text, years_between_boundary)
from medalforge.plans import explore, reports, trends

FACT = ("sales_order_number string, product_key bigint, customer_key bigint, order_date date, "
        "ship_date date, due_date date, sales_amount decimal(18,2), quantity int, "
        "unit_price decimal(18,2)")
DIM_C = ("customer_key bigint, customer_id bigint, customer_number string, first_name string, "
         "last_name string, customer_country string, customer_gender string, marital_status string, "
         "customer_birthdate date, customer_create_date date")
DIM_P = ("product_key bigint, product_id bigint, product_number string, product_name string, "
         "category_id string, category_name string, subcategory_name string, "
         "category_maintenance string, product_cost decimal(18,2), product_line string, "
         "product_start_date date")


def fact_rows(spark, rows):
    full = [(o, p, c, d, d, d, Decimal(str(a)), q, Decimal(str(a))) for o, p, c, d, a, q in rows]
    return spark.createDataFrame(full, FACT)


def dim_c(spark, rows):
    full = [(k, k, f"C{k}", fn, ln, "X", "Male", "Single", b, date(2000, 1, 1))
            for k, fn, ln, b in rows]
    return spark.createDataFrame(full, DIM_C)


def dim_p(spark, rows):
    full = [(k, k, f"P{k}", name, "T", cat, "t", "No", Decimal(str(cost)), "L", date(1994, 1, 1))
            for k, name, cat, cost in rows]
    return spark.createDataFrame(full, DIM_P)


def one(df):
    return [r.asDict() for r in df.collect()]


def test_boundary_differences(spark):
    df = spark.createDataFrame([(date(2020, 1, 31), date(2020, 2, 1)),
                                (date(2020, 12, 31), date(2021, 1, 1)),
                                (date(2021, 1, 1), date(2020, 12, 31))], "a date, b date")
    out = df.select(months_between_boundary("a", "b").alias("m"),
                    years_between_boundary("a", "b").alias("y"),
                    month_start("b").alias("ms")).collect()
    assert [(r.m, r.y) for r in out] == [(1, 0), (1, 1), (-1, -1)]
    assert out[0].ms == date(2020, 2, 1)


def test_full_name_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)],
                               "f string, l string")
    assert [r.n for r in df.select(full_name("f", "l").alias("n")).collect()] == \
        ["a b", " b", "a ", " "]


def test_percent_text_two_decimals(spark):
    df = spark.createDataFrame([(Decimal("12.3"),), (Decimal("-0.004"),), (None,)],
                               "v decimal(10,3)")
    assert [r.p for r in df.select(percent_text("v").alias("p")).collect()] == \
        ["12.30%", "0.00%", None]


def test_year_end_birthday_counts_a_year(spark):
    c = dim_c(spark, [(1, "a", "b", date(1990, 12, 31)), (2, "c", "d", date(1991, 1, 1))])
    r = one(explore.birthdate_range(c, "2002-01-01"))[0]
    assert r["Age_Of_Oldest_Customer"] == 12 and r["Age_Of_Youngest_Customer"] == 11
    assert r["Age_Diff_Between_Youngest_And_Oldest_Customer"] == 1


def test_trend_label_is_inverted_by_default(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 5, 1), 100, 1),
                          ("O2", 1, 1, date(2001, 5, 1), 50, 1),
                          ("O3", 1, 1, date(2002, 5, 1), 50, 1)])
    p = dim_p(spark, [(1, "widget", "Core", 10)])
    rows = one(trends.product_year_trend(f, p))
    assert [r["sales_trend"] for r in rows] == ["Stable", "Increasing", "Stable"]
    fixed = one(trends.product_year_trend(f, p, corrected=True))
    assert [r["sales_trend"] for r in fixed] == ["Stable", "Decreasing", "Stable"]
    assert [r["sales_performance"] for r in rows] == ["Above Average", "Below Average",
                                                      "Below Average"]
    assert rows[0]["avg_sales_per_year"] == Decimal("66.666667")


def test_lag_uses_previous_row_not_calendar_month(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 1, 5), 100, 1),
                          ("O2", 1, 1, date(2000, 4, 5), 150, 0)])
    rows = one(trends.monthly_trend(f))
    assert [r["order_month"] for r in rows] == [date(2000, 1, 1), date(2000, 4, 1)]
    assert rows[1]["mom_growth_pct"] == Decimal("50.00")
    assert rows[1]["cumulative_total_sales"] == Decimal("250.00")
    assert rows[1]["monthly_avg_price"] is None  # zero quantity: NULL, not an error
    assert rows[0]["mom_growth_pct"] is None and rows[1]["yoy_growth_pct"] is None


def test_growth_from_zero_is_null(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 1, 5), 0, 1),
                          ("O2", 1, 1, date(2000, 2, 5), 10, 1)])
    rows = one(trends.monthly_trend(f))
    assert rows[1]["mom_growth_pct"] is None


def test_ratios_round_half_up(spark):
    # 1001 / 40 = 25.025 exactly: decimal arithmetic rounds it up to 25.03.
    f = fact_rows(spark, [(f"O{i}", 1, 1, date(2000, 1, 1), 0, 1) for i in range(39)]
                  + [("O39", 1, 1, date(2000, 1, 1), 1001, 1)])
    row = one(trends.monthly_trend(f))[0]
    assert row["average_order_value"] == Decimal("25.03")


def test_product_segment_boundaries(spark):
    amounts = {1: 49999.50, 2: 50000, 3: 10000, 4: 9999.99, 5: 49999}
    f = fact_rows(spark, [(f"O{k}", k, 1, date(2000, 1, 1), a, 1) for k, a in amounts.items()])
    p = dim_p(spark, [(k, f"p{k}", "Core", 10) for k in amounts])
    seg = {r["product_key"]: r["product_performance_segment"]
           for r in one(reports.product_360(f, p, "2002-01-01"))}
    assert seg == {1: "Low-Performer", 2: "High-Performer", 3: "Mid-Range",
                   4: "Low-Performer", 5: "Mid-Range"}


def test_vip_needs_more_than_threshold_orders(spark):
    def orders(cust, n):
        return [(f"C{cust}-{i}", 1, cust, date(2000, 1, 1) if i == 0 else date(2001, 6, 1), 1, 1)
                for i in range(n)]
    f = fact_rows(spark, orders(1, 5001) + orders(2, 5000) + [("X", 1, 3, date(2000, 1, 1), 5, 1)])
    c = dim_c(spark, [(1, "a", "b", None), (2, "c", None, date(1950, 6, 1)),
                      (3, "e", "f", date(1995, 1, 1))])
    rows = {r["customer_key"]: r for r in one(reports.customer_360(f, c, "2002-01-01"))}
    assert rows[1]["customer_segment"] == "VIP" and rows[2]["customer_segment"] == "Regular"
    assert rows[3]["customer_segment"] == "New"
    assert rows[1]["lifespan"] == 17 and rows[1]["recency"] == 7
    # lifespan 0: monthly spending is the whole amount; NULL birthdate falls to the last band
    assert rows[3]["avg_monthly_spending"] == Decimal("5.00")
    assert rows[1]["customer_situation"] == "Dead" and rows[1]["customer_age"] is None
    assert rows[2]["customer_name"] == "c " and rows[2]["customer_situation"] == "Old"
    assert rows[3]["customer_situation"] == "Not Adult"
    by_amount = {r["customer_key"]: r["customer_segment"]
                 for r in one(reports.customer_360(f, c, "2002-01-01", vip_on="amount",
                                                   threshold=5000))}
    assert by_amount[1] == "VIP" and by_amount[2] == "Regular"


def test_null_keys_form_one_group(spark):
    f = fact_rows(spark, [("O1", None, None, date(2000, 1, 1), 30, 1),
                          ("O2", None, None, date(2000, 1, 1), 20, 1),
                          ("O3", 1, 1, date(2000, 1, 1), 10, 1)])
    p = dim_p(spark, [(1, "w", "Core", 10)])
    c = dim_c(spark, [(1, "a", "b", None)])
    top = one(explore.top_products(f, p, 5))
    assert top[0]["product_name"] is None and top[0]["Total_revenue_per_Product"] == Decimal("50.00")
    seg = {r["customer_segment"]: r["customer_count"]
           for r in one(trends.customer_value_segments(f, c))}
    assert seg == {"New Customer": 1}  # the NULL group counts 0 keys and merges nowhere
    rows = one(trends.customer_value_segments(f, c))
    assert sum(r["customer_count"] for r in rows) == 1


def test_contribution_shares_sum_to_100(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 1, 1), 10, 3), ("O2", 2, 1, date(2000, 1, 1), 20, 1),
                          ("O3", 3, 1, date(2000, 1, 1), 30, 2), ("O4", None, 1, date(2000, 1, 1), 40, 1)])
    p = dim_p(spark, [(1, "a", "Core", 5), (2, "b", "Basic", 7), (3, "c", "Basic", 1)])
    rows = one(trends.category_contribution(f, p))
    total = sum(Decimal(r["category_sales_percentage"].rstrip("%")) for r in rows)
    assert abs(total - 100) <= Decimal("0.02")
    null_cat = [r for r in rows if r["category_name"] is None][0]
    assert null_cat["total_product_cost"] is None and null_cat["total_profit"] is None
    basic = [r for r in rows if r["category_name"] == "Basic"][0]
    assert basic["total_product_cost"] == Decimal("8.00")  # once per sales row, not × quantity


def test_cost_band_edges(spark):
    p = dim_p(spark, [(1, "a", "C", 199.99), (2, "b", "C", 200), (3, "c", "C", 1000),
                      (4, "d", "C", 1000.01)])
    p = p.union(spark.createDataFrame([(5, 5, "P5", "e", "T", "C", "t", "No", None, "L",
                                        date(1994, 1, 1))], p.schema))
    bands = {r["cost_category"]: r["product_count"] for r in one(trends.product_cost_bands(p))}
    assert bands == {"Low Cost Under 200": 1, "Medium Cost Between 200 and 1000": 2,
                     "High Cost Above 1000": 2}


def test_zero_order_count_guard(spark):
    # All order numbers NULL: COUNT(DISTINCT) is 0 and the ratio falls back to 0.
    f = fact_rows(spark, [(None, 1, 1, date(2000, 1, 1), 10, 1)])
    c = dim_c(spark, [(1, "a", "b", None)])
    r = one(reports.customer_360(f, c, "2002-01-01"))[0]
    assert r["total_sales"] == 0 and r["avg_num_of_order"] == Decimal("0.00")


@pytest.mark.parametrize("best", [True, False])
def test_top_n_ties_broken_by_name(spark, best):
    f = fact_rows(spark, [(f"O{k}", k, 1, date(2000, 1, 1), 10, 1) for k in range(1, 8)])
    p = dim_p(spark, [(k, f"n{8 - k}", "C", 1) for k in range(1, 8)])
    names = [r["product_name"] for r in one(explore.top_products(f, p, 5, best=best))]
    assert names == ["n1", "n2", "n3", "n4", "n5"]


def test_dense_months_fill_gaps_with_zero(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 1, 5), 100, 1),
                          ("O2", 1, 1, date(2000, 4, 5), 150, 2)])
    rows = one(trends.monthly_trend(f, dense=True))
    assert [r["order_month"] for r in rows] == [date(2000, m, 1) for m in (1, 2, 3, 4)]
    assert [str(r["total_sales"]) for r in rows] == ["100.00", "0.00", "0.00", "150.00"]
    assert rows[1]["mom_growth_pct"] == Decimal("-100.00") and rows[3]["mom_growth_pct"] is None
    assert rows[3]["average_order_value"] == Decimal("150.00")


def test_numeric_shares_beside_text(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 1, 1), 1, 1), ("O2", 2, 1, date(2000, 1, 1), 2, 1)])
    p = dim_p(spark, [(1, "a", "Core", 5), (2, "b", "Basic", 7)])
    rows = {r["category_name"]: r for r in one(trends.category_contribution(f, p, numeric=True))}
    assert rows["Core"]["category_sales_share"] == Decimal("33.33")
    assert rows["Basic"]["category_sales_percentage"] == "66.67%"


def test_days_based_age(spark):
    f = fact_rows(spark, [("O1", 1, 1, date(2000, 1, 1), 1, 1)])
    c = dim_c(spark, [(1, "a", "b", date(1990, 12, 31))])
    assert one(reports.customer_360(f, c, "2002-01-01"))[0]["customer_age"] == 12
    assert one(reports.customer_360(f, c, "2002-01-01", age="days"))[0]["customer_age"] == 11
    with pytest.raises(ValueError):
        reports.customer_360(f, c, "2002-01-01", vip_on="revenue")


def test_ratio_helpers_and_bands(spark):
    from medalforge.functions import band, ratio_or, safe_ratio
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(10, 2), (10, 0), (None, 5), (7, None)], "n int, d int")
    rows = df.select(safe_ratio("n", "d").alias("s"), ratio_or("n", "d", F.lit(-1.0)).alias("r"),
                     band([(F.col("d") > 3, "big"), (F.col("d") > 0, "small")], "none").alias("b")
                     ).collect()
    assert [r.s for r in rows] == [5.0, None, None, None]
    assert [r.r for r in rows] == [5.0, -1.0, None, None]
    assert [r.b for r in rows] == ["small", "none", "big", "none"]  # NULL falls through
