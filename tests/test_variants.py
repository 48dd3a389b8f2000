"""Library options checked against DuckDB by editing the oracle statement to match."""

import pytest

from medalforge.oracle import AS_OF, oracle_sql
from medalforge.plans import reports, trends
from medalforge.warehouse import gold_for
from tests.conftest import SF01
from tools.check_oracle import compare, duck_connection


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


def _edit(sql: str, old: str, new: str) -> str:
    assert old in sql, old
    return sql.replace(old, new)


def test_vip_on_amount(spark, con):
    g = gold_for(spark, SF01)
    df = reports.customer_360(g["fact_sales"], g["dim_customer_info"], AS_OF, vip_on="amount",
                              threshold=50000)
    sql = oracle_sql()["customer_360"]
    sql = _edit(sql, "AND o.n > 5000", "AND s.money > 50000")
    assert df.where("customer_segment = 'VIP'").count() > 0
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_corrected_trend_labels(spark, con):
    g = gold_for(spark, SF01)
    df = trends.product_year_trend(g["fact_sales"], g["dim_product_info"], corrected=True)
    sql = _edit(oracle_sql()["product_year_trend"],
                "ARRAY['Decreasing', 'Stable', 'Increasing']", "ARRAY['Increasing', 'Stable', 'Decreasing']")
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_days_based_age(spark, con):
    g = gold_for(spark, SF01)
    df = reports.customer_360(g["fact_sales"], g["dim_customer_info"], AS_OF, age="days")
    sql = _edit(oracle_sql()["customer_360"],
                f"date_diff('year', DATE '1920-01-01' + CAST((buyer * 7919) % 28000 AS INTEGER), DATE '{AS_OF}')",
                f"CAST(floor(date_diff('day', DATE '1920-01-01' + CAST((buyer * 7919) % 28000 AS INTEGER), "
                f"DATE '{AS_OF}') / 365.25) AS INTEGER)")
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_value_segment_parameters(spark, con):
    g = gold_for(spark, SF01)
    df = trends.customer_value_segments(g["fact_sales"], g["dim_customer_info"], months=30,
                                        amount=20000)
    sql = oracle_sql()["customer_value_segments"]
    for old, new in ((">= 12", ">= 30"), ("< 12", "< 30"), ("> 5000", "> 20000"), ("<= 5000", "<= 20000")):
        sql = _edit(sql, old, new)
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_cost_band_parameters(spark, con):
    g = gold_for(spark, SF01)
    df = trends.product_cost_bands(g["dim_product_info"], low=300, high=600)
    sql = _edit(oracle_sql()["product_cost_bands"], "product_cost < 200", "product_cost < 300")
    sql = _edit(sql, "BETWEEN 200 AND 1000", "BETWEEN 300 AND 600")
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_rolling_window_parameter(spark, con):
    g = gold_for(spark, SF01)
    df = trends.monthly_trend(g["fact_sales"], window=6)
    sql = oracle_sql()["monthly_trend"].replace("ROWS BETWEEN 2 PRECEDING", "ROWS BETWEEN 5 PRECEDING")
    sql = _edit(sql, "AS rolling_3_month_avg_sales", "AS rolling_6_month_avg_sales")
    assert "rolling_6_month_avg_sales" in df.columns
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_product_segment_thresholds(spark, con):
    g = gold_for(spark, SF01)
    df = reports.product_360(g["fact_sales"], g["dim_product_info"], AS_OF, high=30000,
                             mid_low=5000, mid_high=29999)
    sql = oracle_sql()["product_360"]
    for old, new in (("CAST(50000 AS", "CAST(30000 AS"), ("CAST(10000 AS", "CAST(5000 AS"), ("CAST(49999 AS", "CAST(29999 AS")):
        sql = _edit(sql, old, new)
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_age_band_labels(spark, con):
    g = gold_for(spark, SF01)
    labels = ("Not Adult", "Middle Age", "Old", "Senior")
    df = reports.customer_360(g["fact_sales"], g["dim_customer_info"], AS_OF, age_labels=labels)
    sql = _edit(oracle_sql()["customer_360"], "'Dead') AS customer_situation", "'Senior') AS customer_situation")
    ok, msg = compare(df, con, sql)
    assert ok, msg
