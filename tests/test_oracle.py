"""Every registered query against its DuckDB statement at sf0.01."""

import pytest

import __spark_entry__ as entry
from medalforge.oracle import oracle_sql
from medalforge.plans.registry import queries
from tests.conftest import SF01
from tools.check_oracle import compare, duck_connection

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF01), con, entry.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_key" and len(df.columns) == 16


# Queries whose reference ORDER BY is a total order (with the tiebreaks added):
# the row sequence must equal DuckDB's, not only the multiset of rows.
ORDERED = ("product_hierarchy", "sales_by_year_month", "monthly_trend", "product_year_trend",
           "revenue_by_customer", "top5_products", "bottom5_products", "customer_360_top100",
           "product_360_top100", "customers_by_country", "customers_by_gender",
           "products_by_category", "avg_cost_by_category", "revenue_by_category",
           "items_sold_by_country", "category_contribution")


@pytest.mark.parametrize("name", ORDERED)
def test_query_order_matches_oracle(spark, con, name):
    from tools.check_oracle import canon
    df = entry.queries()[name](spark, SF01)
    cols = df.columns
    got = [tuple(canon(v) for v in r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    want = [tuple(canon(v) for v in r) for r in rel.select(*cols).fetchall()]
    assert got == want
