"""Name the gold tables and reports for ``spark.sql``: as temporary views, as saved tables, or as views of the catalog
that always show the published build.

Users who query the star schema with SQL keep doing so: the gold tables keep
their names, and the two reports are views named as in the warehouse. The
views are the library's DataFrames, so Catalyst plans SQL over them exactly as
it plans the DataFrame calls (filters and column pruning reach the scans).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import Layers
from . import report_sql, reports

GOLD_VIEWS = ("dim_customer_info", "dim_product_info", "fact_sales")
CUSTOMER_OPTIONS = ("vip_on", "threshold", "months", "age", "age_labels", "segment_labels")
PRODUCT_OPTIONS = ("high", "mid_low", "mid_high", "labels")
REPORT_VIEWS = ("view_customer_analytics", "view_product_analytics")


def register_views(spark: SparkSession, gold: dict[str, DataFrame], as_of=None,
                   **report_options) -> list[str]:
    """Create or replace the temp views; returns their names."""
    for name, df in _tables(gold, as_of, report_options).items():
        df.createOrReplaceTempView(name)
    return [*GOLD_VIEWS, *REPORT_VIEWS]


def _tables(gold: dict[str, DataFrame], as_of, options: dict) -> dict[str, DataFrame]:
    customer = {k: v for k, v in options.items() if k in CUSTOMER_OPTIONS}
    product = {k: v for k, v in options.items() if k in PRODUCT_OPTIONS}
    unknown = set(options) - set(customer) - set(product)
    if unknown:
        raise TypeError(f"unknown report options {sorted(unknown)}; known: {sorted(CUSTOMER_OPTIONS + PRODUCT_OPTIONS)}")
    fact = gold["fact_sales"]
    return {**{name: gold[name] for name in GOLD_VIEWS},
            REPORT_VIEWS[0]: reports.customer_360(fact, gold["dim_customer_info"], as_of, **customer),
            REPORT_VIEWS[1]: reports.product_360(fact, gold["dim_product_info"], as_of, **product)}


def publish_tables(spark: SparkSession, gold: dict[str, DataFrame], location: str, database: str = "gold",
                   as_of=None, **report_options) -> list[str]:
    """Save the gold tables and both reports as tables of ``database``, so ``gold.fact_sales`` or
    ``gold.view_customer_analytics`` outlives the session in the session's catalog.

    Files go below ``location``, a folder the cluster shares. The reports are saved as tables, since a
    view would need their definition as SQL text; publish again to refresh them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, df in _tables(gold, as_of, report_options).items():
        path = f"{location.rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.mode("overwrite").option("path", path).saveAsTable(f"{database}.{name}")
        names.append(f"{database}.{name}")
    return names


def register_catalog(spark: SparkSession, layers: Layers, database: str = "gold_live", as_of: str | None = None) -> list[str]:
    """Create or replace persistent views of the gold tables and both reports over ``layers``; returns their names.

    A table's view reads the folder of that table and keeps the rows of the published build, which it looks up in the log of
    builds when it is read: a scalar subquery on the partition column, so files of other builds are not opened. Publishing a build is
    one appended row, so all five names switch to it at once, and before it none does; the reports are definitions,
    so they are current whenever they are read. Folders of builds that are no longer published can be removed.
    """
    if layers.current_build() is None:
        raise FileNotFoundError(f"no gold build has been published under {layers.root}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    current = f"(SELECT max_by(build, struct(number, build)) FROM parquet.`{layers.path('gold', 'builds')}`)"
    definitions = {}
    for name in GOLD_VIEWS:
        columns = ", ".join(f"`{c}`" for c in layers.gold(name).columns)
        definitions[name] = f"SELECT {columns} FROM parquet.`{layers.path('gold', name)}` WHERE build = {current}"
    of = {name: f"{database}.{name}" for name in GOLD_VIEWS}
    definitions[REPORT_VIEWS[0]] = report_sql.customer_360_sql(of["fact_sales"], of["dim_customer_info"], as_of)
    definitions[REPORT_VIEWS[1]] = report_sql.product_360_sql(of["fact_sales"], of["dim_product_info"], as_of)
    for name, text in definitions.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
    return [f"{database}.{name}" for name in definitions]
