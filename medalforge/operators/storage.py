"""A fact stored so that queries can skip most of it.

``write_by_month`` writes one folder per order month (rows without a date in a folder of their own). Inside a
month the rows are sorted by customer, and each column of ``bloom`` gets a Parquet Bloom filter. So

* a filter on ``order_month``, or a join with a filtered table of months, reads the folders of those months
  only (partition pruning, static or dynamic);
* a filter on a customer is decided per row group from minimum and maximum, one on a product from its Bloom
  filter; only row groups that may hold the key are read.

The shuffle before the write is a REBALANCE by month: AQE splits a month that is too large over several
tasks (a hot month is several files) and puts small ones together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_start

MONTH = "order_month"
#: Distinct values that a Bloom filter of a row group is sized for, per column.
BLOOM = {"customer_key": 100_000, "product_key": 100_000}


def write_by_month(fact: DataFrame, path: str, bloom: Mapping[str, int] = BLOOM, date: str = "order_date",
                   sort: str = "customer_key", row_group_bytes: int | None = None) -> None:
    """Write ``fact`` below ``path``, one folder per month of ``date``."""
    rows = fact.withColumn(MONTH, month_start(date)).hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, sort, date)
    writer = rows.write.mode("overwrite").partitionBy(MONTH)
    for column, ndv in bloom.items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(ndv)))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored fact: the columns of ``schema`` and ``order_month`` (a partition column; NULL without a date)."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])).parquet(path)


def sales_of(fact: DataFrame, column: str, key) -> DataFrame:
    """The fact rows of one customer or product; the filter reaches the row groups' statistics and Bloom filters."""
    return fact.where(F.col(column) == F.lit(key))


def sales_in_months(fact: DataFrame, months: DataFrame) -> DataFrame:
    """The fact rows whose month is in ``months`` (a column ``order_month``); only those months' folders are read.

    The months are one row per month at most, so their side is broadcast, and Spark prunes the folders by it.
    """
    return fact.join(F.broadcast(months.select(MONTH).distinct()), MONTH, "left_semi")
