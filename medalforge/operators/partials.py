"""Report aggregates that grow with the fact: partial tables per build, merged by the reports.

``SalesPartials`` keeps, per customer, product and month, what the reports need: sums, first and last
dates, and the distinct orders, products and customers as bitmaps. ``add`` aggregates new fact rows only and
publishes their partials as one more part, all tables in one commit; a report merges the live parts and
never reads the fact.

A bitmap is rows of (word, mask): bit ``k % 64`` of word ``k // 64`` stands for key ``k``. Masks merge by
``bit_or`` and count by ``bit_count``, both fixed-width, so Spark aggregates them in hash maps inside generated
code, partially before any shuffle, and several distinct counts need no copy of the rows per
count. A group of a key costs 12 bytes per word it touches, so sparse sets stay small where the engine's own bitmaps
(``bitmap_construct_agg``) take 4 KB a bucket, and a key with a third of all rows is many rows of
(key, word), never one buffer. Words are dense because the keys are: surrogate keys, and order numbers through a
``KeyDictionary``, which also gives the orders of one build neighbouring words. Surrogate keys
must last between builds (``operators.dictionary``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..sources.parts import Parts
from .dictionary import KeyDictionary

# What the rows of a partial table hold.
TOTALS, ORDERS, PRODUCTS, CUSTOMERS = 0, 1, 2, 3
_COLUMNS = ("kind int, word bigint, mask bigint, sales decimal(28,2), quantity bigint, "
            "first_order date, latest_order date")
#: Per table its key and type, and the members whose distinct count it keeps.
TABLES = {
    "customer": ("customer_key bigint", {ORDERS: "order_key", PRODUCTS: "product_key"}),
    "product": ("product_key bigint", {ORDERS: "order_key", CUSTOMERS: "customer_key"}),
    "month": ("order_month date", {ORDERS: "order_key"}),
}


def bit_words(key: Column) -> tuple[Column, Column]:
    """The word of a dense key and its mask in that word."""
    return F.shiftright(key, 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(key, F.lit(64)).cast("int"))


class SalesPartials:
    """Partial aggregates of a fact under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.parts = Parts(spark, f"{root.rstrip('/')}/partials")
        self.orders = KeyDictionary(spark, f"{root.rstrip('/')}/orders", "sales_order_number", "string", "order_key")

    @staticmethod
    def _schema(table: str) -> str:
        return f"{TABLES[table][0]}, {_COLUMNS}"

    def read(self, table: str) -> DataFrame:
        """All rows of the live partials of a table, not merged."""
        return self.parts.read(self._schema(table), [f"{p}/{table}" for p in self.parts.live()])

    def add(self, fact: DataFrame, note: str | None = None) -> bool:
        """Add new fact rows (those with an order date count); False if ``note`` was added before."""
        if note is not None and note in self.parts.notes():
            return False
        dated = fact.where(F.col("order_date").isNotNull())
        self.orders.extend(dated.select("sales_order_number"), [])
        part = self.parts.new_part()
        staged = (self.orders.attach(dated.select("sales_order_number", "customer_key", "product_key", "order_date",
                                                  "sales_amount", "quantity"))
                  .drop("sales_order_number").withColumn("order_month", month_start("order_date")))
        staged.write.parquet(self.parts.path(f"{part}/rows"))
        rows = self.spark.read.schema(staged.schema).parquet(self.parts.path(f"{part}/rows"))
        for table, (key, members) in TABLES.items():
            name = key.split()[0]
            pieces = rows.groupBy(name).agg(
                F.sum("sales_amount").alias("sales"), F.sum("quantity").alias("quantity"),
                F.min("order_date").alias("first_order"), F.max("order_date").alias("latest_order"))
            pieces = pieces.withColumn("kind", F.lit(TOTALS))
            for kind, member in members.items():
                word, mask = bit_words(F.col(member))
                bits = (rows.where(F.col(member).isNotNull()).groupBy(name, word.alias("word")).agg(F.bit_or(mask).alias("mask"))
                        .withColumn("kind", F.lit(kind)))
                pieces = pieces.unionByName(bits, allowMissingColumns=True)
            fields = [f.split()[0] for f in self._schema(table).replace("decimal(28,2)", "decimal").split(", ")]
            pieces.select(*fields).write.parquet(self.parts.path(f"{part}/{table}"))
        self.parts.commit([part], note=note)
        return True

    def merged(self, table: str, by_key: bool = False) -> DataFrame:
        """The live partials of a table, one row per key, kind and word.

        ``by_key`` puts all rows of a key in one partition, so an aggregate by key that follows moves nothing: with many
        keys hardly any two rows of a task share one, and that aggregate would shuffle nearly every row again. A key has at most one row
        per 64 members and part, so no key is too much for a task.
        """
        key = TABLES[table][0].split()[0]
        rows = self.read(table)
        return (rows.repartition(key) if by_key else rows).groupBy(key, "kind", "word").agg(
            F.bit_or("mask").alias("mask"), F.sum("sales").cast("decimal(28,2)").alias("sales"), F.sum("quantity").alias("quantity"),
            F.min("first_order").alias("first_order"), F.max("latest_order").alias("latest_order"))

    def compact(self) -> None:
        """Put one merged part in place of all live ones."""
        old = self.parts.live()
        if len(old) < 2:
            return
        part = self.parts.new_part()
        for table in TABLES:
            self.merged(table).write.parquet(self.parts.path(f"{part}/{table}"))
        self.parts.commit([part], old)

    def summary(self, table: str) -> DataFrame:
        """One row per key: sales, quantity, first_order, latest_order, and the distinct members n_orders,
        n_products, n_customers (0 where the table does not keep them)."""
        key = TABLES[table][0].split()[0]

        def members(kind: int, name: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("mask"))), F.lit(0)).cast("long").alias(name)

        return self.merged(table, by_key=table != "month").groupBy(key).agg(
            F.max("sales").alias("sales"), F.max("quantity").alias("quantity"), F.min("first_order").alias("first_order"),
            F.max("latest_order").alias("latest_order"), members(ORDERS, "n_orders"), members(PRODUCTS, "n_products"),
            members(CUSTOMERS, "n_customers"))
