"""

Usage: python -m tools.compare_strategies [sf_dir] [runs]

* customer_360 / product_360: aggregate-first (library) against join-first
  (fact joined to the dimension, then aggregated, as a view would do);
* measure_summary: per-column aggregates (library) against one multi-distinct
  aggregate per table and against eight UNION ALL branches;
* surrogate keys: single-partition window against the distributed form;
* the same two report forms with broadcasts disabled (the regime of
  dimensions too large to broadcast), and the fact build with its checked
  broadcast against the salted shuffle join (forced);
* totals per category: join first against a broadcastable dimension (library
  choice at this size) against aggregate first (forced by disabling broadcasts);
* the reports' two distinct counts: Spark's multi-distinct rewrite (Expand)
  against per-order then per-customer grouping plus a separate distinct
  product count, joined back null-safely.

Variants run interleaved (one run of each per round) so that JIT warm-up and
machine drift affect all alike. Prints one JSON object with the median warm
time of each variant.
"""

from __future__ import annotations

import json
import statistics
import sys
import time


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from medalforge.oracle import AS_OF
    from medalforge.operators import surrogate_key
    from medalforge.plans import explore, reports
    from medalforge.session import build_session
    from medalforge.warehouse import gold_for, source

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    runs = int(argv[1]) if len(argv) > 1 else 5
    spark = build_session()
    g = gold_for(spark, sf_dir)
    fact, dc, dp = g["fact_sales"], g["dim_customer_info"], g["dim_product_info"]

    # Variants are registered first and then run interleaved, one run of each
    # per round, so JIT warm-up and machine drift affect all of them alike.
    def timed(make, settings=None):
        return (make, settings or {})

    def customer_join_first():
        j = fact.where(F.col("order_date").isNotNull()).join(
            dc.select(F.col("customer_key").alias("_dk"), "customer_number", "first_name", "last_name",
                      "customer_birthdate", "customer_gender"), F.col("customer_key") == F.col("_dk"), "left")
        return j.groupBy("_dk", "customer_number", "first_name", "last_name", "customer_birthdate",
                         "customer_gender").agg(
            F.count_distinct("product_key"), F.count_distinct("sales_order_number"),
            F.sum("sales_amount"), F.sum("quantity"), F.min("order_date"), F.max("order_date"))

    def customer_core_expand():
        dated = fact.where(F.col("order_date").isNotNull())
        return dated.groupBy("customer_key").agg(
            F.count_distinct("product_key").alias("total_products"),
            F.count_distinct("sales_order_number").alias("total_sales"),
            F.sum("sales_amount").alias("amount"), F.sum("quantity").alias("qty"),
            F.min("order_date").alias("first"), F.max("order_date").alias("last"))

    def customer_core_two_level():
        # per (customer, order) first, then per customer; distinct products apart
        dated = fact.where(F.col("order_date").isNotNull())
        orders = (dated.groupBy("customer_key", "sales_order_number")
                  .agg(F.sum("sales_amount").alias("s"), F.sum("quantity").alias("q"),
                       F.min("order_date").alias("f"), F.max("order_date").alias("l"))
                  .groupBy("customer_key")
                  .agg(F.count("sales_order_number").alias("total_sales"), F.sum("s").alias("amount"),
                       F.sum("q").alias("qty"), F.min("f").alias("first"), F.max("l").alias("last")))
        products = (dated.select("customer_key", "product_key").distinct()
                    .groupBy(F.col("customer_key").alias("_ck"))
                    .agg(F.count("product_key").alias("total_products")))
        return orders.join(products, orders.customer_key.eqNullSafe(products._ck), "left").drop("_ck")

    def product_join_first():
        j = fact.where(F.col("order_date").isNotNull()).join(
            dp.select(F.col("product_key").alias("_dk"), "product_name", "category_name",
                      "subcategory_name", "product_cost"), F.col("product_key") == F.col("_dk"), "left")
        return j.groupBy("_dk", "product_name", "category_name", "subcategory_name", "product_cost").agg(
            F.count_distinct("sales_order_number"), F.sum("sales_amount"), F.sum("quantity"),
            F.count_distinct("customer_key"), F.min("order_date"), F.max("order_date"))

    def measure_one_agg_per_table():
        f = fact.agg(F.sum("sales_amount").alias("m0"), F.sum("quantity").alias("m1"),
                     F.avg("unit_price").alias("m2"), F.count_distinct("sales_order_number").alias("m3"),
                     F.count_distinct("product_key").alias("m4"),
                     F.count_distinct("customer_key").alias("m5"))
        names = list(explore.MEASURE_NAMES)
        return (explore._stack(f, names[:6], [f"m{i}" for i in range(6)], "decimal(28,2)")
                .unionByName(explore._stack(dp.agg(F.count_distinct("product_key").alias("m6")),
                                            names[6:7], ["m6"], "decimal(28,2)"))
                .unionByName(explore._stack(dc.agg(F.count_distinct("customer_key").alias("m7")),
                                            names[7:], ["m7"], "decimal(28,2)")))

    def measure_unions():
        parts = [fact.agg(F.sum("sales_amount").cast("decimal(28,2)").alias("v")),
                 fact.agg(F.sum("quantity").cast("decimal(28,2)").alias("v")),
                 fact.agg(F.avg("unit_price").cast("decimal(28,2)").alias("v")),
                 fact.agg(F.count_distinct("sales_order_number").cast("decimal(28,2)").alias("v")),
                 fact.agg(F.count_distinct("product_key").cast("decimal(28,2)").alias("v")),
                 fact.agg(F.count_distinct("customer_key").cast("decimal(28,2)").alias("v")),
                 dp.agg(F.count_distinct("product_key").cast("decimal(28,2)").alias("v")),
                 dc.agg(F.count_distinct("customer_key").cast("decimal(28,2)").alias("v"))]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    from medalforge.operators.gold import fact_sales
    from medalforge.warehouse import silver_for
    sales = silver_for(spark, sf_dir)["crm_sales_details"]

    def no_broadcast(make):
        """The variant as if the dimensions were too large to broadcast."""
        return timed(make, {"spark.sql.autoBroadcastJoinThreshold": "-1"})

    result = {
        "customer_360_aggregate_first": timed(lambda: reports.customer_360(fact, dc, AS_OF)),
        "customer_360_join_first_core": timed(customer_join_first),
        "customer_360_core_expand": timed(customer_core_expand),
        "customer_360_core_two_level": timed(customer_core_two_level),
        "customer_360_aggregate_first_no_broadcast": no_broadcast(
            lambda: reports.customer_360(fact, dc, AS_OF)),
        "customer_360_join_first_core_no_broadcast": no_broadcast(customer_join_first),
        "revenue_by_category_join_first": timed(lambda: explore.revenue_by_category(fact, dp)),
        "revenue_by_category_aggregate_first": no_broadcast(
            lambda: explore.revenue_by_category(fact, dp)),
        "fact_build_broadcast": timed(lambda: fact_sales(sales, dp, dc)),
        "fact_build_salted_join": timed(lambda: fact_sales(sales, dp, dc, limit_bytes=0)),
        "product_360_aggregate_first": timed(lambda: reports.product_360(fact, dp, AS_OF)),
        "product_360_join_first_core": timed(product_join_first),
        "measure_summary_per_column": timed(lambda: explore.measure_summary(fact, dp, dc)),
        "measure_summary_one_agg_per_table": timed(measure_one_agg_per_table),
        "measure_summary_eight_unions": timed(measure_unions),
        "surrogate_key_window": timed(lambda: orders.withColumn(
            "k", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")))),
        "surrogate_key_distributed": timed(lambda: surrogate_key(
            orders, ["o_orderdate"], "k", tiebreak=["o_orderkey"])),
    }
    samples = {name: [] for name in result}
    for i in range(runs + 1):
        for name, (make, settings) in result.items():
            previous = {k: spark.conf.get(k) for k in settings}
            for k, v in settings.items():
                spark.conf.set(k, v)
            try:
                t = time.perf_counter()
                make().write.format("noop").mode("overwrite").save()
                elapsed = time.perf_counter() - t
            finally:
                for k, v in previous.items():
                    spark.conf.set(k, v)
            if i:  # the first round warms up
                samples[name].append(elapsed)
    medians = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    print(json.dumps({"sf_dir": sf_dir, "runs": runs, "spark": spark.version, **medians}))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
