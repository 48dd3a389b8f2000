"""What the shared steps move: source tables read once, the fact shuffled once per join, partials once per report."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from medalforge import warehouse
from medalforge.operators import gold as gold_ops
from medalforge.operators.cleansing import SILVER_SPECS
from medalforge.operators.joins import heavy_candidates, left_join_dims
from medalforge.operators.partials import SalesPartials
from medalforge.plans import reports
from medalforge.session import scratch_path
from medalforge.sources import Layers
from medalforge.sources.fixtures import bronze_table


def _plan(df, optimized=False):
    q = df._jdf.queryExecution()
    return (q.optimizedPlan() if optimized else q.executedPlan()).toString()


def test_bronze_copy_joins_its_source_once_and_has_the_same_rows(spark):
    a = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") % 9 != 0, F.concat(F.lit("n"), "id")).alias("name"))
    b = spark.range(0, 200, 2).select(F.col("id").alias("j"), (F.col("id") * 3).alias("v"))
    rows = a.join(b.hint("merge"), F.col("k") == F.col("j"))
    got = bronze_table("t", rows, "name")
    assert _plan(got, optimized=True).count("Join") == 1
    text = rows.select(*[(F.col(c) if c == "name" else F.concat(F.lit(" "), F.col(c).cast("string"), F.lit("  "))).alias(c)
                         for c in rows.columns])
    broken = text.where(F.pmod(F.crc32(F.col("name").cast("binary")), F.lit(10)) == 0).withColumn("name", F.lit("  "))
    want = sorted(map(tuple, text.unionByName(broken).collect()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want and broken.count() > 0


def test_salted_joins_one_key_to_two_dimensions(spark):
    fact = spark.range(300).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("b"), "id")
    dims = [(spark.range(2).select(F.col("id").alias("ka"), F.lit("x").alias("x")), "a", "ka"),
            (spark.range(5).select(F.col("id").alias("kb"), F.lit("y").alias("y")), "b", "kb"),
            (spark.range(1).select(F.col("id").alias("kc"), F.lit("z").alias("z")), "a", "kc")]
    out = left_join_dims(fact, dims, limit_bytes=0)
    assert out.columns == ["a", "b", "id", "x", "y", "z"]
    got = {r["id"]: (r["x"], r["y"], r["z"]) for r in out.collect()}
    assert got == {i: ("x" if i % 3 < 2 else None, "y" if i % 4 and i % 7 < 5 else None, "z" if i % 3 == 0 else None) for i in range(300)}


@pytest.mark.parametrize("threshold,mode", [("-1", "sort"), ("10m", "rebalance")])
def test_fact_is_rebalanced_only_if_its_joins_did_not_shuffle_it(spark, monkeypatch, threshold, mode):
    d = F.lit("2001-01-01").cast("date")
    ids = spark.range(1, 41)
    silver = {
        "crm_cust_info": ids.selectExpr("id cust_id", "'c' || id cust_key", "'f' cust_first_name", "'l' cust_last_name",
                                        "'Male' cust_gender", "'Single' cust_marital_status").withColumn("cust_create_date", d),
        "erp_cust_az12": ids.selectExpr("'c' || id cid", "'Male' gen").withColumn("bdate", d),
        "erp_loc_a101": ids.selectExpr("'c' || id cid", "'X' cntry"),
        "crm_prd_info": ids.selectExpr("id prd_id", "'p' || id prd_key", "'t' cat_id", "'n' prd_nm", "1.0BD prd_cost", "'r' prd_line")
        .withColumns({"prd_start_dt": d, "prd_end_dt": F.lit(None).cast("date")}),
        "erp_px_cat_g1v1": spark.sql("SELECT 't' id, 'Core' cat, 's' subcat, 'No' maintenance"),
        "crm_sales_details": spark.range(400).selectExpr("'o' || id sls_ord_num", "'p' || (id % 50) sls_prd_key", "id % 45 sls_cust_id",
                                                         "2.0BD sls_sales", "1 sls_quantity", "2.0BD sls_price")
        .withColumns({c: d for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}),
    }
    modes, layout = [], gold_ops.fact_layout
    monkeypatch.setattr(gold_ops, "fact_layout", lambda f, mode="rebalance": modes.append(mode) or layout(f, mode=mode))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        fact = gold_ops.build_gold(silver, Layers(spark, scratch_path(spark, "moves")), verify=True)["fact_sales"]
        assert (fact.count(), fact.where("product_key IS NULL").count(), fact.where("customer_key IS NULL").count()) == (
            400, 8 + 72, sum(not 1 <= i % 45 <= 40 for i in range(400)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert modes == [mode]


def test_a_report_of_merged_partials_shuffles_them_once(spark):
    fact = spark.range(400).selectExpr("'o' || (id % 90) sales_order_number", "id % 7 customer_key", "nullif(id % 11, 3) product_key",
                                       "date_add(DATE'2001-01-01', cast(id % 60 as int)) order_date",
                                       "cast(id as decimal(18,2)) sales_amount", "1 quantity")
    store = SalesPartials(spark, scratch_path(spark, "moves"))
    store.add(fact.where("order_date < DATE'2001-02-01'"))
    store.add(fact.where("order_date >= DATE'2001-02-01'"))
    for table, key, member, n in (("customer", "customer_key", "product_key", "n_products"),
                                  ("product", "product_key", "customer_key", "n_customers")):
        got = store.summary(table)
        assert _plan(got).count("Exchange hashpartitioning") == 1
        want = fact.groupBy(key).agg(F.sum("sales_amount").cast("decimal(28,2)").alias("sales"), F.count_distinct("sales_order_number").alias("n_orders"),
                                     F.count_distinct(member).alias(n))
        assert sorted(got.select(*want.columns).collect(), key=repr) == sorted(want.collect(), key=repr)


def test_the_reports_shuffle_each_fact_row_of_a_light_key_once(spark):
    rows = spark.range(30000).selectExpr(  # one key holds a third of the rows, 4000 a few each, some none
        "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 50 > 0 THEN id % 4001 END k", "'o' || (id % 90) a", "nullif(id % 11, 3) b", "id % 5 v")
    got = reports.by_key(rows, "k", {"n_a": "a", "n_b": "b"}, F.sum("v").alias("s"), F.max("a").alias("m"))
    want = rows.groupBy("k").agg(F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"), F.sum("v").alias("s"), F.max("a").alias("m"))
    assert got.schema == want.schema
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    heavy = heavy_candidates(rows, ["k"], reports.HEAVY_SHARE)[1]["k"]
    assert "7" in heavy and len(heavy) < 4000
    fact = rows.selectExpr("k product_key", "a sales_order_number", "b customer_key", "v sales_amount", "1 quantity", "DATE'2001-01-01' order_date")
    dim = spark.range(4001).selectExpr("id product_key", "'n' product_name", "'c' category_name", "'s' subcategory_name", "1 product_cost")
    # copies of rows are made for the heavy keys alone
    plan = _plan(reports.product_360(fact, dim))
    assert plan.count("Expand [") == 1 and plan.count("REPARTITION_BY_COL") == 1


def test_bronze_and_silver_tables_are_written_side_by_side(monkeypatch):
    everyone = threading.Barrier(len(SILVER_SPECS), timeout=20)  # breaks unless all writes are under way at once

    class Written:
        def read(self, layer, name):
            return name

        def write(self, df, layer, name):
            everyone.wait()
            return f"{layer}/{name}"

    monkeypatch.setattr(warehouse, "cleanse", lambda df, spec: df)
    assert warehouse.silver_step(Written()) == {name: f"silver/{name}" for name in SILVER_SPECS}
