"""Views of the catalog that switch from build to build at once, and reports kept as definitions."""

import pytest

from medalforge import operators as ops
from medalforge.plans import reports
from medalforge.plans.views import register_catalog
from medalforge.sources import Layers
from medalforge.warehouse import silver_for
from tests.conftest import SF001

AS_OF = "2002-01-01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_all_names_switch_with_the_build(spark, tmp_path):
    silver, layers = silver_for(spark, SF001), Layers(spark, str(tmp_path / "root"))
    with pytest.raises(FileNotFoundError):
        register_catalog(spark, layers, "live_test", AS_OF)
    first = ops.build_gold(silver, layers)
    old = layers.current_build()
    names = register_catalog(spark, layers, "live_test", AS_OF)
    assert len(names) == 5

    def shown():
        return {n: rows_of(spark.sql(f"SELECT * FROM {n}")) for n in names}

    before = shown()
    for name in ops.GOLD_ORDER:
        assert before[f"live_test.{name}"] == rows_of(first[name])
    direct = reports.customer_360(first["fact_sales"], first["dim_customer_info"], AS_OF)
    report = spark.sql("SELECT * FROM live_test.view_customer_analytics")
    assert report.schema.simpleString() == direct.schema.simpleString() and rows_of(report) == rows_of(direct)
    direct = reports.product_360(first["fact_sales"], first["dim_product_info"], AS_OF)
    report = spark.sql("SELECT * FROM live_test.view_product_analytics")
    assert report.schema.simpleString() == direct.schema.simpleString() and rows_of(report) == rows_of(direct)

    # a build that fails after its dimensions are written changes no name
    from pyspark.sql import functions as F
    broken = dict(silver, crm_cust_info=silver["crm_cust_info"].where("cust_id > 9"),
                  crm_sales_details=silver["crm_sales_details"].withColumn("sls_ord_num", F.raise_error(F.lit("broken source"))))
    with pytest.raises(ops.GoldBuildError):
        ops.build_gold(broken, layers)
    assert shown() == before
    # a published one changes all
    second = ops.build_gold(dict(silver, crm_cust_info=silver["crm_cust_info"].where("cust_id > 9")), layers)
    after = shown()
    for name in ops.GOLD_ORDER:
        assert after[f"live_test.{name}"] == rows_of(second[name])
    assert after["live_test.view_customer_analytics"] == rows_of(
        reports.customer_360(second["fact_sales"], second["dim_customer_info"], AS_OF))
    assert after != before
    # only files of the published build are read, so folders of older ones can go
    files = {m["f"] for m in spark.sql("SELECT DISTINCT _metadata.file_path AS f FROM parquet.`%s`" % layers.path("gold", "fact_sales")).collect()}
    assert any(old in f for f in files)
    plan = spark.sql("SELECT * FROM live_test.fact_sales")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(build" in plan or "PartitionFilters: [(build" in plan or "subquery" in plan.lower()


def test_verify_counts_while_the_fact_is_written(spark, tmp_path):
    silver, layers = silver_for(spark, SF001), Layers(spark, str(tmp_path / "root"))
    gold = ops.build_gold(silver, layers, verify=True)
    from pyspark.sql import Observation
    seen = Observation()
    ops.fact_sales(silver["crm_sales_details"], gold["dim_product_info"], gold["dim_customer_info"], seen=seen).write.format("noop").mode("overwrite").save()
    report = {r.fact_key: r.asDict() for r in ops.sales_key_report(silver["crm_sales_details"], gold).collect()}
    ours = {r["fact_key"]: r for r in ops.gold._observed(seen.get, gold)}
    assert ours == report
