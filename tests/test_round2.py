"""Input that must not be lost, builds that must not half happen, and joins that must stay spread."""

import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medalforge import operators as ops
from medalforge import session
from medalforge.functions import rounded_ratio
from medalforge.operators import joins
from medalforge.plans import trends
from medalforge.plans.views import publish_tables, register_views
from medalforge.sources import Layers
from medalforge.sources import bronze
from medalforge.streaming import land_stream
from medalforge.warehouse import gold_for, silver_for
from tests.conftest import SF001

SCHEMA = bronze.STRING(["id", "t"])


def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


# --- landing -------------------------------------------------------------------

def test_malformed_lines_are_kept(spark, tmp_path):
    _file(tmp_path / "csv", "a.csv", "id,t\n1,a,EXTRA\n2,b\n3\n")
    rows = {r.id: r for r in bronze.ingest(spark, str(tmp_path / "csv"), "csv", SCHEMA).collect()}
    assert rows["1"]._corrupt_record == "1,a,EXTRA" and rows["2"]._corrupt_record is None
    assert rows["3"]._corrupt_record == "3"
    _file(tmp_path / "json", "a.json", '{"id": "1", "t": "x"}\n{"id": "2", "t"\n')
    got = sorted((r.id or "", r._corrupt_record or "") for r in bronze.ingest(spark, str(tmp_path / "json"), "json", SCHEMA).collect())
    assert got == [("", '{"id": "2", "t"'), ("1", "")]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    _file(tmp_path / "csv", "a.csv", "t,id\na,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        bronze.ingest(spark, str(tmp_path / "csv"), "csv", SCHEMA).collect()


def test_line_breaks_are_refused_or_carried(spark, tmp_path):
    df = spark.createDataFrame([("1", "two\nlines"), ("2", None)], SCHEMA)
    with pytest.raises(Exception, match="line break"):
        bronze.land(df, str(tmp_path / "c"), "csv")
    bronze.land(df, str(tmp_path / "j"), "json")
    got = sorted((r.id, r.t) for r in bronze.ingest(spark, str(tmp_path / "j"), "json", SCHEMA).collect())
    assert got == [("1", "two\nlines"), ("2", None)]
    with pytest.raises(Exception, match="line break"):
        bronze.land(df.select("t"), str(tmp_path / "t"), "text")


def test_log_lines_land_as_they_are(spark, tmp_path):
    lines = ["GET /a  200 ", "", '"quoted, {odd']
    bronze.land(spark.createDataFrame([(x,) for x in lines], "value string"), str(tmp_path / "log"), "text")
    assert sorted(r.value for r in bronze.ingest(spark, str(tmp_path / "log"), "text").collect()) == sorted(lines)


def test_an_old_file_that_arrives_late_lands(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for name, age in (("new1", 0), ("old", 30), ("new2", 0)):
        path = _file(source, f"{name}.csv", f"id,t\n{name},x,EXTRA\n" if age else f"id,t\n{name},x\n")
        os.utime(path, (time.time() - age * 86400,) * 2)
        land_stream(spark, source, "csv", SCHEMA, target, check).awaitTermination()
    rows = {r.id: r._corrupt_record for r in spark.read.parquet(target).collect()}
    assert rows == {"new1": None, "new2": None, "old": "old,x,EXTRA"}


def test_padded_dates_and_rounded_decimals(spark):
    df = spark.createDataFrame([(" 2001-01-01 ", " 12.34 "), ("2001-02-30", "12.345"), ("", "x")], "d string, m string")
    rows = ops.enforce_types(df, {"d": "date", "m": "decimal(12,2)"}).collect()
    assert [str(r.d) for r in rows] == ["2001-01-01", "None", "None"]
    assert [r._type_errors for r in rows] == [0, 2, 1]


# --- gold builds -----------------------------------------------------------------

def _owners(gold):
    f, c = gold["fact_sales"], gold["dim_customer_info"]
    return {r.sales_order_number: r.customer_id for r in
            f.join(c, "customer_key").select("sales_order_number", "customer_id").distinct().collect()}


def test_a_failed_rebuild_leaves_the_old_gold(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "root"))
    silver = silver_for(spark, SF001)
    ops.build_gold(silver, layers)
    before = _owners({n: layers.gold(n) for n in ops.GOLD_ORDER})
    broken = dict(silver, crm_cust_info=silver["crm_cust_info"].where("cust_id > 9"),
                  crm_sales_details=silver["crm_sales_details"].withColumn("sls_ord_num", F.raise_error(F.lit("broken source"))))
    with pytest.raises(ops.GoldBuildError):
        ops.build_gold(broken, layers)
    assert _owners({n: layers.gold(n) for n in ops.GOLD_ORDER}) == before
    assert layers.gold("dim_customer_info").count() == silver["crm_cust_info"].count()
    first = layers.current_build()
    ops.build_gold(dict(silver, crm_cust_info=silver["crm_cust_info"].where("cust_id > 9")), layers)
    assert layers.current_build() != first
    assert layers.gold("dim_customer_info").count() < layers.gold("dim_customer_info", first).count()
    with pytest.raises(FileNotFoundError):
        Layers(spark, str(tmp_path / "nothing")).gold("fact_sales")


def test_unmatched_sales_and_repeated_keys_fail_the_check(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "root"))
    silver = silver_for(spark, SF001)
    nearly_none = dict(silver, crm_prd_info=silver["crm_prd_info"].where("prd_id % 100 = 1"))
    with pytest.raises(ops.IntegrityError):
        ops.build_gold(nearly_none, layers, verify=True)
    assert layers.current_build() is None  # nothing was published
    twice = dict(silver, crm_cust_info=silver["crm_cust_info"].unionByName(silver["crm_cust_info"].where("cust_id = 5")))
    with pytest.raises(ops.IntegrityError):
        ops.build_gold(twice, layers, verify=True)
    gold = ops.build_gold(silver, layers, verify=True)
    report = {r.fact_key: r for r in ops.sales_key_report(silver["crm_sales_details"], gold).collect()}
    assert 0 < report["sls_prd_key"].unmatched_rows < 0.5 * report["sls_prd_key"].fact_rows
    assert report["sls_cust_id"].repeated_keys == 0


def test_tables_by_name_and_report_options(spark, tmp_path):
    gold = gold_for(spark, SF001)
    names = publish_tables(spark, gold, str(tmp_path / "t1"), as_of="2002-01-01")
    publish_tables(spark, gold, str(tmp_path / "t2"), as_of="2002-01-01")  # again: replaced
    assert "gold.fact_sales" in names and spark.sql("SELECT * FROM gold.fact_sales").count() == gold["fact_sales"].count()
    assert spark.sql("SELECT * FROM gold.view_product_analytics LIMIT 3").count() == 3
    register_views(spark, gold, "2002-01-01", high=1)
    assert {r[0] for r in spark.sql("SELECT DISTINCT product_performance_segment FROM view_product_analytics").collect()} \
        <= {"High-Performer", "Mid-Range", "Low-Performer"}
    assert spark.sql("SELECT * FROM view_product_analytics WHERE total_sales >= 1 "
                     "AND product_performance_segment <> 'High-Performer'").count() == 0
    with pytest.raises(TypeError, match="nonsense"):
        register_views(spark, gold, nonsense=5)


# --- joins -------------------------------------------------------------------------

def test_identical_hot_rows_fill_many_tasks(spark):
    fact = spark.range(0, 100_000, 1, 4).select(F.lit("hot").alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    dim = spark.createDataFrame([("hot", 1), ("b", 2)], "dk string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ops.left_join_dim(fact, dim, "k", "dk", limit_bytes=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 100_000 and len(sizes) >= 5 and max(sizes) < 50_000
    assert out.where("v = 1").count() == 100_000


def test_hot_keys_are_found_before_any_join(spark, monkeypatch):
    seen = []
    real = joins.hot_keys

    def spy(fact, keys, fraction):
        seen.append((fact._jdf.queryExecution().executedPlan().toString(), list(keys)))
        return real(fact, keys, fraction)

    monkeypatch.setattr(joins, "hot_keys", spy)
    fact = spark.createDataFrame([(1, "x", 0), (2, None, 1), (1, "y", 2)], "a long, b string, n int")
    d1 = spark.createDataFrame([(1, "one")], "id long, u string")
    d2 = spark.createDataFrame([("x", 10)], "id2 string, w int")
    got = sorted((r.n, r.u, r.w) for r in ops.left_join_dims(fact, [(d1, "a", "id"), (d2, "b", "id2")], limit_bytes=0).collect())
    assert got == [(0, "one", 10), (1, None, None), (2, "one", None)]
    assert len(seen) == 1 and seen[0][1] == ["a", "b"] and "Join" not in seen[0][0]


def test_a_rewritten_or_wide_dimension_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "dim.csv")
    _file(path, "part.csv", "1,a\n")
    read = lambda: spark.read.schema("id int, t string").csv(path)
    assert joins.fits_broadcast(read(), 1000)
    _file(path, "part.csv", "".join(f"{i},{'x' * 50}\n" for i in range(5000)))
    assert not joins.fits_broadcast(read(), 1000)
    wide = spark.range(10).select("id", F.array_repeat(F.lit("x" * 1000), 10).alias("a"))
    assert not joins.fits_broadcast(wide, 10_000_000)


# --- shared folder, keys, rounding ---------------------------------------------------

class _Conf:
    def get(self, *_):
        return None


class _Context:
    master = "spark://elsewhere:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()

    def setCheckpointDir(self, path):
        raise AssertionError(path)


class _Session:
    sparkContext = _Context()


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session())
    assert session._one_machine("local[8]") and not session._one_machine("local-cluster[2,1,1024]")


def test_surrogate_key_needs_no_earlier_query(tmp_path):
    import subprocess
    import sys
    code = ("from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as e\n"
            f"print('rows', e.queries()['surrogate_key'](s, '{SF001}').count())\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=300,
                         env={**os.environ, "TMPDIR": str(tmp_path)})
    assert "rows 1500" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("num,den,want", [
    ("12.34", "100.00", "0.12"), ("123449999996.00", "1000000000000.00", "0.12"), ("0.005", "1", "0.01"), ("-0.005", "1", "-0.01"),
    ("1", "0", None), ("2", "3", "0.67"), ("-2", "3", "-0.67"), ("1", "-8", "-0.13"),
])
def test_ratios_are_rounded_once(spark, num, den, want):
    df = spark.sql(f"SELECT CAST('{num}' AS DECIMAL(28,3)) n, CAST('{den}' AS DECIMAL(28,2)) d")
    got = df.select(rounded_ratio("n", "d")).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_a_share_just_below_a_tie(spark):
    df = spark.createDataFrame([(Decimal("12344999999.60"),), (Decimal("87655000000.40"),)], "v decimal(28,2)")
    overall, share = trends.share_of_total("v")
    assert sorted(str(r[0]) for r in df.select(share).collect()) == ["12.34", "87.66"]
