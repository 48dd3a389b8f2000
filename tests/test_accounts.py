"""Cleansing that accounts for every row, running windows without a single task, heavy hitters from summaries."""

import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medalforge import operators as ops
from medalforge.operators.joins import heavy_candidates, hot_keys


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- rejects ------------------------------------------------------------------------

SPEC = ops.Cleansing({"id": "bigint", "day": "date", "amount": "decimal(12,2)"}, ["id"], ["name"], ["id"], ["day"])
LANDED = "id string, day string, amount string, name string, _corrupt_record string"


def test_every_row_is_silver_or_a_reject(spark):
    rows = [("1", "2001-01-01", "1.50", " a ", None), ("1", "2001-01-02", "x", "", None), ("1", None, "2", "b", None),
            ("n/a", "2001-01-01", "1", "c", None), (" ", None, None, None, None), (None, None, None, None, '{"id": "9'),
            ("2", "never", "1.555", None, None)]
    done = ops.cleanse_accounted(spark.createDataFrame(rows, LANDED), SPEC)
    done.check()
    assert done.counts == {"landed": 7, "silver": 2, "corrupt line": 1, "type": 1, "critical null": 1, "older row": 2, "values nulled": 3}
    silver = {r.id: (str(r.day), r.amount, r.name, r._type_errors) for r in done.silver.collect()}
    assert silver == {1: ("2001-01-02", None, "Unknown", 1), 2: ("None", Decimal("1.56"), "Unknown", 2)}
    rejects = sorted((r.reason, r.id or "", r._corrupt_record or "") for r in done.rejects.collect())
    assert rejects == [("corrupt line", "", '{"id": "9'), ("critical null", " ", ""), ("older row", "1", ""), ("older row", "1", ""), ("type", "n/a", "")]
    # raw text of a reject is as it landed
    assert (" a ", "1.50") in {(r.name, r.amount) for r in done.rejects.collect()}


def test_accounts_equal_plain_cleansing(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["1", "7", "7", "7", "x", "", None, "23"]), rng.choice(["2001-01-0%d" % rng.randrange(1, 9), "bad", None]),
             rng.choice(["1", "2.5", "n/a", None]), rng.choice(["a", " ", None]), None) for _ in range(400)]
    landed = spark.createDataFrame(rows, LANDED)
    total = replace(SPEC, order=["day", "amount", "name"])
    done = ops.cleanse_accounted(landed, total)
    done.check()
    assert rows_of(done.silver.drop("_type_errors")) == rows_of(ops.cleanse(landed.drop("_corrupt_record"), total).select("id", "day", "amount", "name"))
    assert done.silver.count() + done.rejects.count() == 400
    append = ops.cleanse_accounted(landed, replace(SPEC, keys=()))
    assert append.counts["older row"] == 0 and append.counts["silver"] == ops.cleanse(landed, replace(SPEC, keys=())).count()
    none = ops.cleanse_accounted(landed.limit(0), SPEC)
    none.check()
    assert none.silver.count() == none.rejects.count() == 0


# --- running windows ----------------------------------------------------------------

def plain_windows(df, order):
    w = Window.orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("*", F.sum("x").over(upto).alias("total"), F.avg("x").over(w.rowsBetween(-2, 0)).alias("mean"),
                     F.lag("x", 1).over(w).alias("before"), F.lag("x", 12).over(w).alias("year"))


@pytest.mark.parametrize("n, partitions", [(0, 4), (1, 4), (7, 8), (500, 8), (60, 40)])
def test_running_windows_equal_one_task(spark, n, partitions):
    """Fewer rows per range than the look-back, NULLs in order and value, one order value on most rows."""
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 5, 5, 5, 5, 9]), i, None if rng.random() < 0.2 else Decimal(rng.randrange(10 ** 6)).scaleb(-2)) for i in range(n)]
    df = spark.createDataFrame(rows, "d int, k int, x decimal(18,2)")
    got = ops.running_windows(df, ["d", "k"], {"total": "x"}, {"mean": ("x", 3)}, {"before": ("x", 1), "year": ("x", 12)}, partitions)
    want = plain_windows(df, ["d", "k"])
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows_of(got) == rows_of(want)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


# --- heavy hitters ------------------------------------------------------------------

def test_hot_keys_equal_an_exact_count(spark):
    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN 10 + id % 5 WHEN id % 11 = 0 THEN NULL ELSE id END AS third",
        "CAST(id AS STRING) AS none", "CAST(NULL AS STRING) AS missing", "id % 700 AS many")
    keys = ["third", "none", "missing", "many"]
    for frame in (df, df.limit(40), df.limit(0)):
        got = hot_keys(frame, keys, 1e-3)
        for key in keys:
            counts = {r.v: r["count"] for r in frame.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("v")).count().collect()}
            least = max(1, int(sum(counts.values()) * 1e-3))
            assert sorted(got[key]) == sorted(v for v, n in counts.items() if n >= least)


def test_summaries_are_bounded_and_keys_are_not_shuffled(spark):
    df = spark.range(200_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k")
    totals, candidates = heavy_candidates(df, ["k"], 1e-2)
    assert totals == {"k": 200_000} and "hot" in candidates["k"] and len(candidates["k"]) <= 200
    with pytest.raises(ValueError):
        heavy_candidates(df, ["k"], 1e-7)


# --- profiles that merge --------------------------------------------------------------

def test_a_second_profile_reads_only_new_files(spark):
    from medalforge.session import scratch_path
    path = scratch_path(spark, "profiled")
    first = spark.range(20_000).selectExpr("id", "CAST(id % 500 AS STRING) AS s", "date_add(DATE '2001-01-01', CAST(id % 90 AS INT)) AS d",
                                           "CAST(CASE WHEN id % 4 = 0 THEN NULL ELSE id % 1000 END AS DECIMAL(18,2)) AS x", "id % 2 = 0 AS b")
    first.repartition(3).write.parquet(path)
    store = ops.ProfileStore(spark, scratch_path(spark, "profile"))
    assert len(store.update(spark.read.parquet(path))) == 3
    first.where("id < 100").withColumn("s", F.lit("new")).coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    assert len(store.update(table)) == 1 and store.update(table) == []
    exact = {r.column_name: r for r in ops.profile_columns(table).collect()}
    for r in store.profile(table).collect():
        assert (r.ordinal_position, r.data_type, r.null_count) == (exact[r.column_name].ordinal_position, exact[r.column_name].data_type, exact[r.column_name].null_count)
        assert r.row_count == 20_100
        assert abs(r.distinct_estimate - exact[r.column_name].distinct_count) <= 0.04 * exact[r.column_name].distinct_count
    quantiles = {r.column_name: r.p50 for r in store.profile(table).collect()}
    assert abs(quantiles["id"] - 9_950) < 600 and abs(quantiles["x"] - 500) < 30 and quantiles["s"] is None
    # files that are gone no longer count
    only = spark.read.parquet(*table.inputFiles()[:2])
    assert store.update(only) == [] and {r.row_count for r in store.profile(only).collect()} == {only.count()}
    nothing = store.profile(spark.createDataFrame([], table.schema))
    assert nothing.count() == 0


# --- references checked where the fact lies ---------------------------------------------

def test_references_by_broadcast_bitmap_and_grouping(spark, monkeypatch):
    from medalforge.operators import quality
    fact = spark.range(5000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 300 END AS k", "CAST(id % 300 AS STRING) AS t")
    dim = spark.range(0, 250).unionAll(spark.range(200, 250)).selectExpr("id AS dk", "CAST(id AS STRING) AS dt")
    refs = {"k": ("d", dim, "dk"), "t": ("e", dim, "dt")}
    want = {"d": (5000, 715, fact.where("k >= 250").count()), "e": (5000, 0, fact.where("CAST(t AS INT) >= 250").count())}
    plans = []
    for bytes_ in (10 ** 7, 3_000, 0):  # all keys fit; only the bitmap of the integer keys does; nothing does
        monkeypatch.setattr(quality, "fits_broadcast", lambda df, bytes_=bytes_: ops.projection_bytes(df)[1] <= bytes_)
        report = ops.integrity_report(fact, refs)
        assert {r.dimension: (r.fact_rows, r.null_key_rows, r.unmatched_rows) for r in report.collect()} == want
        plans.append(report._jdf.queryExecution().optimizedPlan().toString())
    assert "bit_or" not in plans[0] and "bit_or" in plans[1] and "bit_or" not in plans[2]
