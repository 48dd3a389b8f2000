"""Keys, joins, cleansing, quality and layer round trips; plan shape checks."""

from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medalforge import operators as ops
from medalforge.plans import explore, reports
from medalforge.session import scratch_path
from medalforge.sources import STRING, Layers, ingest, land
from medalforge.warehouse import gold_for
from tests.conftest import SF001, SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_distributed_key_equals_row_number(spark, partitions):
    # Many equal values in the order column: the tiebreak lets ranges split them.
    rows = [(i, i % 7 if i % 11 else None, f"k{i:04d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, grp int, name string")
    got = ops.surrogate_key(df, ["grp"], "sk", partitions=partitions, tiebreak=["name"])
    want = df.withColumn("want", F.row_number().over(Window.orderBy("grp", "name")).cast("long"))
    joined = got.join(want, "id")
    assert joined.where(F.col("sk") != F.col("want")).count() == 0
    keys = sorted(r.sk for r in got.select("sk").collect())
    assert keys == list(range(1, 2001))


def test_distributed_key_has_no_single_partition_sort(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 13)
    keyed = ops.surrogate_key(df, ["v"], "sk", tiebreak=["id"])
    plan = _plan(keyed)
    # The only remaining window runs over one row per partition (the offsets).
    assert "RowNumber" not in plan and "row_number" not in plan


@pytest.mark.parametrize("limit", [0, None])
def test_left_join_dim_salted_equals_broadcast(spark, limit):
    # one hot key with a third of the rows, NULL keys, and keys missing from the dim
    fact_rows = ([(i, "HOT") for i in range(300)] + [(1000 + i, f"K{i % 50}") for i in range(550)]
                 + [(2000 + i, None) for i in range(100)] + [(3000 + i, "MISSING") for i in range(50)])
    fact = spark.createDataFrame(fact_rows, "row long, k string")
    dim = spark.createDataFrame([("HOT", 1)] + [(f"K{i}", 10 + i) for i in range(50)],
                                "dk string, sk int")
    got = ops.left_join_dim(fact, dim, "k", "dk", limit_bytes=limit, hot_fraction=0.1)
    want = fact.join(dim, fact.k == dim.dk, "left").drop("dk")
    assert got.count() == 1000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salted_join_spreads_a_hot_key(spark):
    fact = spark.createDataFrame([(i, "HOT" if i % 3 == 0 else f"K{i % 97}") for i in range(3000)],
                                 "row long, k string")
    dim = spark.createDataFrame([("HOT", 1)] + [(f"K{i}", i) for i in range(97)], "dk string, sk int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",  # force the shuffle join
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # keep its partitions
    previous = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = ops.left_join_dim(fact, dim, "k", "dk", limit_bytes=0, hot_fraction=0.01)
        assert got.where(F.col("sk").isNull()).count() == 0 and got.count() == 3000
        tasks = (got.where(F.col("k") == "HOT").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
        assert tasks >= 4  # the hot key's 1000 rows are spread, not in one task
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v)


def test_projection_bytes_counts_rows_and_strings(spark):
    df = spark.createDataFrame([("abc", 1), ("de", 2)], "s string, i int")
    rows, size = ops.projection_bytes(df)
    assert rows == 2 and size >= 5


def test_enforce_types_counts_unparseable_values(spark):
    df = spark.createDataFrame([("1", "2001-02-03", "12.5"), ("x", "2001-02-30", ""),
                                ("", None, "n/a")], "a string, d string, m string")
    out = ops.enforce_types(df, {"a": "bigint", "d": "date", "m": "decimal(12,2)"}).collect()
    assert out[0].a == 1 and out[0].d == date(2001, 2, 3) and str(out[0].m) == "12.50"
    assert [r._type_errors for r in out] == [0, 2, 1]


def test_drop_fill_and_latest(spark):
    df = spark.createDataFrame([(1, " a ", "2001-01-01"), (1, "", "2002-01-01"), (None, "c", None),
                                (2, None, None), (2, "z", "2000-01-01")], "id long, t string, d string")
    kept = ops.drop_critical(df, ["id"])
    assert kept.count() == 4
    filled = ops.fill_unknown(kept, ["t"])
    assert sorted(r.t for r in filled.collect()) == ["Unknown", "Unknown", "a", "z"]
    latest = {r.id: r.t for r in ops.latest_per_key(filled, ["id"], ["d"]).collect()}
    assert latest == {1: "Unknown", 2: "z"}  # NULL dates sort last


def test_rename_rejects_unknown_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert ops.rename(df, {"a": "b"}).columns == ["b"]
    with pytest.raises(KeyError):
        ops.rename(df, {"zz": "b"})


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_bronze_round_trip_keeps_text(spark, fmt):
    rows = [("1", "  padded ", ""), ("2", None, "x,y \"q\"")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    path = scratch_path(spark, "test-bronze")
    land(df, path, fmt)
    back = ingest(spark, path, fmt, STRING(["a", "b", "c"]))
    assert back.where("_corrupt_record IS NOT NULL").count() == 0
    got = sorted(tuple(r) for r in back.select("a", "b", "c").collect())
    want = sorted(rows) if fmt == "csv" else sorted([("1", "  padded ", ""), ("2", None, "x,y \"q\"")])
    assert got == want


def test_layers_write_and_read(spark):
    layers = Layers(spark, scratch_path(spark, "test-layers"))
    df = spark.range(10)
    back = layers.write(df, "silver", "numbers")
    assert back.count() == 10 and layers.silver("numbers").count() == 10
    with pytest.raises(ValueError):
        layers.path("platinum", "x")


def test_gold_properties(spark):
    gold = gold_for(spark, SF001)
    fact, dc, dp = gold["fact_sales"], gold["dim_customer_info"], gold["dim_product_info"]
    from medalforge.warehouse import silver_for
    assert fact.count() == silver_for(spark, SF001)["crm_sales_details"].count()
    n = dc.count()
    assert sorted(r.customer_key for r in dc.select("customer_key").collect()) == list(range(1, n + 1))
    rep = {r.dimension: r for r in ops.integrity_report(fact, {
        "product_key": ("dim_product_info", dp, "product_key"),
        "customer_key": ("dim_customer_info", dc, "customer_key")}).collect()}
    assert rep["dim_product_info"].unmatched_rows == 0
    assert rep["dim_product_info"].null_key_rows == 596  # FIXTURES.md coverage table


def test_running_total_ends_at_total_sales(spark):
    from medalforge.plans import trends
    gold = gold_for(spark, SF001)
    fact = gold["fact_sales"]
    last = trends.monthly_trend(fact).orderBy(F.col("order_month").desc()).first()
    total = fact.where(F.col("order_date").isNotNull()).agg(F.sum("sales_amount")).first()[0]
    assert last.cumulative_total_sales == total


def test_measure_summary_reads_each_column_once(spark):
    import re
    gold = gold_for(spark, SF001)
    df = explore.measure_summary(gold["fact_sales"], gold["dim_product_info"],
                                 gold["dim_customer_info"])
    assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    fact_cols = {"sales_order_number", "product_key", "customer_key", "order_date", "ship_date",
                 "due_date", "sales_amount", "quantity", "unit_price"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    reads = []
    for m in re.finditer(r"FileScan parquet [^\n]*?fact_sales[^\n]*?ReadSchema: struct<([^>]*)>",
                         _plan(df)):
        reads += re.findall(r"(\w+):", m.group(1))
    assert set(reads) <= fact_cols and len(reads) == len(set(reads)) == 6
    assert df.count() == 8


def test_report_aggregates_before_joining_and_pushes_filter(spark):
    gold = gold_for(spark, SF001)
    df = reports.customer_360(gold["fact_sales"], gold["dim_customer_info"], "2002-01-01")
    plan = _plan(df)
    assert "IsNotNull(order_date)" in plan
    # the join's probe side is the aggregate, not the fact scan
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = opt.index("Join LeftOuter")
    assert "Aggregate" in opt[join_at:]


def test_latest_per_key_limits_before_shuffle(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    plan = _plan(ops.latest_per_key(ev, ["user_id"], ["ts", "event_id"]))
    limit_at, exchange_at = plan.rfind("WindowGroupLimit"), plan.rfind("Exchange hashpartitioning")
    assert "Partial" in plan and limit_at > exchange_at > 0  # partial limit sits below the shuffle


def test_latest_per_key_hot_key(spark):
    rows = [(i, datetime(2024, 1, 1, 0, 0, i % 60), 1 if i % 3 == 0 else i % 17) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long")
    got = {r.user_id: r.event_id for r in ops.latest_per_key(df, ["user_id"], ["ts", "event_id"]).collect()}
    want = {}
    for eid, ts, uid in rows:
        if uid not in want or (ts, eid) > want[uid]:
            want[uid] = (ts, eid)
    assert got == {u: e for u, (_, e) in want.items()}


def test_profile_columns_exact_and_approx(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    exact = {r.column_name: r for r in ops.profile_columns(df).collect()}
    assert exact["x"].distinct_count == 2 and exact["y"].null_count == 1
    assert exact["y"].data_type == "string" and exact["y"].ordinal_position == 2
    approx = {r.column_name: r for r in ops.profile_columns(df, exact=False).collect()}
    assert approx["x"].distinct_count == 2
    plan = ops.profile_columns(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan  # one single-distinct aggregate per column


def test_single_partition_exchanges_only_carry_aggregates(spark):
    """No registered query gathers unaggregated rows into one task."""
    import __spark_entry__ as entry
    stops = ("Aggregate", "Scan", "Exchange", "HashJoin", "SortMergeJoin", "Window", "Union",
             "Expand", "Generate")
    for name, fn in entry.queries().items():
        lines = _plan(fn(spark, SF001)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            below = next((l for l in lines[i + 1:] if any(s in l for s in stops)), "")
            assert "Aggregate" in below, f"{name}: single-partition exchange over {below.strip()[:80]}"


def test_fact_build_salted_path_equals_broadcast_path(spark):
    from medalforge.operators.gold import fact_sales
    from medalforge.warehouse import silver_for
    gold, silver = gold_for(spark, SF001), silver_for(spark, SF001)
    dims = (gold["dim_product_info"], gold["dim_customer_info"])
    split = fact_sales(silver["crm_sales_details"], *dims, limit_bytes=0)
    plain = fact_sales(silver["crm_sales_details"], *dims)
    assert split.count() == plain.count() == gold["fact_sales"].count()
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_bronze_keeps_malformed_lines(spark):
    import os
    path = scratch_path(spark, "test-corrupt")
    local = path[5:] if path.startswith("file:") else path
    os.makedirs(local)
    with open(f"{local}/raw.csv", "w") as fh:
        fh.write('a,b\n1,x\n2,"unterminated\n3,y,extra\n')
    df = ingest(spark, path, "csv", STRING(["a", "b"]), keep_corrupt=True)
    rows = df.collect()
    assert any(r["_corrupt_record"] for r in rows)
    assert [r.a for r in rows if r["_corrupt_record"] is None][0] == "1"


def test_sql_over_registered_views(spark):
    from medalforge.plans.views import register_views
    gold = gold_for(spark, SF001)
    names = register_views(spark, gold, as_of="2002-01-01")
    assert "view_customer_analytics" in names
    top = spark.sql("SELECT * FROM view_customer_analytics "
                    "ORDER BY total_sales_amount DESC, customer_key LIMIT 100")
    lib = reports.top_rows(reports.customer_360(gold["fact_sales"], gold["dim_customer_info"],
                                                "2002-01-01"), "total_sales_amount", "customer_key")
    assert top.exceptAll(lib).count() == 0 and top.count() == 100
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_sales f LEFT JOIN dim_product_info p "
                  "ON f.product_key = p.product_key").first().n
    assert n == gold["fact_sales"].count()


def test_build_gold_reports_timings_and_names_failures(spark):
    from medalforge.operators.gold import GoldBuildError, build_gold
    from medalforge.warehouse import silver_for
    silver = silver_for(spark, SF001)
    layers = Layers(spark, scratch_path(spark, "test-gold"))
    timings = {}
    gold = build_gold(silver, layers, timings=timings)
    assert set(timings) == {"dim_customer_info", "dim_product_info", "fact_sales", "total"}
    assert gold["fact_sales"].count() == silver["crm_sales_details"].count()
    broken = dict(silver, crm_sales_details=silver["crm_sales_details"].drop("sls_prd_key"))
    with pytest.raises(GoldBuildError) as err:
        build_gold(broken, Layers(spark, scratch_path(spark, "test-gold-bad")))
    assert err.value.table == "fact_sales"


def test_assert_integrity(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k long")
    dim = spark.createDataFrame([(1,), (2,)], "k long")
    report = ops.integrity_report(fact, {"k": ("dim", dim, "k")})
    with pytest.raises(ops.IntegrityError):
        ops.assert_integrity(report)
    ok = ops.integrity_report(fact.where("k is null or k < 5"), {"k": ("dim", dim, "k")})
    assert ops.assert_integrity(ok)[0]["null_key_rows"] == 1
    with pytest.raises(ops.IntegrityError):
        ops.assert_integrity(ok, allow_null_keys=False)
    from medalforge.operators.gold import build_gold
    from medalforge.warehouse import silver_for
    build_gold(silver_for(spark, SF001), Layers(spark, scratch_path(spark, "test-verify")), verify=True)


def test_profile_columns_odd_names(spark):
    df = spark.createDataFrame([(1, "x")], "`it's` int, `a b` string")
    rows = {r.column_name: r for r in ops.profile_columns(df).collect()}
    assert rows["it's"].distinct_count == 1 and rows["a b"].data_type == "string"


def test_dimensions_equal_without_broadcasts(spark):
    from medalforge.operators.gold import dim_customer_info, dim_product_info
    from medalforge.warehouse import silver_for
    s = silver_for(spark, SF001)

    def build():
        return (dim_customer_info(s["crm_cust_info"], s["erp_cust_az12"], s["erp_loc_a101"]),
                dim_product_info(s["crm_prd_info"], s["erp_px_cat_g1v1"]))

    plain = [d.collect() for d in build()]
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # every join takes the salted path
    try:
        salted = [d.collect() for d in build()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    for a, b in zip(plain, salted):
        assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_fact_layout_modes(spark):
    from medalforge.operators.gold import fact_layout
    gold = gold_for(spark, SF001)
    fact = gold["fact_sales"]
    for mode in ("rebalance", "sort"):
        laid = fact_layout(fact, mode=mode)
        assert laid.count() == fact.count()
        plan = _plan(laid)
        assert ("Exchange" in plan) == (mode == "rebalance")
    with pytest.raises(ValueError):
        fact_layout(fact, mode="zorder")


ROLLUP_QUERIES = ("revenue_by_category", "items_sold_by_country", "top5_products",
                  "bottom5_products", "product_year_trend", "category_contribution")


def test_rollup_plans_agree(spark):
    """Join-first (broadcastable dimension) and aggregate-first give the same rows and types."""
    import __spark_entry__ as entry
    qs = entry.queries()
    entry.queries()["fact_sales"](spark, SF001).count()  # build gold before changing settings
    first = {n: qs[n](spark, SF001) for n in ROLLUP_QUERIES}
    want = {n: (df.schema.simpleString(), sorted(map(tuple, df.collect()), key=str))
            for n, df in first.items()}
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in ROLLUP_QUERIES:
            df = qs[n](spark, SF001)
            assert "BroadcastHashJoin" not in _plan(df)
            assert (df.schema.simpleString(), sorted(map(tuple, df.collect()), key=str)) == want[n], n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_rollup_join_first_shuffles_only_the_attribute(spark):
    from medalforge.plans import explore
    gold = gold_for(spark, SF001)
    plan = _plan(explore.revenue_by_category(gold["fact_sales"], gold["dim_product_info"]))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning(product_key" not in plan  # no per-key shuffle
    assert "hashpartitioning(category_name" in plan


def test_every_analytic_shuffle_is_combined_map_side(spark):
    """Below each query's lowest hash shuffle there is a partial aggregate, not raw rows."""
    from medalforge.plans import catalog
    gold = gold_for(spark, SF001)
    for name in catalog.ANALYTICS:
        lines = _plan(catalog.run(name, gold, "2002-01-01")).split("\n")
        idx = [i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l]
        if not idx:
            continue
        lowest = idx[-1]  # printed last = closest to the scans
        below = next((l for l in lines[lowest + 1:] if "Aggregate" in l or "Scan" in l), "")
        combined = "partial_" in below or "functions=[]" in below  # DISTINCT: grouping only
        assert "Aggregate" in below and combined, f"{name}: {below.strip()[:100]}"


def test_measured_join_overrides_the_planner_estimate(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "k long, v string")
    small = _plan(ops.measured_join(left, dim, "k"))
    assert "BroadcastHashJoin" in small
    forced = _plan(ops.measured_join(left, dim, "k", limit_bytes=0))
    assert "SortMergeJoin" in forced and "BroadcastHashJoin" not in forced
    assert ops.measured_join(left, dim, "k", limit_bytes=0).count() == 100


def test_build_gold_is_create_or_replace(spark):
    from medalforge.operators.gold import build_gold
    from medalforge.warehouse import silver_for
    layers = Layers(spark, scratch_path(spark, "test-idempotent"))
    silver = silver_for(spark, SF001)
    first = {n: sorted(map(tuple, df.collect()), key=str) for n, df in build_gold(silver, layers).items()}
    again = build_gold(silver, layers)  # same folders: replaced, not appended
    for name, rows in first.items():
        assert sorted(map(tuple, again[name].collect()), key=str) == rows, name


@pytest.mark.parametrize("limit", [None, 0])
def test_left_join_dim_same_key_name(spark, limit):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz")], "row long, k string")
    dim = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    out = ops.left_join_dim(fact, dim, "k", "k", limit_bytes=limit)
    assert out.columns == ["row", "k", "v"]
    assert sorted(map(tuple, out.collect()), key=str) == \
        [(1, "a", 10), (2, "b", 20), (3, None, None), (4, "zz", None)]
