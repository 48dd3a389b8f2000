"""Tables that grow: merged silver, lasting keys, partial aggregates, a fact that can be skipped."""

import random

import pytest
from pyspark.sql import functions as F

from medalforge import operators as ops
from medalforge.operators.partials import SalesPartials, bit_words
from medalforge.plans import merged, reports, trends
from medalforge.session import scratch_path
from medalforge.sources import STRING, Layers, land
from medalforge.sources.fixtures import BRONZE_CUSTOMER_COLUMNS, bronze_customer
from medalforge.sources.parts import ConcurrentCommit, Parts
from medalforge.streaming.upsert import upsert_stream
from medalforge.warehouse import gold_for, partials_for, silver_for, source
from tests.conftest import SF001

AS_OF = "2002-01-01"


def rows_of(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def leaves(df):
    """The scans of a DataFrame's plan as it ran."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif node.children().isEmpty():
            out.append(node)
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return [n for n in out if n.getClass().getSimpleName() == "FileSourceScanExec"]


def metric(scan, name):
    return scan.metrics().get(name).get().value()


# --- published parts ----------------------------------------------------------------

def test_parts_are_read_as_committed(spark):
    parts = Parts(spark, scratch_path(spark, "parts"))
    assert parts.read("a int").count() == 0 and parts.version() == 0 and parts.notes() == set()
    parts.write(spark.createDataFrame([(1,)], "a int"), "one")
    parts.write(spark.createDataFrame([(2,)], "a int"))
    spark.createDataFrame([(9,)], "a int").write.parquet(parts.path(parts.new_part()))  # written, never committed
    assert rows_of(parts.read("a int")) == [(1,), (2,)]
    old = parts.read("a int")
    parts.write(spark.createDataFrame([(3,)], "a int"), replace=True)
    assert rows_of(parts.read("a int")) == [(3,)] and rows_of(old) == [(1,), (2,)]
    assert parts.version() == 3 and parts.notes() == {"one"}


def test_a_second_writer_of_a_number_is_told(spark, monkeypatch):
    parts = Parts(spark, scratch_path(spark, "parts"))
    parts.commit(["a"])
    stale = parts._last()
    parts.commit(["b"])
    monkeypatch.setattr(parts, "_last", lambda: stale)
    for _ in range(12):  # one of two ids is the lesser; after a few tries ours is not
        try:
            parts.commit(["c"])
        except ConcurrentCommit:
            return
    pytest.fail("no commit was refused")


# --- keyed upsert -------------------------------------------------------------------

SCHEMA = "id bigint, day date, name string, amount decimal(12,2)"


def history(seed, n=300):
    rng = random.Random(seed)
    import datetime as dt
    from decimal import Decimal
    return [(rng.choice([7] * 40 + list(range(60))), rng.choice([None, dt.date(2001, 1, rng.randrange(1, 9))]),
             rng.choice(["a", "b", None]), rng.choice([None, Decimal("1.50"), Decimal("2.00")])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_one_pass(spark, seed):
    """Ties in the order columns, late rows, repeated rows and one hot key."""
    rows = history(seed)
    rng = random.Random(seed + 10)
    batches = [rows[:120], rows[120:130], rows[130:], rows[50:80], []]
    rng.shuffle(batches)
    table = ops.KeyedTable(spark, scratch_path(spark, "keyed"), spark.createDataFrame([], SCHEMA).schema, ["id"], ["day"], buckets=5)
    for batch in batches:
        table.merge(spark.createDataFrame(batch, SCHEMA))
    whole = ops.latest_per_key(spark.createDataFrame(rows, SCHEMA), ["id"], table.order)
    assert rows_of(table.read()) == rows_of(whole)


def test_only_touched_buckets_are_written(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ops.KeyedTable(spark, scratch_path(spark, "keyed"), schema, ["id"], ["day"], buckets=16)
    table.merge(spark.createDataFrame(history(3), SCHEMA))
    before = set(table.parts.live())
    touched = table.merge(spark.createDataFrame([(7, None, "late", None)], SCHEMA), "batch-2")
    after = set(table.parts.live())
    assert len(touched) == 1 and len(before - after) == 1 and len(after - before) == 1
    # a batch that was merged under its id is left out, whatever it holds now
    assert table.merge(spark.createDataFrame([(8, None, "again", None)], SCHEMA), "batch-2") == []
    assert set(table.parts.live()) == after
    # a failed write leaves the table as it was
    with pytest.raises(Exception):
        table.merge(spark.createDataFrame([(9, None, "x", None)], SCHEMA).withColumn("name", F.raise_error(F.lit("broken")).cast("string")))
    assert set(table.parts.live()) == after


def test_stream_merges_each_landing_once(spark):
    raw = bronze_customer(source(spark, SF001, "customer"))
    spec = ops.cleansing.RAW_CUSTOMER
    schema = ops.enforce_types(raw, spec.types, error_col=None).schema
    inbox, ckpt = scratch_path(spark, "inbox"), scratch_path(spark, "ckpt")
    table = ops.KeyedTable(spark, scratch_path(spark, "silver"), schema, spec.keys, spec.order, buckets=4)

    def run():
        upsert_stream(spark, f"{inbox}/*", "csv", STRING(BRONZE_CUSTOMER_COLUMNS), spec, table, ckpt,
                      max_files_per_trigger=1).awaitTermination()

    newer = F.col("cst_create_date") >= "1994"
    land(raw.where(newer).repartition(3), f"{inbox}/a", "csv")
    run()
    land(raw.where(~newer), f"{inbox}/b", "csv")  # late: older rows of known ids
    run()
    version = table.parts.version()
    run()
    assert table.parts.version() == version  # nothing new, nothing merged
    land(raw.where(newer).limit(20), f"{inbox}/c", "csv")  # repeated rows
    run()
    whole = ops.cleanse(raw, spec)
    assert rows_of(table.read()) == rows_of(whole.select(*table.read().columns))


# --- lasting keys -------------------------------------------------------------------

def test_keys_last_and_new_ones_are_dense(spark):
    keys = ops.KeyDictionary(spark, scratch_path(spark, "keys"), "n", "string", "k")
    first = spark.createDataFrame([("b", 2), ("a", 3), ("c", 1), ("c", 9), (None, 0)], "n string, o int")
    assert keys.extend(first, ["o"]) == 3
    assert rows_of(keys.attach(first.select("n"))) == rows_of(spark.createDataFrame(
        [("b", 2), ("a", 3), ("c", 1), ("c", 1), (None, None)], "n string, k long"))
    assert keys.extend(first, ["o"]) == 0 and keys.parts.version() == 1
    # b goes, x and w come; then b returns
    second = spark.createDataFrame([("a", 1), ("x", 5), ("w", 4)], "n string, o int")
    assert keys.extend(second, ["o"]) == 2
    assert rows_of(keys.read()) == [("a", 3, 1), ("b", 2, 1), ("c", 1, 1), ("w", 4, 2), ("x", 5, 2)]
    assert {r.n: r.k for r in keys.attach(first.where("n = 'b'").select("n"), limit_bytes=0).collect()} == {"b": 2}


def test_gold_builds_keep_their_keys(spark):
    silver = silver_for(spark, SF001)
    layers = Layers(spark, scratch_path(spark, "lasting"))
    kept = ops.gold.layers_dictionaries(layers)
    builds = []
    for customers in (silver["crm_cust_info"].where("cust_id % 3 > 0"), silver["crm_cust_info"].where("cust_id % 4 > 0")):
        gold = ops.build_gold({**silver, "crm_cust_info": customers}, layers, dictionaries=kept)
        builds.append({r.customer_id: r.customer_key for r in gold["dim_customer_info"].collect()})
        assert gold["fact_sales"].where("customer_key IS NOT NULL").count() == \
            silver["crm_sales_details"].where(F.col("sls_cust_id").isin(list(builds[-1]))).count()
    first, second = builds
    both = set(first) & set(second)
    assert both and all(first[c] == second[c] for c in both)
    fresh = sorted(second[c] for c in set(second) - set(first))
    assert fresh == list(range(len(first) + 1, len(first) + len(fresh) + 1))


# --- partial aggregates ---------------------------------------------------------------

def test_bit_words(spark):
    df = spark.createDataFrame([(k,) for k in (0, 1, 63, 64, 127, 1 << 40)], "k long")
    word, mask = bit_words(F.col("k"))
    got = {r.k: (r.w, r.m & (1 << 64) - 1) for r in df.select("k", word.alias("w"), mask.alias("m")).collect()}
    assert got == {k: (k // 64, 1 << (k % 64)) for k in got}


def test_reports_of_merged_builds_equal_a_full_pass(spark):
    gold, store = gold_for(spark, SF001), partials_for(spark, SF001)
    fact = gold["fact_sales"]
    pairs = [(merged.customer_360(store, gold["dim_customer_info"], AS_OF), reports.customer_360(fact, gold["dim_customer_info"], AS_OF)),
             (merged.product_360(store, gold["dim_product_info"], AS_OF), reports.product_360(fact, gold["dim_product_info"], AS_OF)),
             (merged.monthly_trend(store), trends.monthly_trend(fact))]
    for ours, direct in pairs:
        assert ours.schema.simpleString() == direct.schema.simpleString()
        assert rows_of(ours) == rows_of(direct)
        assert "Expand" not in ours._jdf.queryExecution().executedPlan().toString()
        assert not any("fact_sales" in f for f in ours.inputFiles())


def test_adding_a_day_reads_only_what_is_new(spark):
    gold = gold_for(spark, SF001)
    fact = gold["fact_sales"].where("order_date IS NOT NULL")
    day = fact.agg(F.max("order_date")).first()[0]
    store = SalesPartials(spark, scratch_path(spark, "partials"))
    assert store.add(fact.where(F.col("order_date") < F.lit(day)), "before")
    old = {f for t in ("customer", "product", "month") for f in store.read(t).inputFiles()}
    fresh = spark.read.parquet(_written(spark, fact.where(F.col("order_date") == F.lit(day))))
    assert store.add(fresh, "day") and not store.add(fresh, "day")
    for table in ("customer", "product", "month"):
        files = set(store.read(table).inputFiles())
        assert files & old and files - old and not any("fact" in f for f in files)
    assert rows_of(merged.customer_360(store, gold["dim_customer_info"], AS_OF)) == \
        rows_of(reports.customer_360(fact, gold["dim_customer_info"], AS_OF))
    before = rows_of(store.summary("product"))
    store.compact()
    assert rows_of(store.summary("product")) == before and len(store.parts.live()) == 1


def _written(spark, df):
    path = scratch_path(spark, "new_day")
    df.write.parquet(path)
    return path


def test_late_lines_of_a_known_order_count_once(spark):
    import datetime as dt
    from decimal import Decimal
    schema = "sales_order_number string, product_key long, customer_key long, order_date date, sales_amount decimal(18,2), quantity int"
    day = dt.date(2001, 5, 5)
    store = SalesPartials(spark, scratch_path(spark, "partials"))
    store.add(spark.createDataFrame([("A", 1, 1, day, Decimal(5), 1), ("B", 1, None, day, None, 2)], schema))
    store.add(spark.createDataFrame([("A", 1, 1, day, Decimal(7), 1), ("A", None, 1, day, Decimal(1), 1), ("C", 2, 1, None, Decimal(1), 1)], schema))
    got = {r.customer_key: (r.sales, r.quantity, r.n_orders, r.n_products) for r in store.summary("customer").collect()}
    assert got == {1: (Decimal("13.00"), 3, 1, 1), None: (None, 2, 1, 1)}
    empty = SalesPartials(spark, scratch_path(spark, "partials"))
    assert empty.summary("month").count() == 0
    empty.add(spark.createDataFrame([], schema))
    assert empty.summary("customer").count() == 0


# --- a fact that can be skipped -------------------------------------------------------

@pytest.fixture(scope="module")
def by_month(spark):
    fact, path = gold_for(spark, SF001)["fact_sales"], scratch_path(spark, "by_month")
    # row groups of a few rows, so that small data has some to skip
    ops.write_by_month(fact.where("year(order_date) < 1997 OR order_date IS NULL").coalesce(2), path, row_group_bytes=1024)
    return ops.read_by_month(spark, path, fact.schema)


def test_stored_by_month_holds_the_same_rows(spark, by_month):
    fact = gold_for(spark, SF001)["fact_sales"]
    assert rows_of(by_month.drop("order_month")) == rows_of(fact.where("year(order_date) < 1997 OR order_date IS NULL"))
    assert by_month.where("order_month IS NULL").count() == fact.where("order_date IS NULL").count()


def test_months_are_pruned(spark, by_month):
    total = sum(metric(s, "numFiles") for s in leaves(by_month))
    one = by_month.where("order_month = DATE '1996-03-01'")
    assert sum(metric(s, "numFiles") for s in leaves(one)) < total / 5
    months = spark.createDataFrame([("Q1", "1996-01-01"), ("Q1", "1996-02-01")], "q string, m string").selectExpr("q", "cast(m as date) order_month")
    joined = ops.sales_in_months(by_month, months.where("q = 'Q1'"))
    scans = [s for s in leaves(joined) if "order_month" in s.toString()]
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert sum(metric(s, "numFiles") for s in scans) < total / 5
    assert rows_of(joined.select(by_month.columns)) == rows_of(by_month.where("order_month IN (DATE '1996-01-01', DATE '1996-02-01')"))


def test_row_groups_are_skipped(spark, by_month):
    total = by_month.count()
    for column in ("customer_key", "product_key"):
        keys = [r[0] for r in by_month.where(f"{column} IS NOT NULL").groupBy(column).count().orderBy("count").limit(1).collect()]
        one = ops.sales_of(by_month, column, keys[0])
        read = sum(metric(s, "numOutputRows") for s in leaves(one))
        assert one.count() <= read < total / 2
        assert rows_of(one) == rows_of(by_month.where(F.col(column).cast("string") == str(keys[0])))
