"""Every named query as ``(spark, sf_dir) -> DataFrame`` over the test tables.

The wiring from test tables to library calls lives here; the library
functions themselves take DataFrames and parameters only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..session import scratch_path
from ..sources import Layers
from ..sources import bronze as bronze_io
from ..sources.fixtures import BRONZE_CUSTOMER_COLUMNS, bronze_customer
from ..streaming.upsert import upsert_stream
from ..warehouse import gold_for, layers_for, monthly_fact_for, partials_for, silver_for, source
from . import catalog, merged, reports
from .views import register_catalog

AS_OF = "2002-01-01"  # the date that ages and recency are counted to

Query = Callable[[SparkSession, str], DataFrame]

# Business names for the CRM customer columns (technical → business).
CUSTOMER_RENAMES = {
    "cust_id": "customer_id",
    "cust_key": "customer_number",
    "cust_first_name": "first_name",
    "cust_last_name": "last_name",
    "cust_gender": "gender",
    "cust_marital_status": "marital_status",
    "cust_create_date": "customer_create_date",
}


#: Queries over tables that grow, or that build or account for something in every run.
GROWING = ("silver_upsert", "customer_rejects", "customer_reconciliation", "lasting_keys", "fact_by_month", "customer_360_merged",
           "product_360_merged", "monthly_trend_merged", "customer_statement", "best_months_sales", "order_running", "profile_merged",
           "gold_sql_products", "customer_360_today", "customer_360_days")


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return gold_for(spark, sf_dir)[name]


def _silver(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_for(spark, sf_dir)[name]


def _fact(s, d):
    return _gold(s, d, "fact_sales")


def _dim_c(s, d):
    return _gold(s, d, "dim_customer_info")


def _dim_p(s, d):
    return _gold(s, d, "dim_product_info")


def _bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_customer(source(spark, sf_dir, "customer"))


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw customer copy as CSV in bronze, then read it back untyped."""
    path = layers_for(spark, sf_dir).path("bronze", "crm_cust_info_csv")
    bronze_io.land(_bronze_rows(spark, sf_dir), path, "csv")
    return bronze_io.ingest(spark, path, "csv", bronze_io.STRING(BRONZE_CUSTOMER_COLUMNS))


def bronze_ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows landed and read as JSON lines."""
    path = layers_for(spark, sf_dir).path("bronze", "crm_cust_info_json")
    bronze_io.land(_bronze_rows(spark, sf_dir), path, "json")
    return bronze_io.ingest(spark, path, "json", bronze_io.STRING(BRONZE_CUSTOMER_COLUMNS))


def bronze_ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as log lines, landed and read as text."""
    path = layers_for(spark, sf_dir).path("bronze", "events_log")
    line = F.concat_ws(" ", F.lit("event"), F.col("event_id").cast("string"), F.lit("user"), F.col("user_id").cast("string"))
    bronze_io.land(source(spark, sf_dir, "events").select(line.alias("value")), path, "text")
    return bronze_io.ingest(spark, path, "text")


def silver_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze → typed → critical NULLs dropped → placeholders → latest row per id → silver."""
    clean = ops.cleanse_customers(_bronze_rows(spark, sf_dir))
    return layers_for(spark, sf_dir).write(clean, "silver", "customer_raw_copy")


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw customer copy landed in three batches, late and repeated ids among them, merged into silver by a stream."""
    inbox, rows = scratch_path(spark, "inbox"), _bronze_rows(spark, sf_dir)
    types = ops.enforce_types(rows, ops.cleansing.CUSTOMER_TYPES, error_col=None).schema
    spec = ops.cleansing.RAW_CUSTOMER
    silver = ops.KeyedTable(spark, scratch_path(spark, "silver_customer"), types, spec.keys, spec.order)
    batch = F.pmod(F.crc32(F.concat("cst_key", "cst_create_date").cast("binary")), F.lit(3))
    for number in range(3):
        bronze_io.land(rows.where(batch == number), f"{inbox}/landed={number}", "json")
        upsert_stream(spark, f"{inbox}/*", "json", bronze_io.STRING(BRONZE_CUSTOMER_COLUMNS), spec, silver).awaitTermination()
    return silver.read()


def _accounted(spark: SparkSession, sf_dir: str) -> ops.Accounted:
    """The raw customer copy as JSON lines, some cut short, cleansed with an account of every line; a date is required."""
    rows = _bronze_rows(spark, sf_dir)
    line = F.to_json(F.struct(*BRONZE_CUSTOMER_COLUMNS))
    cut = F.substring_index("cst_key", "#", -1).cast("long") % 41 == 0
    inbox = scratch_path(spark, "inbox")
    bronze_io.land(rows.select(F.when(cut, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line).alias("value")), inbox, "text")
    landed = bronze_io.ingest(spark, inbox, "json", bronze_io.STRING(BRONZE_CUSTOMER_COLUMNS))
    spec = replace(ops.cleansing.RAW_CUSTOMER, critical=["cst_id", "cst_create_date"])
    done = ops.cleanse_accounted(landed, spec)
    done.check()
    return done


def customer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that did not become silver, as they landed, and why."""
    key = F.coalesce("cst_key", F.regexp_extract("_corrupt_record", '"cst_key":"([^"]*)"', 1))
    return _accounted(spark, sf_dir).rejects.select(
        "reason", key.alias("cst_key"), F.when(F.col("_corrupt_record").isNull(), F.col("cst_create_date")).alias("cst_create_date"),
        F.col("_corrupt_record").isNotNull().alias("whole_line_kept"))


def customer_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed, silver and rejected rows by reason, as counted by the write."""
    rows = ops.reconciliation({"crm_cust_info": _accounted(spark, sf_dir)})
    return spark.createDataFrame(rows, "table_name string, outcome string, row_count long")


def order_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total, three-order mean and previous amount over all orders by date, with no single-task window."""
    orders = source(spark, sf_dir, "orders").select(
        "o_orderdate", "o_orderkey", F.floor("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return ops.running_windows(orders, ["o_orderdate", "o_orderkey"], totals={"running_total": "amount"},
                               means={"mean_3_orders": ("amount", 3)}, lags={"previous_amount": ("amount", 1)})


#: Dates of the two builds of ``lasting_keys``.
SNAPSHOTS = ("1994-06-30", AS_OF)


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the fact by merged sketches of its files, held against exact counts and ranks."""
    fact = monthly_fact_for(spark, sf_dir).drop("order_month")
    store = ops.ProfileStore(spark, scratch_path(spark, "profile"))
    store.update(fact)
    ours = store.profile(fact).where("p50 IS NOT NULL OR data_type = 'string'")
    exact = ops.profile_columns(fact).select("column_name", "distinct_count")
    numbers = [f.name for f in fact.schema.fields if f.dataType.typeName() not in ("string", "date")]
    medians = {r["column_name"]: r["p50"] for r in ours.where(F.col("column_name").isin(numbers)).collect()}  # one row per column
    under = fact.agg(*[(F.count_if(F.col(c).cast("double") < m) / F.count(c)).alias(c + "_l") for c, m in medians.items()],
                     *[(F.count_if(F.col(c).cast("double") <= m) / F.count(c)).alias(c + "_h") for c, m in medians.items()]).first()
    close = F.lit(None).cast("boolean")
    for c in numbers:
        close = F.when(F.col("column_name") == c, F.lit(bool(under[c + "_l"] <= 0.53 and under[c + "_h"] >= 0.47))).otherwise(close)
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return ours.join(exact, "column_name").select("column_name", "data_type", "row_count", "null_count",
                                                  near.alias("distinct_within_5_percent"), close.alias("median_within_3_percent"))


def lasting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of both dimensions in the second of two builds: as of a day in 1994, and after customers and products
    came and products ended."""
    silver = silver_for(spark, sf_dir)
    layers = Layers(spark, scratch_path(spark, "lasting"))
    dictionaries = ops.gold.layers_dictionaries(layers)
    for day in SNAPSHOTS:
        began = silver["crm_prd_info"].where(F.col("prd_start_dt") <= F.lit(day).cast("date"))
        still = began.withColumn("prd_end_dt", F.when(F.col("prd_end_dt") <= F.lit(day).cast("date"), F.col("prd_end_dt")))
        known = silver["crm_cust_info"].where(F.col("cust_create_date") <= F.lit(day).cast("date"))
        gold = ops.build_gold({**silver, "crm_cust_info": known, "crm_prd_info": still}, layers, dictionaries=dictionaries)

    def keys(name: str, natural: str, key: str) -> DataFrame:
        rows = gold[name].select(F.col(natural).alias("_n"), key)
        since = dictionaries[name].read().select(F.col(key).alias("_key"), "since")
        return rows.join(since, rows[key] == since["_key"]).select(
            F.lit(name).alias("dimension"), F.col("_n").cast("string").alias("natural_key"), F.col(key).alias("surrogate_key"), "since")

    return keys("dim_customer_info", "customer_id", "customer_key").unionByName(keys("dim_product_info", "product_number", "product_key"))


def customer_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales of the customer with the largest revenue, from the fact stored by month."""
    best = partials_for(spark, sf_dir).summary("customer").where("customer_key IS NOT NULL")
    key = best.orderBy(F.col("sales").desc(), "customer_key").first()["customer_key"]
    fact = monthly_fact_for(spark, sf_dir)
    return ops.sales_of(fact, "customer_key", key).drop("order_month")


def best_months_sales(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """All sales of the ``n`` months with the largest sales; other months' folders are not read."""
    months = partials_for(spark, sf_dir).summary("month").orderBy(F.col("sales").desc(), "order_month").limit(n)
    return ops.sales_in_months(monthly_fact_for(spark, sf_dir), months).drop("order_month")


def gold_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build gold from silver, check and publish it; the manifest of what was published, in build order."""
    layers = Layers(spark, scratch_path(spark, "publish"))
    ops.build_gold(silver_for(spark, sf_dir), layers, verify=True)
    build = layers.current_build()
    gold = {name: layers.gold(name, build) for name in ops.GOLD_ORDER}
    parts = [ops.profile_tables({name: gold[name]})
             .select("table_name", F.lit(i + 1).alias("build_order"), "row_count")
             for i, name in enumerate(ops.GOLD_ORDER)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gold_sql_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by its name in the catalog, as a SQL user asks for it."""
    gold_for(spark, sf_dir)
    register_catalog(spark, layers_for(spark, sf_dir), as_of=AS_OF)
    return spark.sql("SELECT * FROM gold_live.view_customer_analytics ORDER BY total_sales_amount DESC, customer_key LIMIT 100")


def gold_sql_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product report by its name in the catalog."""
    gold_for(spark, sf_dir)
    register_catalog(spark, layers_for(spark, sf_dir), as_of=AS_OF)
    return spark.sql("SELECT * FROM gold_live.view_product_analytics")


def customer_360_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages and recency counted to the day of the run."""
    return catalog.run("customer_360", gold_for(spark, sf_dir), None)


def customer_360_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages in completed years by elapsed days."""
    return reports.customer_360(_fact(spark, sf_dir), _dim_c(spark, sf_dir), AS_OF, age="days")


def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of the fact by surrogate key, and of the sales by natural key."""
    gold = gold_for(spark, sf_dir)
    by_key = ops.natural_key_report(gold["fact_sales"], {
        "product_key": ("dim_product_info", gold["dim_product_info"], "product_key"),
        "customer_key": ("dim_customer_info", gold["dim_customer_info"], "customer_key")})
    return by_key.unionByName(ops.sales_key_report(silver_for(spark, sf_dir)["crm_sales_details"], gold))


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_for(spark, sf_dir)
    gold = gold_for(spark, sf_dir)
    s = ops.profile_tables(silver).withColumn("table_schema", F.lit("silver"))
    g = ops.profile_tables(gold).withColumn("table_schema", F.lit("gold"))
    return s.unionByName(g).select("table_schema", "table_name", "row_count", "column_count")


def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    keyed = ops.surrogate_key(orders, ["o_orderdate"], "order_key", tiebreak=["o_orderkey"])
    return keyed.select("o_orderkey", "order_key")


def resolve_gender_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_for(spark, sf_dir)
    joined = ops.left_join_dim(silver["crm_cust_info"], silver["erp_cust_az12"].select("cid", "gen"),
                               "cust_key", "cid")
    return joined.select("cust_id", "cust_gender", "gen",
                         ops.resolve_gender("cust_gender", "gen").alias("customer_gender"))


def _analytic(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.run(name, gold_for(spark, sf_dir), AS_OF)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # bronze / silver
    q["bronze_ingest"] = bronze_ingest
    q["bronze_ingest_json"] = bronze_ingest_json
    q["bronze_ingest_log"] = bronze_ingest_log
    for name in ops.cleansing.SILVER_SPECS:
        q[f"silver_{name}"] = partial(_silver, name)
    q["enforce_types"] = lambda s, d: ops.enforce_types(_bronze_rows(s, d), ops.cleansing.CUSTOMER_TYPES)
    q["drop_critical_nulls"] = lambda s, d: ops.drop_critical(
        ops.enforce_types(_bronze_rows(s, d), ops.cleansing.CUSTOMER_TYPES), ["cst_id"])
    q["fill_placeholders"] = lambda s, d: ops.fill_unknown(_bronze_rows(s, d),
                                                           ops.cleansing.CUSTOMER_TEXT)
    q["latest_per_key"] = lambda s, d: ops.latest_per_key(
        source(s, d, "events"), ["user_id"], ["ts", "event_id"])
    q["rename_business"] = lambda s, d: ops.rename(silver_for(s, d)["crm_cust_info"], CUSTOMER_RENAMES)
    q["silver_write"] = silver_write
    q["silver_upsert"] = silver_upsert
    q["customer_rejects"] = customer_rejects
    q["customer_reconciliation"] = customer_reconciliation
    # gold
    q["dim_customer_info"] = _dim_c
    q["dim_product_info"] = _dim_p
    q["fact_sales"] = _fact
    q["fact_sales_salted"] = lambda s, d: ops.fact_sales(silver_for(s, d)["crm_sales_details"], _dim_p(s, d), _dim_c(s, d),
                                                         limit_bytes=0)
    q["gold_publish"] = gold_publish
    q["gold_sql_top100"] = gold_sql_top100
    q["gold_sql_products"] = gold_sql_products
    q["customer_360_today"] = customer_360_today
    q["customer_360_days"] = customer_360_days
    q["fact_by_month"] = lambda s, d: monthly_fact_for(s, d).drop("order_month")
    q["surrogate_key"] = surrogate_key_query
    q["lasting_keys"] = lasting_keys
    q["resolve_gender"] = resolve_gender_query
    q["active_only"] = lambda s, d: ops.active_only(silver_for(s, d)["crm_prd_info"])
    q["integrity_report"] = integrity
    q["table_profile"] = table_profile
    q["column_profile"] = lambda s, d: ops.profile_columns(_dim_c(s, d))
    # the analytic queries, over the gold tables built from the test tables
    for name in catalog.ANALYTICS:
        q[name] = partial(_analytic, name)
    # the same reports from partial aggregates of several builds, and queries that skip most of the fact
    q["customer_360_merged"] = lambda s, d: merged.customer_360(partials_for(s, d), _dim_c(s, d), AS_OF)
    q["product_360_merged"] = lambda s, d: merged.product_360(partials_for(s, d), _dim_p(s, d), AS_OF)
    q["monthly_trend_merged"] = lambda s, d: merged.monthly_trend(partials_for(s, d))
    q["customer_statement"] = customer_statement
    q["best_months_sales"] = best_months_sales
    q["order_running"] = order_running
    q["profile_merged"] = profile_merged
    return q
