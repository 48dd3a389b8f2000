"""Gold builders: two dimensions and the fact table on their surrogate keys.

The reference defines these as views, so every query re-runs the row-number
windows and dimension joins. Here they are materialised once per build
(``build_gold``): dimensions first, then the fact that reads them, all below a
folder of the build's own; readers switch to it when all are complete and checked.
"""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.catalog import Layers
from .dictionary import KeyDictionary, lasting_dimension
from .joins import fits_broadcast, left_join_dim, left_join_dims
from .keys import surrogate_key
from .quality import assert_references, natural_key_report, repeated_keys

GOLD_ORDER = ("dim_customer_info", "dim_product_info", "fact_sales")

log = logging.getLogger("medalforge.gold")


class GoldBuildError(RuntimeError):
    """A gold table failed to build; ``table`` names it, the cause is chained."""

    def __init__(self, table: str, cause: BaseException):
        super().__init__(f"building gold table {table!r} failed: {cause}")
        self.table = table


def resolve_gender(master, other) -> Column:
    """Master value unless it is 'Unknown' (or NULL); then the other source, else 'Unknown'."""
    m = F.col(master) if isinstance(master, str) else master
    o = F.col(other) if isinstance(other, str) else other
    return F.when(m != "Unknown", m).otherwise(F.coalesce(o, F.lit("Unknown")))


def active_only(df: DataFrame, end_col: str = "prd_end_dt") -> DataFrame:
    """Current versions: rows whose end date is NULL."""
    return df.where(F.col(end_col).isNull())


def dim_customer_info(cust: DataFrame, demo: DataFrame, loc: DataFrame,
                      key_mode: str = "distributed", dictionary: KeyDictionary | None = None) -> DataFrame:
    """CRM customers enriched with ERP demographics and location, keyed by ``cust_id`` order.

    With a ``dictionary`` (of ``customer_id``) customers keep the key of earlier builds. The enrichments are left joins through ``left_join_dim``: broadcast when
    their measured size allows, otherwise a shuffle join with hot keys salted.
    """
    joined = left_join_dims(cust, [
        (demo.select("cid", "bdate", "gen"), "cust_key", "cid"),
        (loc.select(F.col("cid").alias("_lcid"), "cntry"), "cust_key", "_lcid")])
    pre = joined.select(
        F.col("cust_id").alias("customer_id"),
        F.col("cust_key").alias("customer_number"),
        F.col("cust_first_name").alias("first_name"),
        F.col("cust_last_name").alias("last_name"),
        F.col("cntry").alias("customer_country"),
        resolve_gender(F.col("cust_gender"), F.col("gen")).alias("customer_gender"),
        F.col("cust_marital_status").alias("marital_status"),
        F.col("bdate").alias("customer_birthdate"),
        F.col("cust_create_date").alias("customer_create_date"),
    )
    if dictionary is not None:
        return lasting_dimension(pre, dictionary)
    keyed = surrogate_key(pre, ["customer_id"], "customer_key", mode=key_mode,
                          tiebreak=["customer_number"])
    return keyed.select("customer_key", *pre.columns)


def dim_product_info(prd: DataFrame, cat: DataFrame, key_mode: str = "distributed",
                     dictionary: KeyDictionary | None = None) -> DataFrame:
    """Active products with their category, keyed by (start date, product number) order.

    With a ``dictionary`` (of ``product_number``) products keep the key of earlier builds. The category lookup goes through ``left_join_dim``: a category shared by a
    large share of the products is broadcast or salted, never one task.
    """
    joined = left_join_dim(active_only(prd), cat.select("id", "cat", "subcat", "maintenance"),
                           "cat_id", "id")
    pre = joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category_name"),
        F.col("subcat").alias("subcategory_name"),
        F.col("maintenance").alias("category_maintenance"),
        F.col("prd_cost").alias("product_cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("product_start_date"),
    )
    if dictionary is not None:
        return lasting_dimension(pre, dictionary, ["product_start_date"])
    keyed = surrogate_key(pre, ["product_start_date", "product_number"], "product_key",
                          mode=key_mode, tiebreak=["product_id"])
    return keyed.select("product_key", *pre.columns)


#: Per natural key of the sales: the dimension, its key, and the dimension's natural key.
REFERENCES = {"sls_prd_key": ("dim_product_info", "product_key", "product_number"),
              "sls_cust_id": ("dim_customer_info", "customer_key", "customer_id")}


def _fact_dims(dim_p: DataFrame, dim_c: DataFrame) -> list[tuple[DataFrame, str, str]]:
    return [(dim_p.select("product_number", "product_key"), "sls_prd_key", "product_number"),
            (dim_c.select("customer_id", "customer_key"), "sls_cust_id", "customer_id")]


def fact_sales(sales: DataFrame, dim_p: DataFrame, dim_c: DataFrame,
               limit_bytes: int | None = None, seen: Observation | None = None) -> DataFrame:
    """Sales on surrogate keys; unmatched natural keys give NULL surrogate keys.

    ``seen`` receives, when the fact is written, its rows and per natural key those without one and those without a
    dimension row: the joins have both at hand, so no later pass has to look keys up again.
    """
    f = left_join_dims(sales, _fact_dims(dim_p, dim_c), limit_bytes)
    if seen is not None:
        metrics = [F.count(F.lit(1)).alias("fact_rows")]
        for natural, (_, key, _) in REFERENCES.items():
            metrics += [F.count_if(F.col(natural).isNull()).alias(f"null_{natural}"),
                        F.count_if(F.col(natural).isNotNull() & F.col(key).isNull()).alias(f"unmatched_{natural}")]
        f = f.observe(seen, *metrics)
    return f.select(
        F.col("sls_ord_num").alias("sales_order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("ship_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("unit_price"),
    )


def sales_key_report(sales: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """Natural keys of the sales against those of the dimensions (``quality.natural_key_report``)."""
    return natural_key_report(sales, {
        "sls_prd_key": ("dim_product_info", gold["dim_product_info"], "product_number"),
        "sls_cust_id": ("dim_customer_info", gold["dim_customer_info"], "customer_id")})


def fact_layout(fact: DataFrame, partitions: int | None = None, mode: str = "rebalance") -> DataFrame:
    """File layout of the written fact: evenly spread, each file sorted by order date.

    ``mode="rebalance"`` (default) spreads the rows with a REBALANCE: a
    round-robin shuffle whose output AQE sizes from the measured data (large
    partitions split, small ones merged), so files track the data volume;
    ``partitions`` fixes the count instead. Neither needs a sampling pass over
    the input (a range partitioning would run the whole fact build once more to
    pick its bounds), and both stay balanced whatever the key skew.
    ``mode="sort"`` keeps the input partitioning and only sorts within it: no
    shuffle, for inputs that already arrive in many well-sized splits.
    Sorting within each file by order date clusters row groups by date, so the
    NULL dates that nearly every query excludes sit in row groups the pushed
    ``IsNotNull`` filter skips, and date-range filters prune on min/max
    statistics.
    """
    if mode not in ("rebalance", "sort"):
        raise ValueError(f"unknown fact layout {mode!r}")
    if mode == "rebalance":
        fact = fact.hint("rebalance") if partitions is None else fact.repartition(partitions)
    keys = [F.col("order_date").asc_nulls_first(), F.col("sales_order_number")]
    return fact.sortWithinPartitions(*keys)


def _observed(counts: dict, gold: dict[str, DataFrame]) -> list[dict]:
    """One row per reference, as ``natural_key_report`` has it, from the counts of the fact's write."""
    rows = []
    for natural, (name, _, own) in REFERENCES.items():
        rows.append({"dimension": name, "fact_key": natural, "fact_rows": counts["fact_rows"], "null_key_rows": counts[f"null_{natural}"],
                     "unmatched_rows": counts[f"unmatched_{natural}"], "repeated_keys": repeated_keys(gold[name], own).first()[0]})
    return rows


def layers_dictionaries(layers: Layers) -> dict[str, KeyDictionary]:
    """The dictionaries of both dimensions' keys, kept beside the gold builds."""
    return {"dim_customer_info": KeyDictionary(layers.spark, layers.path("gold", "keys/customer"), "customer_id", "bigint", "customer_key"),
            "dim_product_info": KeyDictionary(layers.spark, layers.path("gold", "keys/product"), "product_number", "string", "product_key")}


def build_gold(silver: dict[str, DataFrame], layers: Layers, key_mode: str = "distributed",
               timings: dict[str, float] | None = None, verify: bool = False,
               fact_layout_mode: str = "rebalance", max_unmatched: float = 0.5,
               dictionaries: dict[str, KeyDictionary] | None = None) -> dict[str, DataFrame]:
    """Build the gold tables in dependency order and publish them together; return them read back.

    The two dimensions do not depend on each other and are built as two
    concurrent Spark jobs; the fact, which reads both, follows. Seconds per
    table (and ``total``) are logged and, if ``timings`` is given, stored in it.
    ``fact_layout_mode`` is passed to ``fact_layout`` ("rebalance" or "sort"); a fact whose joins are salted shuffles
    comes out of them evenly spread, so it is only sorted.
    A failure raises ``GoldBuildError`` naming the table and leaves the published
    build as it was. With ``verify`` the build is checked before it is published:
    no natural key may occur twice in a dimension, and at most a share of ``max_unmatched`` of the
    sales with a natural key may find no dimension row, as counted while the fact is written;
    ``IntegrityError`` otherwise. (A surrogate key of the fact comes from its dimension.)
    ``dictionaries`` (dimension name → ``KeyDictionary``, see ``layers_dictionaries``) make
    surrogate keys last from build to build.
    """
    lasting = dictionaries or {}
    build = layers.new_build()
    timings = {} if timings is None else timings
    started = time.perf_counter()

    def timed(name: str, make) -> DataFrame:
        t0 = time.perf_counter()
        try:
            out = layers.write_build(make(), build, name)
        except Exception as exc:  # name the table, keep the original cause
            raise GoldBuildError(name, exc) from exc
        timings[name] = time.perf_counter() - t0
        log.info("gold table %s written in %.0f ms", name, 1000 * timings[name])
        return out

    with ThreadPoolExecutor(max_workers=2) as pool:
        dim_c = pool.submit(timed, "dim_customer_info", lambda: dim_customer_info(
            silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"], key_mode,
            lasting.get("dim_customer_info")))
        dim_p = pool.submit(timed, "dim_product_info", lambda: dim_product_info(
            silver["crm_prd_info"], silver["erp_px_cat_g1v1"], key_mode, lasting.get("dim_product_info")))
        out = {"dim_customer_info": dim_c.result(), "dim_product_info": dim_p.result()}
    seen = Observation()

    def fact() -> DataFrame:
        dim_p, dim_c = out["dim_product_info"], out["dim_customer_info"]
        rows = fact_sales(silver["crm_sales_details"], dim_p, dim_c, seen=seen if verify else None)
        # a salted shuffle join already leaves its rows spread evenly: a REBALANCE would move the whole fact once more
        spread = not all(fits_broadcast(dim) for dim, _, _ in _fact_dims(dim_p, dim_c))
        return fact_layout(rows, mode="sort" if spread else fact_layout_mode)

    out["fact_sales"] = timed("fact_sales", fact)
    if verify:
        assert_references(_observed(seen.get, out), max_unmatched=max_unmatched)
    layers.publish(build)
    timings["total"] = time.perf_counter() - started
    log.info("gold layer built in %.0f ms", 1000 * timings["total"])
    return out
