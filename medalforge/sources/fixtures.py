"""Test tables → the six silver tables the gold layer reads.

The reference ships no data. These mappings derive silver-shaped rows from the
TPC-H-like test tables by plain modulo formulas (documented in FIXTURES.md), so
that NULLs, unmatched keys, ended products and missing dates all occur. They
are fixtures, not business logic: the library functions know nothing of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SILVER_SOURCES = ("customer", "nation", "part", "orders", "lineitem")


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def crm_cust_info(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("cust_id"),
        F.col("c_name").alias("cust_key"),
        F.substring_index("c_name", "#", 1).alias("cust_first_name"),
        F.when(k % 50 != 0, F.substring_index("c_name", "#", -1)).alias("cust_last_name"),
        F.when(k % 3 == 0, "Male").when(k % 3 == 1, "Female").otherwise("Unknown")
         .alias("cust_gender"),
        F.when(F.col("c_acctbal") < 0, "Single").otherwise("Married").alias("cust_marital_status"),
        _days_after("1994-01-01", k % 365).alias("cust_create_date"),
    )


def erp_cust_az12(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.where(k % 11 != 0).select(
        F.col("c_name").alias("cid"),
        _days_after("1920-01-01", (k * 7919) % 28000).alias("bdate"),
        F.when(k % 4 == 1, "Male").when(k % 4 > 1, "Female").alias("gen"),
    )


def erp_loc_a101(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return (customer.where(F.col("c_custkey") % 13 != 0)
            .join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
            .select(F.col("c_name").alias("cid"), F.col("n_name").alias("cntry")))


def crm_prd_info(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("prd_id"),
        F.concat(F.lit("PRD-"), k.cast("string")).alias("prd_key"),
        F.col("p_type").alias("cat_id"),
        F.col("p_name").alias("prd_nm"),
        (F.col("p_size") * 30).cast("decimal(18,2)").alias("prd_cost"),
        F.col("p_brand").alias("prd_line"),
        _days_after("1994-01-01", k % 300).alias("prd_start_dt"),
        F.when(k % 10 == 0, F.lit("2000-01-01").cast("date")).alias("prd_end_dt"),
    )


def erp_px_cat_g1v1(part: DataFrame) -> DataFrame:
    t = F.col("p_type")
    return (part.select(t).where(t != "PROMO").distinct().select(
        t.alias("id"),
        F.when(t.isin("ECONOMY", "SMALL"), "Basic").otherwise("Core").alias("cat"),
        F.lower(t).alias("subcat"),
        F.when(t == "LARGE", "Yes").otherwise("No").alias("maintenance"),
    ))


def crm_sales_details(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    a = F.when(F.col("l_partkey") % 5 == 1, 8).otherwise(1)
    b = F.when(F.col("o_custkey") % 5 == 0, 8).otherwise(1)
    unrounded = F.col("l_extendedprice") / (F.lit(40) * a * b)
    qty = F.col("l_quantity")
    return j.select(
        F.concat(F.lit("SO"), F.col("l_orderkey").cast("string")).alias("sls_ord_num"),
        F.concat(F.lit("PRD-"), F.col("l_partkey").cast("string")).alias("sls_prd_key"),
        F.col("o_custkey").alias("sls_cust_id"),
        F.when(F.col("l_orderkey") % 97 != 0, F.to_date("o_orderdate")).alias("sls_order_dt"),
        F.to_date("l_shipdate").alias("sls_ship_dt"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("sls_due_dt"),
        F.floor(unrounded).cast("decimal(18,2)").alias("sls_sales"),
        qty.cast("int").alias("sls_quantity"),
        F.floor(unrounded / F.when(qty != 0, qty)).cast("decimal(18,2)").alias("sls_price"),
    )


def silver_tables(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver frames from loaded test tables (see ``load_tables``)."""
    return {
        "crm_cust_info": crm_cust_info(t["customer"]),
        "erp_cust_az12": erp_cust_az12(t["customer"]),
        "erp_loc_a101": erp_loc_a101(t["customer"], t["nation"]),
        "crm_prd_info": crm_prd_info(t["part"]),
        "erp_px_cat_g1v1": erp_px_cat_g1v1(t["part"]),
        "crm_sales_details": crm_sales_details(t["lineitem"], t["orders"]),
    }


# Raw (bronze) customer copy: every field a string, with blanks, padded names,
# unparseable dates and amounts, missing ids, and an older repeat of every
# fifth customer. Modulo formulas, so DuckDB can derive the same rows.
BRONZE_CUSTOMER_COLUMNS = ("cst_id", "cst_key", "cst_firstname", "cst_lastname",
                           "cst_marital_status", "cst_gndr", "cst_create_date", "cst_acctbal")


def bronze_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    first = F.substring_index("c_name", "#", 1)
    last = F.substring_index("c_name", "#", -1)
    created = F.date_format(_days_after("1994-01-01", k % 365), "yyyy-MM-dd")

    def row(create_date: Column, marital: Column) -> list[Column]:
        return [
            F.when(k % 29 == 0, "").otherwise(k.cast("string")).alias("cst_id"),
            F.col("c_name").alias("cst_key"),
            F.when(k % 17 == 0, "").when(k % 7 == 0, F.concat(F.lit("  "), first, F.lit(" ")))
             .otherwise(first).alias("cst_firstname"),
            F.when(k % 19 == 0, "   ").otherwise(last).alias("cst_lastname"),
            marital.alias("cst_marital_status"),
            F.when(k % 3 == 0, "Male").when(k % 3 == 1, "Female").otherwise("").alias("cst_gndr"),
            create_date.alias("cst_create_date"),
            F.when(k % 37 == 0, "n/a").otherwise(F.col("c_acctbal").cast("decimal(12,2)")
                                                 .cast("string")).alias("cst_acctbal"),
        ]

    current = customer.select(*row(
        F.when(k % 23 == 0, "not a date").when(k % 31 == 0, "2001-02-30").otherwise(created),
        F.when(k % 13 == 0, "").when(F.col("c_acctbal") < 0, "Single").otherwise("Married")))
    older = customer.where(k % 5 == 0).select(*row(
        F.date_format(_days_after("1993-01-01", k % 365), "yyyy-MM-dd"), F.lit("Single")))
    return current.unionByName(older)


def bronze_table(name: str, silver: DataFrame, critical: str) -> DataFrame:
    """The raw copy of a silver table: every field a string, values that will be typed padded with blanks,
    and about every tenth row once more without its ``critical`` value, to be dropped."""
    def raw(f) -> Column:
        text = F.col(f.name).cast("string")
        return (text if f.dataType.typeName() == "string" else F.concat(F.lit(" "), text, F.lit("  "))).alias(f.name)

    rows = silver.select(*[raw(f) for f in silver.schema.fields])
    tenth = F.pmod(F.crc32(F.col(critical).cast("binary")), F.lit(10)) == 0
    # repeated in place: a union of two scans would read, join and shuffle the source tables twice
    twice = rows.withColumn("_broken", F.explode(F.when(tenth, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    return twice.withColumn(critical, F.when(F.col("_broken"), F.lit("  ")).otherwise(F.col(critical))).drop("_broken")
