"""Bronze → silver cleansing: typing, dropping, placeholder filling, dedup, renaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERRORS = "_type_errors"


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def enforce_types(df: DataFrame, spec: Mapping[str, str], date_format: str = "yyyy-MM-dd",
                  error_col: str | None = ERRORS) -> DataFrame:
    """Cast string columns to the types in ``spec`` ("date" uses ``date_format``).

    Padding is trimmed first. A value that does not parse becomes NULL instead of
    failing the job; the number of such values per row (blank inputs excluded)
    goes to ``error_col``, as does a number that its decimal type had to round.
    """
    if not spec:
        return df.withColumn(error_col, F.lit(0)) if error_col else df
    typed, errors = {}, []
    for name, dtype in spec.items():
        raw = F.col(name)
        value = (F.try_to_date(F.trim(raw), date_format) if dtype == "date"
                 else F.trim(raw).try_cast(dtype))
        typed[name] = value
        bad = value.isNull()
        if dtype.startswith("decimal"):
            bad = bad | (F.trim(raw).try_cast("decimal(38,18)") != value)
        errors.append(F.when(~_blank(raw) & F.coalesce(bad, F.lit(True)), 1).otherwise(0))
    out = df
    if error_col:  # counted on the raw strings, before they are replaced
        total = errors[0]
        for e in errors[1:]:
            total = total + e
        out = out.withColumn(error_col, total.cast("int"))
    return out.withColumns(typed)


def drop_critical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows in which any critical column is NULL."""
    return df.na.drop(how="any", subset=list(cols))


def fill_unknown(df: DataFrame, cols: Sequence[str], placeholder: str = "Unknown") -> DataFrame:
    """Trim text; blank or missing values become ``placeholder``."""
    return df.withColumns({c: F.when(_blank(F.col(c)), F.lit(placeholder)).otherwise(F.trim(F.col(c)))
                           for c in cols})


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the most recent row per key: ``ROW_NUMBER() … ORDER BY order DESC = 1``.

    ``order`` lists columns from most to least significant; all are taken
    descending with NULLs last, the last one should make the order unique.
    The filter on ``row_number() = 1`` lets Spark insert a partial per-key
    limit before the shuffle, so a key holding many rows is cut down to one
    row per input partition map-side rather than sorted in one task.
    """
    desc = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    w = Window.partitionBy(*keys).orderBy(*desc)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Technical → business column names; unknown source names are an error."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.withColumnsRenamed(dict(mapping))


# Silver step for the raw customer copy: the operators above in order.
CUSTOMER_TYPES = {"cst_id": "bigint", "cst_create_date": "date", "cst_acctbal": "decimal(12,2)"}
CUSTOMER_TEXT = ("cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")
CUSTOMER_ORDER = ("cst_create_date", "cst_marital_status")


def cleanse_customers(bronze: DataFrame) -> DataFrame:
    typed = enforce_types(bronze, CUSTOMER_TYPES)
    kept = drop_critical(typed, ["cst_id"])
    filled = fill_unknown(kept, CUSTOMER_TEXT)
    return latest_per_key(filled, ["cst_id"], CUSTOMER_ORDER)


@dataclass(frozen=True)
class Cleansing:
    """What a raw table of strings needs to become a silver table.

    ``types`` of the columns that are not text; ``critical`` columns, without which a row
    is dropped; ``text`` columns whose blanks become the placeholder (blanks of
    other text become NULL); ``keys`` and ``order`` for the latest row per key, if any.
    """

    types: Mapping[str, str] = field(default_factory=dict)
    critical: Sequence[str] = ()
    text: Sequence[str] = ()
    keys: Sequence[str] = ()
    order: Sequence[str] = ()


def cleanse(bronze: DataFrame, spec: Cleansing) -> DataFrame:
    """Typing, trimming, dropping, placeholder filling and the latest row per key, in this order."""
    out = enforce_types(bronze, spec.types, error_col=None)
    plain = [f.name for f in bronze.schema.fields if f.name not in spec.types and f.name not in spec.text]
    out = out.withColumns({c: F.when(~_blank(F.col(c)), F.trim(F.col(c))) for c in plain})
    out = fill_unknown(drop_critical(out, spec.critical), spec.text)
    return latest_per_key(out, spec.keys, spec.order) if spec.keys else out


# The raw customer copy, as ``cleanse_customers`` treats it.
RAW_CUSTOMER = Cleansing(CUSTOMER_TYPES, ["cst_id"], CUSTOMER_TEXT, ["cst_id"], CUSTOMER_ORDER)

# The six tables that the gold layer reads.
SILVER_SPECS = {
    "crm_cust_info": Cleansing({"cust_id": "bigint", "cust_create_date": "date"}, ["cust_id"],
                               ["cust_gender", "cust_marital_status"], ["cust_id"], ["cust_create_date", "cust_key"]),
    "erp_cust_az12": Cleansing({"bdate": "date"}, ["cid"], (), ["cid"], ["bdate", "gen"]),
    "erp_loc_a101": Cleansing({}, ["cid"], (), ["cid"], ["cntry"]),
    "crm_prd_info": Cleansing({"prd_id": "bigint", "prd_cost": "decimal(18,2)", "prd_start_dt": "date", "prd_end_dt": "date"},
                              ["prd_id", "prd_key"], (), ["prd_id"], ["prd_start_dt", "prd_key"]),
    "erp_px_cat_g1v1": Cleansing({}, ["id"], (), ["id"], ["cat", "subcat"]),
    "crm_sales_details": Cleansing({"sls_cust_id": "bigint", "sls_order_dt": "date", "sls_ship_dt": "date", "sls_due_dt": "date",
                                    "sls_sales": "decimal(18,2)", "sls_quantity": "int", "sls_price": "decimal(18,2)"},
                                   ["sls_ord_num", "sls_prd_key"]),
}
