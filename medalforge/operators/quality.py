"""Referential integrity and table / column profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import fits_broadcast
from .partials import bit_words


def integrity_report(fact: DataFrame, refs: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per reference ``fact_key → (dimension name, dimension, dim_key)``.

    Columns: dimension, fact_key, fact_rows, null_key_rows, unmatched_rows.
    The dimension's keys go to the fact if they are measured small enough to be broadcast, or, for integer keys,
    as an exact bitmap of 64 keys a word, which is for dense keys a small part of that: each fact row is checked
    where it lies and no fact key is shuffled. Beyond both, fact keys are counted first (one row per distinct key, partial
    aggregation map-side), and only those counts meet the dimension keys.
    """
    parts = []
    for fact_key, (dim_name, dim, dim_key) in refs.items():
        k, n = F.col("_k"), F.col("_n")
        counted = _checked_in_place(fact, fact_key, dim, dim_key)
        if counted is None:
            per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
            known = dim.select(F.col(dim_key).alias("_k")).distinct().withColumn("_m", F.lit(True))
            counted = per_key.join(known.hint("merge"), "_k", "left")
        parts.append(counted.agg(
            F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("fact_rows"),
            F.coalesce(F.sum(F.when(k.isNull(), n)), F.lit(0)).cast("long").alias("null_key_rows"),
            F.coalesce(F.sum(F.when(k.isNotNull() & F.col("_m").isNull(), n)), F.lit(0))
             .cast("long").alias("unmatched_rows"),
        ).select(F.lit(dim_name).alias("dimension"), F.lit(fact_key).alias("fact_key"),
                 "fact_rows", "null_key_rows", "unmatched_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _checked_in_place(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame | None:
    """Fact rows (_k, _n = 1, _m set if the key is known) checked where they lie, or None if nothing small enough says so."""
    rows = fact.select(F.col(fact_key).alias("_k"), F.lit(1).cast("long").alias("_n"))
    keys = dim.where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_k"))
    if fits_broadcast(keys.withColumn("_m", F.lit(True))):
        return rows.join(F.broadcast(keys.distinct().withColumn("_m", F.lit(True))), "_k", "left")
    if not (isinstance(keys.schema["_k"].dataType, (T.LongType, T.IntegerType)) and isinstance(rows.schema["_k"].dataType, (T.LongType, T.IntegerType))):
        return None
    word, mask = bit_words(F.col("_k").cast("long"))
    words = keys.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_mask"))
    if not fits_broadcast(words):
        return None
    held = rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
    return held.withColumn("_m", F.when(F.col("_mask").bitwiseAND(mask) != 0, F.lit(True)))


def natural_key_report(sales: DataFrame, refs: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """``integrity_report`` on natural keys, plus the dimension's repeated ones.

    A transaction without a dimension row (``unmatched_rows``) loses its place in
    every report per product or customer, and a natural key that a dimension
    holds twice (``repeated_keys``) multiplies revenue.
    """
    out = integrity_report(sales, refs)
    repeated = None
    for name, dim, key in refs.values():
        one = repeated_keys(dim, key).select(F.lit(name).alias("dimension"), "repeated_keys")
        repeated = one if repeated is None else repeated.unionByName(one)
    return out.join(repeated, "dimension").select(*out.columns, "repeated_keys")


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    """One row, ``repeated_keys``: how many non-NULL keys a dimension holds more than once."""
    return (dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.count_if(F.col("_n") > 1).alias("repeated_keys")))


class IntegrityError(AssertionError):
    """Fact rows reference keys that the dimension does not have."""


def assert_integrity(report: DataFrame, allow_null_keys: bool = True,
                     max_unmatched: float = 0.0) -> list[dict]:
    """Raise ``IntegrityError`` if any reference in a report is broken.

    The report has one row per dimension, so collecting it is bounded. NULL
    keys (facts whose natural key had no active dimension row) are allowed by
    default: the gold fact keeps them, as the reference's left joins do.
    ``max_unmatched``: share of the rows with a key that may be unmatched.
    """
    return assert_references([r.asDict() for r in report.collect()], allow_null_keys, max_unmatched)


def assert_references(rows: list[dict], allow_null_keys: bool = True, max_unmatched: float = 0.0) -> list[dict]:
    """``assert_integrity`` on the rows of a report."""
    broken = [r for r in rows if r["unmatched_rows"] > max_unmatched * (r["fact_rows"] - r["null_key_rows"])
              or r.get("repeated_keys") or (not allow_null_keys and r["null_key_rows"])]
    if broken:
        raise IntegrityError(f"broken references: {broken}")
    return rows


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count, column_count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count",
                       F.lit(len(df.columns)).alias("column_count"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_columns(df: DataFrame, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """One row per column: column_name, ordinal_position, data_type, null_count, distinct_count.

    Exact counts run one aggregate per column (its NULL count and its distinct
    count, a single-distinct aggregate), so every column is read once and no
    row is expanded; several distinct counts in one aggregate would make Spark
    copy each row once per column. ``exact=False`` counts all columns in one
    pass with HyperLogLog++ (``approx_count_distinct``).
    """
    names = ("column_name", "ordinal_position", "data_type", "null_count", "distinct_count")

    def row(i: int, c: str, nulls: str, distinct: str) -> list:
        return [F.lit(c), F.lit(i + 1), F.lit(df.schema[c].dataType.simpleString()),
                F.col(nulls), F.col(distinct).cast("long")]

    if not exact:
        aggs = []
        for i, c in enumerate(df.columns):
            col = F.col(f"`{c}`")
            aggs += [F.count(F.when(col.isNull(), 1)).alias(f"n{i}"),
                     F.approx_count_distinct(col, rsd).alias(f"d{i}")]
        entries = [e for i, c in enumerate(df.columns) for e in row(i, c, f"n{i}", f"d{i}")]
        return df.agg(*aggs).select(F.stack(F.lit(len(df.columns)), *entries).alias(*names))
    parts = []
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        one = df.agg(F.count(F.when(col.isNull(), 1)).alias("n"), F.count_distinct(col).alias("d"))
        parts.append(one.select(*[e.alias(n) for e, n in zip(row(i, c, "n", "d"), names)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
