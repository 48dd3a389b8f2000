"""Fact → dimension LEFT joins with a checked broadcast and salted hot keys.

* If the dimension's join projection is provably small (rows and string bytes
  measured by one aggregate over the dimension), it is broadcast: no shuffle of
  the fact at all. A projection with arrays, maps or structs has no simple byte
  bound and is never broadcast.
* Otherwise one shuffle join on (key, salt) is used. The *hot* keys, those
  holding at least ``hot_fraction`` of the rows, come from a bounded summary of the key
  columns of the base table and an exact count of its candidates, for all joins of a chain at once and before any of
  them; there are at most ``1 / hot_fraction`` per column, so they come back as
  bounded lists. Fact rows of hot keys and rows with a NULL key (which can never
  match, and would otherwise all land in one task) get a salt; all other rows get
  salt 0. Dimension rows of hot keys are repeated once per salt.
* The salt is a hash of a row number given when the base table is scanned, so
  identical rows get different salts, a retried task gives the same ones, and
  rows may hold columns of any type.

A hot key's rows are spread over all partitions by that hash (evenly up to
chance), every other key holds under ``hot_fraction`` of the rows, and the base
table is read three times: its key columns twice, and the joins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_limit

# UnsafeRow layout: 8-byte null bitmap word + 8 bytes per field, variable-length
# data rounded up to 8 bytes; plus hash-table overhead per entry.
_ROW_OVERHEAD = 8 + 16
_ROW = "_fact_row"
SALTS_PER_TASK = 8  # salts fall on tasks by hash; several per task even that out


def _measurable(df: DataFrame) -> bool:
    return not any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
                   for f in df.schema.fields)


def projection_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated in-memory bytes) of ``df`` (columns of simple types), from one aggregate pass."""
    if not _measurable(df):
        raise TypeError("a projection with arrays, maps or structs has no simple byte bound")
    var_cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [F.sum(F.octet_length(F.col(c)) + 7).alias(f"b{i}") for i, c in enumerate(var_cols)]
    row = df.agg(*exprs).first()
    rows = int(row["rows"])
    var_bytes = sum(int(row[f"b{i}"] or 0) for i in range(len(var_cols)))
    fixed = rows * (_ROW_OVERHEAD + 16 * len(df.columns))  # wide decimals take two words
    return rows, fixed + var_bytes


_SIZES: dict[tuple, int] = {}
#: Files below a folder of one build (``sources.catalog``) are written once and never change.
_IMMUTABLE = re.compile(r"/build=[0-9]+-[0-9a-f]{8}/")


def fits_broadcast(df: DataFrame, limit_bytes: int | None = None) -> bool:
    """Whether ``df`` (a dimension projection) is under the broadcast bound, measured.

    The size is remembered only for tables of a finished build, whose files never change.
    """
    limit = broadcast_limit(df.sparkSession) if limit_bytes is None else limit_bytes
    if limit < 0 or not _measurable(df):
        return False
    files = df.inputFiles()
    if not files or not all(_IMMUTABLE.search(f) for f in files):
        return projection_bytes(df)[1] <= limit
    key = (df.semanticHash(), files[0].rsplit("/", 1)[0], len(files))
    if key not in _SIZES:
        _SIZES[key] = projection_bytes(df)[1]
    return _SIZES[key] <= limit


def measured_join(left: DataFrame, dim: DataFrame, on, how: str = "left",
                  limit_bytes: int | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Join ``left`` to a dimension-sized ``dim``: broadcast only if measured under the bound.

    Otherwise the join is hinted as a sort-merge join, so the planner cannot
    broadcast ``dim`` on an estimate from compressed file sizes either.
    ``bound`` is measured instead of ``dim`` when it is a cheaper upper bound
    (the key column itself for its distinct values, say).
    """
    fits = fits_broadcast(dim if bound is None else bound, limit_bytes)
    side = F.broadcast(dim) if fits else dim.hint("merge")
    return left.join(side, on, how)


def left_join_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                  limit_bytes: int | None = None, hot_fraction: float = 1e-3) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key``; ``dim`` should be unique on its key.

    ``dim`` is the projection to join (key plus the columns to bring over).
    """
    return left_join_dims(fact, [(dim, fact_key, dim_key)], limit_bytes, hot_fraction)


def left_join_dims(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]],
                   limit_bytes: int | None = None, hot_fraction: float = 1e-3) -> DataFrame:
    """``fact`` LEFT JOINed to each (dim, fact_key, dim_key) in turn; every fact_key is a column of ``fact``."""
    fits = [fits_broadcast(dim, limit_bytes) for dim, _, _ in dims]
    out = fact
    if not all(fits):
        wide = [key for (_, key, _), small in zip(dims, fits) if not small]
        hot = hot_keys(fact, wide, hot_fraction)
        n = SALTS_PER_TASK * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = {_salt(key): _salted(key, hot[key], n) for key in wide}
        # all salts are taken from the row number here, so the shuffles carry them (mostly 0), not the number
        out = fact.withColumn(_ROW, F.monotonically_increasing_id()).withColumns(salts).drop(_ROW)
    for (dim, fact_key, dim_key), small in zip(dims, fits):
        if small:
            out = out.join(F.broadcast(dim), out[fact_key] == dim[dim_key], "left").drop(dim[dim_key])
        else:
            out = _salted_join(out, dim, fact_key, dim_key, hot[fact_key], n)
    return out.drop(*[_salt(key) for _, key, _ in dims])


def heavy_candidates(fact: DataFrame, keys: Sequence[str], fraction: float) -> tuple[dict[str, int], dict[str, list[str]]]:
    """Per key column the number of non-NULL values, and values (as strings) that include all of at least ``fraction``.

    One aggregate with a frequent-items summary per column (``approx_top_k``): summaries have a fixed number
    of counters, are filled per task and merged, so what moves is a summary per task, however many keys there are. With 8 /
    ``fraction`` counters a value's count is off by less than ``fraction`` / 4 of the rows, so no value of that share can
    be missing from it, nor from its first 2 / ``fraction`` values.
    """
    tracked, most = min(1_000_000, int(8 / fraction)), int(2 / fraction)
    if most > tracked // 4:
        raise ValueError("hot keys under a share of 8e-6 need more counters than a summary has")
    text = [F.col(k).cast("string") for k in keys]
    aggs = [F.count(c).alias(f"n{i}") for i, c in enumerate(text)]
    # NULLs are put under one of the values, if any: they are counted apart
    aggs += [F.call_function("approx_top_k", c, F.lit(most), F.lit(tracked)).alias(f"t{i}") for i, c in enumerate(text)]
    row = fact.agg(*aggs).first()
    return ({k: row[f"n{i}"] for i, k in enumerate(keys)},
            {k: [x["item"] for x in row[f"t{i}"] if x["item"] is not None] for i, k in enumerate(keys)})


def hot_keys(fact: DataFrame, keys: Sequence[str], fraction: float) -> dict[str, list[str]]:
    """Per key column, the values (as strings) that hold at least ``fraction`` of its non-NULL rows.

    Candidates come from bounded summaries (``heavy_candidates``); a second pass over the key columns counts the candidates alone,
    exactly. Neither pass shuffles the other keys.
    """
    totals, candidates = heavy_candidates(fact, keys, fraction)
    found: dict[str, list[str]] = {k: [] for k in keys}
    cells = [F.struct(F.lit(k).alias("c"), F.col(k).cast("string").alias("v")) for k in keys if candidates[k]]
    if not cells:
        return found
    wanted = F.lit(False)
    for k in keys:
        if candidates[k]:
            wanted = wanted | ((F.col("x.c") == k) & F.col("x.v").isin(candidates[k]))
    counts = fact.select(F.explode(F.array(*cells)).alias("x")).where(wanted).groupBy("x.c", "x.v").agg(F.count(F.lit(1)).alias("n"))
    for r in counts.collect():  # at most 2 / fraction values per column
        if r["n"] >= max(1, int(totals[r["c"]] * fraction)):
            found[r["c"]].append(r["v"])
    return found


def _salt(fact_key: str) -> str:
    return f"_salt_{fact_key}"


def _salted(fact_key: str, hot: list[str], n: int) -> Column:
    """A salt below ``n`` from the row number for NULLs and the values in ``hot``, else 0."""
    key = F.col(fact_key)
    return F.when(key.isNull() | key.cast("string").isin(hot), F.pmod(F.xxhash64(_ROW), F.lit(n))).otherwise(F.lit(0).cast("bigint"))


def _salted_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hot: list[str], n: int) -> DataFrame:
    """One shuffle join on (key, salt) of a fact with its salt of ``n``; ``hot``: key values that are spread."""
    every_salt = F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")
    dim_salted = dim.withColumn("_dsalt", F.explode(
        F.when(F.col(dim_key).cast("string").isin(hot), every_salt).otherwise(F.array(F.lit(0).cast("bigint")))))
    cond = (fact[fact_key] == dim_salted[dim_key]) & (fact[_salt(fact_key)] == dim_salted["_dsalt"])
    # measured too large to broadcast: keep it a shuffle join on (key, salt)
    return (fact.join(dim_salted.hint("merge"), cond, "left")
            .drop(dim_salted[dim_key]).drop("_dsalt"))
