"""Fact measures rolled up to dimension attributes, with the join placed by measured size.

``rollup`` answers "totals per category / country / product name" (optionally
also per a fact-side expression such as the order year). Two exact plans:

* **join first** when the dimension projection is provably broadcastable: the
  fact meets the broadcast dimension map-side and is partially aggregated by
  the attribute, so the only shuffle carries one row per attribute value per
  task;
* **aggregate first** otherwise: the fact is partially aggregated by the
  dimension key, the (at most dimension-sized) result joins the dimension,
  and a second aggregate merges per attribute. This never shuffles fact rows
  for the join.

Both give the same rows and the same types. The size check is one aggregate
over the dimension projection, remembered per plan and input files, so
repeated queries over the same gold table pay for it once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import fits_broadcast

# measure kinds: aggregate on fact rows, merge of partial results
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _result_type(kind: str, dtype: T.DataType) -> T.DataType | None:
    """Type both plans are cast to: decimal sums widened to precision 38."""
    if kind == "sum" and isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, dtype.scale)
    return None


def rollup(fact: DataFrame, dim: DataFrame, key: str, by: list[str],
           measures: Mapping[str, tuple[str, str]], fact_groups: Mapping[str, Column] | None = None,
           dim_measures: Mapping[str, str] | None = None,
           limit_bytes: int | None = None) -> DataFrame:
    """Totals per ``by`` (dimension columns) and ``fact_groups`` (named fact expressions).

    ``measures`` maps an output name to (kind, fact column), kind one of
    sum / count / min / max. ``dim_measures`` maps an output name to a
    dimension column summed once per fact row (NULL when every value is NULL).
    A fact row whose key has no dimension row falls in the group whose
    dimension columns are NULL, as with a left join.
    """
    fact_groups = dict(fact_groups or {})
    dim_measures = dict(dim_measures or {})
    extra = [c for c in dict.fromkeys(dim_measures.values()) if c not in by]
    d = dim.select(F.col(key).alias("_rk"), *by, *extra)
    groups = [*by, *fact_groups]
    facts = fact.withColumns(fact_groups) if fact_groups else fact
    out_types = {}
    for name, (kind, col) in measures.items():
        out_types[name] = _result_type(kind, fact.schema[col].dataType)
    for name, col in dim_measures.items():
        out_types[name] = _result_type("sum", dim.schema[col].dataType)

    if fits_broadcast(d, limit_bytes):
        joined = facts.join(F.broadcast(d), facts[key] == d["_rk"], "left")
        aggs = [_FIRST[kind](col).alias(name) for name, (kind, col) in measures.items()]
        aggs += [F.sum(col).alias(name) for name, col in dim_measures.items()]
        out = joined.groupBy(*groups).agg(*aggs)
    else:
        per_key = [_FIRST[kind](col).alias(f"_p_{name}") for name, (kind, col) in measures.items()]
        if dim_measures:
            per_key.append(F.count(F.lit(1)).alias("_rows"))
        partial = facts.groupBy(key, *fact_groups).agg(*per_key)
        joined = partial.join(d.hint("merge"), partial[key] == d["_rk"], "left")
        aggs = [_MERGE[kind](f"_p_{name}").alias(name) for name, (kind, _) in measures.items()]
        aggs += [F.sum(F.col(col) * F.col("_rows")).alias(name) for name, col in dim_measures.items()]
        out = joined.groupBy(*groups).agg(*aggs)
    casts = {name: F.col(name).cast(t) for name, t in out_types.items() if t is not None}
    return out.withColumns(casts) if casts else out
