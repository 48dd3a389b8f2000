"""Running windows over all rows of a table, without putting them in one task.

``SUM(x) OVER (ORDER BY …)``, a mean over the last rows and ``LAG`` have no PARTITION BY, so a plain window sorts the whole
table in one task. Here the rows are sorted into ranges, written once, and each range computes its windows
by itself on its own rows and on

* the total of all earlier ranges (one row per range, added up on the driver, broadcast), for running totals;
* the last rows of the earlier ranges (as many as the widest look-back, per range), put in front of its own
  and left out of the result, for means and lags, whatever number of ranges those rows come from.

So nothing but two small tables crosses the ranges, and rows of one order value may lie in several.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

_PID, _RID, _CTX = "_rw_pid", "_rw_rid", "_rw_before"


def running_windows(df: DataFrame, order: Sequence[str], totals: Mapping[str, str] | None = None,
                    means: Mapping[str, tuple[str, int]] | None = None, lags: Mapping[str, tuple[str, int]] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """``df`` with running columns in the order of ``order`` (ascending, NULLs first; it should be total).

    ``totals``: name → column, ``SUM(column) OVER (ORDER BY order)`` up to the row; ``means``: name → (column, rows),
    the mean of the row and those before it; ``lags``: name → (column, rows back). Values are as
    the plain windows give them: sums of decimals are exact.
    """
    totals, means, lags = dict(totals or {}), dict(means or {}), dict(lags or {})
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in order]
    path = scratch_path(spark, "running")
    (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
       .withColumns({_PID: F.spark_partition_id(), _RID: F.monotonically_increasing_id()}).write.parquet(path))
    staged = spark.read.parquet(path)

    back = max([w - 1 for _, w in means.values()] + [k for _, k in lags.values()] + [0])
    looked = sorted({c for c, _ in [*means.values(), *lags.values()]})
    rows = staged.withColumn(_CTX, F.lit(False))
    if back:
        rows = rows.unionByName(_rows_before(staged, looked, back), allowMissingColumns=True)
    local = Window.partitionBy(_PID).orderBy(_RID)
    out: dict[str, Column] = {}
    for name, (c, w) in means.items():
        out[name] = F.avg(c).over(local.rowsBetween(-(w - 1), Window.currentRow))
    for name, (c, k) in lags.items():
        out[name] = F.lag(c, k).over(local)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, c in totals.items():  # rows from before are not part of the range's own total
        out[name] = F.sum(F.when(~F.col(_CTX), F.col(c))).over(upto)
    done = rows.withColumns(out).where(~F.col(_CTX))
    if totals:
        before = F.broadcast(_earlier_totals(staged, totals))  # one row per range
        done = done.join(before, _PID, "left")
        for name in totals:
            earlier, own = F.col(f"_rw_{name}"), F.col(name)
            kind = done.schema[name].dataType
            both = F.when(own.isNull(), earlier).when(earlier.isNull(), own).otherwise(own + earlier)
            done = done.withColumn(name, both.cast(kind))
    return done.select(*df.columns, *totals, *means, *lags)


def _earlier_totals(staged: DataFrame, totals: Mapping[str, str]) -> DataFrame:
    """Per range the totals of all ranges before it (NULL where those hold no value), added up on the driver."""
    own = staged.groupBy(_PID).agg(*[F.sum(c).alias(f"_rw_{name}") for name, c in totals.items()])
    so_far: list = [None] * len(totals)
    out = []
    for row in sorted(own.collect(), key=lambda r: r[_PID]):  # one row per range
        out.append((row[_PID], *so_far))
        so_far = [b if a is None else a if b is None else a + b for a, b in zip(so_far, tuple(row)[1:])]
    return staged.sparkSession.createDataFrame(out, _widest(own.schema))


def _widest(schema: T.StructType) -> T.StructType:
    """The schema with decimals as wide as they get, for sums of sums."""
    return T.StructType([T.StructField(f.name, T.DecimalType(38, f.dataType.scale) if isinstance(f.dataType, T.DecimalType) else f.dataType)
                         for f in schema.fields])


def _rows_before(staged: DataFrame, columns: Sequence[str], back: int) -> DataFrame:
    """For every range the ``back`` rows before its first: (range, place, columns), at most ``back`` per range."""
    spark = staged.sparkSession
    last = Window.partitionBy(_PID).orderBy(F.col(_RID).desc())
    kept = staged.select(_PID, _RID, *columns).withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= back)
    tails = sorted(kept.drop("_n").collect(), key=lambda r: r[_RID])  # at most ``back`` rows per range; ids rise with the range
    out, seen = [], []
    for pid in sorted({r[_PID] for r in tails}):
        out += [(pid, i - back, True, *[r[c] for c in columns]) for i, r in enumerate(seen[-back:])]
        seen = (seen + [r for r in tails if r[_PID] == pid])[-back:]
    fields = ", ".join([f"`{_PID}` int, `{_RID}` bigint, `{_CTX}` boolean",
                        *[f"`{c}` {staged.schema[c].dataType.simpleString()}" for c in columns]])
    return spark.createDataFrame(out, fields)
