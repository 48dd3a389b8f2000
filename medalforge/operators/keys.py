"""Surrogate keys: ``ROW_NUMBER() OVER (ORDER BY …)`` without a single-task sort.

A window with no PARTITION BY sends every row to one task. The distributed form
gives the same numbers:

1. range-partition on the order columns (plus a unique tiebreak, so partition
   bounds can split inside a run of equal values) and sort within partitions;
2. tag each row with its partition id and its position inside the partition,
   and checkpoint to the shared folder (persisted first, so the sort is not
   computed twice), so the sampled range bounds are fixed once and both later
   passes see the same rows in the same partitions;
3. count rows per partition (one row per partition), turn the counts into
   running offsets, broadcast that table (its size is the partition count) and
   add offset + position + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_PID, _RID, _N, _OFF = "_sk_pid", "_sk_rid", "_sk_n", "_sk_off"


def _cols(cols: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def surrogate_key(df: DataFrame, order: Sequence, name: str, mode: str = "distributed",
                  partitions: int | None = None, tiebreak: Sequence = ()) -> DataFrame:
    """Append ``name`` = 1..n in the order of ``order`` (ascending, NULLs first).

    ``mode="window"`` is the plain single-partition window, for small inputs;
    ``mode="distributed"`` never gathers unsorted rows in one task.
    """
    order_cols = _cols(list(order) + list(tiebreak))
    if mode == "window":
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order_cols)).cast("long"))
    if mode != "distributed":
        raise ValueError(f"unknown surrogate key mode {mode!r}")
    spark = df.sparkSession
    shared_dir(spark)  # the checkpoint below needs the folder, whatever ran before
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_RID, F.monotonically_increasing_id()))
    # Persist first: an eager reliable checkpoint otherwise computes the sorted
    # partitions twice (once to count, once to write the checkpoint files).
    staged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        checkpointed = staged.checkpoint(eager=True)
    finally:
        staged.unpersist()
    staged = checkpointed
    counts = staged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    offsets = counts.select(
        _PID, (F.sum(_N).over(Window.orderBy(_PID)) - F.col(_N)).alias(_OFF))
    position = F.col(_RID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (staged.join(F.broadcast(offsets), _PID)
            .withColumn(name, (F.col(_OFF) + position + 1).cast("long"))
            .drop(_PID, _RID, _OFF))
