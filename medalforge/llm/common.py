"""Helpers that several operators of this subpackage share.

Words follow one rule everywhere unless an operator says otherwise: maximal
runs of characters other than space and \\x09-\\x0D, with only A-Z lowered.
Arrow's ASCII kernels implement that rule over a whole batch at once.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir

#: Text bytes that one vectorised step holds at a time; longer batches are cut between rows.
STEP_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage, survives lost executors.

    The files stay until the folder goes, so they are packed tightly (zstd takes about a quarter less for texts than the default).
    ``batch_rows``: rows per Arrow batch while this table is written, where rows are wide.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    before = spark.conf.get(_BATCH)
    if batch_rows:
        spark.conf.set(_BATCH, str(batch_rows))
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files that nothing refers to any more: it does so when the driver collects garbage,
    which a driver with little to do hardly does by itself."""
    jvm = getattr(spark, "_jvm", None)
    gc.collect()
    if jvm is not None:
        jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def strings(values) -> pa.Array:
    """One plain string array of its own memory (some kernels misread slices), nulls as empty strings."""
    array = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if array.offset:
        array = array.take(pa.array(np.arange(len(array))))
    return pc.fill_null(array.cast(pa.large_string()), "")


def steps(batches: Iterator[pa.RecordBatch], text: str = "text",
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that each piece holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
            pa.default_memory_pool().release_unused()


def words_of(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of all rows in order, and the row that each belongs to."""
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    rows = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not filled.all():
        flat, rows = flat.filter(pa.array(filled)), rows[filled]
    return flat, rows


def encoded(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Index of each word in the array of distinct words."""
    code = flat.dictionary_encode()
    return code.indices.to_numpy(zero_copy_only=False).astype(np.int64), code.dictionary
