"""Silver as a stream: new raw files → typed, cleansed rows → merged by key.

Each micro-batch is cleansed by the table's spec and merged into a ``KeyedTable`` (``foreachBatch``). The file
source's checkpoint says which files a batch holds, and the table's log which batches it holds, under
an id of target and batch, so a batch that is run again after a failure is merged once.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleansing import Cleansing, cleanse
from ..operators.upsert import KeyedTable
from ..session import shared_dir
from ..sources.bronze import CORRUPT, configured
from .landing import MAX_FILE_AGE


def upsert_stream(spark: SparkSession, source_dir: str, fmt: str, schema: T.StructType, spec: Cleansing, target: KeyedTable,
                  checkpoint_dir: str | None = None, max_files_per_trigger: int | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Start the query and return it (``awaitTermination()`` to wait). Lines that do not parse are left out."""
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = configured(reader, fmt, schema, keep_corrupt=True).load(source_dir)
    rows = cleanse(raw.where(f"{CORRUPT} IS NULL").drop(CORRUPT), replace(spec, keys=()))
    stable = hashlib.sha1(target.parts.root.encode()).hexdigest()[:16]  # same target → same checkpoint
    checkpoint = checkpoint_dir or f"{shared_dir(spark)}/medalforge/streams/{stable}"
    named = hashlib.sha1(checkpoint.encode()).hexdigest()[:16]

    def merge(batch, number: int) -> None:
        target.merge(batch, f"{named}-{number}")

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
