"""Bronze landing as a stream: new raw files in a folder → Parquet, exactly once.

Each run picks up only the files not seen before (the file source tracks them
in the checkpoint), writes them unchanged and untyped, and stops
(``availableNow``), so the same job can run on a schedule or continuously.
The checkpoint lives in the shared folder, so a restarted job after a lost
driver or executor resumes where it stopped and never lands a file twice. Files
land whatever their modification time: the file source's age limit, which skips
old files that arrive late, is set to ``MAX_FILE_AGE``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir
from ..sources.bronze import configured

MAX_FILE_AGE = "36500d"


def land_stream(spark: SparkSession, source_dir: str, fmt: str, schema: T.StructType | None,
                target_dir: str, checkpoint_dir: str | None = None,
                max_files_per_trigger: int | None = None,
                available_now: bool = True, keep_corrupt: bool = True) -> StreamingQuery:
    """Start the landing query and return it (``awaitTermination()`` to wait).

    As in ``sources.bronze.ingest``, lines that do not parse are kept in ``_corrupt_record``.
    """
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = configured(reader, fmt, schema, keep_corrupt).load(source_dir)
    stable = hashlib.sha1(target_dir.encode()).hexdigest()[:16]  # same target → same checkpoint
    checkpoint = checkpoint_dir or f"{shared_dir(spark)}/medalforge/streams/{stable}"
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", target_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
