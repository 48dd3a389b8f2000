"""Keyed tables that are kept up to date by merging batches: silver that adds to its history.

``KeyedTable`` holds the latest row per key, dealt by a hash of the key into buckets, each a part of
its own. ``merge`` reduces a batch to its latest row per key (cut down map-side, so a hot key sends
one row per task), reads the live parts of the buckets that the batch touches, no others, keeps the
latest row per key of both and publishes the new parts in place of the old ones in one commit.

Which row is the latest is a total order (``order``, descending, NULLs last, then all other columns), so
batches may come in any order, late, repeated or overlapping: the table always equals one pass over all rows
that were merged. A batch that was committed under its id is not merged again, so a restarted stream
does no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.parts import Parts
from .cleansing import latest_per_key

BUCKETS = 64
_BUCKET = "_bucket"


class KeyedTable:
    """The latest row per key under ``root``; ``buckets`` should make a bucket one task's worth of rows."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str],
                 buckets: int = BUCKETS):
        self.parts = Parts(spark, root)
        self.schema, self.keys, self.buckets = schema, list(keys), buckets
        self.order = [*order, *sorted(f.name for f in schema.fields if f.name not in set(order) | set(keys))]

    def read(self) -> DataFrame:
        return self.parts.read(self.schema)

    def _bucket_of(self, part: str) -> int:
        return int(part.rsplit(f"/{_BUCKET}=", 1)[1])

    def merge(self, batch: DataFrame, batch_id: str | None = None) -> list[int]:
        """Merge rows in; returns the buckets that were written anew (none if the batch was merged before)."""
        if batch_id is not None and batch_id in self.parts.notes():
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        columns = [f.name for f in self.schema.fields]
        rows = latest_per_key(batch.select(*columns), self.keys, self.order).withColumn(_BUCKET, bucket)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read for its buckets and for the merge
        try:
            touched = sorted(r[0] for r in rows.select(_BUCKET).distinct().collect())  # at most ``buckets``
            old = [p for p in self.parts.live() if self._bucket_of(p) in set(touched)]
            new = rows
            if old:
                held = self.parts.read(self.schema, old).withColumn(_BUCKET, bucket)
                # at most two rows per key are left, so dealing by bucket serves both the window and the write
                both = held.unionByName(rows).repartition(self.buckets, _BUCKET)
                latest = Window.partitionBy(_BUCKET, *self.keys).orderBy(*[F.col(c).desc_nulls_last() for c in self.order])
                new = both.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")
            else:
                new = rows.repartition(self.buckets, _BUCKET)
            if touched:
                part = self.parts.new_part()
                new.write.partitionBy(_BUCKET).parquet(self.parts.path(part))
                self.parts.commit([f"{part}/{_BUCKET}={b}" for b in touched], old, batch_id)
            elif batch_id is not None:
                self.parts.commit(note=batch_id)
        finally:
            rows.unpersist()
        return touched
