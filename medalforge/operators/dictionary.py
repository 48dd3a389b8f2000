"""Surrogate keys that keep their meaning: an append-only dictionary of natural keys.

A row number over a dimension is new with every build, so a stored key of an older build means another
row. A ``KeyDictionary`` gives a natural key its number once: ``extend`` finds the natural keys
it has not seen (an anti-join on a unique side), numbers them densely after the last number in
the given order (``surrogate_key``: distributed, no single-task sort) and publishes them as one more part.
Keys whose rows are gone keep their number, and get it back when they return.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.parts import Parts
from .joins import left_join_dim, measured_join
from .keys import surrogate_key


class KeyDictionary:
    """(natural key → surrogate key) under ``root``; ``natural`` is one column of type ``dtype``."""

    def __init__(self, spark: SparkSession, root: str, natural: str, dtype: str, key: str):
        self.parts = Parts(spark, root)
        self.natural, self.key = natural, key
        self.schema = T.StructType.fromDDL(f"`{natural}` {dtype}, `{key}` bigint, `since` bigint")

    def read(self) -> DataFrame:
        """(natural key, surrogate key, number of the commit that gave it)."""
        return self.parts.read(self.schema)

    def extend(self, rows: DataFrame, order: Sequence[str | Column] = ()) -> int:
        """Number the natural keys of ``rows`` that have no number yet; returns how many there were.

        New keys follow ``order`` (ascending, NULLs first), then the natural key; a NULL natural key gets no
        number. Of several rows of a key the least in that order places it.
        """
        known = self.read()
        last = known.agg(F.max(self.key)).first()[0] or 0
        natural = F.col(self.natural)
        ranks = {f"_o{i}": (F.col(c) if isinstance(c, str) else c) for i, c in enumerate(order)}
        seen = rows.where(natural.isNotNull()).select(natural, F.struct(*[e.alias(n) for n, e in ranks.items()] or [F.lit(0).alias("_o")]).alias("_o"))
        seen = seen.groupBy(self.natural).agg(F.min("_o").alias("_o"))
        fresh = measured_join(seen, known.select(self.natural), self.natural, "left_anti")
        numbered = surrogate_key(fresh.select(self.natural, "_o.*"), list(ranks), self.key, tiebreak=[self.natural])
        since = self.parts.version() + 1
        part = self.parts.new_part()
        out = numbered.select(self.natural, (F.col(self.key) + F.lit(last)).cast("long").alias(self.key), F.lit(since).cast("long").alias("since"))
        out.write.parquet(self.parts.path(part))
        added = self.parts.read(self.schema, [part]).count()
        if added:
            self.parts.commit([part])
        return added

    def attach(self, rows: DataFrame, limit_bytes: int | None = None) -> DataFrame:
        """``rows`` with the surrogate key of their natural key (NULL for one that has none)."""
        known = self.read().select(F.col(self.natural).alias("_natural"), self.key)
        return left_join_dim(rows, known, self.natural, "_natural", limit_bytes)


def lasting_dimension(rows: DataFrame, dictionary: KeyDictionary, order: Sequence[str | Column] = ()) -> DataFrame:
    """A dimension with its lasting key in front: unseen natural keys are numbered first."""
    dictionary.extend(rows, order)
    return dictionary.attach(rows).select(dictionary.key, *rows.columns)
