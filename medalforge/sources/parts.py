"""Tables that grow and change by published parts.

A ``Parts`` table is a folder of Parquet parts and a log of commits. Every commit is one row,
in one file, that lists all live parts; readers take the list of the last commit, so parts that were
written but not committed, or have been replaced, are never read, and a reader that
started on an earlier list can finish on it. One writer at a time; a second one
that commits the same number is told so.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "number long, id string, note string, live array<string>"


class ConcurrentCommit(RuntimeError):
    """Another writer committed the same number first; nothing of this commit is read."""


class Parts:
    """A table of live Parquet parts under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def _last(self) -> tuple[int, list[str]]:
        log = self._commits()
        row = None if log is None else log.orderBy(F.col("number").desc(), "id").first()
        return (0, []) if row is None else (row["number"], list(row["live"]))

    def version(self) -> int:
        """Number of the last commit, 0 before the first."""
        return self._last()[0]

    def live(self) -> list[str]:
        """Paths of the live parts, below the root."""
        return self._last()[1]

    def notes(self) -> set[str]:
        """The notes of all commits (ids of the batches they hold, say)."""
        log = self._commits()
        return set() if log is None else {r["note"] for r in log.where("note IS NOT NULL").select("note").collect()}

    def path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def new_part(self) -> str:
        return f"parts/{uuid.uuid4().hex}"

    def commit(self, add: Iterable[str] = (), remove: Iterable[str] = (), note: str | None = None) -> int:
        """Publish a list of parts: those of the last commit, without ``remove``, and ``add``."""
        number, live = self._last()
        gone, own = set(remove), uuid.uuid4().hex
        row = (number + 1, own, note, [p for p in live if p not in gone] + list(add))
        self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        first = self._commits().where(F.col("number") == number + 1).orderBy("id").first()
        if first["id"] != own:
            raise ConcurrentCommit(f"commit {number + 1} of {self.root} was made by another writer")
        return number + 1

    def write(self, df: DataFrame, note: str | None = None, replace: bool = False) -> int:
        """Write ``df`` as a part and publish it, beside the live ones or (``replace``) in their place."""
        part = self.new_part()
        df.write.parquet(self.path(part))
        return self.commit([part], self.live() if replace else (), note)

    def read(self, schema: T.StructType | str, parts: Sequence[str] | None = None) -> DataFrame:
        """The live parts (or ``parts``) as one frame; no parts, no rows."""
        parts = self.live() if parts is None else list(parts)
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(p) for p in parts])
