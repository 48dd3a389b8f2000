"""Bronze / silver / gold storage as folders of Parquet tables.

``Layers`` maps (layer, table) to a path under one root. Bronze and silver
tables are replaced one by one. Gold tables belong together: each build writes
each of them in a folder of the build's own (``<table>/build=<id>``), and only a finished build is published,
by appending one row to the ``builds`` table, whose latest row names the build
that readers get. A build that fails leaves the earlier one as it was, and a
reader that started on an earlier build can finish on it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


class Layers:
    """Paths of the medallion layers under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        return f"{self.root}/{layer}/{name}"

    def write(self, df: DataFrame, layer: str, name: str,
              partition_by: Sequence[str] | None = None) -> DataFrame:
        """Write a table and return it read back from storage (lineage cut)."""
        path = self.path(layer, name)
        write_table(df, path, partition_by)
        return read_table(self.spark, path)

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name))

    def silver(self, name: str) -> DataFrame:
        return self.read("silver", name)

    # -- gold builds -----------------------------------------------------------

    def new_build(self) -> str:
        """An id for a build to be: its start in milliseconds, and chance."""
        return f"{time.time_ns() // 1_000_000}-{uuid.uuid4().hex[:8]}"

    def write_build(self, df: DataFrame, build: str, name: str) -> DataFrame:
        path = self.path("gold", f"{name}/build={build}")
        write_table(df, path)
        return read_table(self.spark, path)

    def publish(self, build: str) -> None:
        """Make ``build`` the one that readers get: one row, in one file, appended in one commit."""
        last = self._last()
        row = [(1 if last is None else last[0] + 1, build)]
        (self.spark.createDataFrame(row, "number long, build string").coalesce(1)
         .write.mode("append").parquet(self.path("gold", "builds")))

    def current_build(self) -> str | None:
        """The published build, or None before the first."""
        last = self._last()
        return None if last is None else last[1]

    def _last(self) -> tuple[int, str] | None:
        try:
            builds = self.spark.read.schema("number long, build string").parquet(self.path("gold", "builds"))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise
        row = builds.orderBy(F.col("number").desc(), F.col("build").desc()).first()
        return None if row is None else (row["number"], row["build"])

    def gold(self, name: str, build: str | None = None) -> DataFrame:
        """A gold table of the published build (or of ``build``)."""
        build = build or self.current_build()
        if build is None:
            raise FileNotFoundError(f"no gold build has been published under {self.root}")
        return read_table(self.spark, self.path("gold", f"{name}/build={build}"))
