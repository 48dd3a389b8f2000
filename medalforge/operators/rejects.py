"""Cleansing that accounts for every landed row: what became silver, what did not, and why.

``cleanse_accounted`` types the raw rows once and writes them in one pass, partitioned by outcome: the silver
rows, and the rejects as they landed, each with a reason. The counts of both come from the write itself
(``Observation``), so landed = silver + rejects by reason costs no pass of its own.

Reasons, the first that holds: ``corrupt line`` (did not parse), ``type`` (a critical column holds a value that
is not of its type), ``critical null`` (a critical column is blank), ``older row`` (a later row of its
key exists). Other values that do not parse become NULL in silver, as before, but are counted
(``values nulled``, and per row in ``_type_errors``).

Which row of a key is the latest is found by a cut that sends one row per key and task; the flags come back by row
number, so a key with a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.bronze import CORRUPT
from .cleansing import ERRORS, Cleansing, enforce_types, latest_per_key

CORRUPT_LINE, TYPE, CRITICAL_NULL, OLDER_ROW = "corrupt line", "type", "critical null", "older row"
REASONS = (CORRUPT_LINE, TYPE, CRITICAL_NULL, OLDER_ROW)
_OUTCOME, _ROW, _RAW, _REASON = "_outcome", "_landed_row", "_raw", "_reason"


@dataclass
class Accounted:
    """Silver and rejects of one table, and how many rows each took."""

    silver: DataFrame
    rejects: DataFrame
    counts: dict[str, int]

    def check(self) -> None:
        """Raise unless every landed row is silver or a reject of one reason."""
        if self.counts["landed"] != self.counts["silver"] + sum(self.counts[r] for r in REASONS):
            raise AssertionError(f"rows are missing: {self.counts}")


def _blank(name: str) -> Column:
    return F.col(f"{_RAW}.{name}").isNull() | (F.trim(F.col(f"{_RAW}.{name}")) == "")


def _labelled(landed: DataFrame, spec: Cleansing) -> DataFrame:
    """Silver columns, raw columns in ``_raw`` and the reason of all rejects but older rows."""
    names = [c for c in landed.columns if c != CORRUPT]
    corrupt = F.col(CORRUPT) if CORRUPT in landed.columns else F.lit(None).cast("string")
    rows = landed.select(*names, F.struct(*names, corrupt.alias(CORRUPT)).alias(_RAW))
    errors = enforce_types(rows, spec.types).select(*names, _RAW, ERRORS)
    untyped = F.lit(False)
    empty = F.lit(False)
    for c in spec.critical:
        untyped = untyped | (F.col(c).isNull() & ~_blank(c))
        empty = empty | _blank(c)
    reason = (F.when(F.col(f"{_RAW}.{CORRUPT}").isNotNull(), CORRUPT_LINE).when(untyped, TYPE).when(empty, CRITICAL_NULL))
    typed = errors.withColumn(_REASON, reason)
    # trimming and placeholders, as ``cleanse`` does
    clean, plain = typed, [c for c in names if c not in spec.types]
    for c in plain:
        trimmed = F.when(~_blank(c), F.trim(F.col(c)))
        clean = clean.withColumn(c, F.coalesce(trimmed, F.lit("Unknown")) if c in spec.text else trimmed)
    return clean


def cleanse_accounted(landed: DataFrame, spec: Cleansing, path: str | None = None) -> Accounted:
    """Cleanse a bronze table (strings, perhaps ``_corrupt_record``) by ``spec``; silver and rejects lie below ``path``."""
    spark = landed.sparkSession
    path = path or scratch_path(spark, "accounted")
    rows = _labelled(landed, spec)
    names = [c for c in landed.columns if c != CORRUPT]
    if spec.keys:
        # typed once and written with a number, so that flags can come back by row
        rows.withColumn(_ROW, F.monotonically_increasing_id()).write.parquet(f"{path}/typed")
        rows = spark.read.parquet(f"{path}/typed")
        order = [*spec.order, *sorted(c for c in names if c not in set(spec.keys) | set(spec.order))]
        latest = (latest_per_key(rows.where(F.col(_REASON).isNull()).select(_ROW, *names), spec.keys, [*order, _ROW])
                  .select(_ROW, F.lit(True).alias("_latest")))
        rows = (rows.join(latest, _ROW, "left")
                .withColumn(_REASON, F.coalesce(F.col(_REASON), F.when(F.col("_latest").isNull(), F.lit(OLDER_ROW))))
                .drop(_ROW, "_latest"))
    kept = F.col(_REASON).isNull()
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("landed"), F.count_if(kept).alias("silver"),
               F.coalesce(F.sum(F.when(kept, F.col(ERRORS))), F.lit(0)).alias("values nulled"),
               *[F.count_if(F.col(_REASON) == r).alias(r) for r in REASONS]]
    outcome = F.when(kept, "silver").otherwise("rejects")
    raw = F.when(~kept, F.col(_RAW))
    out = rows.observe(seen, *metrics).withColumn(_RAW, raw).withColumn(_OUTCOME, outcome)
    out.write.partitionBy(_OUTCOME).parquet(f"{path}/rows")
    counts = {k: int(v) for k, v in seen.get.items()}
    # an outcome without rows has no folder: both come from the one table, whose partitions are pruned
    written = spark.read.schema(out.schema).parquet(f"{path}/rows")
    silver = written.where(F.col(_OUTCOME) == "silver").select(*names, ERRORS)
    rejects = written.where(F.col(_OUTCOME) == "rejects").select(F.col(_REASON).alias("reason"), f"{_RAW}.*")
    return Accounted(silver, rejects, counts)


def reconciliation(tables: dict[str, Accounted], reasons: Sequence[str] = REASONS) -> list[tuple[str, str, int]]:
    """(table, outcome, rows) of each table: landed, silver, every reason, and the values nulled."""
    return [(name, what, a.counts[what]) for name, a in tables.items() for what in ("landed", "silver", *reasons, "values nulled")]
