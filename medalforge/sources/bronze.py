"""Bronze landing: raw files kept exactly as they arrived, every field a string.

CSV, JSON lines and plain text (logs: one line, one row). CSV and text are read
line by line, so files split across tasks; a field with a line break would come
back as two rows, so ``land`` refuses one in these formats (land such sources as
JSON). A CSV header must name the declared columns in their order. Lines that do
not parse, or have too many or too few fields, are kept whole in
``_corrupt_record``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Reader / writer options that keep text unchanged: no whitespace trimming;
# an empty string is written quoted ("") and read back as an empty string,
# while a missing value is an empty field and reads back as NULL.
_CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}
# On read, only an unquoted empty field is NULL; a quoted "" stays "". The
# header is compared with the schema instead of being skipped.
_CSV_READ = {**_CSV_OPTIONS, "nullValue": "\u0000", "enforceSchema": "false"}
CORRUPT = "_corrupt_record"
FORMATS = ("csv", "json", "text")


def STRING(columns: Sequence[str]) -> T.StructType:
    """All-string schema: bronze never types its fields."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _whole_lines(df: DataFrame, fmt: str) -> DataFrame:
    """The same rows; writing one with a line break in a string fails."""
    def checked(c: str):
        broken = F.col(f"`{c}`").rlike("[\\r\\n]")
        message = F.lit(f"column {c} holds a line break, which {fmt} files cannot carry; land it as json")
        return F.when(broken, F.raise_error(message)).otherwise(F.col(f"`{c}`")).alias(c)

    return df.select(*[checked(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def land(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write raw rows as text files (CSV, JSON lines, or the lines of one string column)."""
    if fmt == "csv":
        _whole_lines(df, fmt).write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    elif fmt == "text":
        _whole_lines(df, fmt).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unsupported bronze format {fmt!r}")


def configured(reader, fmt: str, schema: T.StructType | None, keep_corrupt: bool):
    """A batch or stream reader with the options of a bronze format."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported bronze format {fmt!r}")
    if fmt == "text":
        return reader.format("text")
    if keep_corrupt and CORRUPT not in schema.fieldNames():
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = reader.schema(schema)
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**_CSV_READ).format("csv") if fmt == "csv" else reader.format("json")


def ingest(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None,
           keep_corrupt: bool = True, target: str | None = None) -> DataFrame:
    """Land raw files, read with a declared schema (no inference pass), as a Parquet table; returns that table.

    A ``_corrupt_record`` column holds whole lines that did not parse; without
    ``keep_corrupt`` such lines lose what does not fit the schema. Text files need no
    schema: one row per line, column ``value``. The table goes to ``target``, or to a folder of its own under the shared
    one. Raw files are parsed once, here: later queries read any columns, the corrupt lines alone among them.
    """
    raw = configured(spark.read, fmt, schema, keep_corrupt).load(path)
    target = target or scratch_path(spark, "bronze")
    raw.write.mode("overwrite").parquet(target)
    return spark.read.schema(raw.schema).parquet(target)
