"""Small documents with awkward rows, and plain Python versions of shared rules."""

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def crc(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long word, repeated rows, clashing columns."""
    rows = [
        (1, "The cat sat on the mat.", "en", "a", 23),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \n\t ", "de", None, 4),
        (None, "Die Katze und der Hund", "de", "b", 22),
        (None, None, None, None, None),
        (6, "x" * 3000, "en", "a", 3000),
        (7, "日本語 ▁ 🙂 \x00 ü", None, "c", 9),
        (1, "The cat sat on the mat.", "en", "a", 23),
        (1, "The cat sat on the mat.", "en", "a", 23),
        (8, "12 34 !!", "fr", "c", 8),
        (9, " ".join(f"w{i % 50}" for i in range(20000)), "en", "a", 0),
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df, *names):
    from pyspark.sql import functions as F
    for name in names:
        df = df.withColumn(name, F.lit("own"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
