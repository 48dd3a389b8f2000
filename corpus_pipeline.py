"""From raw documents to sampled token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept, written as Parquet and read again. All but the last return the columns of
``documents``.

1. language ID: texts of no language (null or without a letter) go;
2. quality rules: texts that a rule of the cascade rejects go;
3. n-gram Jaccard join: one document of each group of near copies stays, the
   first in reading order (rows are told apart by a number that is written once with them,
   so neither repeated ids nor another split of the files do harm);
4. mixing sources to target weights: documents are repeated or left out;
5. SentencePiece encoding and decoding: sampled segmentations of every text, decoded and compared (copies of a
   document are sampled alike).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalforge.llm import jaccard, langid, mixing, quality, sampling
from medalforge.llm.common import release, stored, table


#: Rows per Arrow batch in the session that runs the pipeline: whole rows with their texts go to the workers and back.
BATCH_ROWS = 500


def _begin(spark: SparkSession) -> None:
    """Small batches, and no shuffle files of the stage before."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    release(spark)


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns that a stage reads, and the whole row aside, so names that a stage adds cannot clash."""
    return docs.select(*columns, F.struct("*").alias("_all"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    # each text goes to the workers once, in small batches; names that the stage adds cannot clash with these
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    text = f"_c{docs.columns.index('text')}"
    kept = langid.predict(plain, langid.train(docs), text).where(F.col("lang_pred") != langid.UNKNOWN)
    return kept.select(*plain.columns).toDF(*docs.columns)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return quality.filter_quality(_packed(docs, "doc_id", "text")).where("kept").select("_all.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    rows = stored(mixing.numbered(_packed(docs)), "numbered")
    linked = jaccard.link_documents(rows.select(F.col("_row").alias("doc_id"), "_all.text"))
    copies = linked.where("doc_id != component_id").select(F.col("doc_id").alias("_row"))
    return rows.join(copies, "_row", "left_anti").select("_all.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return mixing.take(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return sampling.encode(docs, check=True)


STAGES = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_texts),
]

# Learned models, sampled costs, components and random draws are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
