import pytest

import corpus_pipeline
from medalforge.llm import jaccard, mixing, sampling
from tests.conftest import SF001

from .helpers import awkward, empty, with_clashes


def test_stages_in_order_and_their_decisions(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality rules", "n-gram Jaccard join", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "12 34", "en", "src0", 5)], docs.schema)
    out = with_clashes(docs.unionByName(extra), "score", "kept")
    sizes = [out.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1], 1):
        kept = corpus_pipeline.stored(stage(spark, out, SF001), f"test-stage{number}")
        assert kept.columns == out.columns and kept.where("score != 'own' OR kept != 'own'").count() == 0
        out = kept
        sizes.append(out.count())
        if number == 1:
            assert out.where("doc_id > 9000").count() == 0 and sizes[1] >= 0.95 * sizes[0] - 2
    assert sizes[1] > sizes[2] > sizes[3] > 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, out, SF001)
    assert encoded.where("rank = 1").count() == sizes[4]
    texts = {(r.doc_id, r.text) for r in sampling.decode(encoded).select("doc_id", "text").distinct().collect()}
    assert texts == {(r.doc_id, r.text) for r in out.select("doc_id", "text").distinct().collect()}


SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.mark.parametrize("module,name,run", [
    (jaccard, "near_pairs", lambda docs: jaccard.link_documents(docs.select("doc_id", "text"))),
    (jaccard, "link_documents", lambda docs: corpus_pipeline.drop_near_copies(docs.sparkSession, docs, SF001)),
    (mixing, "measured", mixing.take),
])
def test_files_split_otherwise_between_two_scans(spark, monkeypatch, module, name, run):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = sorted(map(tuple, run(docs).collect()))
    real, before = getattr(module, name), spark.conf.get(SPLIT)

    def then_resplit(*args, **options):
        out = corpus_pipeline.stored(real(*args, **options), "before-resplit")
        spark.conf.set(SPLIT, "16k")
        return out

    monkeypatch.setattr(module, name, then_resplit)
    try:
        got = sorted(map(tuple, run(docs).collect()))
    finally:
        spark.conf.set(SPLIT, before)
    assert len(want) > 0 and got == want


def test_awkward_and_empty_tables(spark):
    """Null ids and texts, ties, repeated rows, a long word, a long text; and no rows at all."""
    for docs in (awkward(spark), empty(spark)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1], 1):
            kept = corpus_pipeline.stored(stage(spark, docs, SF001), f"awkward-stage{number}")
            assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 or number == 4
            docs = kept
        encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
        assert encoded.where("NOT round_trip").count() == 0
        assert encoded.where("rank = 1").count() == docs.count()
