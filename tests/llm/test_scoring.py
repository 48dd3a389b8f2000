import math
from collections import Counter

import numpy as np
import pytest

from medalforge.llm import langid, lmscore, toxicity
from medalforge.llm.lattice import Lattice, load_pieces
from medalforge.llm.sampling import decode, encode
from tests.conftest import SF001, SF01

from .helpers import awkward, crc, empty, with_clashes, words


def test_lm_score_by_hand(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, lmscore.score(with_clashes(docs, "score", "uid", "k", "word")).collect()), key=str)
    train = Counter()
    ends = 0
    for i, t in rows:
        if crc(i, 5) != 1:
            train.update(words(t))
            ends += 1
    n, v = sum(train.values()) + ends, len(train) + 1
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    want = []
    for i, t in rows:
        w = words(t)
        want.append((i, crc(i, 5) == 1, len(w) + 1, sum(x in train for x in w) + 1, n, sum(base(train[x]) for x in w) + base(ends)))
    want.sort(key=str)
    assert [g[:5] for g in got] == [x[:5] for x in want]
    assert [g[5] for g in got] == pytest.approx([x[5] for x in want])
    assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)
    assert lmscore.score(empty(spark)).count() == 0


def test_lm_is_a_distribution_and_prefers_its_corpus(spark):
    pieces = load_pieces()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = docs.withColumn("held_out", lmscore.held_out())
    counted = lmscore.word_counts(rows)
    sums = counted.selectExpr("sum(c) c", "count_if(c > 0) v", "count_if(c = 1) n1", "count_if(c = 2) n2").first().asDict()
    ends = rows.where("not held_out").count()
    logp = lmscore.fit(counted, ends, pieces)
    assert np.exp(logp[np.isfinite(logp)]).sum() == pytest.approx(1)
    model = lmscore.WordModel(pieces, logp, ends, sums)
    known = counted.toPandas()
    import pyarrow as pa
    p = 10 ** model.words_log10(pa.array(known["word"], pa.large_string()), known["c"].to_numpy(float))
    total = p.sum() + math.exp(model.end)
    assert 0.75 < total < 1  # the rest is for words not seen
    scored = lmscore.score(docs).toPandas()
    out = scored[scored.held_out]
    shuffled = [("".join(reversed(t)),) for (t,) in docs.where(lmscore.held_out()).select("text").collect()]
    back = Lattice(pieces, [w for (t,) in shuffled for w in words(t)]).forward(logp)[0].sum() / math.log(10)
    assert out.score.sum() > back


def test_encode_and_decode(spark):
    docs = awkward(spark)
    out = encode(with_clashes(docs, "rank", "ids", "_key"))
    assert out.columns == ["doc_id", "rank", "ids", "log_prob", "perturbed", "log_inclusion"]
    texts = sorted((str(r.doc_id), r.text) for r in decode(out.where("rank = 1")).collect())
    assert texts == sorted((str(r.doc_id), r.text) for r in docs.where("text is not null").collect())
    again = encode(docs.repartition(5)).selectExpr("doc_id", "rank", "perturbed", "hash(ids) h")
    assert sorted(map(str, again.collect())) == sorted(map(str, out.selectExpr("doc_id", "rank", "perturbed", "hash(ids) h").collect()))
    assert encode(empty(spark)).count() == 0


def test_language_held_out_accuracy(spark):
    got = langid.op9_language_id(spark, SF01)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").selectExpr("doc_id", "lang")
    row = got.join(docs, "doc_id").where("held_out").selectExpr("avg(cast(lang_pred = lang as int)) a", "min(score) s", "max(score) t").first()
    assert row.a > 0.98 and 0 <= row.s <= row.t <= 1


def test_language_edges(spark):
    train = awkward(spark)
    model = langid.train(train)
    assert model.languages == ["de", "en", "fr"]
    out = langid.predict(with_clashes(train, "score", "lang_pred"), model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    by = {(r.doc_id, r.text): r for r in out.collect()}
    for doc_id, text in ((2, None), (3, ""), (4, " \n\t "), (8, "12 34 !!"), (None, None)):
        assert (by[doc_id, text].lang_pred, by[doc_id, text].score) == ("und", 0.0)
    assert by[1, "The cat sat on the mat."].lang_pred == "en"
    none = langid.train(empty(spark))
    assert {r.lang_pred for r in langid.predict(train, none).collect()} == {"und"}
    # other labels than text and lang are never read
    swapped = langid.train(train.selectExpr("doc_id", "text", "lang", "'z' source", "0L n_chars"))
    assert np.allclose(swapped.logp, model.logp)


def test_language_likelihood_by_enumeration(spark):
    from .test_lattice import brute
    from medalforge.llm.lattice import MARK
    import pyarrow as pa
    pieces = load_pieces()
    got = langid.log_likelihoods(pieces, pa.array(["katze", "une"]), pieces.log_probs()[None, :])[0]
    assert got == pytest.approx([brute(MARK + "katze"), brute(MARK + "une")])


def test_toxicity_held_out(spark):
    got = toxicity.op6_toxicity(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet").where("toxic is not null")
    assert got.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    pairs = got.where("held_out").join(labels, "doc_id").select("score", "toxic", "predicted").toPandas()
    pos, neg = pairs.score[pairs.toxic == 1].to_numpy(), pairs.score[pairs.toxic == 0].to_numpy()
    assert (pos[:, None] > neg[None, :]).mean() > 0.8
    assert ((pairs.score >= 0.3) == (pairs.predicted == 1)).all() and pairs.score.between(0, 1).all()


def test_toxicity_edges(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 0, 1), (9, 1, 0), (None, 1, 1), (2, None, None), (3, 0, 0), (4, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, epochs=1)
    out = toxicity.predict(with_clashes(docs, "score", "predicted"), model)
    assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    none = toxicity.train(docs, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.predict(docs, none).collect()} == {0.0}
    assert toxicity.predict(empty(spark), model).count() == 0


def test_network_learns_a_phrase():
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for i in range(300):
        d = rng.integers(10, 200, (30, 1)).repeat(2, axis=1)
        if i % 2:
            d[10:12, 0], d[10:12, 1] = (3, 4), (3, 4)  # the pair 3 4
        else:
            d[10, :], d[20, :] = 3, 4  # both words, apart
        docs.append(d)
        labels.append(i % 2)
    y = np.array(labels, float)
    net = toxicity.Network(np.arange(256))
    net.fit(docs, y, epochs=15)
    z = net.logits(np.concatenate(docs), np.repeat(np.arange(300), 30), 300)
    assert ((z > 0) == (y == 1)).mean() > 0.95


def test_gradient_of_the_network():
    net = toxicity.Network(np.arange(50), seed=3)
    bucket = np.random.default_rng(1).integers(0, 50, (12, 2))
    rows = np.repeat([0, 1], 6)
    before = net.logits(bucket, rows, 2)
    net.p["o"] = net.p["o"] + 1e-6
    pooled, _ = net.pooled(net.place[bucket], rows, 2, net.tables())
    assert net.logits(bucket, rows, 2) - before == pytest.approx(1e-6 * pooled.sum(axis=1), rel=1e-2, abs=1e-9)


def test_every_segmentation_is_decoded_and_compared(spark):
    docs = awkward(spark)
    out = encode(docs, check=True)
    assert out.columns[-2:] == ["decoded_bytes", "round_trip"] and out.where("NOT round_trip").count() == 0
    sizes = {(str(r.doc_id), r.n) for r in docs.where("text IS NOT NULL").selectExpr("doc_id", "octet_length(text) n").collect()}
    assert {(str(r.doc_id), r.decoded_bytes) for r in out.collect()} == sizes
    assert encode(empty(spark), check=True).count() == 0


def test_a_wrong_segmentation_is_told():
    from medalforge.llm.sampling import piece_bytes, round_trips
    import pyarrow as pa
    pieces = load_pieces()
    spelled = piece_bytes(pieces)
    at = {p: i for i, p in enumerate(pieces.pieces)}
    a, b = at["▁a"], at["▁b"]
    texts = pa.array(["a", "b", "a b"], pa.large_string())
    got = lambda *lists: [x.tolist() for x in round_trips(spelled, texts, np.arange(3), np.concatenate(lists), np.array([len(x) for x in lists]))]
    assert got([a], [b], [a, b]) == [[1, 1, 3], [True, True, True]]
    assert got([a], [a], [b, b]) == [[1, 1, 3], [True, False, False]]
    assert got([a], [a, b], [a]) == [[1, 3, 1], [True, False, False]]


def test_encoding_takes_units_as_arrow_and_leaves_no_near_one_of_the_largest_values_out():
    import pyarrow as pa

    from medalforge.llm.sampling import Choices, _Path, hashed1

    pieces = load_pieces()
    units = ["the", "", "na\u00efve", "x\u2581y", "\U0001f600" * 3, "abcabcabc" * 40, "plain"]
    listed, held = Lattice(pieces, units), Lattice(pieces, pa.array(["cut", *units], pa.large_string()).slice(1))
    assert held.points.tolist() == listed.points.tolist() and held.cls.tolist() == listed.cls.tolist()
    assert held.reach.tolist() == listed.reach.tolist() and held.base.tolist() == listed.base.tolist()
    choices = Choices(pieces, pa.array(units), pieces.log_probs())
    codes = np.array([5, 0, 2, 6] * 30)
    for seed in range(20):
        edges, begin = choices.walk(codes, np.arange(len(codes), dtype=np.uint64) + np.uint64(1000 * seed))
        path = _Path(choices, edges, begin, 0.3, 2, hashed1(seed, 1), 2)
        every = path._values(np.arange(2, len(edges)), hashed1(seed, 1))
        assert np.sort(path.beside)[-3:].tolist() == np.sort(every)[-3:].tolist()
