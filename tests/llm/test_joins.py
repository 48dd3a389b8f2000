import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medalforge.llm import ann, jaccard, mixing
from tests.conftest import SF001

from .helpers import awkward, empty, with_clashes, words


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_components(rows):
    """{(doc_id, shingle count): component} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and sets[a][0] is not None and sets[b][0] is not None:
                common = len(x & y)
                if 100 * common >= 80 * (len(x) + len(y) - common):
                    parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return sorted(((i, len(s), None if i is None else low[root(k)]) for k, (i, s) in enumerate(sets)), key=str)


def planted(rng, n):
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 160))] for _ in range(n)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for doc in base:
        rows.append(doc)
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(doc)
            for _ in range(rng.randint(0, max(1, len(doc) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy + rng.choice([[], ["tail"], doc[:3]]))
        if rng.random() < 0.3:
            rows.append(passage + doc[:rng.randint(0, 40)])
    # a chain of copies, and a group of near copies larger than a task's local groups
    chain = [f"c{i}" for i in range(60)]
    for k in range(12):
        rows.append(chain[k * 3:] + [f"d{i}" for i in range(k * 3)])
    big = [f"b{i}" for i in range(120)]
    rows += [big[:i] + [f"x{i}"] + big[i + 1:] for i in range(40)]
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_components_equal_brute_force(spark):
    rows = planted(random.Random(4), 60) + [(900, None), (901, ""), (None, "a b c d e f"), (902, "Some words"),
                                            (903, "some WORDS"), (3, "some words"), (3, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard.link_documents(with_clashes(docs, "node", "row", "x")).collect()), key=str)
    assert got == brute_components(rows)


def test_components_of_documents_and_edges(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, jaccard.link_documents(docs).collect()), key=str)
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert jaccard.link_documents(empty(spark)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.integers(5, 700), st.integers(0, 10**6))
def test_linked_sets_agree_on_a_block(n, seed):
    rng = np.random.default_rng(seed)
    common = rng.integers(0, 2**63, n, dtype=np.uint64)
    extra = rng.integers(0, 2**63, n // 4, dtype=np.uint64)
    cut = int(rng.integers(0, n // 4 + 1))
    a = np.unique(common)
    b = np.unique(np.concatenate([common[: n - int(rng.integers(0, n // 8 + 1))], extra[:cut // 2]]))
    if not jaccard.linked(a, b):
        return
    value = np.concatenate([a, b])
    owner = np.repeat([0, 1], [len(a), len(b)])
    who, key = jaccard.sketch_keys(value, owner, np.array([len(a), len(b)]))
    assert len(a) + len(b) < 10 and (np.array_equal(a, b)) or np.array_equal(a, b) or set(key[who == 0]) & set(key[who == 1])
    band = int(np.searchsorted(jaccard._BANDS, max(len(a), len(b)), side="right")) - 1
    apart = np.bitwise_count(jaccard._parity_bits(a, band).view(np.uint64) ^ jaccard._parity_bits(b, band).view(np.uint64)).sum()
    assert apart <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))  # lower-bounds the symmetric difference


def test_a_shared_passage_makes_candidates_in_proportion_to_the_rows(spark):
    """Texts of own words around one passage: none link, and nearly all drop the passage's blocks."""
    rng = np.random.default_rng(4)
    passage = " ".join(f"shared{i}" for i in range(12))
    kept = {}
    for n in (1000, 4000):
        docs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10 ** 9, 120)) + " " + passage) for i in range(n)]
        known = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) row")
        kept[n] = jaccard.shared_blocks(known)[2].count()
    assert kept[1000] <= 100 and kept[4000] <= 400


def test_templated_texts_just_below_the_threshold(spark):
    """Pages that share most, but not enough, and their near copies."""
    rng = np.random.default_rng(5)
    template = [f"t{i}" for i in range(120)]
    docs = []
    for i in range(60):
        own = [f"o{x}" for x in rng.integers(0, 10 ** 9, int(rng.integers(8, 40)))]
        docs.append((i, " ".join(template + own)))
        if i % 3 == 0:
            docs.append((100 + i, " ".join(template + own[:-1])))
    got = jaccard.link_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(docs)


def test_short_keys_round_trip():
    key = np.random.default_rng(0).integers(0, 1 << 56, 1000, dtype=np.uint64)
    assert (jaccard._long(jaccard._short(key).tobytes()) == key).all()


# --- nearest neighbours ------------------------------------------------------

def brute_nearest(rows, k):
    clean = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        clean.setdefault(i, np.array(v, float))
    out = []
    for q, a in clean.items():
        if q % 50:
            continue
        scored = sorted((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 12), i) for i, b in clean.items() if i != q)
        out += [(q, r, i) for r, (_, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_hilbert_curve_is_continuous():
    for d, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        keys = ann.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_small_tables_are_exact(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(0, 400)]
    rows += [(1000 + i, rows[50][1]) for i in range(30)]  # equal vectors, ties
    rows += [(2000, None), (2050, [0.0] * 8), (2100, [float("nan")] * 8), (2150, [1.0, None] + [0.0] * 6), (None, rows[3][1]),
             (rows[7][0], rows[7][1]), (2200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(with_clashes(df, "v", "rank", "size"), F.pmod("vec_id", F.lit(50)) == 0, recall=1.0)
    rows_ = sorted((r.query_id, r.rank, r.vec_id) for r in got.collect())
    want = brute_nearest(rows, 5)
    hit = len(set((q, i) for q, _, i in rows_) & set((q, i) for q, _, i in want)) / len(want)
    assert hit >= 0.95 and len(rows_) == len(want)
    few = ann.search(df.where("vec_id < 3"), F.col("vec_id") == 0)
    assert [(r.rank, r.vec_id) for r in few.orderBy("rank").collect()] == [(r, i) for _, r, i in brute_nearest(rows[:3], 5)]
    assert ann.search(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_each_vector_length_is_searched_and_unclear_ids_are_refused(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    rows = {n: [(i, [float(np.float32(x)) for x in rng.normal(size=n)]) for i in ids]
            for n, ids in ((8, range(0, 300)), (6, range(300, 360)), (12, range(1000, 1001)))}
    df = spark.createDataFrame(sum(rows.values(), []), "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in ann.search(df, F.pmod("vec_id", F.lit(50)) == 0, recall=1.0).collect()}
    for n in rows:
        want = {(q, i) for q, _, i in brute_nearest(rows[n], 5)}
        mine = {(q, i) for q, i in got if q in dict(rows[n])}
        assert len(mine) == len(want) and len(mine & want) >= 0.9 * len(want)
    with pytest.raises(ValueError, match="different vectors"):
        ann.search(df.union(spark.createDataFrame([(7, rows[8][8][1])], df.schema)), F.col("vec_id") == 0)


def test_recall_on_the_table(spark):
    got = ann.op4_hilbert_neighbours(spark, SF001)
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    want = brute_nearest([(r.vec_id, list(r.embedding)) for r in table.collect()], 5)
    rows = {(r.query_id, r.vec_id) for r in got.collect()}
    assert len(rows & {(q, i) for q, _, i in want}) >= 0.9 * len(want)


# --- mixing ------------------------------------------------------------------

def water(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(w[s] for s in free))
        over = [s for s in free if share * w[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **{s: share * w[s] for s in free}}
        fixed.update({s: cap * sizes[s] for s in over})


def test_targets_and_draws(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), ["a", "b", None, "é", "Z", "tiny"][i % 6 if i % 60 else 5]) for i in range(900)]
    rows += [(2000, None, "void"), (2001, "", "void"), (None, "w w w", "a"), (None, "w w w", "a"), (5, "w " * 36, None), (5, "w " * 36, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(mixing.numbered(docs)).toPandas()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water(sizes)
    assert len(out) == len(rows)
    for s, g in out.groupby("source", dropna=False):
        s = None if s is None or s != s else s
        assert g["target"].iloc[0] == pytest.approx(want[s]) and g["source_size"].iloc[0] == sizes[s]
        assert abs((g["copies"] * g["size"]).sum() - want[s]) <= 90
    assert out["copies"].between(0, 3).all()
    again = mixing.mix(mixing.numbered(docs)).toPandas()
    key = ["doc_id", "source", "size", "copies"]
    assert again[key].sort_values(key).reset_index(drop=True).equals(out[key].sort_values(key).reset_index(drop=True))
    taken = mixing.take(with_clashes(docs, "_row", "size", "copies"))
    assert taken.columns == ["doc_id", "text", "source", "_row", "size", "copies"] and taken.count() == out["copies"].sum()
    assert mixing.mix(mixing.numbered(empty(spark))).count() == 0
    assert mixing.mix(mixing.numbered(awkward(spark))).count() == awkward(spark).count()


def test_unequal_probabilities(spark):
    """Copies go in proportion to the weights of a source, whole parts for certain."""
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(800)]
    docs = mixing.numbered(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    weight = docs.selectExpr("_row", "cast(1 + doc_id % 4 as double) weight")
    out = mixing.mix(docs, weights=(1, 1, 1), weight=weight).toPandas()
    share = out.groupby(out.doc_id % 4).copies.mean()
    for group, wanted in {0: 1 / 2, 2: 3 / 2, 1: 2 / 3, 3: 4 / 3}.items():
        assert share[group] == pytest.approx(wanted, abs=0.13)
        assert set(out.copies[out.doc_id % 4 == group]) <= {int(wanted), int(wanted) + 1}


def test_stored_tables_are_packed_with_zstd(spark):
    from medalforge.llm.common import stored

    df = spark.range(50).selectExpr("id", "'t' || id text")
    back = stored(df, "packed")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert back.inputFiles() and all(f.endswith(".zstd.parquet") for f in back.inputFiles())
