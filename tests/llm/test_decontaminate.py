"""Suffix-array decontamination against every window of every item, looked for word by word."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from medalforge.llm import decontaminate as dc
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, with_clashes

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def plain_words(text):
    return _WORD.findall((text or "").encode().lower())


def brute(text, items, window=10):
    """(words, hit words, ids) of one text."""
    words = plain_words(text)
    hit, found = [False] * len(words), set()
    for name, item in items:
        own = plain_words(item)
        k = min(window, len(own))
        for i in range(len(own) - k + 1 if k else 0):
            for a in range(len(words) - k + 1):
                if words[a:a + k] == own[i:i + k]:
                    found.add("" if name is None else str(name))
                    hit[a:a + k] = [True] * k
    return len(words), sum(hit), sorted(found)


def longest_match(text, items, window=10):
    """Words of the longest verbatim match that holds a window."""
    words = plain_words(text)
    best = 0
    for _, item in items:
        own = plain_words(item)
        for i in range(len(own)):
            for a in range(len(words)):
                k = 0
                while i + k < len(own) and a + k < len(words) and own[i + k] == words[a + k]:
                    k += 1
                best = max(best, k if k >= min(window, len(own)) else 0)
    return best


def results(df):
    return sorted((r["n_words"], sum(s["end"] - s["start"] for s in r["hits"]), sorted(r["items"])) for r in df.collect())


def corpus(spark, seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "Dog", "ü", "x1", "日本", "long" * 9]
    items = [(i % 9, " ".join(rng.choices(vocabulary[:4 + i % 5], k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(None, "null id of two"), (50, None), (51, "..., !"), (52, items[5][1])]
    docs = []
    for i in range(n):
        words = rng.choices(vocabulary + ["other", "words"], k=rng.choice([0, 2, 12, 60]))
        if rng.random() < 0.6:
            at = rng.randrange(len(words) + 1)
            words[at:at] = (rng.choice(items)[1] or "null-id of two").split()
        docs.append((i, ", ".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    docs, items = corpus(spark, seed)
    found = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert results(found) == sorted(brute(t, items) for _, t in docs)
    texts = dict(docs)
    for r in found.where("longest IS NOT NULL").collect():
        assert r["longest"]["n_words"] == longest_match(texts[r["doc_id"]], items)
        own = [plain_words(t) for i, t in items if ("" if i is None else str(i)) == r["longest"]["item"]]
        k, a, b = r["longest"]["n_words"], r["longest"]["item_start"], r["longest"]["start"]
        assert any(w[a:a + k] == plain_words(texts[r["doc_id"]])[b:b + k] for w in own)


def test_several_blocks_give_the_same(spark):
    docs, items = corpus(spark, 4)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert len(list(dc.item_blocks(i, block_bytes=100))) > 3
    assert results(dc.find_contamination(d, i, block_bytes=100)) == results(dc.find_contamination(d, i))


def test_suffix_array_orders_suffixes():
    import numpy as np
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 50, 300):
        text = rng.integers(0, 3, n)
        order = dc.suffix_array(text, n)
        assert [text[i:].tolist() for i in order] == sorted(text[i:].tolist() for i in range(n))


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "cat SAT on the Mat"), (2, " ".join(f"w{i % 50}" for i in range(95))), (3, "")], ITEMS)
    docs = with_clashes(awkward(spark), "hits", "items", "n_words", "_row", "longest", "_all")
    found = dc.find_contamination(docs, items)
    plain = [(1, "cat SAT on the Mat"), (2, " ".join(f"w{i % 50}" for i in range(95)))]
    texts = [r["text"] for r in docs.select("text").collect()]
    assert results(found) == sorted(brute(t, plain) for t in texts[:-1]) + [(20000, 20000, ["2"])]
    left = dc.remove_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 4
    assert results(dc.find_contamination(docs, items, block_bytes=40)) == results(found)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], ITEMS)
    assert dc.find_contamination(empty(spark), items).count() == 0
    for none in (items.limit(0), spark.createDataFrame([(1, None), (2, " .")], ITEMS)):
        found = dc.find_contamination(awkward(spark), none)
        assert found.count() == 12 and found.where(F.size("items") > 0).count() == 0


def test_query_on_whole_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    expected = {}
    for d, text in docs:
        n, hit, ids = brute(text, items)
        expected[d] = (n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
           for r in dc.op12_suffix_decontamination(spark, SF001).collect()}
    assert got == expected and any(v[4] for v in got.values())
