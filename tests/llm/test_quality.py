import re
from collections import Counter

import pytest

from medalforge.llm import quality
from tests.conftest import SF001

from .helpers import awkward, empty, with_clashes

SPACE = " \t\n\x0b\x0c\r"


def measure(text):
    text = text or ""
    w = [x for x in re.split(f"[{SPACE}]+", text) if x]
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_measures_by_hand(spark):
    extra = spark.createDataFrame([
        (20, "a b c d e f g h i a b c d e f g h i", "en", "s", 1), (21, "x " * 40, "en", "s", 1),
        (22, "#a\n#a\n\n \n b |<>\nb", "en", "s", 1), (23, "one two three four five six seven eight", "en", "s", 1),
        (24, "k " * 8 + "u v " + "k " * 8, "en", "s", 1)], awkward(spark).schema)
    docs = awkward(spark).union(extra).union(spark.read.parquet(f"{SF001}/documents.parquet").select(*extra.columns))
    for r in quality.with_measures(with_clashes(docs, "n_words", "n_lines", "_m")).collect():
        assert tuple(r[m] for m in quality.MEASURES) == measure(r.text), r.doc_id


def test_query_keeps_clean_and_rejects_junk(spark):
    out = quality.op3_quality_rules(spark, SF001).toPandas()
    assert list(out.columns) == ["doc_id", *quality.MEASURES, "base_failed", "kept"]
    assert ((out.n_words < 20) | (100 * out.n_repeat_words > 30 * out.n_words)).equals(out.base_failed)
    assert not (out.base_failed & out.kept).any()
    labels = spark.read.parquet(f"{SF001}/labels.parquet").toPandas()
    both = out.merge(labels, on="doc_id")
    assert both[(both.quality == 1) & ~both.base_failed].kept.mean() == 1.0
    assert both[both.quality == 0].kept.mean() < 0.1


def test_order_does_not_change_the_verdict(spark):
    docs = quality.with_measures(spark.read.parquet(f"{SF001}/documents.parquet"))
    rules = quality.default_rules()
    order = [quality.Estimate(r.name, 1.0, 0.0) for r in rules]
    a = quality.cascade(docs, rules, order).select("doc_id", "kept").toPandas()
    b = quality.cascade(docs, rules, order[::-1]).select("doc_id", "kept").toPandas()
    assert a.equals(b)


def test_rules_go_by_rejection_per_cost(spark):
    from pyspark.sql import functions as F
    docs = spark.range(4000).selectExpr("id doc_id", "repeat('word ', 200) text")
    slow = F.size(F.array_sort(F.split(F.repeat("text", 20), " "))) < 0
    rules = [quality.Rule("slow", slow), quality.Rule("all", F.col("doc_id") >= 0), quality.Rule("none", F.lit(None).cast("boolean"))]
    estimates = quality.estimate(docs, rules)
    assert estimates[0].name == "all" and estimates[0].rejected == 1
    assert {e.name: e.rejected for e in estimates if e.name != "all"} == {"slow": 0, "none": 0}
    out = quality.cascade(docs, rules, estimates)
    assert out.where("rejected_by = 'all' and not kept").count() == 4000


def test_no_python_in_the_plan_and_edges(spark):
    out = quality.filter_quality(with_clashes(awkward(spark), "kept", "rejected_by"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert out.where("text is null").select("rejected_by").distinct().collect()[0][0] == "too_few_words" \
        or out.where("text is null and kept").count() == 0
    assert quality.filter_quality(empty(spark)).count() == 0


@pytest.mark.parametrize("text,rejected", [
    ("It " * 30 + "was " * 30, True),
    ("SHOUTING IS ALL THAT THIS TEXT DOES FROM ITS FIRST WORD TO ITS VERY LAST WORD AND MORE OF THE SAME", True),
    ("An ordinary sentence of some twenty words that says nothing in particular, but says it well enough to be kept here.", False),
])
def test_single_rules(spark, text, rejected):
    row = quality.filter_quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.kept is not rejected


def test_query_matches_duckdb(spark):
    from tools.check_oracle import compare, duck_connection
    ok, msg = compare(quality.op3_quality_rules(spark, SF001), duck_connection(SF001), quality.ORACLE_SQL)
    assert ok, msg
