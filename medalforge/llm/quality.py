"""Rule-based quality filter as a short-circuit cascade, in built-in functions only.

A rule is a name and a Boolean column that is true for texts to reject. On a
sample of the table each rule's cost (seconds over the sample) and selectivity
(share it rejects) are measured; the rules are then ordered by rejection per
cost, and one CASE expression evaluates them in that order and stops at the
first that rejects. The order changes the work, never the verdict: a text is
kept when no rule rejects it. Which rule is named for a text that several
reject depends on the order.

The sample is picked by a hash over the whole table, ``sample_rows`` expected.

Words are runs of characters other than space and \\x09-\\x0D; lines are split
at \\n. Defined results: null text counts as empty (no words, rejected by
``too_few_words``); a rule that yields null does not reject. Input columns
stay; the measures, ``rejected_by`` and ``kept`` replace columns of those names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SAMPLE_ROWS = 2000
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"
_STUTTER = rf"(?<!{_WORD})({_WORD}++)(?={_SPACE}++\1(?!{_WORD}))"  # a word that the next one equals
_HASH = 1 << 30


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE + "+"), "")


def _repeat_words(tokens: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text, by 64-bit window hashes."""

    def joined(h, by):  # hash i with hash i + by: doubles the words that each covers
        return F.zip_with(h, F.slice(h, F.lit(by + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))

    def windows(h):
        return _let(_let(joined(h, 1), lambda x: joined(x, 2)),
                    lambda x: F.slice(joined(x, 4), F.lit(1), F.size(x) - (WINDOW - 1)))

    def repeated(w):
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(p):
            at = lambda k: F.get(p, k)["h"]
            twice = F.filter(F.sequence(F.lit(0), F.size(p) - 1),
                             lambda k: F.coalesce(at(k) == at(k - 1), F.lit(False))
                             | F.coalesce(at(k) == at(k + 1), F.lit(False)))
            return F.sort_array(F.transform(twice, lambda k: F.get(p, k)["i"]))

        def covered(s):
            return F.aggregate(F.sequence(F.lit(0), F.size(s) - 1), F.lit(0).cast("long"),
                               lambda total, k: total + F.least(F.lit(WINDOW), F.coalesce(
                                   F.get(s, k + 1) - F.get(s, k), F.lit(WINDOW))))

        starts_then_sum = _let(_let(placed, starts), covered)
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(starts_then_sum)

    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    return F.when(F.size(tokens) > WINDOW, _let(_let(hashed, windows), repeated)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """Struct of the MEASURES of a text and n_lines, its lines with a word (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))

    def of_words(w):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
            _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"))

    return _let(words(text), of_words)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HELPERS = ("n_lines",)


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the measures; they replace columns of their names."""
    df = df.drop(*MEASURES, *HELPERS, "_m")
    return df.withColumn("_m", measures(F.col(text))).select("*", *[F.col("_m")[m].alias(m) for m in MEASURES + HELPERS]).drop("_m")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def default_rules(text: str = "text") -> list[Rule]:
    """The production rules, over a table that has the measures as columns.

    Thresholds leave ordinary prose of any language that puts spaces between
    words alone: they ask for junk in a third of the text or more.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    n = F.col("n_words")
    count = lambda pattern: F.regexp_count(body, F.lit(pattern))
    lines = F.col("n_lines")
    return [
        Rule("too_few_words", n < MIN_WORDS),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n),
        Rule("repeated_lines", (F.col("n_dup_lines") >= 4) & (100 * F.col("n_dup_lines") > 40 * lines)),
        Rule("symbols", 100 * F.col("n_symbols") > 30 * n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("few_letter_words", 100 * count(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*") < 60 * n),
        Rule("stuttered_words", 100 * count(_STUTTER) > 30 * n),
        Rule("upper_case", 100 * count(r"\p{Lu}") > 60 * count(r"\p{L}")),
        Rule("bullet_lines", 100 * count(r"(?m)^[\x20\x09]*[-*•‣]\s") > 90 * lines),
        Rule("ellipsis_lines", 100 * count(r"(?m)(\.\.\.|…)[\x20\x09]*$") > 30 * lines),
    ]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.seconds


def sampled(df: DataFrame, rows: int, key: str) -> DataFrame:
    """About ``rows`` rows of the whole table, picked by a hash of ``key``."""
    total = df.count()
    share = min(1.0, rows / max(1, total))
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(_HASH)) < int(share * _HASH))


def estimate(sample: DataFrame, rules: list[Rule]) -> list[Estimate]:
    """Seconds and share of rejections of each rule over the sample, best rejection per cost first."""
    def timed(condition):
        began = time.perf_counter()
        row = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("r")).first()
        return time.perf_counter() - began, row

    timed(F.lit(False))
    floor = min(timed(F.lit(False))[0] for _ in range(2))
    found = []
    for rule in rules:
        seconds, row = timed(F.coalesce(rule.rejects, F.lit(False)))
        found.append(Estimate(rule.name, max(seconds - floor, 1e-3), row["r"] / max(1, row["n"])))
    return sorted(found, key=lambda e: (-e.worth, e.seconds, e.name))


def cascade(df: DataFrame, rules: list[Rule], order: list[Estimate]) -> DataFrame:
    """Append ``rejected_by`` (the first rule of the order that rejects, else null) and ``kept``."""
    by_name = {r.name: r.rejects for r in rules}
    verdict = None
    for e in order:
        condition = F.coalesce(by_name[e.name], F.lit(False))
        verdict = F.when(condition, e.name) if verdict is None else verdict.when(condition, e.name)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("rejected_by", "kept")]
    first = F.lit(None).cast("string") if verdict is None else verdict
    out = df.select(*kept, first.alias("rejected_by"))
    return out.withColumn("kept", F.col("rejected_by").isNull())


def filter_quality(df: DataFrame, text: str = "text", key: str = "doc_id", rules: list[Rule] | None = None,
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Measure every text, order the rules on a sample, and append the verdict of the cascade."""
    rules = default_rules(text) if rules is None else rules
    measured = with_measures(df, text)
    sample = stored(with_measures(sampled(df.select(key, text), sample_rows, key), text), "quality-sample")
    return cascade(measured, rules, estimate(sample, rules))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filter_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select("doc_id", *MEASURES, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


# DuckDB statement for the query: windows as rows of text, stutters by comparing neighbours.
ORACLE_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM t),
f AS (SELECT rid, doc_id, t, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM w),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g
        FROM (SELECT rid, ws, unnest(range(1, n_words - 6)) AS i FROM f WHERE n_words > 8)),
twice AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1),
hit AS (SELECT DISTINCT rid, i + k AS at FROM win JOIN twice USING (rid, g), range(8) AS o(k)),
r AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
m AS (SELECT f.*, coalesce(r.n, 0) AS n_repeat_words,
             len([i for i in range(1, n_words) if ws[i] = ws[i + 1]]) AS stutters,
             len([x for x in ws if regexp_matches(x, '\p{L}')]) AS letter_words,
             len(regexp_extract_all(t, '\p{Lu}')) AS upper_letters, len(regexp_extract_all(t, '\p{L}')) AS letters,
             len(regexp_extract_all(t, '(?m)^[ \t]*[-*•‣]\s')) AS bullets,
             len(regexp_extract_all(t, '(?m)(\.\.\.|…)[ \t]*$')) AS ellipses
      FROM f LEFT JOIN r USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
            OR (n_dup_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines)
            OR 100 * n_symbols > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * letter_words < 60 * n_words OR 100 * stutters > 30 * n_words
            OR 100 * upper_letters > 60 * letters OR 100 * bullets > 90 * n_lines
            OR 100 * ellipses > 30 * n_lines) AS kept
FROM m"""
