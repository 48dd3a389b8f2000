"""Language identification by segmentation-marginalised unigrams.

Each language has a unigram distribution over the pieces of one fixed public
subword vocabulary. A text is the sequence of its letter runs (letters and
combining marks, lower-cased); the probability of a run is summed over all its
segmentations by the forward recursion of ``lattice``; runs are independent.
The prediction is the language of highest likelihood, the score its posterior
under equal priors.

Learning: in how many texts of a language each word stands, from a bounded sample of labelled
rows (``max_docs`` expected per language, picked by a hash of ``doc_id`` and text, so equal rows come
together), a word of over ``LONG`` letters weighing as little as one of that length, so
neither one long text nor one endless word moves a language; then
``rounds`` of expectation maximisation, whose expected piece uses are computed
by Spark tasks and summed per piece; the driver sees one number per language
and piece. The first round weighs segmentations by the vocabulary's own scores.

Defined results: null text or one without a letter is ``und`` with score 0;
equal likelihoods go to the language that sorts first; a label without a letter in any
of its training texts is never predicted, and with no other label
every text is ``und``. Repeated rows are predicted alike. Columns of the
input stay; ``lang_pred`` and ``score`` replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, remainder, steps, stored, strings, table
from .lattice import VOCABULARY, Lattice, Pieces, adapted, load_pieces

UNKNOWN = "und"
MAX_DOCS = 4000       # expected sample size per language
MAX_LANGUAGES = 500   # bounds the model: languages x pieces numbers
ROUNDS, STRENGTH = 2, 2000.0
LONG = 40             # letters beyond which a word weighs less
HELD_OUT = (4, 2)
_NODES = 4_000_000    # lattice nodes x languages in memory at once
_HASH = 1 << 30


@dataclass
class LanguageModel:
    pieces: Pieces
    languages: list[str]
    logp: np.ndarray  # (languages, pieces)
    learned: np.ndarray  # languages with a letter in a training text


def runs_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased letter runs of all rows, and the row of each."""
    lists = pc.split_pattern_regex(pc.utf8_lower(text), r"[^\p{L}\p{M}]+")
    rows = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    return flat.filter(pa.array(filled)), rows[filled]


def _chunks(words: pa.Array, sets: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of words whose lattices hold about _NODES numbers."""
    size = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False) + 2) * sets
    start = 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + _NODES, side="right")))
        yield start, words.slice(start, stop - start).to_pylist()
        start = stop


def log_likelihoods(pieces: Pieces, words: pa.Array, logp: np.ndarray) -> np.ndarray:
    """Marginal log-probability of each word under each set, shape (sets, words)."""
    out = np.empty((len(logp), len(words)))
    for start, chunk in _chunks(words, len(logp)):
        out[:, start:start + len(chunk)] = Lattice(pieces, chunk).forward(logp)
    return out


def expected_uses(pieces: Pieces, words: pa.Array, counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by the words, weighted by ``counts`` (sets, words)."""
    out = np.zeros((len(logp), len(pieces)))
    for start, chunk in _chunks(words, 2 * len(logp)):
        out += Lattice(pieces, chunk).expected(logp, counts[:, start:start + len(chunk)])
    return out


def sample(documents: DataFrame, max_docs: int) -> tuple[list[str], DataFrame]:
    """The languages, and about ``max_docs`` training rows of each (all rows of smaller ones)."""
    held = F.coalesce(remainder("doc_id", HELD_OUT[0]), F.lit(-1)) == HELD_OUT[1]
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held)
    sizes = {r["lang"]: r["n"] for r in
             known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: their model has no size bound")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_HASH))
    picked = F.lit(False)
    for lang, n in sizes.items():
        picked = picked | ((F.col("lang") == lang) & (draw < int(min(1.0, max_docs / n) * _HASH)))
    return sorted(sizes), known.where(picked).select("lang", "text")


def train(documents: DataFrame, vocabulary: str = VOCABULARY, max_docs: int = MAX_DOCS,
          rounds: int = ROUNDS, strength: float = STRENGTH) -> LanguageModel:
    """Fit the piece distribution of every language that labels a training row."""
    pieces = load_pieces(vocabulary)
    languages, rows = sample(documents, max_docs)
    prior = pieces.log_probs()
    logp = np.tile(prior, (len(languages), 1))
    if not languages:
        return LanguageModel(pieces, languages, logp, np.zeros(0, bool))
    number = {lang: k for k, lang in enumerate(languages)}

    def count(batches):
        for batch in steps(batches):
            flat, of = runs_of(strings(batch.column("text")))
            codes, words = encoded(flat)
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            once = np.unique(of * max(1, len(words)) + codes)  # a word counts once per text
            key, n = np.unique(lang[once // max(1, len(words))] * max(1, len(words)) + once % max(1, len(words)), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(key % max(1, len(words)))).cast(pa.string()),
                 pa.array(key // max(1, len(words)), pa.int32()), pa.array(n, pa.int64())], ["word", "k", "n"])

    counts = stored(rows.mapInArrow(count, "word string, k int, n long")
                    .groupBy("word", "k").agg(F.sum("n").alias("n")), "langid")
    for _ in range(rounds):
        def uses(batches, logp=logp):
            total = None
            for batch in batches:
                codes, words = encoded(batch.column("word"))
                weight = np.zeros((len(languages), len(words)))
                size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
                np.add.at(weight, (batch.column("k").to_numpy(), codes), batch.column("n").to_numpy())
                weight *= np.minimum(1.0, LONG / np.maximum(size, 1))
                part = expected_uses(pieces, words, weight, logp)
                total = part if total is None else total + part
            if total is not None:
                k, piece = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(piece, pa.int32()),
                                                  pa.array(total[k, piece])], ["k", "piece", "uses"])

        found = (counts.mapInArrow(uses, "k int, piece int, uses double")
                 .groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toArrow())
        total = np.zeros(logp.shape)
        total[found["k"].to_numpy(), found["piece"].to_numpy()] = found["uses"].to_numpy()
        logp = adapted(prior, total, strength)
    learned = np.zeros(len(languages), bool)
    learned[[r["k"] for r in counts.select("k").distinct().collect()]] = True  # one row per language
    return LanguageModel(pieces, languages, logp, learned)


def _predicted(model: LanguageModel, text: pa.Array) -> tuple[list[str], np.ndarray]:
    n, sets = len(text), len(model.languages)
    flat, rows = runs_of(text)
    if not model.learned.any():
        return [UNKNOWN] * n, np.zeros(n)
    codes, words = encoded(flat)
    each = log_likelihoods(model.pieces, words, model.logp)
    total = np.stack([np.bincount(rows, each[k][codes], minlength=n) for k in range(sets)]).astype(float)
    total[~model.learned] = -np.inf
    best = total.argmax(axis=0)
    score = 1.0 / np.exp(total - total.max(axis=0)).sum(axis=0)
    lettered = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
    return names, np.where(lettered, score, 0.0)


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Append ``lang_pred`` and ``score``."""
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    source = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = source.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches):
        for batch in steps(batches, text):
            names, score = _predicted(model, strings(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score)],
                                             [*kept, "lang_pred", "score"])

    return source.mapInArrow(run, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train(documents)
    held = F.coalesce(remainder("doc_id", HELD_OUT[0]), F.lit(-1)) == HELD_OUT[1]
    return predict(documents.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
