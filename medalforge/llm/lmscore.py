"""Language-model scoring by subword lattice likelihood.

A text is its words (A-Z lowered) and the end; each word is spelled with the
word mark in front by the pieces of an existing vocabulary. Unigram scores of the
pieces weight all segmentations of a word, and the forward recursion in log
space (``lattice``) sums them. As no piece crosses a word, the probability of the
text is the product of its words' and the end's: the marginal over all
segmentations of the text.

The vocabulary's own scores weight segmentations at first; ``rounds`` of
expectation maximisation over the distinct training words then adapt them, with
``strength`` pseudo-uses keeping the vocabulary's weights as the prior. Every
distinct word is one lattice, and the driver sees one number per piece.

Words seen in training have one more arc in their lattice, the whole word, with
its absolutely discounted training frequency; the mass that the discount frees
goes to the piece arcs, so the model stays a distribution over all texts, unseen
words included. ``word_arcs=False`` leaves the pieces alone. The discount is
n1 / (n1 + 2 n2), from the words seen once and twice. All training words are
counted by Spark; nothing is cut off.

Scoring: a distinct word's probability is computed once for the whole corpus.
Words with a share of at least 1 / HOT of all words (so at most HOT of them, of
at most HOT_BYTES bytes) go to the tasks; all others are joined by word, and as
none of those holds more than that share, the join is even.

The base score is an add-half unigram model over whole words.

Defined results: null text counts as empty, whose only token is the end; a null
``doc_id`` is a training row; repeated rows are scored one by one, and each counts in
training; without training rows all counts are 0 and the vocabulary's own
weights score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, remainder, steps, stored, strings, table, words_of
from .langid import expected_uses, log_likelihoods
from .lattice import MARK, VOCABULARY, Pieces, adapted, load_pieces

HELD_OUT = (5, 1)
ROUNDS, STRENGTH = 2, 2000.0
HOT, HOT_BYTES = 1 << 18, 64
_COUNT_STEP = 24 << 20


def held_out():
    return F.coalesce(remainder("doc_id", HELD_OUT[0]), F.lit(-1)) == HELD_OUT[1]


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c, a): uses of each word in training rows and in all rows of (held_out, text)."""
    def count(batches):
        for batch in steps(batches, limit=_COUNT_STEP):
            flat, of = words_of(strings(batch.column("text")))
            codes, words = encoded(flat)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [words.cast(pa.string()), pa.array(np.bincount(codes[train[of]], minlength=n).astype(np.int64)),
                 pa.array(np.bincount(codes, minlength=n).astype(np.int64))], ["word", "c", "a"])

    return stored(rows.mapInArrow(count, "word string, c long, a long")
                  .groupBy("word").agg(F.sum("c").alias("c"), F.sum("a").alias("a")), "words")


def fit(words: DataFrame, ends: int, pieces: Pieces, rounds: int = ROUNDS, strength: float = STRENGTH,
        distinct: bool = True) -> np.ndarray:
    """Natural-log piece probabilities adapted to the words of (word, c) with c > 0, each once or as often as
    it is used, and to ``ends`` uses of the end piece."""
    prior = pieces.log_probs()
    logp = prior
    for _ in range(rounds):
        def uses(batches, logp=logp):
            total = np.zeros(len(pieces))
            for batch in batches:
                counts = batch.column("c").to_numpy().astype(float)[None, :]
                counts = np.minimum(counts, 1.0) if distinct else counts
                total += expected_uses(pieces, strings(batch.column("word")), counts, logp[None, :])[0]
            piece = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(total[piece])], ["piece", "uses"])

        found = (words.where("c > 0").select("word", "c").mapInArrow(uses, "piece int, uses double")
                 .groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow())
        total = np.zeros(len(pieces))
        total[found["piece"].to_numpy()] = found["uses"].to_numpy()
        total[pieces.end_id] += ends
        logp = adapted(prior, total, strength)
    return logp


class WordModel:
    """Log10 probabilities of words and of the end, from piece probabilities and training counts."""

    def __init__(self, pieces: Pieces, logp: np.ndarray, ends: int, sums=None):
        self.pieces, self.logp = pieces, logp
        self.arcs = sums is not None and sums["c"] > 0
        starts = np.array([u and p.startswith(MARK) for p, u in zip(pieces.pieces, pieces.usable)])
        self.end = float(logp[pieces.end_id])
        # a word's pieces end where the next word or the end begins
        self.stop = float(np.log1p(np.exp(self.end) / np.exp(logp[starts]).sum()))
        if self.arcs:
            n1, n2 = sums["n1"], sums["n2"]
            self.discount = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
            self.words = float(sums["c"])
            self.freed = np.log(max(self.discount * sums["v"] / self.words, 1e-300))
            self.end = float(np.log(ends / (ends + self.words))) if ends else self.end
            self.more = np.log1p(-np.exp(self.end))

    def words_log10(self, words: pa.Array, counts: np.ndarray) -> np.ndarray:
        by_pieces = log_likelihoods(self.pieces, words, self.logp[None, :])[0]
        if not self.arcs:
            return by_pieces / np.log(10)
        with np.errstate(divide="ignore"):
            arc = np.log(np.maximum(counts - self.discount, 0.0) / self.words)
        return (self.more + np.logaddexp(arc, self.freed + self.stop + by_pieces)) / np.log(10)


def scored_words(words: DataFrame, model: WordModel) -> DataFrame:
    """(word, c, a, lm): with the log10 probability of each word."""
    def score(batches):
        for batch in batches:
            lm = model.words_log10(strings(batch.column("word")), batch.column("c").to_numpy().astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lm)], ["word", "c", "a", "lm"])

    return stored(words.mapInArrow(score, "word string, c long, a long, lm double"), "scored-words")


_PARTS = ("k string, uid long, n long, doc_id long, held_out boolean, n_tokens long, n_known long, "
          "base double, lm double")


def score(documents: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS,
          strength: float = STRENGTH, word_arcs: bool = True) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of (doc_id, text)."""
    pieces = load_pieces(vocabulary)
    rows = documents.select("doc_id", "text", held_out().alias("held_out"))
    words = word_counts(rows)
    ends = rows.where("NOT held_out").count()
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("a"), F.lit(0)).alias("a"),
                     F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("n1"),
                     F.count_if(F.col("c") == 2).alias("n2")).first()
    tokens, kinds = sums["c"] + ends, sums["v"] + (ends > 0)
    floor = float(np.log10(tokens + 0.5 * (kinds + 1)))
    logp = fit(words, ends, pieces, rounds, strength, distinct=word_arcs)
    model = WordModel(pieces, logp, ends, sums.asDict() if word_arcs else None)
    every = scored_words(words, model)
    hot = (F.col("a") * HOT >= sums["a"]) & (F.length(F.col("word").cast("binary")) <= HOT_BYTES)
    table_ = every.where(hot).toArrow()
    hot_words = table_["word"].combine_chunks().cast(pa.large_string())
    hot_c = table_["c"].to_numpy().astype(float)
    hot_lm = table_["lm"].to_numpy().astype(float)
    end = (float(np.log10(ends + 0.5)) - floor, model.end / np.log(10), int(ends > 0))

    def parts(batches):
        for batch in steps(batches):
            n = batch.num_rows
            flat, of = words_of(strings(batch.column("text")))
            codes, distinct = encoded(flat)
            at = pc.fill_null(pc.index_in(distinct, value_set=hot_words), -1).to_numpy(zero_copy_only=False)[codes]
            warm = at >= 0
            where, which = of[warm], at[warm]
            base = np.bincount(where, (np.log10(hot_c + 0.5) - floor)[which], minlength=n) + end[0]
            lm = np.bincount(where, hot_lm[which], minlength=n) + end[1]
            known = np.bincount(where, (hot_c > 0)[which], minlength=n).astype(np.int64) + end[2]
            total = np.bincount(of, minlength=n).astype(np.int64) + 1
            uid = batch.column("uid").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f" {u}" for u in uid.tolist()], pa.string()), batch.column("uid"), pa.nulls(n, pa.int64()),
                 batch.column("doc_id"), batch.column("held_out"), pa.array(total), pa.array(known), pa.array(base),
                 pa.array(lm)], _NAMES)
            pair, count = np.unique(of[~warm] * max(1, len(distinct)) + codes[~warm], return_counts=True)
            row, word = pair // max(1, len(distinct)), pair % max(1, len(distinct))
            m = len(pair)
            for s in range(0, m, 1 << 18):
                cut = slice(s, s + (1 << 18))
                size = len(pair[cut])
                none = [pa.nulls(size, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [distinct.take(pa.array(word[cut])).cast(pa.string()), pa.array(uid[row[cut]]),
                     pa.array(count[cut].astype(np.int64)), *none], _NAMES)

    emitted = rows.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(parts, _PARTS)
    rare = every.where(~hot).select(F.col("word").alias("k"), "c", F.col("lm").alias("word_lm"))
    share = emitted.join(rare, "k", "left")
    of_word = F.col("n") * (F.log10(F.col("c") + 0.5) - floor)
    return (share.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.coalesce(F.sum(F.when(F.col("c") > 0, F.col("n"))), F.lit(0))).alias("n_known"),
        (F.max("base") + F.coalesce(F.sum(of_word), F.lit(0.0))).alias("base_score"),
        (F.max("lm") + F.coalesce(F.sum(F.col("n") * F.col("word_lm")), F.lit(0.0))).alias("score"))
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"),
                "base_score", "score"))


_NAMES = ["k", "uid", "n", "doc_id", "held_out", "n_tokens", "n_known", "base", "lm"]


def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))


