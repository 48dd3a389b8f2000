"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order, null last, get the weights 5, 2, 1,
repeating, as shares of all words; a target stops at ``cap`` times its source's
words and the excess is shared again by weight, until no target is above. That
is the level L at which the sum of min(cap * words, L * weight) is the total;
it is found by a few aggregates over the source table.

Copies: a source whose target is r times its words wants r copies of each
document, or, where documents have a ``weight``, copies in proportion to it with
a limit of ``cap`` (the same level rule, inside the source). The whole part is
certain. The rest is the inclusion probability p of one more copy, and those are
drawn by Pareto order sampling: a document's ranking number is
(u / (1 - u)) / (p / (1 - p)), u uniform from a hash of seed and document, and
the smallest numbers of a source are taken until the words that it still misses
are filled. Copies are whole documents: near the end a document that does not
fit is passed over for the next ones that do (``FILL`` candidates), and one that
overshoots is taken where that comes nearer.

No source is gathered in one task: ranking numbers are cut into ``BINS`` bins
whose words are summed per source; all documents of the bins below the target
are taken, and only the bin in which it falls, with the ``FILL`` documents after
it, is gone through in order.

Defined results: null or empty text has size 0 and is taken 0 times; a null
``doc_id`` or source is an ordinary value; repeated rows are separate documents,
numbered among rows of the same id, source and text, so reruns agree whatever
the partitioning; a source without words has target 0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import measured_join
from ..operators.keys import surrogate_key
from .common import stored, table

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20
BINS = 4096
FILL = 500
_ROW = ("_row", "doc_id", "source", "size")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(*key: Column) -> Column:
    """A number in (0, 1) from a hash of the key."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def by_source(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Join per-source columns to rows; null is a source like any other.

    The sources are broadcast if measured under the session's bound, so the rows of a large source
    stay where they are; beyond it the join is one that Spark can split at a large source.
    """
    extra = [c for c in sources.columns if c != "source"]
    return (measured_join(docs.alias("d"), sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "inner")
            .select("d.*", *[f"s.{c}" for c in extra]))


def numbered(documents: DataFrame) -> DataFrame:
    """Append ``_row``. Another scan of the same files can be split, and so numbered, otherwise: rows that
    are read again by number have to be ``stored`` first."""
    return documents.withColumn("_row", F.monotonically_increasing_id())


def measured(rows: DataFrame) -> DataFrame:
    """(_row, doc_id, source, size, u) of numbered rows of (doc_id, source, text)."""
    sized = rows.select("_row", "doc_id", "source", n_words(F.col("text")).alias("size"),
                        F.xxhash64("text").alias("h"))
    same = Window.partitionBy("doc_id", "source", "h").orderBy("_row")
    return stored(sized.withColumn("copy", F.row_number().over(same))
                  .select(*_ROW, uniform(F.lit(SEED), F.col("doc_id"), F.col("source"), F.col("h"), F.col("copy")).alias("u")),
                  "sizes")


def targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) of measured documents, one row per source."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = sizes.withColumn("_missing", F.col("source").isNull())
    ranked = surrogate_key(ordered, ["_missing", "source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    limit = F.lit(float(cap)) * F.col("source_size")
    total = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level = 0.0
    while True:  # the level rises as sources reach their limit
        full = limit <= F.lit(level) * F.col("weight")
        row = ranked.agg(F.sum(F.when(full, limit).otherwise(0.0)).alias("held"),
                         F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"] or (total - row["held"]) / row["open"] <= level * (1 + 1e-12):
            break
        level = (total - row["held"]) / row["open"]
    return stored(ranked.select("source", "source_size", F.least(limit, F.lit(level) * F.col("weight")).alias("target")),
                  "targets")


def levels(docs: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Append ``level`` to the sources: sum(size * min(cap, level * weight)) over a source is its target."""
    state = sources.withColumn("level", F.lit(0.0))
    while True:
        full = F.col("level") * F.col("weight") >= float(cap)
        sums = (by_source(docs, state).groupBy("source")
                .agg(F.sum(F.when(full, 0.0).otherwise(F.col("size") * F.col("weight"))).alias("open"),
                     F.sum(F.when(full, float(cap) * F.col("size")).otherwise(0.0)).alias("held")))
        risen = F.when(F.col("open") > 0, F.greatest("level", (F.col("target") - F.col("held")) / F.col("open")))
        step = stored(by_source(state, stored(sums, "sums")).withColumn("new", F.coalesce(risen, F.col("level"))), "levels")
        state = step.withColumn("level", F.col("new")).select(*sources.columns, "level")
        if not step.where(F.col("new") > F.col("level") * (1 + 1e-9)).limit(1).count():
            return state


def _through(rows: pd.DataFrame) -> pd.DataFrame:
    """One source's documents around its target, in order: each that fits the room is taken, and at
    last the one that overshoots it if that comes nearer."""
    rows = rows.sort_values(["q", "_row"], kind="stable").reset_index(drop=True)
    room, taken = float(rows["room"].iloc[0]), []
    for size in rows["size"].tolist():
        taken.append(size <= room)
        room -= size if taken[-1] else 0
    left = [(size, i) for i, (size, t) in enumerate(zip(rows["size"].tolist(), taken)) if not t]
    if left and min(left)[0] < 2 * room:
        taken[min(left)[1]] = True
    return pd.DataFrame({"_row": rows["_row"], "extra": taken})[lambda x: x["extra"]][["_row"]]


def pareto_draw(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """The ``_row`` of documents that get one more copy.

    ``docs`` has _row, source, size, u and p (0 < p < 1); ``sources`` the words ``room`` to fill.
    """
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = stored(docs.select("_row", "source", "size", q.alias("q"))
                    .withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS)), "ranked")
    bins = stored(ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "bins")
    along = Window.partitionBy("source").orderBy("bin")
    running = (by_source(bins, sources.select("source", "room"))
               .withColumn("upto", F.sum("words").over(along)).withColumn("docs", F.sum("n").over(along)))
    whole = F.col("upto") <= F.col("room")
    cut = running.groupBy("source").agg(
        F.max("room").alias("room"), F.coalesce(F.max(F.when(whole, F.col("upto"))), F.lit(0)).alias("below"),
        F.coalesce(F.max(F.when(whole, F.col("bin"))), F.lit(-1)).alias("last"),
        F.min(F.when(~whole, F.col("docs"))).alias("reached"))
    cut = stored(cut, "cuts")
    end = (by_source(running.select("source", "bin", "docs"), cut).where(F.col("docs") >= F.col("reached") + FILL)
           .groupBy("source").agg(F.min("bin").alias("end")))
    cut = (cut.alias("c").join(end.alias("e"), F.col("c.source").eqNullSafe(F.col("e.source")), "left")
           .select("c.*", F.coalesce("e.end", F.lit(BINS)).alias("end")))
    cut = stored(cut, "cut")
    placed = by_source(ranked, cut)
    near = (placed.where("bin > last AND bin <= end").withColumn("room", F.col("room") - F.col("below"))
            .groupBy("source").applyInPandas(_through, "_row long"))
    return placed.where("bin <= last").select("_row").union(near)


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
        weight: DataFrame | None = None) -> DataFrame:
    """(_row, doc_id, source, size, source_size, target, copies) of numbered rows of (doc_id, source, text).

    ``weight``: optional (_row, weight), relative inclusion of the documents of a source.
    """
    docs = measured(rows)
    sources = targets(docs, weights, cap)
    if weight is None:
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        wanted = by_source(docs, sources).withColumn("wanted", rate)
    else:
        docs = stored(docs.join(weight.select("_row", "weight"), "_row"), "weights")
        wanted = (by_source(docs, levels(docs, sources, cap))
                  .withColumn("wanted", F.least(F.lit(float(cap)), F.col("level") * F.col("weight"))))
    near = F.abs(F.col("wanted") - F.round("wanted")) < 1e-9
    wanted = stored(wanted.withColumn("wanted", F.when(near, F.round("wanted")).otherwise(F.col("wanted")))
                    .withColumn("certain", F.when(F.col("size") > 0, F.floor("wanted")).otherwise(0))
                    .withColumn("p", F.col("wanted") - F.floor("wanted")), "wanted")
    room = stored(wanted.groupBy("source")
                  .agg((F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("room")), "room")
    drawn = stored(pareto_draw(wanted.where("p > 0 AND size > 0"), room), "drawn")
    return (wanted.join(drawn.withColumn("extra", F.lit(1)), "_row", "left")
            .select(*_ROW, "source_size", "target",
                    (F.col("certain") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies")))


def take(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mixed documents themselves, each as often as it is taken, with the columns of the input."""
    rows = stored(numbered(documents.select(F.struct("*").alias("_all"))), "numbered")
    copies = (mix(rows.select("_row", "_all.doc_id", "_all.source", "_all.text"), weights, cap)
              .where("copies > 0").select("_row", "copies"))
    return (rows.join(copies, "_row")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_all.*"))


def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix(rows).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
