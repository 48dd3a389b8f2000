"""Approximate nearest neighbours by shifted Hilbert curves.

Every vector gets a key on each of ``CURVES`` Hilbert curves. A curve has its
own random orthonormal projection to ``DIMENSIONS`` coordinates and its own
random shift of the grid, so that neighbours that one curve cuts apart stay
together on others. Coordinates are placed on the grid by the quantiles of a
bounded sample; keys are computed for all rows.

Spark range-partitions the rows by (curve, key, id) and numbers them; a query's
candidates are the rows within ``window`` places of its own on any curve. Rows
lie in blocks of BLOCK places, queries in chunks of CHUNK, and each overlapping
(block, chunk) is one bounded group, scored by one matrix product; the best of
all groups are merged per query. Scores are cosines of the original vectors in
double precision.

The window is fitted, not fixed: for a bounded sample of queries the true
neighbours are found by brute force, and the window is the smallest that holds
``recall`` of them on some curve. Where vectors have structure it is a small
part of the table; on isotropic data, where nearest neighbours are hardly nearer than
others, no ordering helps much and it is a large one.

Equal vectors: only the ``k`` + 1 smallest ids of each distinct vector can be
among anyone's nearest, so no more of them are indexed (besides queries).

Vectors of each length have curves and a window of their own: a query's
neighbours are among the vectors of its length.

Defined results: rows with a null id, and vectors that are null, zero, or hold
null or non-finite components take no part; repeated rows count once, and an id
with different vectors is an error; a query has all candidates when they are
fewer than ``k``; ties go to the smaller id.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from .common import stored, table

CURVES, DIMENSIONS, BITS = 12, 6, 6
FIT_ROWS, FIT_QUERIES, RECALL = 4096, 96, 0.96
BLOCK, CHUNK = 4096, 32768
SEED = 11
_ROUND = 12  # digits by which a group's scores are compared before the exact ones


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below 2 ** bits."""
    x = grid.T.astype(np.int64).copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):  # undo the reflections and rotations of each level
        bit, below = 1 << level, (1 << level) - 1
        for i in range(d):
            swap = np.where(x[i] & bit, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(x[i] & bit, below, swap)
            if i:
                x[i] ^= swap
    for i in range(1, d):  # Gray decoding
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[d - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


class Curves:
    """Projections, grids and shifts of all curves, fitted on a sample of vectors."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS,
                 seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.bits, self.dimensions = bits, min(dimensions, size)
        self.bases = [np.linalg.qr(rng.normal(size=(size, self.dimensions)))[0] for _ in range(curves)]
        self.grids = [np.sort(sample @ base, axis=0) for base in self.bases]
        self.shifts = [rng.random(self.dimensions) * 0.2 for _ in range(curves)]

    def keys(self, unit: np.ndarray) -> list[np.ndarray]:
        out = []
        for base, grid, shift in zip(self.bases, self.grids, self.shifts):
            y = unit @ base
            place = np.stack([np.searchsorted(grid[:, i], y[:, i]) for i in range(self.dimensions)], axis=1) / len(grid)
            cell = ((place * 0.8 + shift) * (1 << self.bits)).astype(np.int64)
            out.append(hilbert_keys(np.minimum(cell, (1 << self.bits) - 1), self.bits))
        return out


def matrix(blobs) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.float64) for b in blobs]) if len(blobs) else np.zeros((0, 0))


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _usable(batches):
    """Vectors as bytes of doubles, unusable ones left out."""
    for batch in batches:
        ids, blobs, sizes = [], [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = vector.values
            if vec_id is None or values is None or not len(values) or values.null_count:
                continue
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            norm = np.linalg.norm(x)
            if np.isfinite(x).all() and 0 < norm < np.inf:
                ids.append(vec_id)
                blobs.append(x.tobytes())
                sizes.append(len(x))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary()),
                                          pa.array(sizes, pa.int32())], ["vec_id", "v", "size"])


def nearest(query: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int,
            allowed: np.ndarray | None = None):
    """(query index, row index, score) of each query's ``k`` nearest other rows, ties to smaller ids."""
    order = np.argsort(row_ids, kind="stable")
    scores = np.round(units(query) @ units(rows[order]).T, _ROUND)
    scores[query_ids[:, None] == row_ids[order][None, :]] = -np.inf
    if allowed is not None:
        scores[~allowed[:, order]] = -np.inf
    out = []
    for i, line in enumerate(scores):
        if len(line) > k:
            least = np.partition(line, len(line) - k)[len(line) - k]
            above, equal = np.flatnonzero(line > least), np.flatnonzero(line == least)
            found = np.concatenate([above, equal[:k - len(above)]])
        else:
            found = np.arange(len(line))
        for j in found[line[found] > -np.inf].tolist():
            a, b = query[i], rows[order[j]]
            out.append((i, int(order[j]), float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))))
    return out


_RESULT = "query_id long, vec_id long, score double"


def _found(found, query_ids, row_ids) -> pd.DataFrame:
    i, j, score = (np.array(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    return pd.DataFrame({"query_id": query_ids[i], "vec_id": row_ids[j], "score": score.astype(float)})


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of all that were found."""
    along = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def exact(vectors: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """Brute force: a bounded set of queries (vec_id, v) against all vectors, block by block."""
    ids, own = queries["vec_id"].to_numpy(np.int64), matrix(queries["v"].tolist())

    def score(batches):
        for batch in batches:
            row_ids, rows = batch.column("vec_id").to_numpy(), matrix(batch.column("v").to_pylist())
            if len(row_ids) and len(ids):
                yield pa.RecordBatch.from_pandas(_found(nearest(own, ids, rows, row_ids, k), ids, row_ids), preserve_index=False)

    return best(vectors.select("vec_id", "v").mapInArrow(score, _RESULT), k)


def _fitted_window(vectors: DataFrame, queries: DataFrame, placed: DataFrame, k: int, rows: int, recall: float) -> int:
    """The smallest window that holds ``recall`` of the true neighbours of a sample of queries."""
    sample = queries.orderBy(F.xxhash64("vec_id")).limit(FIT_QUERIES).select("vec_id", "v").toPandas()
    true = exact(vectors, sample, k).toPandas()
    if true.empty:
        return rows
    wanted = sorted(set(true["query_id"]) | set(true["vec_id"]))
    place = placed.where(F.col("vec_id").isin([int(x) for x in wanted])).select("curve", "vec_id", "place").toPandas()
    at = place.pivot(index="vec_id", columns="curve", values="place")
    apart = np.abs(at.loc[true["query_id"]].to_numpy() - at.loc[true["vec_id"]].to_numpy()).min(axis=1)
    return int(np.quantile(apart, recall, method="higher"))


def search(table_: DataFrame, is_query, k: int = 5, recall: float = RECALL, curves: int = CURVES,
           vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row where ``is_query`` (a condition
    on ``vec_id``) holds."""
    source = table_.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    every = source.mapInArrow(_usable, "vec_id long, v binary, size int")
    every = stored(every.groupBy("vec_id").agg(F.min_by("v", F.struct("size", "v")).alias("v"),
                                               F.min("size").alias("size"),
                                               (F.min(F.struct("size", "v")) != F.max(F.struct("size", "v"))).alias("differ")), "vectors")
    unclear = [r[0] for r in every.where("differ").select("vec_id").limit(3).collect()]
    if unclear:
        raise ValueError(f"ids with different vectors, such as {unclear}")
    sizes = [r[0] for r in every.select("size").distinct().orderBy("size").collect()]
    if not sizes:
        return table_.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_search_size(every.where(F.col("size") == size) if len(sizes) > 1 else every, is_query, k, recall, curves)
             for size in sizes]
    return reduce(DataFrame.union, found)


def _search_size(every: DataFrame, is_query, k: int, recall: float, curves: int) -> DataFrame:
    """``search`` over (vec_id, v, size) of vectors of one length."""
    total = every.count()
    sample = every.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, FIT_ROWS / max(1, total)) * (1 << 30)))
    sample = sample.limit(2 * FIT_ROWS).toPandas()
    if sample.empty:
        sample = every.limit(1).toPandas()
    model = Curves(units(matrix(sample["v"].tolist())), curves)
    equal = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    vectors = stored(every.withColumn("n", F.row_number().over(equal))
                     .where(F.col("n") <= k + 1).select("vec_id", "v", is_query.alias("q"))
                     .union(every.where(is_query).select("vec_id", "v", F.lit(True)))
                     .dropDuplicates(["vec_id"]), "indexed")

    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("vec_id")
                for c, key in enumerate(model.keys(units(matrix(batch.column("v").to_pylist())))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key), ids],
                                                     ["curve", "key", "vec_id"])

    rows = vectors.count()
    keys = vectors.select("vec_id", "v").mapInArrow(keyed, "curve int, key long, vec_id long")
    placed = stored(surrogate_key(keys, ["curve", "key"], "place", tiebreak=["vec_id"])
                    .select("curve", "vec_id", (F.col("place") - 1 - F.col("curve") * F.lit(rows)).alias("place")), "places")
    window = _fitted_window(vectors, vectors.where("q"), placed, k, rows, recall)
    full = stored(placed.join(vectors, "vec_id"), "placed-vectors")
    span = lambda lo, hi, unit: F.explode(F.sequence(F.floor(lo / unit), F.floor(hi / unit)))
    near = lambda at: (F.greatest(at - window, F.lit(0)), F.least(at + window, F.lit(rows - 1)))
    asked = (full.where("q").withColumn("chunk", F.floor(F.col("place") / CHUNK))
             .withColumn("block", span(*near(F.col("place")), BLOCK)).select("curve", "block", "chunk", "place", "vec_id", "v"))
    edge = F.col("block") * BLOCK
    held = (full.alias("h").withColumn("block", F.floor(F.col("place") / BLOCK))
            .withColumn("chunk", span(F.greatest(edge - window, F.lit(0)), F.least(edge + BLOCK - 1 + window, F.lit(rows - 1)), CHUNK))
            .select(*[F.col(c).alias(c) for c in ("curve", "block", "chunk", "place", "vec_id", "v")]))

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, row_ids = left["vec_id"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        if not len(ids) or not len(row_ids):
            return _found([], ids, row_ids)
        inside = np.abs(left["place"].to_numpy()[:, None] - right["place"].to_numpy()[None, :]) <= window
        return _found(nearest(matrix(left["v"].tolist()), ids, matrix(right["v"].tolist()), row_ids, k, inside), ids, row_ids)

    group = ["curve", "block", "chunk"]
    return best(asked.groupBy(*group).cogroup(held.groupBy(*group)).applyInPandas(scored, _RESULT), k)


def op4_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)
