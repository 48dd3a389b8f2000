"""Subword encoding by Gumbel top-k sampling without replacement, and decoding.

A text is cut at spaces into units, each spelled with the word mark in front,
as SentencePiece does; no piece crosses a unit, so the text's lattice is the
chain of its units' lattices. A segmentation has the probability that the
vocabulary's unigram scores give it among all segmentations of the text.

``encode`` emits the ``k`` segmentations with the largest Gumbel-perturbed
log-probabilities, an exact sample without replacement, without listing
segmentations: an A* search from the top of the lattice, whose node values are
the perturbed maxima over everything below a node. The backward recursion gives
each node the summed probability of its completions, so the root's value is one
Gumbel draw, a child chosen in proportion to its mass inherits its parent's
value, and the other children together (one lazy node) get a Gumbel variate
truncated at that value. The search pops the largest node, follows it down to a
full segmentation, and emits it; its new siblings join the frontier. Emitted
values fall, and segmentations are distinct.

Inclusion scores: given the largest value that was not emitted, kappa, a
segmentation of log-probability f is in the sample with probability
1 - exp(-exp(f - kappa)); ``log_inclusion`` is its logarithm.

All randomness is a hash of (seed, row key, position), so a row gets the same
sample in any batch or partition. The steps down the lattices of all units of
a batch are taken together in numpy.

Defined results: null text has no segmentations (no rows); an empty text has
one, the mark alone; texts with fewer than ``k`` segmentations give all of them;
a null key counts as key 0; repeated rows are sampled alike. ``decode`` gives
back exactly the text, whatever segmentation was drawn.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, steps, strings, table
from .lattice import MARK, VOCABULARY, Lattice, Pieces, byte_weights, load_pieces, utf8

SAMPLES = 2
SEED = 7
STEP = 3 << 19  # text bytes whose lattices a task holds at once
_U = np.uint64


_ALL, _ODD, _ODD2 = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def hashed(x, part) -> np.ndarray:
    """Mix a number, or an aligned array, into 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = (x ^ np.asarray(part).astype(np.int64).view(_U)) * _U(_ODD) + _U(_ODD2)
        x = (x ^ (x >> _U(32))) * _U(_ODD2)
        return x ^ (x >> _U(29))


def hashed1(x: int, *parts: int) -> int:
    """``hashed`` of plain numbers, one part after the other."""
    for part in parts:
        x = ((x ^ (part & _ALL)) * _ODD + _ODD2) & _ALL
        x = ((x ^ (x >> 32)) * _ODD2) & _ALL
        x ^= x >> 29
    return x


def uniform(x):
    """(0, 1) from 64-bit hashes, 53 bits of them."""
    return ((x >> _U(11)).astype(float) + 0.5) / float(1 << 53)


def uniform1(x: int, *parts: int) -> float:
    return ((hashed1(x, *parts) >> 11) + 0.5) / float(1 << 53)


class Choices(Lattice):
    """Lattices with, at every node, the posterior probabilities of its edges as a cumulative list."""

    def __init__(self, pieces: Pieces, units: list[str] | pa.Array, logp: np.ndarray):
        super().__init__(pieces, units)
        # backward recursion, as in the base class but for one set of probabilities
        beta = np.full(self.nodes, -np.inf)
        beta[self.base[self.lens] + np.arange(self.n)] = 0.0
        degree = np.zeros(self.nodes, np.int64)
        sources, targets, spelled, steps_ = [], [], [], []
        for o in range(self.longest - 1, -1, -1):
            for length, ranks, ids in self.edges_from(o):
                source, target = self.base[o] + ranks, self.base[o + max(1, length)] + ranks
                step = beta[target] + (logp[ids] if length else byte_weights(pieces, ids, logp[None, :])[0])
                beta[source] = np.logaddexp(beta[source], step)
                degree[source] += 1
                sources.append(source)
                targets.append(target)
                spelled.append(ids if length else -1 - ids)
                steps_.append(step)
        self.first = np.cumsum(degree) - degree
        self.degree = degree
        size = int(degree.sum())
        self.upto, self.logq = np.empty(size), np.empty(size)
        self.target, self.ids = np.empty(size, np.int64), np.empty(size, np.int64)  # ids < 0: code points in bytes
        if size:
            logq = np.concatenate(steps_) - beta[np.concatenate(sources)]
            share = np.exp(logq)
            place, mass, done, at = self.first.copy(), np.zeros(self.nodes), 0, []
            for source in sources:
                to = place[source]
                place[source] = to + 1
                mass[source] += share[done:done + len(source)]
                self.upto[to] = mass[source]
                at.append(to)
                done += len(source)
            at = np.concatenate(at)
            self.logq[at], self.target[at], self.ids[at] = logq, np.concatenate(targets), np.concatenate(spelled)
        self.rank = np.empty(self.n, np.int64)
        self.rank[self.order] = np.arange(self.n)
        self.total = np.empty(self.n)
        self.total[self.order] = beta[:self.n]

    def walk(self, units: np.ndarray, key: np.ndarray):
        """One sampled path per unit, by the unit's hash: edges in order, and where each unit's edges begin."""
        node, active = self.rank[units], np.arange(len(units))
        taken = []
        step = 0
        while len(active):
            u = uniform(hashed(key[active], step))
            at = node[active]
            edge = self.first[at]
            last = edge + self.degree[at] - 1
            up = np.flatnonzero((u >= self.upto[edge]) & (edge < last))
            while len(up):
                edge[up] += 1
                up = up[(u[up] >= self.upto[edge[up]]) & (edge[up] < last[up])]
            taken.append((active, edge))
            node[active] = self.target[edge]
            active = active[self.degree[node[active]] > 0]
            step += 1
        count = np.zeros(len(units), np.int64)
        for which, _ in taken:
            count[which] += 1
        begin = np.concatenate([[0], np.cumsum(count)])
        edges = np.empty(begin[-1], np.int64)
        for k, (which, edge) in enumerate(taken):
            edges[begin[which] + k] = edge
        return edges, begin

    def finish(self, node: int, key: int) -> list[int]:
        """Edges of one sampled path from a node to the end of its unit."""
        out = []
        while self.degree[node]:
            out.append(self.pick(node, (), uniform1(key, len(out))))
            node = int(self.target[out[-1]])
        return out

    def pick(self, node: int, without: tuple[int, ...], u: float) -> int:
        """An edge of the node other than ``without``, in proportion to its probability."""
        edges = [e for e in range(self.first[node], self.first[node] + self.degree[node]) if e not in without]
        mass = np.cumsum(np.exp(self.logq[edges]))
        return edges[min(int(np.searchsorted(mass, u * mass[-1], side="right")), len(edges) - 1)]


def _truncated(location, limit, u):
    """A Gumbel variate at ``location`` that is at most ``limit``."""
    return -np.logaddexp(-limit, np.log(-np.log(u)) - location)


_REACH = 38.0  # a variate from 53 random bits lies less than this above its location
_HEAD = 192


class _Path:
    """An emitted segmentation, and the lazy nodes beside it: at each of its edges from ``start`` on, all others.

    Locations fall along the path, so nodes further than _REACH below the (k + 1)-th largest value
    of the first ones cannot be among the k + 1 largest and are left out.
    """

    def __init__(self, choices: Choices, edges, begin, value, start, key, k):
        self.edges, self.begin, self.value = edges, begin, value
        self.logq = choices.logq[edges]
        self.log_prob = float(self.logq.sum())
        self.before = np.cumsum(self.logq) - self.logq
        end = min(len(edges), start + _HEAD)
        self.beside = np.full(end, -np.inf)
        self.beside[start:] = self._values(np.arange(start, end), key)
        if end < len(edges):
            floor = np.sort(self.beside)[-k - 1] if len(self.beside) > k else -np.inf
            stop = int(np.searchsorted(-self.before, _REACH - floor, side="right"))
            if stop > end:
                self.beside = np.concatenate([self.beside, np.full(stop - end, -np.inf)])
                at = np.arange(end, stop)
                if floor > -np.inf:  # a variate above its location by x needs 1 - u < exp(-x)
                    u = uniform(hashed(_U(key), at))
                    at = at[(1 - u) * (1 - 1e-9) <= np.exp(np.minimum(0.0, self.before[end:stop] - floor))]
                if len(at):
                    self.beside[at] = self._values(at, key)
        self.best = float(self.beside.max()) if len(self.beside) else -np.inf

    def _values(self, at, key):
        with np.errstate(divide="ignore"):
            rest = np.log(np.maximum(0.0, -np.expm1(self.logq[at])))
        u = uniform(hashed(_U(key), at))
        return np.where(rest > -34, _truncated(self.before[at] + rest, self.value, u), -np.inf)


def top_k(choices: Choices, key: int, walks, k: int):
    """The ``k`` segmentations of one text, best perturbed value first, and kappa.

    ``walks``: k sampled paths of the text as (edges, where each unit begins).
    """
    root = -math.log(-math.log(uniform1(key, -2)))
    paths = [_Path(choices, *walks[0], root, 0, hashed1(key, -1, 0), k)]
    excluded: dict[tuple[int, int], tuple[int, ...]] = {}
    while True:
        s = max(range(len(paths)), key=lambda i: paths[i].best)
        parent, value, number = paths[s], paths[s].best, len(paths)
        if number == k or value == -np.inf:
            return paths, value
        t = int(parent.beside.argmax())
        node = int(np.searchsorted(choices.first, parent.edges[t], side="right") - 1)
        edge = choices.pick(node, excluded.get((s, t), (int(parent.edges[t]),)), uniform1(key, -3, number))
        without = (*excluded.get((s, t), (int(parent.edges[t]),)), edge)
        excluded[s, t] = without
        left = [e for e in range(choices.first[node], choices.first[node] + choices.degree[node]) if e not in without]
        parent.beside[t] = -np.inf
        if left:
            location = float(parent.logq[:t].sum() + np.logaddexp.reduce(choices.logq[left]))
            parent.beside[t] = _truncated(location, value, uniform1(key, -4, number))
        parent.best = float(parent.beside.max())
        # the rest of the unit is sampled here; later units follow the walk of this number
        tail = choices.finish(int(choices.target[edge]), hashed1(key, -5, number))
        unit = int(np.searchsorted(parent.begin, t, side="right") - 1)
        edges, begin = walks[number]
        head = np.concatenate([parent.edges[:t], [edge], tail]).astype(np.int64)
        begin = np.concatenate([parent.begin[:unit + 1], begin[unit + 1:] - begin[unit + 1] + len(head)])
        paths.append(_Path(choices, np.concatenate([head, edges[walks[number][1][unit + 1]:]]), begin, value, t + 1,
                           hashed1(key, -1, number), k))


def _ids(choices: Choices, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of a run of edges, bytes spelled out, and the number of ids per edge."""
    ids = choices.ids[edges]
    raw = ids < 0
    if not raw.any():
        return ids, np.ones(len(ids), np.int64)
    spelled = {p: choices.pieces.byte_ids[list(utf8(int(-1 - p)))] for p in np.unique(ids[raw]).tolist()}
    count = np.ones(len(ids), np.int64)
    count[raw] = [len(spelled[p]) for p in ids[raw].tolist()]
    out = np.repeat(ids, count)
    at = np.cumsum(count) - count
    for i in np.flatnonzero(raw).tolist():
        out[at[i]:at[i] + count[i]] = spelled[int(ids[i])]
    return out, count


_SCHEMA = "rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


def encode_batch(pieces: Pieces, logp: np.ndarray, texts: pa.Array, keys: np.ndarray, k: int, seed: int):
    """The sampled segmentations of a string array: (row, rank, ids of all, ids of each, log_prob, perturbed,
    log_inclusion)."""
    lists = pc.split_pattern(texts, " ")
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    codes, distinct = encoded(lists.flatten())
    choices = Choices(pieces, distinct, logp)
    ends = np.cumsum(size)
    key = hashed(hashed(np.zeros(len(keys), _U), np.full(len(keys), seed)), keys)
    place = hashed(np.repeat(key, size), np.arange(len(codes)) - np.repeat(ends - size, size))
    walks = [choices.walk(codes, hashed(place, j)) for j in range(k)]
    base = np.add.reduceat(choices.total[codes], ends - size) if len(codes) else np.zeros(0)
    edges, out = [], []
    for row in range(len(texts)):
        a, b = int(ends[row] - size[row]), int(ends[row])
        own = [(e[begin[a]:begin[b]], begin[a:b + 1] - begin[a]) for e, begin in walks]
        paths, kappa = top_k(choices, int(key[row]), own, k)
        for rank, path in enumerate(paths, 1):
            x = path.log_prob - kappa
            inclusion = x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 50.0))))
            edges.append(path.edges)
            out.append((row, rank, path.log_prob + base[row], path.value, inclusion))
    ids, count = _ids(choices, np.concatenate(edges))
    first = np.append(0, np.cumsum([len(e) for e in edges]))
    row, rank, log_prob, value, inclusion = (np.array(x) for x in zip(*out))
    return row, rank, ids, np.diff(np.append(0, np.cumsum(count))[first]), log_prob, value, inclusion


def piece_bytes(pieces: Pieces) -> pa.Array:
    """The bytes that each piece spells."""
    return pa.array(_values(pieces), pa.large_binary())


def round_trips(spelled: pa.Array, texts: pa.Array, row: np.ndarray, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decodes segmentations (``count`` of ``ids`` each, of the texts ``row``): their bytes without the leading mark, and
    whether they are the text's, byte by byte."""
    pieces = spelled.take(pa.array(ids))
    bounds = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1)
    decoded = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    at = (bounds - bounds[0])[np.append(0, np.cumsum(count))]
    own = np.diff(at)
    wanted = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())).take(pa.array(row))
    ends = np.frombuffer(wanted.buffers()[1], np.int64, len(wanted) + 1)
    same = np.diff(ends) == own
    if same.all():
        differs = np.flatnonzero(decoded != np.frombuffer(wanted.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]])
        same[np.searchsorted(at, differs, side="right") - 1] = False
    else:  # of different lengths: one by one
        same &= np.array([decoded[at[i]:at[i + 1]].tobytes() == wanted[i].as_py().encode("utf-8", "surrogatepass") for i in range(len(row))])
    return own - 1, same


def encode(df: DataFrame, text: str = "text", key: str = "doc_id", k: int = SAMPLES, seed: int = SEED,
           vocabulary: str = VOCABULARY, check: bool = False) -> DataFrame:
    """(key, rank, ids, log_prob, perturbed, log_inclusion): up to ``k`` rows per non-null text.

    ``log_prob`` is the natural-log unigram probability of the segmentation, ``perturbed`` its
    Gumbel-perturbed value among all segmentations of the text. With ``check`` every segmentation is decoded
    again, and two columns follow: decoded_bytes, and round_trip, whether these are the text's.
    """
    pieces = load_pieces(vocabulary)
    logp = pieces.log_probs()
    source = df.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(F.col(f"`{key}`")).alias("_hash"),
                       F.col(f"`{text}`").alias("_text")).where("_text IS NOT NULL")
    schema = f"_key {source.schema['_key'].dataType.simpleString()}, {_SCHEMA}" + (", decoded_bytes long, round_trip boolean" if check else "")
    spelled = piece_bytes(pieces) if check else None

    def run(batches):
        for batch in steps(batches, "_text", STEP):
            hashes = batch.column("_hash").to_numpy(zero_copy_only=False)
            texts = strings(batch.column("_text"))
            row, rank, ids, size, log_prob, value, inclusion = encode_batch(pieces, logp, texts, hashes, k, seed)
            checked = [] if spelled is None else [pa.array(x) for x in round_trips(spelled, texts, row, ids, size)]
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(row, pa.int64())), pa.array(rank, pa.int32()), listed,
                 pa.array(log_prob), pa.array(value), pa.array(inclusion), *checked],
                ["_key", "rank", "ids", "log_prob", "perturbed", "log_inclusion", *["decoded_bytes", "round_trip"][:len(checked)]])

    return source.mapInArrow(run, schema).withColumnRenamed("_key", key)


def _values(pieces: Pieces) -> list[bytes]:
    """The bytes that each piece spells."""
    values = getattr(pieces, "_bytes", None)
    if values is None:
        values = [p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p in pieces.pieces]
        for b, i in enumerate(pieces.byte_ids.tolist()):
            values[i] = bytes([b])
        pieces._bytes = values
    return values


def decode_ids(pieces: Pieces, ids) -> str:
    """The text that a list of piece ids spells."""
    values = _values(pieces)
    return b"".join([values[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def decode(df: DataFrame, ids: str = "ids", into: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Append the text spelled by a column of piece ids; null ids give null."""
    pieces = load_pieces(vocabulary)
    kept = [c for c in df.columns if c != into]
    source = df.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches):
        for batch in batches:
            texts = [None if x is None else decode_ids(pieces, x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, into])

    return source.mapInArrow(run, source.select("*", F.lit("").alias(into)).schema)


def op2_gumbel_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), check=True).withColumn("n_pieces", F.size("ids"))
