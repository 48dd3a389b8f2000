"""Exact n-gram Jaccard self-join by parity sketches, and its connected components.

A text's set holds the 64-bit hashes of its distinct five-word shingles (A-Z
lowered; with one to four words the whole sequence is the one shingle). Equal
sets form one class, known by a 64-bit digest; classes are what is joined.

Two sets link when 100 |A & B| >= 80 |A | B|, which bounds their symmetric
difference by (|A| + |B|) / 9. Per band of sizes, the hash range is cut into
blocks, more of them than that bound; every token is XOR-ed into the sketch of
its block. One differing token changes one block, so the number of differing
blocks (the Hamming distance over blocks) is at most the symmetric difference,
and by the pigeonhole principle two linked sets agree on a block. A set with at
least as many non-empty blocks as the bound plus one agrees on a non-empty one;
a set that falls short repeats with another hash, so both partners meet there.
Sets near the upper end of a band also join the next band.

Blocks meet in Spark: packed by hash into ``spark.sql.shuffle.partitions``
buckets and matched in tasks. A block that many sets of one task share is
dealt out there (its first set goes to the bucket, the others to any task).
Of a set's e non-empty blocks only the d + 1 that the fewest sets have are kept, d being the bound (blocks that were
dealt out come last; ties go by block): of the blocks
that a partner lacks there are at most d, so the rarest block that both have is among the kept of either.
A block of a common passage is thus dropped by all sets that have enough blocks of their own.
Candidates are verified in three rounds:

1. every set against the first of each of its blocks; links give components;
2. in blocks that still hold several components, sets outside the block's largest one against
   ``PIVOTS`` sets of that one: near copies that missed the first set of their block mostly link here;
3. in blocks that hold several components even so, sets of different components
   only, those of the largest component against the others. All other pairs are
   connected already; what is left are sets that are alike, but below the threshold.

Each round drops pairs whose bit sketches (one parity bit per token) differ in
more bits than the symmetric difference may have, and verifies the rest on whole
shingle sets, read again from the texts (a row is known by its id and a hash of its text): the sets of a candidate's partners come to
its own, and a candidate with many partners is dealt out to many groups.
Components come from repeated star contraction on the links.

Defined results: null text or one without words has an empty set, links with
nothing and is its own component; rows with a null ``doc_id`` get a null
component and take no part in links; repeated rows come out once each. Hash
collisions (64 bits within a set, for sets and for blocks) are not resolved,
but a collision of blocks only costs a verification.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import left_join_dim
from .common import encoded, release, steps, stored, strings, table, words_of

SHINGLE = 5
LOCAL_GROUP = 16      # sets of one task on one block before they are pre-aggregated
PARTNERS = 256        # partners of one set that are verified in one group
STEP = 1 << 20        # text bytes that a task works on at once
FILTER_BITS = 1 << 26 # bits of the filter that spares texts without candidates a shuffle
BATCH_ROWS = 400      # texts or sets that a task holds at once
BITS = 16             # bits of a sketch per difference that linked sets may have
ATTEMPTS = 4
MANY = 1 << 60        # stands for the size of a block that was dealt out
PIVOTS = 8            # sets of a block's largest component that the others are tried on first
HOT_SHARE = 5e-3      # share of the rows from which a block is salted
_U = np.uint64
_C1, _C2, _C3 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)
_LOW = _U(127)        # key bits that hold the band and the mark of a pre-aggregated block


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix finaliser)."""
    x = (x ^ (x >> _U(30))) * _C1
    x = (x ^ (x >> _U(27))) * _C2
    return x ^ (x >> _U(31))


# Size bands: 1, 2, 3, 4, 6, 9, 13, ...; band j holds sizes BANDS[j] <= n < BANDS[j + 1].
BANDS = [1]
while BANDS[-1] < 1 << 40:
    BANDS.append(max(BANDS[-1] + 1, BANDS[-1] * 3 // 2))
_BANDS = np.array(BANDS, np.int64)


def bound(band: np.ndarray) -> np.ndarray:
    """The largest symmetric difference of linked sets whose larger one is in the band."""
    return 2 * (_BANDS[band + 1] - 1) // 9


def blocks(band: np.ndarray) -> np.ndarray:
    d = bound(band)
    return np.where(d > 0, np.ceil(1.25 * (d + 1)).astype(np.int64) + 6, 0)


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted by row and hash; their rows; set size per row."""
    n = len(text)
    flat, rows = words_of(text)
    if not len(flat):
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(n, np.int64)
    codes, distinct = encoded(flat)
    h = pd.util.hash_array(distinct.to_numpy(zero_copy_only=False).astype(object), categorize=False)[codes]
    count = np.bincount(rows, minlength=n)
    with np.errstate(over="ignore"):
        roll = np.full(len(h), _C3)
        whole = len(h) - SHINGLE + 1
        value = np.zeros(0, _U)
        owner = np.zeros(0, np.int64)
        if whole > 0:
            roll = np.full(whole, _C3)
            for k in range(SHINGLE):
                roll = roll * _C2 + h[k:k + whole]
            inside = rows[:whole] == rows[SHINGLE - 1:]
            value, owner = mixed(roll[inside]), rows[:whole][inside]
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        if len(short):
            first = np.cumsum(count) - count
            extra = np.empty(len(short), _U)
            for i, r in enumerate(short.tolist()):
                x = _U(count[r]) + _C1
                for k in range(count[r]):
                    x = x * _C2 + h[first[r] + k]
                extra[i] = x
            value, owner = np.concatenate([value, mixed(extra)]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, owner, np.bincount(owner, minlength=n)


def digests(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One 64-bit number per set, as signed; 0 for empty sets."""
    out = np.zeros(len(size), _U)
    full = np.flatnonzero(size)
    if len(full):
        starts = (np.cumsum(size) - size)[full]
        with np.errstate(over="ignore"):
            total = np.add.reduceat(mixed(value + _C3), starts)
            out[full] = mixed(total + size[full].astype(_U) * _C1)
    return out.view(np.int64)


def _block_keys(value, owner, band, attempt):
    """Keys of the non-empty blocks: (set index, key). ``value`` is sorted by owner and hash."""
    m = blocks(band)[owner].astype(_U)
    if attempt:
        value = mixed(value ^ mixed(np.array([attempt], _U)))
        order = np.lexsort((value, owner))
        value, owner, m = value[order], owner[order], m[order]
    block = ((value >> _U(32)) * m) >> _U(32)
    edge = np.ones(len(value), bool)
    edge[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])
    at = np.flatnonzero(edge)
    with np.errstate(over="ignore"):
        parity = np.bitwise_xor.reduceat(mixed(value + _C1), at)
        who = owner[at]
        j = band[who].astype(_U)
        key = mixed(mixed(parity + block[at] * _C2) + (j + _U(64 * attempt)) * _C3)
    return who, (key & ~_LOW) | (j << _U(1))


def sketch_keys(value: np.ndarray, owner: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All block keys of all sets: (set index, key)."""
    return counted_keys(value, owner, size)[:2]


def counted_keys(value: np.ndarray, owner: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All block keys of all sets: (set index, key), and per set and band (its own, the next) how many keys it has
    there, 0 if they are too few to leave any out."""
    own = np.searchsorted(_BANDS, size, side="right") - 1
    enough = np.zeros((2, len(size)), np.int64)
    out_who, out_key = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for ahead in (0, 1):
        band = np.maximum(own, 0) + ahead
        take = (size > 0) & (bound(band) > 0)
        if ahead:
            take &= 5 * size >= 4 * _BANDS[band]
        left = take
        for attempt in range(ATTEMPTS):
            rows = left[owner]
            if not rows.any():
                break
            who, key = _block_keys(value[rows], owner[rows], band, attempt)
            out_who.append(who)
            out_key.append(key)
            have = np.bincount(who, minlength=len(size))
            if not attempt:
                enough[ahead] = np.where(have > bound(band), have, 0)
            left = left & (have <= bound(band))
        rest = np.flatnonzero(left)
        out_who.append(rest)  # never so in practice: they all meet in one block
        out_key.append((mixed(band[rest].astype(_U) + _C2) & ~_LOW) | (band[rest].astype(_U) << _U(1)))
    return np.concatenate(out_who), np.concatenate(out_key), enough


def _longs(band: int) -> int:
    """Length of a band's bit sketches: BITS bits per allowed difference, so that few differences fall
    on one bit and cancel, and the distance of two sketches is close to that of the sets."""
    return int(BITS * (bound(np.array([band]))[0] + 1) // 64 + 1)


def _parity_bits(value: np.ndarray, band: int) -> np.ndarray:
    """One parity bit per token, 64 to a long."""
    longs = _longs(band)
    at = (mixed(value ^ _C2) % _U(64 * longs)).astype(np.int64)
    bits = (np.bincount(at, minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


_PACKED = "p int, kind int, a binary, b binary, c binary, d binary, bits array<binary>"
_NAMES = ["p", "kind", "a", "b", "c", "d", "bits"]


def _row(p, kind, a, b, c=None, d=None, bits=None):
    return (p, kind, a.tobytes(), b.tobytes(), b"" if c is None else c.tobytes(), b"" if d is None else d.tobytes(), bits)


def _short(key: np.ndarray) -> np.ndarray:
    """Keys in seven bytes: the highest byte is left out."""
    return np.ascontiguousarray(key.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :7]


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(raw, np.uint8).reshape(-1, 7)
    return out.view("<u8").reshape(-1).astype(_U)


def _packed(batches, parts: int):
    """Texts to packed rows: kind 0 block keys and classes; kind 1 those of blocks that are dealt out;
    kind 2 documents, their classes, sizes, text hashes, bands and numbers of keys."""
    turn = 0
    for batch in steps(batches, limit=STEP):
        value, owner, size = shingle_sets(strings(batch.column("text")))
        node = digests(value, size)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        turn += 1
        ends = np.cumsum(size)
        own = np.searchsorted(_BANDS, size, side="right") - 1
        bits = [None if not n else b"".join(_parity_bits(value[e - n:e], j + k).tobytes() for k in (0, 1) if not k or _joins_next(n, j))
                for n, e, j in zip(size.tolist(), ends.tolist(), own.tolist())]
        lane = lambda: (turn * 7919 + int(abs(node[0])) % parts) % parts
        # one set per class
        _, first = np.unique(node, return_index=True)
        mine = np.zeros(len(size), bool)
        mine[first] = True
        mine &= size > 0
        rows = mine[owner]
        who, key, enough = counted_keys(value[rows], owner[rows], np.where(mine, size, 0))
        out = [_row(lane(), 2, np.asarray(ids, np.int64), node, size.astype(np.int64),
                    np.stack([batch.column("row").to_numpy(), own, *enough]), bits)]
        key &= _U((1 << 56) - 1)
        nodes = node[who]
        order = np.lexsort((nodes, key))
        key, nodes = key[order], nodes[order]
        run = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        length = np.diff(np.append(run, len(key)))
        big = np.repeat(length > LOCAL_GROUP, length)
        lead = np.zeros(len(key), bool)
        lead[run] = True
        tied = big & ~lead
        if tied.any():
            marked, members = key[tied], nodes[tied]
            for s in range(0, len(marked), 1 << 16):
                turn += 1
                cut = slice(s, s + (1 << 16))
                out.append(_row(lane(), 1, marked[cut] | _U(1), members[cut]))
        key = np.where(big, key | _U(1), key)[~tied]
        nodes = nodes[~tied]
        part = (mixed(key >> _U(7)) % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in range(parts):
            take = order[cuts[p]:cuts[p + 1]]
            if len(take):  # a table of the classes, and their places in it
                classes, index = np.unique(nodes[take], return_inverse=True)
                index = index.astype(np.uint16 if len(classes) <= 1 << 16 else np.uint32)
                out.append(_row(p, 0, _short(key[take]), index, classes))
        p, kind, *blobs, bits = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(kind, pa.int32()), *[pa.array(x, pa.binary()) for x in blobs],
             pa.array(bits, pa.list_(pa.binary()))], _NAMES)


_FOUND = "kind int, a long, b long, c long, d long, own long, e0 long, e1 long, bits binary"


def _rows(kind, a, b, c=None, d=None, bits=None, limit=1 << 16):
    for s in range(0, len(a), limit):
        cut = slice(s, s + limit)
        n = len(a[cut])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(a[cut].view(np.int64)), pa.array(b[cut].view(np.int64)),
             *[pa.nulls(n, pa.int64()) if x is None else pa.array(x[cut]) for x in (c, *([None] * 4 if d is None else d))],
             pa.nulls(n, pa.binary()) if bits is None else bits.slice(s, limit)],
            ["kind", "a", "b", "c", "d", "own", "e0", "e1", "bits"])


def _matched(batches):
    """Packed rows of one bucket to rows: kind 0 (block, class, sets of the block, MANY if it was dealt out) of shared blocks, kind 2 (doc_id, class, size, text
    hash, band, numbers of keys, bit sketches)."""
    keys, nodes = [], []
    for batch in batches:
        for kind, a, b, c, d, bits in zip(*(batch.column(k) for k in ("kind", "a", "b", "c", "d", "bits"))):
            kind, a, b, c = kind.as_py(), a.as_py(), b.as_py(), np.frombuffer(c.as_py(), np.int64)
            if kind == 0:
                key = _long(a)
                keys.append(key)
                nodes.append(c[np.frombuffer(b, np.uint16 if len(b) == 2 * len(key) else np.uint32)])
            elif kind == 1:
                a, b = np.frombuffer(a, _U), np.frombuffer(b, np.int64)
                yield from _rows(0, a | _U(1), b, np.full(len(a), MANY))
            else:
                yield from _rows(2, np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), c,
                                 np.frombuffer(d.as_py(), np.int64).reshape(4, -1), bits.values)
    if keys:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((node, key >> _U(1)))
        key, node = key[order], node[order]
        block = key >> _U(1)
        new = np.concatenate([[True], (block[1:] != block[:-1]) | (node[1:] != node[:-1])])
        marked = np.maximum.reduceat((key & _U(1)).astype(np.int8), np.flatnonzero(new))
        block, node = block[new], node[new]
        run = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        length = np.diff(np.append(run, len(block)))
        shared = (length > 1) | (np.maximum.reduceat(marked, run) > 0)
        live = np.repeat(shared, length)
        # all sets of a block are here, unless it was dealt out
        held = np.where(np.maximum.reduceat(marked, run) > 0, MANY, length)
        yield from _rows(0, (block[live] << _U(1)) | _U(1), node[live], np.repeat(held, length)[live])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 80 * (len(a) + len(b) - common)


def _joins_next(n: int, own: int) -> bool:
    """Whether a set of ``n`` tokens of band ``own`` can link with one of the next band."""
    return 5 * n >= 4 * BANDS[own + 1]


def _bits_of(n: int, blob: bytes, band: int) -> np.ndarray:
    """The bit sketch of a set of ``n`` tokens under a band: its own or the next."""
    own = int(np.searchsorted(_BANDS, n, side="right")) - 1
    longs = _longs(own)
    bits = np.frombuffer(blob, _U)
    return bits[:longs] if band == own else bits[longs:]


def _near(batches):
    """Pairs whose sizes and bit sketches let them link."""
    names = ("x", "y", "nx", "ny", "bx", "by")
    for batch in batches:
        keep = []
        for _, _, n, m, a, b in zip(*(batch.column(c).to_pylist() for c in names)):
            band = int(np.searchsorted(_BANDS, max(n, m), side="right")) - 1
            keep.append(5 * min(n, m) >= 4 * max(n, m)
                        and 9 * int(np.bitwise_count(_bits_of(n, a, band) ^ _bits_of(m, b, band)).sum()) <= n + m)
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("x").filter(keep), batch.column("y").filter(keep)], ["x", "y"])


def near_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (x, y) that pass the bit sketches of ``classes`` (node, n, bits)."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias("n" + s), F.col("bits").alias("b" + s))
    both = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "nx", "ny", "bx", "by")
    return both.mapInArrow(_near, "x long, y long")


def _tested(batches):
    """Groups in order (x, part): the set of x, then those of its partners; the pairs that link."""
    group, own = None, None
    for batch in (b.slice(s, 256) for b in batches for s in range(0, b.num_rows, 256)):
        out = []
        for x, part, partner, blob in zip(*(batch.column(c).to_pylist() for c in ("x", "part", "partner", "shingles"))):
            value = np.frombuffer(blob, _U)
            if partner is None:
                group, own = (x, part), value
            elif group == (x, part) and linked(own, value):
                out.append((x, partner))
        x, y = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])


def verify(pairs: DataFrame, classes: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """The pairs (x, y) whose whole sets link. ``classes``: (node, doc_id, row), a row of ``known`` that has the set."""
    degree = pairs.groupBy("x").agg((F.floor(F.count(F.lit(1)) / PARTNERS) + 1).alias("parts"))
    asked = (pairs.join(degree, "x")
             .select(F.col("y").alias("node"), "x", F.pmod(F.xxhash64("y"), F.col("parts")).alias("part"), F.col("y").alias("partner")))
    own = degree.select(F.col("x").alias("node"), "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                        F.lit(None).cast("long").alias("partner"))
    wanted = stored(asked.union(own).groupBy("node").agg(F.collect_list(F.struct("x", "part", "partner")).alias("groups"))
                    .join(classes.select("node", "doc_id", "row"), "node"), name + "-wanted")
    release(known.sparkSession)
    # A bitmap of fixed size spares the texts of other rows the shuffle; the join decides.
    place = F.pmod(F.xxhash64("doc_id", "row"), F.lit(FILTER_BITS))
    maps = (wanted.select(place.alias("h")).groupBy(F.floor(F.col("h") / 32768).cast("int").alias("at"))
            .agg(F.bitmap_construct_agg(F.pmod("h", F.lit(32768))).alias("bits")).toArrow())
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for at, blob in zip(maps["at"].to_pylist(), maps["bits"].to_pylist()):
        bits[at] = np.frombuffer(blob, np.uint8)
    bits = bits.reshape(-1)

    def few(batches):
        for batch in batches:
            h = batch.column("h").to_numpy()
            held = pa.array(((bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1).astype(bool))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(held) for c in ("doc_id", "row", "text")], ["doc_id", "row", "text"])

    def sets_of(batches):
        for batch in steps(batches, limit=STEP):
            value, _, size = shingle_sets(strings(batch.column("text")))
            node, ends = digests(value, size), np.cumsum(size)
            out = []
            for i, (right, groups) in enumerate(zip(batch.column("node").to_pylist(), batch.column("groups").to_pylist())):
                if node[i] != right:
                    raise RuntimeError("rows changed between two scans of the documents")
                blob = value[ends[i] - size[i]:ends[i]].tobytes()
                out += [(g["x"], g["part"], g["partner"], blob) for g in groups]
            for s in range(0, len(out), 512):
                x, part, partner, blob = zip(*out[s:s + 512])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(part, pa.int64()), pa.array(partner, pa.int64()),
                                                  pa.array(blob, pa.binary())], ["x", "part", "partner", "shingles"])

    # equal rows come once; the combining aggregate keeps many of them from one task
    texts = (known.select("doc_id", "row", "text", place.alias("h")).mapInArrow(few, "doc_id long, row long, text string")
             .groupBy("doc_id", "row").agg(F.first("text").alias("text")).join(wanted, ["doc_id", "row"]))
    groups = (texts.select("node", "groups", "text").mapInArrow(sets_of, "x long, part long, partner long, shingles binary")
              .repartition("x", "part").sortWithinPartitions("x", "part", F.col("partner").asc_nulls_first()))
    return stored(groups.mapInArrow(_tested, "x long, y long"), name, BATCH_ROWS)


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node of each component, by alternating star contraction."""
    edges = stored(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                   .where("u != v").distinct(), "edges")
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(floor, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(floor.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = stored(small, "edges")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
                        F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20))).alias("s")).first()
        if now == state:
            break
        state = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct())


def _sketches(batches):
    for batch in batches:
        out = []
        for node, n, blob in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "bits"))):
            own = int(np.searchsorted(_BANDS, n, side="right")) - 1
            out += [(node, j, n, _bits_of(n, blob, j).view(np.int64)) for j in (own, own + 1) if j == own or _joins_next(n, own)]
        node, j, n, bits = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(j, pa.int32()), pa.array(n, pa.int64()),
                                          pa.array(bits, pa.list_(pa.int64()))], ["node", "band", "n", "bits"])


def _crossing(shared: DataFrame, comps: DataFrame, classes: DataFrame, tested: DataFrame, pivots: int | None = None) -> DataFrame:
    """Untested pairs of different components that share a block and whose bit sketches are near enough; with ``pivots``
    only those with so many sets of a block's largest component."""
    member = (shared.join(comps, "node", "left")
              .select("block", "node", F.coalesce("comp", "node").alias("comp")))
    open_blocks = (member.groupBy("block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .where("lo != hi").select("block"))
    member = stored(member.join(open_blocks, "block"), "open")
    largest = (member.groupBy("block", "comp").agg(F.count(F.lit(1)).alias("k"))
               .groupBy("block").agg(F.max_by("comp", F.struct("k", "comp")).alias("main")))
    band = F.shiftrightunsigned("block", 1).bitwiseAND(63).cast("int")
    bits = (classes.where("bits IS NOT NULL").select("node", "n", "bits")
            .mapInArrow(_sketches, "node long, band int, n long, bits array<long>"))
    member = member.join(largest, "block").withColumn("band", band).join(bits, ["node", "band"])
    left = member.where("comp != main").select("block", *[F.col(c).alias("l_" + c) for c in ("node", "comp", "n", "bits")])
    if pivots:
        drawn = Window.partitionBy("block").orderBy(F.xxhash64("node"), "node")  # cut to the first map-side
        member = member.where("comp = main").withColumn("_place", F.row_number().over(drawn)).where(F.col("_place") <= pivots)
    right = member.select("block", "main", *[F.col(c).alias("r_" + c) for c in ("node", "comp", "n", "bits")])
    apart = F.aggregate(F.zip_with("l_bits", "r_bits", lambda a, b: F.bit_count(a.bitwiseXOR(b))),
                        F.lit(0), lambda total, k: total + k)
    near = left.join(right, "block").where(
        (F.col("l_comp") != F.col("r_comp")) & ((F.col("r_comp") == F.col("main")) | (F.col("l_node") < F.col("r_node")))
        & (5 * F.least("l_n", "r_n") >= 4 * F.greatest("l_n", "r_n"))
        & (9 * apart <= F.col("l_n") + F.col("r_n")))
    pairs = near.select(F.least("l_node", "r_node").alias("x"), F.greatest("l_node", "r_node").alias("y")).distinct()
    return pairs.join(tested, ["x", "y"], "left_anti")


def _rarest(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Of (block, node, f), f the sets of the block, those that any linked pair can do with, in blocks that several
    sets keep, with the first of these: (block, node, pivot)."""
    band = F.shiftrightunsigned("block", 1).bitwiseAND(63).cast("int")
    held = shared.withColumn("band", band).join(classes.select("node", "own", "e0", "e1"), "node")
    mine = Window.partitionBy("node", "band")
    keys = F.when(F.col("band") == F.col("own"), F.col("e0")).otherwise(F.col("e1"))
    bounds = F.array(*[F.lit(int(d)) for d in bound(np.arange(64))])
    # blocks of this set alone are not listed, and come before all others
    rank = F.row_number().over(mine.orderBy("f", "block")) + keys - F.count(F.lit(1)).over(mine)
    held = held.select("block", "node", "f", (keys == 0).alias("short"), rank.alias("rank"), (F.get(bounds, F.col("band")) + 1).alias("most"))
    kept = stored(held.where("f > 1 AND (short OR rank <= most)").select("block", "node"), "kept")
    firsts = (kept.groupBy(F.col("block").alias("_block")).agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    return left_join_dim(kept, firsts, "block", "_block", hot_fraction=HOT_SHARE).where("pivot IS NOT NULL")


def shared_blocks(known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (doc_id, text, row): (doc_id, node, n) per document, the classes of equal sets, and (block, node, pivot) of blocks
    that several classes keep."""
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = known.mapInArrow(lambda batches: _packed(batches, parts), _PACKED)
    found = stored(packed.repartitionById(parts, F.col("p")).mapInArrow(_matched, _FOUND), "blocks", BATCH_ROWS)
    release(known.sparkSession)
    docs = found.where("kind = 2").select(F.col("a").alias("doc_id"), F.col("b").alias("node"), F.col("c").alias("n"))
    firsts = (found.where("kind = 2 AND c > 0").groupBy(F.col("b").alias("node"))
              .agg(F.min(F.struct(F.col("a").alias("doc_id"), F.col("d").alias("row"))).alias("f"), F.max("c").alias("n"),
                   F.max("own").alias("own"), F.max("e0").alias("e0"), F.max("e1").alias("e1"), F.any_value("bits").alias("bits")))
    classes = stored(firsts.select("node", "f.*", "n", "own", "e0", "e1", "bits"), "classes")
    release(known.sparkSession)
    every = found.where("kind = 0").select(F.col("a").alias("block"), F.col("b").alias("node"), F.col("c").alias("f")).distinct()
    shared = stored(_rarest(every, classes), "shared")
    release(known.sparkSession)
    return docs, classes, shared


def link_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of (doc_id, text). The texts are read more than once."""
    known = documents.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("row"))
    docs, classes, shared = shared_blocks(known)
    candidates = shared.where("node != pivot").select(F.col("pivot").alias("x"), F.col("node").alias("y")).distinct()
    tested = stored(near_pairs(candidates, classes), "pairs")
    links = verify(tested, classes, known, "links")
    shared = shared.drop("pivot")
    for step, pivots in (("pivots", PIVOTS), ("crossing", None)):
        comps = components(links)
        crossing = stored(_crossing(shared, comps, classes, tested, pivots), step)
        release(documents.sparkSession)
        links = stored(links.union(verify(crossing, classes, known, step + "-links")), "links")
        tested = stored(tested.union(crossing), "tested")
        release(documents.sparkSession)
    comps = stored(components(links), "components")
    named = (classes.select("node", "doc_id").join(comps, "node", "left")
             .select("node", "doc_id", F.coalesce("comp", "node").alias("comp")))
    lowest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    label = named.join(lowest, "comp").select("node", "component_id")
    out = docs.join(label, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    orphans = documents.where("doc_id IS NULL").select("doc_id", "text")

    def sizes(batches):
        for batch in steps(batches, limit=STEP):
            size = shingle_sets(strings(batch.column("text")))[2]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(size), pa.int64()), pa.array(size.astype(np.int64)),
                                              pa.nulls(len(size), pa.int64())], ["doc_id", "n_shingles", "component_id"])

    return out.union(orphans.mapInArrow(sizes, "doc_id long, n_shingles long, component_id long"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
