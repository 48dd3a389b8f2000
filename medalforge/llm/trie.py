"""Prefix trie of conversations: which turns they share from the start, and what sharing them saves.

Every distinct prefix of turns (role, text) is a node. ``prefix_nodes`` returns one row per node of
sequences of turns: smallest member, depth, smallest member of the parent, members, children, leaves
below, bytes saved below if each node's last text is stored once, and a digest of the members that end there.

A turn is known by the MD5 of role and text, and a sequence is cut into blocks of ``BLOCK`` turns, a block being
the joined digests, so a conversation of any length is many rows. Blocks are sorted into ranges of
(prefix before the block, digests, id); runs of at most ``SHARD`` rows are the range shards. A shard
encodes its digests by a dictionary of its own, inserts its distinct sequences into a ternary search tree,
medians first, which keeps the trees of siblings balanced, and goes over the nodes without recursion,
last made first, to add members, leaves and savings to the parents.

Only prefixes of a shard's first and last sequence can lie in other shards too. These boundary nodes
come out with what they have outside other boundary nodes; their parts are added up by node, and
each boundary node adds its share to all its boundary ancestors. Copies of one conversation, however many,
therefore spread over shards; the digest of their ids streams in order through one task.

Where blocks follow blocks, the later ones are gone through first: what a conversation
stands for as a node's smallest member there (savings, a leaf, children of the block's root) is then a weight of its
row in the earlier blocks.

Defined results: rows without conv_id take no part; null roles and texts are empty; rows of
a turn go by role, by the first 32 characters of the text and by its MD5; extra columns do not matter; an empty
table has no nodes. Different turns of one MD5 are not told apart, nor prefixes of whole blocks of one 128-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import left_join_dim
from .common import stored, table

BLOCK = 64
SHARD = 4096
_WIDTH = 16
FINAL, OPEN, BOUNDARY, ENDS = 0, 1, 2, 3  # a node; one whose parent is a boundary node; part of a boundary node; ids that end there
_NODE = ("kind int, block long, depth long, id binary, parent_id binary, parent_conv long, conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved long, size long, going long, root_conv long, path array<binary>, ends string, shard long")
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}
_FIELDS = [(f.split()[0], _TYPES[f.split()[1]]) for f in _NODE.split(", ")]
_NOTHING = hashlib.sha256().hexdigest()


class TernaryTree:
    """Trie of code sequences; the children of a node are a binary search tree by code."""

    def __init__(self):
        # node 0 is the root; a node's parent has a smaller number
        self.code, self.low, self.high, self.down = [-1], [0], [0], [0]
        self.parent, self.depth = [-1], [0]

    def _new(self, code: int, parent: int) -> int:
        self.code.append(code)
        self.low.append(0)
        self.high.append(0)
        self.down.append(0)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.code) - 1

    def insert(self, sequence) -> int:
        """The node of a sequence, made if need be."""
        node = 0
        for code in sequence:
            links, at = self.down, node
            while links[at]:
                at = links[at]
                if code == self.code[at]:
                    break
                links = self.low if code < self.code[at] else self.high
            else:
                links[at] = new = self._new(code, node)
                at = new
            node = at
        return node


def medians_first(n: int) -> Iterator[int]:
    """0 to n-1, the middle one first, then those of both halves, and so on."""
    spans = [(0, n)]
    for low, high in spans:
        if low < high:
            middle = (low + high) >> 1
            yield middle
            spans += [(low, middle), (middle + 1, high)]


def _group_nodes(root: str, block: int, rows: list[tuple], is_first: bool, is_last: bool, shard: int) -> Iterator[tuple]:
    """Node rows of one block root's sorted rows (key, sizes, conv, continues, weights of children, leaves, savings, root_conv)."""
    keys, members = [], []
    for key, group in groupby(rows, key=lambda r: r[0]):
        keys.append(key)
        members.append(list(group))
    digests = np.frombuffer(b"".join(keys), f"S{_WIDTH}")
    _, codes = np.unique(digests, return_inverse=True)  # dictionary of the shard
    codes = codes.ravel().tolist()
    starts = np.append(0, np.cumsum([len(k) // _WIDTH for k in keys])).tolist()
    tree, at = TernaryTree(), [0] * len(keys)
    for i in medians_first(len(keys)):
        at[i] = tree.insert(codes[starts[i]:starts[i + 1]])
    total = len(tree.code)
    n, least, children, leaves, saved, going, size = ([0] * total for _ in range(7))
    least = [None] * total
    ends: dict[int, list] = {}
    for i, node in enumerate(at):
        sizes, up, depth = members[i][0][1], node, tree.depth[node]
        while depth and not size[up]:
            size[up] = sizes[depth - 1] + 1  # 1 more, to tell a visited node
            up, depth = tree.parent[up], depth - 1
        n[node] = len(members[i])
        least[node] = members[i][0][2]
        for _, _, conv, continues, w_children, w_leaves, w_saved, _ in members[i]:
            if continues:
                going[node] += 1
                children[node] += w_children
                leaves[node] += w_leaves
                saved[node] += w_saved
            else:
                ends.setdefault(node, []).append(conv)
    edge = [False] * total
    for i, wanted in ((0, is_first), (len(keys) - 1, is_last)):
        node = at[i] if wanted else -1
        while node >= 0:
            edge[node] = True
            node = tree.parent[node]
    for node in range(total - 1, -1, -1):  # children before parents
        if not edge[node]:
            leaves[node] += children[node] == 0 and going[node] == 0
            saved[node] += (n[node] - 1) * (size[node] - 1 if size[node] else 0)
        up = tree.parent[node]
        if up < 0:
            continue
        n[up] += n[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
        if not edge[node]:
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    ids: dict[int, bytes] = {}
    for i, wanted in ((0, is_first), (len(keys) - 1, is_last)):
        if wanted:
            node = at[i]
            while node >= 0:
                ids[node] = hashlib.md5(root.encode() + b"/" + keys[i][:_WIDTH * tree.depth[node]]).digest()
                node = tree.parent[node]
    root_conv = rows[0][7]
    base = block * BLOCK
    for node in range(total):
        up, depth = tree.parent[node], tree.depth[node]
        bytes_ = size[node] - 1 if size[node] else 0
        own = ",".join(map(str, ends.get(node, ())))
        common = (least[node], n[node], children[node], leaves[node], saved[node], bytes_, going[node], root_conv)
        if edge[node]:
            path, walk = [], node
            while walk >= 0:
                path.append(ids[walk])
                walk = tree.parent[walk]
            yield (BOUNDARY, block, base + depth, ids[node], ids.get(up), None, *common, path, None, shard)
            if own:
                yield (ENDS, block, base + depth, ids[node], None, None, *(None,) * 8, None, own, shard)
            continue
        digest = hashlib.sha256(own.encode()).hexdigest() if own else _NOTHING
        if up >= 0 and edge[up]:
            yield (OPEN, block, base + depth, None, ids[up], None, *common, None, digest, shard)
        else:
            above = None if up < 0 else root_conv if up == 0 and block else least[up]
            yield (FINAL, block, base + depth, None, None, above, *common, None, digest, shard)


def _shard_rows(batches) -> Iterator[pa.RecordBatch]:
    """Node rows of the range shards of a sorted partition."""
    names = ["root", "block", "key", "sizes", "conv_id", "continues", "w_children", "w_leaves", "w_saved", "root_conv"]
    task = TaskContext.get().partitionId() << 32
    held, shard = [], 0

    def nodes():
        groups = [(k, [r[2:] for r in g]) for k, g in groupby(held, key=lambda r: r[:2])]
        for i, ((root, block), rows) in enumerate(groups):
            yield from _group_nodes(root, block, rows, i == 0, i + 1 == len(groups), task + shard)

    def flushed():
        out = list(nodes())
        for start in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out[start:start + 4096]), _FIELDS)],
                                             names=[f for f, _ in _FIELDS])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            held.append(row)
            if len(held) >= SHARD:
                yield from flushed()
                held, shard = [], shard + 1
    if held:
        yield from flushed()


def _digests(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each boundary node, whose chunks stream by shard."""
    out = []
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("id", "ends"))))
    for node, chunks in groupby(rows, key=lambda r: r[0]):
        digest, lead = hashlib.sha256(), ""
        for _, ids in chunks:
            digest.update((lead + ids).encode())
            lead = ","
        out.append((node, digest.hexdigest()))
        if len(out) == 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["id", "ends"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out_, t) for out_, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["id", "ends"])


def _block_nodes(blocks: DataFrame) -> DataFrame:
    """Merged nodes of weighted blocks, those of depth 0 of later blocks among them (``inner`` false)."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["root", "key", "conv_id"]
    parts = stored(blocks.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_shard_rows, _NODE), "trie")
    merged = stored(parts.where(F.col("kind") == BOUNDARY).groupBy("id").agg(
        *[F.first(c).alias(c) for c in ("block", "depth", "parent_id", "path", "root_conv")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "going")],
        F.min("conv_id").alias("conv_id"), F.max("size").alias("size")), "boundary")
    own = merged.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("_more"))
    merged = merged.join(own, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0)))
    leaf = ((F.col("n_children") == 0) & (F.col("going") == 0)).cast("long")
    share = merged.select(F.explode("path").alias("id"), (F.col("n_leaves") + leaf).alias("n_leaves"),
                          (F.col("saved") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    sums = share.groupBy("id").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    chunks = (parts.where(F.col("kind") == ENDS).select("id", "shard", "ends")
              .repartition("id").sortWithinPartitions("id", "shard").select("id", "ends"))
    ended = stored(chunks.mapInArrow(_digests, "id binary, ends string"), "ends", batch_rows=64)
    later_root = (F.col("block") > 0) & (F.col("depth") == F.col("block") * BLOCK)
    boundary = stored(merged.drop("n_leaves", "saved", "_more", "path").join(sums, "id").join(ended, "id", "left")
                      .withColumn("ends", F.coalesce("ends", F.lit(_NOTHING)))
                      .withColumn("as_parent", F.when(later_root, F.col("root_conv")).otherwise(F.col("conv_id"))), "boundary")
    waiting = parts.where(F.col("kind") == OPEN).drop("id").unionByName(
        boundary.drop("id", "as_parent"), allowMissingColumns=True)
    waiting = left_join_dim(waiting.drop("parent_conv"), boundary.select(F.col("id").alias("_id"), F.col("as_parent").alias("parent_conv")),
                            "parent_id", "_id")
    columns = ["block", "depth", "conv_id", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends", "size", "going"]
    return (parts.where(F.col("kind") == FINAL).select(*columns).unionByName(waiting.select(*columns))
            .withColumn("inner", ~later_root))


def _weights(blocks: DataFrame) -> DataFrame:
    """What each conversation adds, as smallest member of nodes in later blocks, to its row in a block."""
    nodes = stored(_block_nodes(blocks.where("block > 0")), "later")
    inner = nodes.where("inner").withColumn("own", (F.col("n_convs") - 1) * F.col("size"))
    own = inner.groupBy("conv_id", "block").agg(
        F.sum("own").alias("own"), F.max(((F.col("n_children") == 0) & (F.col("going") == 0)).cast("long")).alias("leaf"))
    roots = nodes.where("NOT inner").select("conv_id", (F.col("block") - 1).alias("block"), F.col("n_children").alias("w_children"))
    later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    # a few numbers per block of conversations of several blocks
    slim = blocks.where("several").select("conv_id", "block").join(own, ["conv_id", "block"], "left").join(roots, ["conv_id", "block"], "left")
    return slim.select("conv_id", "block", zero("w_children").alias("w_children"),
                       zero(F.sum("leaf").over(later)).alias("w_leaves"), zero(F.sum("own").over(later)).alias("w_saved"))


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """One row per node of sequences (conv_id long, position long from 0 without gaps, digest binary(16), size long,
    length long: turns of the conversation); a conversation without turns has a row whose position is null."""
    block = F.floor(F.col("position") / BLOCK).cast("long")
    cell = F.struct("position", "digest", "size")
    blocks = (turns.groupBy("conv_id", F.coalesce(block, F.lit(0)).cast("long").alias("block"))
              .agg(F.array_sort(F.collect_list(F.when(F.col("position").isNotNull(), cell))).alias("cells"), F.max("length").alias("length"))
              .select("conv_id", "block", F.unhex(F.array_join(F.transform("cells", lambda c: F.hex(c["digest"])), "")).alias("key"),
                      F.transform("cells", lambda c: c["size"]).alias("sizes"),
                      ((F.col("block") + 1) * BLOCK < F.col("length")).alias("continues"), (F.col("length") > BLOCK).alias("several"),
                      (F.col("length") >= BLOCK).alias("_full")))
    blocks = stored(blocks, "blocks")
    none = {c: F.lit(0).cast("long") for c in ("w_children", "w_leaves", "w_saved")}
    if blocks.where("several").isEmpty():
        weighted = blocks.withColumns({"root": F.lit("0"), "root_conv": F.lit(None).cast("long"), **none})
    else:
        upto = Window.partitionBy("conv_id").orderBy("block")
        before, done = upto.rowsBetween(Window.unboundedPreceding, -1), upto.rowsBetween(Window.unboundedPreceding, 0)
        hashes = [F.xxhash64("key", "block", F.lit(seed)) for seed in (1, 2)]
        name = lambda w, number: F.concat_ws(":", number.cast("string"), *[F.hex(F.bit_xor(c).over(w)) for c in ("_a", "_b")])
        slim = (blocks.where("_full").select("conv_id", "block", F.octet_length("key").alias("_n"), hashes[0].alias("_a"), hashes[1].alias("_b"))
                .select("conv_id", "block", "_n", name(before, F.col("block")).alias("root"), name(done, F.col("block") + 1).alias("_after")))
        slim = stored(slim.withColumn("root", F.when(F.col("block") == 0, "0").otherwise(F.col("root"))), "roots")
        # the smallest conversation that has the whole prefix, also if it ends there
        firsts = slim.where(F.col("_n") == BLOCK * _WIDTH).groupBy(F.col("_after").alias("_root")).agg(F.min("conv_id").alias("root_conv"))
        named = blocks.join(slim.select("conv_id", "block", "root"), ["conv_id", "block"], "left").withColumn("root", F.coalesce("root", F.lit("0")))
        later = left_join_dim(named.where("block > 0"), firsts, "root", "_root")
        rooted = stored(named.where("block = 0").withColumn("root_conv", F.lit(None).cast("long")).unionByName(later), "rooted")
        weighted = rooted.join(_weights(rooted.withColumns(none)), ["conv_id", "block"], "left")
        weighted = weighted.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in none})
    nodes = _block_nodes(weighted)
    return nodes.where("inner").select("conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                                       F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def _positions(batches) -> Iterator[pa.RecordBatch]:
    """Place of each row among its conversation's rows in this sorted partition."""
    pid, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
        fresh = np.append(conv[0] != last, conv[1:] != conv[:-1])
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(conv)), 0))
        place = np.arange(len(conv)) - start
        if not fresh[0]:
            place[: int(np.argmax(fresh)) if fresh.any() else len(conv)] += count
        last, count = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(conv), pid, np.int32)), pa.array(place),
                                          batch.column("digest"), batch.column("size")], names=["conv_id", "pid", "place", "digest", "size"])


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, position from 0, digest, size) of rows (conv_id, turn, role, text), however many a conversation has."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (rows.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 32).alias("head"),
                    F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
                    F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("_row")))
    order = ["conv_id", "turn", "role", "head", "digest", "_row"]  # _row parts equal rows only
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "digest", "size")
                    .mapInArrow(_positions, "conv_id long, pid int, place long, digest binary, size long"), "turns")
    # only the first conversation of a partition can have rows before: at most one row per partition
    spans = placed.groupBy("conv_id", "pid").agg((F.max("place") + 1).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    carried = spans.select("conv_id", "pid", earlier.alias("_before")).where("_before > 0")
    return (placed.join(F.broadcast(carried), ["conv_id", "pid"], "left")
            .select("conv_id", (F.col("place") + F.coalesce("_before", F.lit(0))).alias("position"), "digest", "size"))


def rebuilt(rows: DataFrame, family: int = 5, shared: int = 9) -> DataFrame:
    """Turns for ``prefix_nodes``: each conversation c begins with the first crc32(c) % ``shared`` turns of
    c - c % ``family`` (floored) in place of as many of its own."""
    turns = stored(numbered_turns(rows), "numbered")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    plan = sizes.select("conv_id", "n", (F.col("conv_id") - F.pmod("conv_id", F.lit(family))).alias("base"),
                        F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).cast("long").alias("h"))
    heads = turns.where(F.col("position") < shared - 1)
    short = heads.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("conv_id", "base")
    taken = F.least("h", F.coalesce("_n", F.lit(0)))
    plan = stored(plan.join(short, "base", "left").select("conv_id", "base", "h", taken.alias("taken"),
                                                        (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    own = left_join_dim(turns, plan.select(F.col("conv_id").alias("_c"), "h", "taken", "length"), "conv_id", "_c")
    own = own.where(F.col("position") >= F.col("h")).withColumn("position", F.col("position") - F.col("h") + F.col("taken"))
    # a family has at most ``family`` members, and a head fewer than ``shared`` turns
    lent = plan.join(heads.withColumnRenamed("conv_id", "base"), "base").where(F.col("position") < F.col("h"))
    columns = ["conv_id", "position", "digest", "size", "length"]
    bare = plan.where("length = 0").select("conv_id", "length")
    return own.select(*columns).unionByName(lent.select(*columns)).unionByName(bare, allowMissingColumns=True)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(rebuilt(table(spark, sf_dir, "conversations")))
