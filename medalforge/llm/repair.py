"""Conversation structure repair by a persistent audit DP.

A conversation's rows, by turn, get the cheapest edits after which the role initials read
``(s?(ua)+)?``: Keep, Rerole to user or assistant, Delete (required for blank and
duplicate rows), Insert a user or assistant without text; a truncated row that is not deleted
costs extra. The audit is the edits' initials; of equally cheap ones the ASCII-least.

The DP goes over rows and the four states of that pattern. Every state holds its best audit
as a node that links to the audit it extends, so prefixes are shared. Nodes carry
binary-lifting ancestors and a rolling hash of their whole audit: ties compare by searching
the longest common prefix over the ancestors, and the prefix that the hashes claim is walked
and verified (verified nodes are merged, so no node is walked twice).

On Spark: rows are sorted into ranges of (conversation, turn), so a conversation of any size
spreads over tasks. A task finishes the conversations that lie inside its range. Rows of those
that touch an end of the range, or have over ``PIECE`` rows, are written and cut into pieces of at
most ``PIECE`` rows; a piece yields costs and audits from every state to every state (an
insertion stands before a row, so audits of one piece are never prefixes of each other), with
the audits' order; the pieces of a conversation are then chained by costs and order alone, 32
numbers a piece. Only the digest of a repaired conversation reads its rows in order in one
task, where they stream; nothing is held whole but the audit itself.

Defined results: null ids form a conversation; null roles and texts count as one space; rows of a
turn go by role, by the first 32 characters of the text and by its hash; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cmp_to_key
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

PIECE = 4096
_BYTES = 16 << 20  # text that a task holds of one conversation
_FLUSH = 512
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
# Costs of the edits, fixed values.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
_FAR = 1 << 60
# States of the pattern: nothing yet, after s, after u, after a. Per state: (initial kept, next state).
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT = (2, 2, 3, 2)  # where an inserted or reroled row leads
_ROLE = ("user", "user", "assistant", "user")
_ENDS = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
_SPACE = " \t\n\x0b\x0c\r"
_LAST = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")


class Audits:
    """Edit strings as nodes that share prefixes; node 0 is the empty string."""

    BASE, PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self):
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, … edits shorter
        self.char, self.depth, self.hash, self.same = [""], [0], [0], [0]

    def extend(self, node: int, char: str) -> int:
        new, chain, at, k = len(self.char), [node], node, 0
        while k < len(self.up[at]):
            at = self.up[at][k]
            chain.append(at)
            k += 1
        self.up.append(chain)
        self.char.append(char)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.BASE + ord(char)) % self.PRIME)
        self.same.append(new)
        return new

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _lift(self, node: int, steps: int) -> int:
        while steps:
            k = steps.bit_length() - 1
            node = self.up[node][k]
            steps -= 1 << k
        return node

    def _find(self, node: int) -> int:
        while self.same[node] != node:
            self.same[node] = node = self.same[self.same[node]]
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth spell the same; those that do are merged."""
        trail = []
        while (a := self._find(a)) != (b := self._find(b)):
            if self.char[a] != self.char[b]:
                return False
            trail.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        for a, b in trail:
            self.same[self._find(max(a, b))] = self._find(min(a, b))
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether a's string comes before b's."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lift(a, self.depth[a] - depth), self._lift(b, self.depth[b] - depth)
        if self.hash[x] == self.hash[y]:
            if self._equal(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)  # the hashes collided
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self._equal(self.up[x][0], self.up[y][0]):
            return self.char[x] < self.char[y]
        return self.text(a) < self.text(b)


def _offer(audits, cost, node, state, price, source, char):
    """Take an edit into ``state`` if it is cheaper than the best so far, or as cheap and ASCII-less."""
    if price > cost[state]:
        return
    new = audits.extend(source, char)
    if price < cost[state] or audits.less(new, node[state]):
        cost[state], node[state] = price, new


def _insertions(audits, cost, node):
    for state in (0, 1, 3, 2):  # a second insertion can only follow one into state 2
        if cost[state] < _FAR:
            _offer(audits, cost, node, _NEXT[state], cost[state] + INSERT, node[state], "I")


def best_edits(rows: list[tuple[str, int]], start: int = 0) -> tuple[Audits, list[int], list[int]]:
    """Cheapest audits of rows (initial, fault) from a state to every state, none ending in an insertion."""
    audits = Audits()
    cost, node = [_FAR] * 4, [0] * 4
    cost[start] = 0
    for initial, fault in rows:
        _insertions(audits, cost, node)
        after, nodes = [_FAR] * 4, [0] * 4
        extra = CUT if fault == TRUNCATED else 0
        for state in range(4):
            price = cost[state]
            if price >= _FAR:
                continue
            _offer(audits, after, nodes, state, price + DELETE, node[state], "D")
            if fault in (BLANK, DUPLICATE):
                continue
            kept = _KEEP[state].get(initial)
            if kept is not None:
                _offer(audits, after, nodes, kept, price + extra, node[state], "K")
            _offer(audits, after, nodes, _NEXT[state], price + extra + REROLE, node[state], "R")
        cost, node = after, nodes
    return audits, cost, node


def whole_audit(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    audits, cost, node = best_edits(rows)
    ends = [(cost[s] + price, node[s], tail) for s, (price, tail) in _ENDS.items() if cost[s] < _FAR]
    least = min(c for c, _, _ in ends)
    best = None
    for c, n, tail in ends:
        if c == least and (best is None or audits.less(n, best[0])):
            best = (n, tail)
    return least, audits.text(best[0]) + best[1]


def _states(rows, audit, state):
    """(edit, role, row) of an audit over rows (role, ...), the row None for insertions."""
    at = iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(at)
        if edit in "IR":
            yield edit, _ROLE[state], row
            state = _NEXT[state]
        else:
            yield edit, None, row
            if edit == "K":
                state = _KEEP[state][row[0][:1]]


class Facts:
    """Counts of a run of rows that can be joined with the next run's."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = None
        self.first_initial = self.last_initial = None
        self.seen = False

    def add(self, turn, initial, fault):
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        if self.seen:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        else:
            self.first_initial, self.seen = initial, True
        if turn is not None:
            self.distinct += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last_initial = initial

    def join(self, other: Facts) -> None:
        """Add the facts of the rows that follow."""
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        if self.seen and other.seen:
            self.illegal += self.last_initial + other.first_initial not in ("su", "ua", "au")
        self.distinct += other.distinct - (self.high is not None and self.high == other.low)
        if not self.seen:
            self.first_initial = other.first_initial
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        if other.seen:
            self.last_initial, self.seen = other.last_initial, True

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "distinct", "low", "high", "first_initial", "last_initial", "seen")

    def values(self) -> tuple:
        return tuple(getattr(self, f) for f in self.FIELDS)

    @classmethod
    def of(cls, values) -> Facts:
        out = cls()
        for f, v in zip(cls.FIELDS, values):
            setattr(out, f, v)
        return out


_RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_RESULT_ARROW = [(n.split()[0], pa.string() if n.endswith("string") else pa.int64()) for n in _RESULT.split(", ")]
_EDGE = "edge boolean, pid int, rid long, turn long, role string, text string"
_EDGE_ARROW = [("edge", pa.bool_()), ("pid", pa.int32()), ("rid", pa.int64()), ("turn", pa.int64()),
               ("role", pa.string()), ("text", pa.string())]
_FACTS = ("blank long, duplicate long, truncated long, illegal long, distinct long, low long, high long, "
          "first_initial string, last_initial string, seen boolean")
_FACTS_ARROW = [(n.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[n.split()[1]])
                for n in _FACTS.split(", ")]


def _flushed(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]], weight=lambda row: 0):
    """Record batches of row tuples."""
    def batch(held):
        columns = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if len(held) >= _FLUSH or size > _BYTES:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def fault(role: str, text: str, seen: set) -> int:
    """The first fault of a row; ``seen``: (role, text digest) of the conversation's rows so far."""
    key = (role, hashlib.md5(text.encode("utf-8", "surrogatepass")).digest())
    again = key in seen
    seen.add(key)
    if not text.strip(_SPACE):
        return BLANK
    return DUPLICATE if again else 0 if _LAST.search(text) else TRUNCATED


def _finish(rows: list[tuple]) -> tuple:
    """The result columns of one conversation's (turn, role, text)."""
    seen, facts, marks = set(), Facts(), []
    for turn, role, text in rows:
        f = fault(role, text, seen)
        facts.add(turn, role[:1], f)
        marks.append((role[:1], f))
    cost, audit = whole_audit(marks)
    digest, lead = hashlib.sha256(), ""
    for edit, role, row in _states([(r, t) for _, r, t in rows], audit, 0):
        if edit == "D":
            continue
        line = f"{row[0] if edit == 'K' else role}:{row[1] if row else ''}"
        digest.update((lead + line).encode("utf-8", "surrogatepass"))
        lead = "\n"
    return (facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost, audit, digest.hexdigest())


def _in_range(batches) -> Iterator[tuple]:
    """Results of the conversations inside a sorted partition, and the rows of those that may go beyond it."""
    pid = TaskContext.get().partitionId()
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "_dropped"))))
    none, plain = (None,) * len(_RESULT_ARROW), (False,) + (None,) * (len(_EDGE_ARROW) - 1)
    rid, held, first = 0, None, True

    def edge(conv, row):
        nonlocal rid
        dropped = row[4]
        rid += not dropped
        return (conv, *none, True, pid, None if dropped else rid - 1, row[1], row[2], None if dropped else row[3])

    for conv, group in groupby(rows, key=lambda r: r[0]):
        if held is not None:  # the conversation before ended inside the range
            yield (held[0], *_finish([r[1:4] for r in held[1] if not r[4]]), *plain)
        held, size, spilled = (conv, []), 0, first
        first = False
        for row in group:
            if not spilled:
                held[1].append(row)
                size += len(row[3])
                if len(held[1]) <= PIECE and size <= _BYTES:
                    continue
                spilled = True
                for r in held[1]:
                    yield edge(conv, r)
            else:
                yield edge(conv, row)
        if spilled:
            held = None
    if held is not None:
        for r in held[1]:
            yield edge(held[0], r)


def _piece_rows(batches) -> Iterator[tuple]:
    """Costs, audits and order from state to state of every piece (rows sorted by pid, rid)."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "pid", "rid", "turn", "initial", "fault"))))
    for (pid, _, conv), group in groupby(rows, key=lambda r: (r[1], r[2] // PIECE, r[0])):
        group = list(group)  # at most PIECE rows of a few bytes
        facts = Facts()
        for r in group:
            facts.add(*r[3:])
        marks = [r[4:] for r in group]
        costs, ranks, audits = [], [], []
        for start in range(4):
            tree, cost, node = best_edits(marks, start)
            order = sorted((s for s in range(4) if cost[s] < _FAR),
                           key=cmp_to_key(lambda x, y: -1 if tree.less(node[x], node[y]) else 1))
            costs += cost
            ranks += [order.index(s) if s in order else 4 for s in range(4)]
            audits += [tree.text(node[s]) if s in order else "" for s in range(4)]
        yield (conv, pid, group[0][2], *facts.values(), costs, ranks, audits)


def _chained(batches) -> Iterator[tuple]:
    """For each piece the states it starts and ends in; a conversation's facts and cost go with its last piece."""
    names = ["conv_id", "pid", "start", *Facts.FIELDS, "costs", "ranks"]
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in names)))
    for _, group in groupby(rows, key=lambda r: r[0]):
        pieces = list(group)  # 32 numbers for PIECE rows
        facts = Facts()
        for p in pieces:
            facts.join(Facts.of(p[3:-2]))
        left = [_ENDS[s][0] for s in range(4)]
        goes = []
        for p in reversed(pieces):
            costs, ranks = p[-2], p[-1]
            choice, total = [], []
            for s in range(4):
                options = [(costs[4 * s + q] + left[q], ranks[4 * s + q], q) for q in range(4)]
                best = min(options)
                choice.append(best[2])
                total.append(best[0])
            goes.append(choice)
            left = total
        cost, state = left[0], 0
        for i, (p, choice) in enumerate(zip(pieces, reversed(goes))):
            end = choice[state]
            last = i + 1 == len(pieces)
            stats = ((facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost) if last else (None,) * 6)
            yield (p[1], p[2], state, 4 * state + end, _ENDS[end][1] if last else "", *stats)
            state = end


def _edits(batches) -> Iterator[tuple]:
    """Per row of a piece: its edit, the roles inserted before and after it, and its new role."""
    names = ["pid", "start", "state", "audit", "tail", "initials", *[n for n, _ in _RESULT_ARROW[:6]]]
    for b in batches:
        for pid, start, state, audit, tail, initials, *stats in zip(*(b.column(c).to_pylist() for c in names)):
            rows = [(i, None) for i in initials]
            lead, out, rid = [], [], start
            for edit, role, _ in _states(rows, audit + tail, state):
                if edit == "I":
                    lead.append(role)
                    continue
                out.append([pid, rid, len(lead) * "I" + edit, lead, role, []])
                lead, rid = [], rid + 1
            out[-1][5] = lead  # inserted after the last row
            for i, row in enumerate(out):
                yield (*row, *(stats if i + 1 == len(out) else (None,) * 6))


def _digested(batches) -> Iterator[tuple]:
    """One result per conversation from its rows in order, which stream."""
    names = ["conv_id", "edit", "lines", *[n for n, _ in _RESULT_ARROW[:6]], "tail"]
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in names)))
    for conv, group in groupby(rows, key=lambda r: r[0]):
        digest, lead, audit, stats = hashlib.sha256(), "", [], None
        for _, edit, lines, *numbers, tail in group:
            for line in lines:
                digest.update((lead + line).encode("utf-8", "surrogatepass"))
                lead = "\n"
            audit.append(edit + "I" * tail)
            if numbers[0] is not None:
                stats = numbers
        yield (conv, *stats, "".join(audit), digest.hexdigest())


def _mapped(df: DataFrame, rows, fields, schema: str, weight=lambda row: 0) -> DataFrame:
    """mapInArrow of a generator of tuples; the type of conv_id, where it leads the fields, is the input's."""
    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        typed = [(n, first.schema.field("conv_id").type if t is None else t) for n, t in fields]

        def again():
            yield first
            yield from batches

        yield from _flushed(rows(again()), typed, weight)

    return df.mapInArrow(run, schema)


def _blank(text: str) -> Column:
    return ~F.col(text).rlike(r"[^\x20\x09-\x0D]")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of rows (conv_id, turn, role, text, optionally _dropped: not there, but its id is)."""
    key = rows.schema["conv_id"].dataType.simpleString()
    dropped = F.col("_dropped") if "_dropped" in rows.columns else F.lit(False)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), dropped.alias("_dropped"),
                       F.monotonically_increasing_id().alias("_row"))  # parts equal rows; any order of those is right
    order = ["conv_id", "turn", "role", F.substring("text", 1, 32), F.xxhash64("text"), "_row"]
    fields = [("conv_id", None), *_RESULT_ARROW, *_EDGE_ARROW]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _mapped(rows.repartitionByRange(n, *order).sortWithinPartitions(*order), _in_range,
                     fields, f"conv_id {key}, {_RESULT}, {_EDGE}", lambda r: len(r[-1] or r[7] or ""))
    ranged = stored(ranged, "repair", batch_rows=2000)
    names = [n for n, _ in _RESULT_ARROW]
    done = ranged.where("NOT edge").select("conv_id", *names)
    edge = ranged.where("edge").select("conv_id", "pid", "rid", "turn", "role", "text")
    return done.unionByName(_joined_pieces(edge, key))


def _joined_pieces(edge: DataFrame, key: str) -> DataFrame:
    """The result for the conversations whose rows were written apart."""
    names = [n for n, _ in _RESULT_ARROW]
    kept = edge.where("rid IS NOT NULL")
    # the first row of each (conversation, role, text), by a combining aggregate, so hot texts stay small
    firsts = (kept.where(~_blank("text")).groupBy("conv_id", "role", F.md5("text"))
              .agg(F.min(F.struct("pid", "rid")).alias("f")).select("f.pid", "f.rid", F.lit(True).alias("_first")))
    mark = (F.when(_blank("text"), BLANK).when(F.col("_first").isNull(), DUPLICATE)
            .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(0))
    marked = stored(kept.join(firsts, ["pid", "rid"], "left")
                    .select("conv_id", "pid", "rid", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"),
                            mark.cast("long").alias("fault")), "marked")
    placed = (marked.select("conv_id", "pid", "rid", "turn", "initial", "fault", F.floor(F.col("rid") / PIECE).alias("_chunk"))
              .repartition("pid", "_chunk").sortWithinPartitions("pid", "rid"))
    longs, ints, texts = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())
    pieces = stored(_mapped(placed, _piece_rows,
                            [("conv_id", None), ("pid", pa.int32()), ("start", pa.int64()), *_FACTS_ARROW,
                             ("costs", longs), ("ranks", ints), ("audits", texts)],
                            f"conv_id {key}, pid int, start long, {_FACTS}, costs array<long>, ranks array<int>, audits array<string>",
                            lambda r: sum(map(len, r[-1]))), "pieces")
    six = ", ".join(_RESULT.split(", ")[:6])
    chained = _mapped(pieces.drop("audits").repartition("conv_id").sortWithinPartitions("conv_id", "pid", "start"), _chained,
                      [("pid", pa.int32()), ("start", pa.int64()), ("state", pa.int32()), ("choice", pa.int32()), ("tail", pa.string()),
                       *_RESULT_ARROW[:6]], f"pid int, start long, state int, choice int, tail string, {six}")
    initials = (marked.groupBy("conv_id", "pid", F.floor(F.col("rid") / PIECE).alias("_chunk"))
                .agg(F.min("rid").alias("start"), F.transform(F.array_sort(F.collect_list(F.struct("rid", "initial"))), lambda r: r["initial"])
                     .alias("initials")).select("pid", "start", "initials"))
    chosen = (chained.join(pieces.select("pid", "start", "audits"), ["pid", "start"]).join(initials, ["pid", "start"])
              .withColumn("audit", F.get("audits", "choice")).drop("audits"))
    edits = _mapped(chosen, _edits, [("pid", pa.int32()), ("rid", pa.int64()), ("edit", pa.string()), ("before", texts),
                                     ("new_role", pa.string()), ("after", texts), *_RESULT_ARROW[:6]],
                    f"pid int, rid long, edit string, before array<string>, new_role string, after array<string>, {six}")
    added = lambda roles: F.transform(roles, lambda r: F.concat(r, F.lit(":")))
    own = F.when(F.col("edit").endswith("D"), F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.coalesce("new_role", "role"), F.lit(":"), "text")))
    lines = (marked.join(edits, ["pid", "rid"])
             .select("conv_id", "pid", "rid", "edit", F.concat(added("before"), own, added("after")).alias("lines"),
                     F.size("after").alias("tail"), *names[:6]))
    digested = _mapped(lines.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "rid"), _digested,
                       [("conv_id", None), *_RESULT_ARROW], f"conv_id {key}, {_RESULT}")
    nothing = hashlib.sha256().hexdigest()
    gone = (edge.groupBy("conv_id").agg(F.count("rid").alias("_n")).where("_n = 0")
            .select("conv_id", *[F.lit(0).cast("long").alias(n) for n in names[:6]], F.lit("").alias("audit"),
                    F.lit(nothing).alias("repaired_sha256")))
    return digested.unionByName(gone)


def damage(rows: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) with planted faults; dropped rows are marked ``_dropped``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")), F.lit(20))
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), dealt.alias("_dealt"))
    rows = rows.withColumn("_copies", F.when(F.col("_dealt") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_dealt") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_dealt") == 1, "").when(F.col("_dealt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_dealt") == 0).alias("_dropped"), F.explode("_copies").alias("_copy"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))
