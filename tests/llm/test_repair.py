"""Conversation repair against a plain DP over strings, and that against all edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from medalforge.llm import repair as rp
from tests.conftest import SF001

ROWS = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        dealt = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if dealt == 1:
            text = ""
        elif dealt == 2:
            text = re.sub(r"[.!?]", "", text)
        elif dealt == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(dealt, 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
        out.append(1 if not last else 2 if (role, text) in seen else 0 if last[1] in ".!?" else 3)
        seen.add((role, text))
    return out


def plain_audit(initials, faults):
    """Least (cost, audit): every state holds its whole string."""
    def relax(best):
        for s, t in ((0, 2), (1, 2), (3, 2), (2, 3), (0, 2), (3, 2)):
            if s in best:
                new = (best[s][0] + 5, best[s][1] + "I")
                best[t] = min(best.get(t, new), new)
        return best

    best = {0: (0, "")}
    for c, f in zip(initials, faults):
        best, after = relax(best), {}
        for s, (cost, text) in best.items():
            options = [(s, 2, "D")]
            if f not in (1, 2):
                extra = 5 * (f == 3)
                legal = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s]
                if c in legal:
                    options.append((legal[c], extra, "K"))
                options.append((3 if s == 2 else 2, extra + 1, "R"))
            for t, price, edit in options:
                new = (cost + price, text + edit)
                after[t] = min(after.get(t, new), new)
        best = after
    best = relax(best)
    return min(v for s, v in best.items() if s in (0, 3))


def every_audit(initials, faults):
    """Least (cost, audit) over all edit sequences with at most two insertions in a place."""
    found = []
    n = len(initials)
    for places in itertools.product(range(3), repeat=n + 1):
        for edits in itertools.product("DKR", repeat=n):
            cost, audit, roles = 0, "", [""]
            ok = True
            for i in range(n + 1):
                audit += "I" * places[i]
                cost += 5 * places[i]
                roles = [r + "".join(x) for r in roles for x in itertools.product("ua", repeat=places[i])]
                if i == n:
                    break
                edit = edits[i]
                audit += edit
                if edit == "D":
                    cost += 2
                    continue
                ok = ok and faults[i] not in (1, 2)
                cost += 5 * (faults[i] == 3) + (edit == "R")
                roles = [r + x for r in roles for x in ("ua" if edit == "R" else initials[i])]
            if ok and any(re.fullmatch("(s?(ua)+)?", r) for r in roles):
                found.append((cost, audit))
    return min(found)


def brute(rows):
    """Result per conv_id of undamaged rows."""
    convs = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        faults = plain_faults([r[2:] for r in own])
        initials = [r[2][:1] for r in own]
        cost, audit = plain_audit(initials, faults)
        lines, state, at = [], 0, 0
        for edit in audit:
            role = None
            if edit in "IR":
                role, state = ("assistant", 3) if state == 2 else ("user", 2)
            if edit == "I":
                lines.append(role + ":")
                continue
            if edit == "R":
                lines.append(f"{role}:{own[at][3]}")
            elif edit == "K":
                lines.append(f"{own[at][2]}:{own[at][3]}")
                state = {"s": 1, "u": 2, "a": 3}[initials[at]]
            at += 1
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def conversations(seed, n=40, longest=30):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 4, longest])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No!", "What?", "cut off", "  ", "", None, "日本. \n", f"own {conv} {turn}.", "x" * 50 + "."])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn + 3, None]), role, text))
    rng.shuffle(rows)
    return rows


def test_plain_dp_equals_every_edit_sequence():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(4)
        initials, faults = rng.choices("suat", k=n), rng.choices([0, 0, 0, 1, 2, 3], k=n)
        assert plain_audit(initials, faults) == every_audit(initials, faults)


@pytest.mark.parametrize("seed", range(4))
def test_persistent_audits_equal_strings(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n = rng.choice([0, 1, 2, 5, 9, 40])
        initials, faults = rng.choices("suat", k=n), rng.choices([0, 0, 0, 1, 2, 3], k=n)
        assert rp.whole_audit(list(zip(initials, faults))) == plain_audit(initials, faults)


@pytest.mark.parametrize("prime", [rp.Audits.PRIME, 7])
def test_order_of_audits_survives_hash_collisions(monkeypatch, prime):
    monkeypatch.setattr(rp.Audits, "PRIME", prime)
    rng = random.Random(8)
    audits, nodes = rp.Audits(), {0: ""}
    for _ in range(400):
        parent = rng.choice(list(nodes)[-60:])
        char = rng.choice("DIKR"[:2])
        nodes[audits.extend(parent, char)] = nodes[parent] + char
    for _ in range(4000):
        a, b = rng.sample(list(nodes), 2)
        assert audits.text(a) == nodes[a]
        assert audits.less(a, b) == (nodes[a] < nodes[b])


@pytest.mark.parametrize("piece", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, piece):
    """With small pieces, long conversations are chained from many."""
    monkeypatch.setattr(rp, "PIECE", piece)
    rows = conversations(5)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert got(rp.repair(rp.damage(df))) == brute(rows)


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(rp, "PIECE", 16)
    rng = random.Random(6)
    rows = [(7, t // 2, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"t{t}.", "cut"])) for t in range(600)] + conversations(2, 8)
    df = spark.createDataFrame(rows, ROWS)
    assert got(rp.repair(rp.damage(df))) == brute(rows)


def test_clashing_columns_ids_of_other_types_and_empty_tables(spark):
    from pyspark.sql import functions as F
    rows = conversations(9, 12, 6)
    df = spark.createDataFrame(rows, ROWS)
    for name in ("audit", "pid", "rid", "edge", "_row", "fault"):
        df = df.withColumn(name, F.lit("own"))
    assert got(rp.repair(rp.damage(df))) == brute(rows)
    as_text = rp.repair(rp.damage(df.withColumn("conv_id", F.col("conv_id").cast("string"))))
    assert got(as_text) == {None if k is None else str(k): v for k, v in brute(rows).items()}
    assert got(rp.repair(rp.damage(df.limit(0)))) == {}


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "long " * 400_000 + "."), (1, 1, "assistant", "word" * 500_000), (2, 0, "user", "Hi.")]
    assert got(rp.repair(rp.damage(spark.createDataFrame(rows, ROWS)))) == brute(rows)


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = got(rp.op11_conversation_repair(spark, SF001))
    assert result == brute(rows)
