import functools
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medalforge.llm.common import steps, strings, words_of
from medalforge.llm.lattice import MARK, Lattice, load_pieces
from medalforge.llm.sampling import decode_ids, encode_batch

PIECES = load_pieces()
LOGP = PIECES.log_probs()
KNOWN = {p: LOGP[i] for i, p in enumerate(PIECES.pieces) if PIECES.usable[i]}


def segmentations(text):
    """Every (pieces, log-probability) of a marked string, literal marks and unknown characters in bytes."""
    if not text:
        yield (), 0.0
        return
    start = text[0] == MARK
    for j in range(1, len(text) + 1):
        q = text[:j]
        if q in KNOWN:
            for rest, lp in segmentations(text[j:]):
                yield (q, *rest), KNOWN[q] + lp
    if text[0] not in KNOWN and not start:
        lp0 = sum(LOGP[PIECES.byte_ids[b]] for b in text[0].encode())
        for rest, lp in segmentations(text[1:]):
            yield (text[0], *rest), lp0 + lp


def brute(text):
    @functools.lru_cache(None)
    def total(i):
        if i == len(text):
            return 0.0
        xs = []
        for j in range(i + 1, len(text) + 1):
            q = text[i:j]
            if q in KNOWN and MARK not in q[1:] and not (i and q[0] == MARK):
                xs.append(KNOWN[q] + total(j))
        if text[i] not in KNOWN or (i and text[i] == MARK):
            xs.append(sum(LOGP[PIECES.byte_ids[b]] for b in text[i].encode()) + total(i + 1))
        m = max(xs)
        return m + math.log(sum(math.exp(x - m) for x in xs))

    return total(0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abehntßé日🙂▁\n", max_size=9), min_size=1, max_size=6))
def test_forward_equals_the_sum_over_all_segmentations(words):
    got = Lattice(PIECES, words).forward(LOGP)[0]
    assert got == pytest.approx([brute(MARK + w) for w in words], rel=1e-9)


def test_several_sets_and_backward_agree():
    words = ["the", "whole", "", "überall"]
    lattice = Lattice(PIECES, words)
    both = lattice.forward(np.stack([LOGP, LOGP - 0.5]))
    assert both[0] == pytest.approx(Lattice(PIECES, words).forward(LOGP)[0])
    beta = lattice.backward(LOGP[None, :])[0][:lattice.n]
    assert beta == pytest.approx(both[0][lattice.order])


def test_expected_uses_equal_enumeration():
    word = "then"
    all_ = list(segmentations(MARK + word))
    z = sum(math.exp(lp) for _, lp in all_)
    want = np.zeros(len(PIECES))
    for pieces, lp in all_:
        for p in pieces:
            want[PIECES.pieces.index(p)] += 3 * math.exp(lp) / z
    assert Lattice(PIECES, [word]).expected(LOGP, np.array([3.0]))[0] == pytest.approx(want)


def test_a_long_word_is_finite():
    assert np.isfinite(Lattice(PIECES, ["ab" * 4000]).forward(LOGP)).all()


def test_words_of_slices_and_controls():
    text = pa.array(["A b\x0bC\x85d é", None, "", "  Z"])
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    flat, rows = words_of(strings(batch.slice(1).column("text")))
    assert flat.to_pylist() == ["z"] and rows.tolist() == [2]
    flat, rows = words_of(strings(text))
    assert flat.to_pylist() == ["a", "b", "c\x85d", "é", "z"]
    pieces = list(steps(iter([batch]), limit=4))
    assert sum(p.num_rows for p in pieces) == 4


def sampled(texts, k, seed=1):
    row, rank, ids, size, lp, value, inclusion = encode_batch(PIECES, LOGP, pa.array(texts, pa.large_string()),
                                                              np.arange(len(texts)), k, seed)
    ends = np.cumsum(size)
    return [(row[i], rank[i], ids[ends[i] - size[i]:ends[i]].tolist(), lp[i], value[i], inclusion[i])
            for i in range(len(row))]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_every_sample_decodes_to_the_text(text):
    rows = sampled([text], 3)
    assert rows and all(decode_ids(PIECES, r[2]) == text for r in rows)
    assert len({tuple(r[2]) for r in rows}) == len(rows)
    assert all(a[4] >= b[4] for a, b in zip(rows, rows[1:]))
    assert all(r[5] <= 1e-12 for r in rows)


def test_top_k_lists_all_of_a_small_lattice():
    text = "then"
    want = {p: lp for p, lp in segmentations(MARK + text)}
    rows = sampled([text], 500)
    got = {tuple(PIECES.pieces[i] for i in r[2]): r[3] for r in rows}
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p]) for p in want)
    assert all(r[5] == 0.0 for r in rows)  # all are in: inclusion probability 1


def test_without_replacement_frequencies():
    text, n = "hen", 4000
    segs = [(p, lp) for p, lp in segmentations(MARK + text)]
    p = np.exp([lp for _, lp in segs])
    p /= p.sum()
    index = {s: i for i, (s, _) in enumerate(segs)}
    first, second, weight = np.zeros(len(p)), np.zeros(len(p)), np.zeros(len(p))
    for _, rank, ids, _, _, inclusion in sampled([text] * n, 2):
        i = index[tuple(PIECES.pieces[k] for k in ids)]
        (first if rank == 1 else second)[i] += 1 / n
        weight[i] += p[i] / math.exp(inclusion) / n
    after = np.array([sum(p[j] * p[i] / (1 - p[j]) for j in range(len(p)) if j != i) for i in range(len(p))])
    assert np.abs(first - p).max() < 4 * math.sqrt(0.25 / n)
    assert np.abs(second - after).max() < 4 * math.sqrt(0.25 / n)
    assert weight.sum() == pytest.approx(1, abs=0.1)  # inclusion scores are unbiased weights
