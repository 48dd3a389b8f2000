"""Segmentation lattices over a fixed public subword vocabulary.

``Pieces`` holds a vocabulary and its trie; ``Lattice`` holds many strings at
once and walks their segmentation lattices with numpy, one character offset
after the other: the forward and backward recursions run in log space over all
strings of the batch, for one or several sets of piece log-probabilities.

A string is spelled by pieces. A character without a piece of its own can only
be spelled by the byte pieces of its UTF-8 form, as can a literal word mark
(U+2581) in a text, so every string has a segmentation and decoding is exact.

Nothing is trained about the vocabulary itself: pieces and scores are read
from a model file whose path is a parameter; the driver reads it and the
pieces travel to the tasks in the closure (tens of thousands of strings).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"

_MULT = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18


class Pieces:
    """A vocabulary: pieces that may spell text, byte pieces, and the scores of the file.

    Not spellable, and so absent from lattices: control and unknown pieces, and
    runs of several word marks (they would join words).
    """

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], end_id: int,
                 log_scores: bool):
        self.pieces, self.scores = list(pieces), np.asarray(scores, float)
        self.byte_ids, self.end_id, self.log_scores = np.asarray(byte_ids), end_id, log_scores
        skipped = set(byte_ids)
        self.usable = np.array([i not in skipped and i != end_id and bool(p) and (s > -1e8 or len(p) == 1)
                                and not (p[0] == "<" and p[-1] == ">" and len(p) > 1)
                                and MARK not in p[1:]
                                for i, (p, s) in enumerate(zip(self.pieces, self.scores))])
        self._build()

    def __len__(self) -> int:
        return len(self.pieces)

    def _build(self) -> None:
        chars = sorted({c for p, u in zip(self.pieces, self.usable) if u for c in p})
        self.classes = np.zeros(0x110000, np.int16)
        for k, c in enumerate(chars):
            self.classes[ord(c)] = k + 1
        self.n_classes = len(chars) + 1
        node, self.longest = {"": 0}, 1
        ends, edges = {}, {}
        for i in np.flatnonzero(self.usable):
            piece = self.pieces[i]
            self.longest = max(self.longest, len(piece))
            at = 0
            for k in range(1, len(piece) + 1):
                prefix = piece[:k]
                if prefix not in node:
                    node[prefix] = len(node)
                    edges[at * self.n_classes + int(self.classes[ord(piece[k - 1])])] = node[prefix]
                at = node[prefix]
            ends[at] = int(i)
        self.piece_at = np.full(len(node), -1, np.int32)
        self.piece_at[list(ends)] = list(ends.values())
        bits = max(_SLOT_BITS, (len(edges) * 4).bit_length())
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        keys = np.fromiter(edges, np.int64, len(edges))
        slots = ((keys.astype(np.uint64) * _MULT) >> self.shift).astype(np.int64)
        self.probes = 1
        for key, slot, target in zip(keys.tolist(), slots.tolist(), edges.values()):
            probe = 1
            while self.keys[slot] != -1:
                slot, probe = (slot + 1) & mask, probe + 1
            self.keys[slot], self.next[slot] = key, target
            self.probes = max(self.probes, probe)
        self.mask = mask

    def step(self, state: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The trie node that each state reaches by its character class, -1 where there is none."""
        key = state * self.n_classes + cls
        slot = ((key.astype(np.uint64) * _MULT) >> self.shift).astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == key, self.next[slot], -1).astype(np.int64)
        left = np.flatnonzero((held != key) & (held != -1))
        for _ in range(self.probes - 1):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
            held = self.keys[slot[left]]
            hit = held == key[left]
            out[left[hit]] = self.next[slot[left[hit]]]
            left = left[~hit & (held != -1)]
        return out

    def log_probs(self) -> np.ndarray:
        """Natural-log unigram probabilities from the file's own scores.

        Scores of a unigram model are log-probabilities already. Those of a
        merge vocabulary are negated merge ranks; rank r gets a probability in
        proportion to 1 / (r + 10) (Zipf's law over ranks).
        Byte pieces and the end piece share the mass of one late-ranked piece each.
        """
        w = np.exp(self.scores) if self.log_scores else 1.0 / (10.0 + np.maximum(-self.scores, 0.0))
        ranked = self.usable & (self.scores > -1e8)
        least = w[ranked].min() if ranked.any() else 1.0
        p = np.where(self.usable, np.maximum(w, least), 0.0)
        p[self.byte_ids] = least
        p[self.end_id] = least
        with np.errstate(divide="ignore"):
            return np.log(p / p.sum())


@lru_cache(maxsize=4)
def load_pieces(path: str = VOCABULARY) -> Pieces:
    """Read a SentencePiece model file that has byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces, scores = [sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)]
    byte_of = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    if len(byte_of) != 256:
        raise ValueError(f"{path} has no full set of byte pieces")
    hidden = [i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)]
    for i in hidden:
        scores[i] = -1e9
    ranks = [-s for i, s in enumerate(scores) if s > -1e8]
    log_scores = not all(float(r).is_integer() for r in ranks)
    return Pieces(pieces, scores, [byte_of[b] for b in range(256)], sp.eos_id(), log_scores)


class Lattice:
    """The lattices of many strings, laid out offset by offset.

    Strings are ordered by falling length, so the strings that reach an offset
    are a prefix of that order and the nodes of one offset are a slice.
    ``marked``: each string gets the word mark in front.
    """

    def __init__(self, pieces: Pieces, texts: list[str] | pa.Array, marked: bool = True):
        self.pieces, n = pieces, len(texts)
        mark = MARK if marked else ""
        if isinstance(texts, pa.Array):  # no string object per text
            spelled = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.cast(pa.large_string()), pa.scalar(mark, pa.large_string()))
            lens = pc.utf8_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.frombuffer(spelled.buffers()[1], np.int64, n + 1)
            joined = (spelled.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[ends[0]:ends[-1]].decode("utf-8", "surrogatepass")
        else:
            lens = np.fromiter(map(len, texts), np.int64, n) + len(mark)
            joined = "".join([mark + t for t in texts]) if marked else "".join(texts)
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        starts = np.cumsum(lens) - lens
        self.order = np.argsort(-lens, kind="stable")
        self.lens, self.starts = lens[self.order], starts[self.order]
        longest = int(lens.max()) if n else 0
        # reach[o]: strings with at least o characters; their nodes at o are base[o] .. base[o] + reach[o].
        self.reach = np.searchsorted(-self.lens, -np.arange(longest + 1), side="right")
        self.base = np.concatenate([[0], np.cumsum(self.reach)])
        self.longest, self.n = longest, n
        self.cls = pieces.classes[self.points].astype(np.int64)
        literal = self.points == ord(MARK)
        if marked:
            literal[starts] = False
        else:
            literal[:] = False
        self.cls[literal] = 0
        self.nodes = int(self.base[-1])

    def edges_from(self, o: int):
        """Yield (length, strings, piece ids) of the edges that start at offset ``o``; then the characters
        that only bytes can spell, as (0, strings, code points)."""
        pieces = self.pieces
        ranks = np.arange(self.reach[o + 1])
        state = np.zeros(len(ranks), np.int64)
        for length in range(1, min(pieces.longest, self.longest - o) + 1):
            k = np.searchsorted(ranks, self.reach[o + length])
            ranks, state = ranks[:k], state[:k]
            at = self.starts[ranks] + (o + length - 1)
            state = pieces.step(state, self.cls[at])
            alive = state >= 0
            ids = np.where(alive, pieces.piece_at[state], -1)
            hit = ids >= 0
            if length == 1 and not hit.all():
                yield 0, ranks[~hit], self.points[at[~hit]]
            if hit.any():
                yield length, ranks[hit], ids[hit]
            ranks, state = ranks[alive], state[alive]
            if not len(ranks):
                return

    def _weights(self, length: int, ids: np.ndarray, logp: np.ndarray) -> np.ndarray:
        if length:
            return logp[:, ids]
        return byte_weights(self.pieces, ids, logp)

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations, shape (sets, strings), in the given order."""
        return self._forward(np.atleast_2d(logp))[1]

    def _forward(self, logp):
        alpha = np.full((len(logp), self.nodes), -np.inf)
        alpha[:, :self.n] = 0.0
        for o in range(self.longest):
            for length, ranks, ids in self.edges_from(o):
                source, target = self.base[o] + ranks, self.base[o + max(1, length)] + ranks
                alpha[:, target] = np.logaddexp(alpha[:, target], alpha[:, source] + self._weights(length, ids, logp))
        total = np.empty((len(logp), self.n))
        total[:, self.order] = alpha[:, self.base[self.lens] + np.arange(self.n)]
        return alpha, total

    def backward(self, logp: np.ndarray, visit=None) -> np.ndarray:
        """Log-probability of everything after each node. ``visit`` sees each edge group, last offset first."""
        beta = np.full((len(logp), self.nodes), -np.inf)
        beta[:, self.base[self.lens] + np.arange(self.n)] = 0.0
        for o in range(self.longest - 1, -1, -1):
            for length, ranks, ids in self.edges_from(o):
                source, target = self.base[o] + ranks, self.base[o + max(1, length)] + ranks
                step = beta[:, target] + self._weights(length, ids, logp)
                if visit is not None:
                    visit(length, ranks, ids, source, step)
                beta[:, source] = np.logaddexp(beta[:, source], step)
        return beta

    def expected(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, the strings weighted by ``counts`` (sets, strings)."""
        logp, counts = np.atleast_2d(logp), np.atleast_2d(counts)[:, self.order]
        alpha, total = self._forward(logp)
        total = total[:, self.order]
        out = np.zeros((len(logp), len(self.pieces)))

        def visit(length, ranks, ids, source, step):
            share = np.exp(alpha[:, source] + step - total[:, ranks]) * counts[:, ranks]
            for k in range(len(logp)):
                if length:
                    out[k] += np.bincount(ids, share[k], minlength=out.shape[1])
                else:
                    for point, mass in zip(ids.tolist(), share[k].tolist()):
                        for b in utf8(point):
                            out[k, self.pieces.byte_ids[b]] += mass

        self.backward(logp, visit)
        return out


def utf8(point: int) -> bytes:
    return chr(point).encode("utf-8", "surrogatepass")


def byte_weights(pieces: Pieces, points: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Log-probability of spelling each code point by its bytes, shape (sets, points)."""
    distinct, back = np.unique(points, return_inverse=True)
    sums = np.array([logp[:, pieces.byte_ids[list(utf8(int(p)))]].sum(axis=1) for p in distinct]).reshape(-1, len(logp))
    return sums[back].T


def adapted(prior: np.ndarray, expected: np.ndarray, strength: float) -> np.ndarray:
    """Log of the posterior mean: expected uses plus ``strength`` uses spread as the prior says."""
    mass = np.asarray(expected, float) + strength * np.exp(prior)
    with np.errstate(divide="ignore"):
        return np.log(mass / mass.sum(axis=-1, keepdims=True))
