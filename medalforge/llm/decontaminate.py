"""Benchmark decontamination: training suffix arrays, searched for every suffix of every test item.

Documents are cut into shards (whole documents, about ``SHARD_BYTES`` of text). A shard
turns its words into codes of the test vocabulary, leaves out words that no item has
and runs too short for a match, sorts the suffixes of the rest (prefix doubling, as deep as
the longest item) and looks every item suffix up by binary search, one word deeper at a
time. The interval that is left at window depth holds all places of that window, and the deepest
interval that is not empty the longest verbatim match (reported if it holds a window).

A window is ``window`` consecutive words of an item; an item of fewer, but not none, is one
window. ``find_contamination`` returns one row per document with the words that lie in an
occurrence of a window (``hits``, merged spans), the items found and the longest match;
``remove_contaminated`` keeps the documents without one.

A document lies in one shard, so nothing is shuffled. The items go to the tasks in
blocks of about ``BLOCK_BYTES`` of text; if they need several blocks, each block passes over
the numbered documents, and the spans of a document are merged.

Defined results: null texts have no words; items without words match nothing; items are told
apart by their id as text, a null id is written as an empty string; documents keep every repeated
row; other columns do not matter. Words are compared by 64-bit hash and length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import steps, stored, strings, table

WINDOW = 10
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 8 << 20
_ROW = "_row"
FOUND = ("n_words long, hits array<struct<start:long,end:long>>, items array<string>, "
         "longest struct<item:string,item_start:long,start:long,n_words:long>")
_ARROW = [("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
          ("items", pa.list_(pa.string())),
          ("longest", pa.struct([("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64())]))]

# Bytes that belong to words after A-Z are lowered: digits, a-z and everything beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_WEIGHTS = np.random.default_rng(7).integers(1 << 62, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every row in order, and the row that each belongs to."""
    text = strings(text)
    ends = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    low = _LOWER[data]
    inside = _WORD[low]
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = (ends - ends[0])[:-1]
    cuts = cuts[cuts < len(low)]
    before[cuts] = False  # a word never reaches over a row's end
    first = inside & ~before
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kept = np.flatnonzero(inside)
    at = np.cumsum(first[kept]) - 1
    place = kept - starts[at]
    del first, before
    heads = np.flatnonzero(place == 0)
    with np.errstate(over="ignore"):
        value = _WEIGHTS[place & 4095] * (low[kept].astype(np.uint64) + np.uint64(1))
        hashes = np.add.reduceat(value, heads)
        hashes += np.diff(np.append(heads, len(kept))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    rows = np.searchsorted(ends - ends[0], starts, side="right") - 1
    return hashes, rows


@dataclass
class Items:
    """A block of test items: their words as codes from 1, one after the other, each suffix with its item."""

    names: list[str]  # distinct ids
    vocabulary: np.ndarray  # sorted word hashes; code = place + 1
    codes: np.ndarray
    item: np.ndarray  # of each suffix, as place of its id
    offset: np.ndarray  # of each suffix in its item
    left: np.ndarray  # words from the suffix's start to the item's end
    window: np.ndarray  # words of a window of its item

    @classmethod
    def of(cls, ids: list[str], texts: list[str], window: int) -> Items:
        hashes, rows = word_hashes(pa.array(texts, pa.string()))
        vocabulary, codes = np.unique(hashes, return_inverse=True)
        sizes = np.bincount(rows, minlength=len(ids))
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        names, item = np.unique(np.array(ids, object), return_inverse=True) if ids else ([], np.zeros(0, np.int64))
        return cls(list(names), vocabulary, codes + 1, item.ravel()[rows], offset, sizes[rows] - offset, np.minimum(window, sizes)[rows])


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``text``, in order of their first ``depth`` codes at least."""
    rank = text.astype(np.int64)
    k = 1
    while True:
        order = np.argsort(rank, kind="stable")
        sorted_rank = rank[order]
        fresh = np.empty(len(text), bool)
        fresh[:1] = False
        fresh[1:] = sorted_rank[1:] != sorted_rank[:-1]
        place = np.cumsum(fresh)
        if k >= depth or not len(text) or place[-1] == len(text) - 1:
            return order
        dense = np.empty(len(text), np.int64)
        dense[order] = place + 1
        following = np.zeros(len(text), np.int64)
        following[:-k] = dense[k:] if k < len(text) else 0
        rank = dense * (len(text) + 1) + following
        k *= 2


def _bound(text, order, depth, low, high, code, after: bool):
    """First place in [low, high) whose suffix has at ``depth`` a code not under (``after``: over) ``code``."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        found = text[order[middle] + depth]
        up = found <= code[open_] if after else found < code[open_]
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
        open_ = open_[low[open_] < high[open_]]
    return low


def search_shard(codes: np.ndarray, rows: np.ndarray, items: Items):
    """Windows and longest matches of ``items`` in the words (codes, 0: of no item) of a shard's rows.

    Returns (word is hit, (row, item) pairs, (row, suffix, word, length) of each row's longest match).
    """
    hit = np.zeros(len(codes) + 1, np.int64)
    shortest = int(items.window.min())
    # runs of known words within a row that are long enough for a window; 0 ends each run
    edge = np.ones(len(codes) + 1, bool)
    edge[1:-1] = (rows[1:] != rows[:-1]) | ((codes[1:] == 0) != (codes[:-1] == 0))
    at = np.flatnonzero(edge)
    size = np.diff(at)
    wide = (size >= shortest) & (codes[at[:-1]] > 0)
    starts, sizes = at[:-1][wide], size[wide]
    none = np.zeros(0, np.int64)
    if not len(starts):
        return hit[:-1] > 0, (none, none), (none, none, none, none)
    jumps = np.repeat(starts - np.append(0, np.cumsum(sizes + 1)[:-1]), sizes + 1)
    origin = np.arange(len(jumps)) + jumps  # word of each place of the text; one past the run for its 0
    text = np.append(codes, 0)[origin]
    text[np.cumsum(sizes + 1) - 1] = 0
    depth_limit = int(items.left.max())
    order = suffix_array(text, depth_limit)
    text = np.append(text, np.zeros(depth_limit + 1, text.dtype))
    first = text[order]

    suffix = np.arange(len(items.codes))
    low = np.searchsorted(first, items.codes, side="left")
    high = np.searchsorted(first, items.codes, side="right")
    windows = []  # (low, high, words, item)
    longest = np.zeros(len(order), np.int64)  # words matched from each suffix of the shard, at window depth at least
    by = np.zeros(len(order), np.int64)
    depth = 1
    while True:
        alive = low < high
        suffix, low, high = suffix[alive], low[alive], high[alive]
        if not len(suffix):
            break
        full = items.window[suffix] == depth
        if full.any():
            windows.append((low[full], high[full], np.full(full.sum(), depth), items.item[suffix[full]]))
        deep = items.window[suffix] <= depth
        if deep.any():
            pairs, one = np.unique(np.stack([low[deep], high[deep]]), axis=1, return_index=True)
            for a, b, s in zip(pairs[0].tolist(), pairs[1].tolist(), suffix[deep][one].tolist()):
                longest[a:b] = depth
                by[a:b] = s
        more = items.left[suffix] > depth
        suffix, low, high = suffix[more], low[more], high[more]
        code = items.codes[suffix + depth]
        low, high = (_bound(text, order, depth, low, high, code, False),
                     _bound(text, order, depth, low, high, code, True))
        depth += 1
    if not windows:
        return hit[:-1] > 0, (none, none), (none, none, none, none)

    low, high, width, item = (np.concatenate(c) for c in zip(*windows))
    _, one, same = np.unique(np.stack([low, high, width]), axis=1, return_index=True, return_inverse=True)
    same = same.ravel()
    # a word starts one window of each width, so the places of different windows are at most words x widths
    count = (high - low)[one]
    which = np.repeat(np.arange(len(one)), count)
    place = np.repeat(low[one] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    word = origin[order[place]]
    np.add.at(hit, word, 1)
    np.add.at(hit, word + width[one][which], -1)
    # rows of each distinct window, then the items that have it
    held = np.unique(which * np.int64(rows[-1] + 1) + rows[word])
    window_of, row_of = held // np.int64(rows[-1] + 1), held % np.int64(rows[-1] + 1)
    known = np.unique(same * np.int64(len(items.names)) + item)
    owners = known % len(items.names)
    start = np.searchsorted(known // len(items.names), np.arange(len(one) + 1))
    fan = (start[1:] - start[:-1])[window_of]
    owner = owners[np.repeat(start[:-1][window_of] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())]
    pair = np.unique(np.repeat(row_of, fan) * np.int64(len(items.names)) + owner)

    matched = np.flatnonzero(longest)
    word = origin[order[matched]]
    best = np.lexsort((by[matched], word, -longest[matched], rows[word]))
    best = best[np.append(True, np.diff(rows[word[best]]) > 0)]
    top = (rows[word[best]], by[matched[best]], word[best], longest[matched[best]])
    return np.cumsum(hit[:-1]) > 0, (pair // len(items.names), pair % len(items.names)), top


def _search_batch(text: pa.Array, items: Items) -> list[pa.Array]:
    n = len(text)
    hashes, rows = word_hashes(text)
    n_words = np.bincount(rows, minlength=n)
    spans: list[list] = [[] for _ in range(n)]
    found: list[list] = [[] for _ in range(n)]
    longest: list[dict | None] = [None] * n
    if len(hashes) and len(items.codes):
        place = np.minimum(np.searchsorted(items.vocabulary, hashes), len(items.vocabulary) - 1)
        codes = np.where(items.vocabulary[place] == hashes, place + 1, 0)
        hit, (row, item), top = search_shard(codes, rows, items)
        first = np.cumsum(n_words) - n_words
        edge = np.flatnonzero(np.diff(np.concatenate([[0], np.where(hit, rows + 1, 0), [0]])))
        for a, b in zip(edge.tolist(), np.append(edge[1:], len(hit)).tolist()):
            if a < len(hit) and hit[a]:
                r = int(rows[a])
                spans[r].append({"start": int(a - first[r]), "end": int(b - first[r])})
        for r, i in zip(row.tolist(), item.tolist()):
            found[r].append(items.names[i])
        for r, s, w, k in zip(*(c.tolist() for c in top)):
            longest[r] = {"item": items.names[items.item[s]], "item_start": int(items.offset[s]),
                          "start": int(w - first[r]), "n_words": k}
    return [pa.array(c, t) for c, (_, t) in zip((n_words, spans, found, longest), _ARROW)]


def item_blocks(items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES):
    """The items of (item_id, text), one block of about ``block_bytes`` of text after the other, dealt by hash."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id")
    texts = items.select(name, F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    total = texts.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 16)).first()[0] or 0
    blocks = 1 + int(total) // block_bytes
    for block in range(blocks):
        mine = texts.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == block).orderBy("id", "text").toArrow()
        yield block + 1 == blocks, Items.of(mine.column("id").to_pylist(), mine.column("text").to_pylist(), window)


def find_contamination(documents: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                       window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(``keep`` columns of each document, n_words, hits, items, longest) against items (item_id, text)."""
    docs = documents.select(*keep, F.col("text").cast("string").alias("text"))
    blocks = item_blocks(items, window, block_bytes)
    last, block = next(blocks)
    if last:
        return _search(docs, block)
    rows = stored(docs.select(F.monotonically_increasing_id().alias(_ROW), F.struct(*keep).alias("_kept"), "text"), "decontaminate")
    found = stored(_search(rows, block), "matches")
    for _, block in blocks:
        part = _search(rows.select(_ROW, "text"), block).where(F.size("items") > 0)
        found = found.unionByName(stored(part, "matches"), allowMissingColumns=True)
    # at most one row per document and block
    merged = found.groupBy(_ROW).agg(
        F.first("_kept", ignorenulls=True).alias("_kept"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max_by("longest", F.struct("longest.n_words", -F.col("longest.start"))).alias("longest"))
    return _merge_spans(merged.select("_kept.*", "n_words", "hits", "items", "longest"))


def _merge_spans(found: DataFrame) -> DataFrame:
    """The same rows; spans that touch or overlap become one."""
    at = found.columns.index("hits")

    def run(batches):
        for batch in batches:
            hits = []
            for spans in batch.column(at).to_pylist():
                done: list[dict] = []
                for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
                    if done and span["start"] <= done[-1]["end"]:
                        done[-1]["end"] = max(done[-1]["end"], span["end"])
                    else:
                        done.append(span)
                hits.append(done)
            columns = list(batch.columns)
            columns[at] = pa.array(hits, _ARROW[1][1])
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return found.mapInArrow(run, found.schema)


def _search(docs: DataFrame, items: Items) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # one block of items
    kept = [f for f in docs.schema.fields if f.name != "text"]
    text_at = docs.columns.index("text")

    def run(batches):
        block = shared.value
        for batch in steps(batches, "text", SHARD_BYTES):
            columns = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            columns += _search_batch(batch.column(text_at), block)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + [n for n, _ in _ARROW])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [FOUND])
    return docs.mapInArrow(run, schema)


def remove_contaminated(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a word in any window of an item; all their columns."""
    packed = documents.select(F.struct("*").alias("_all"), "text")
    return find_contamination(packed, items, ("_all",), window).where(F.size("items") == 0).select("_all.*")


def op12_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.col("longest.n_words").alias("longest_words"),
        F.col("longest.item").alias("longest_item"), F.col("longest.start").alias("longest_at"))


# The same rows by plain windows: every window of an item against every window of a text of that length.
ORACLE_SQL = r"""
WITH text_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT DISTINCT COALESCE(CAST(item_id AS VARCHAR), '') AS item, text,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_window AS (
  SELECT item, text, i, least(10, len(w)) AS k, array_to_string(w[i + 1:i + least(10, len(w))], ' ') AS g
  FROM (SELECT *, unnest(range(len(w) - least(10, len(w)) + 1)) AS i FROM item_words WHERE len(w) > 0)),
widths AS (SELECT DISTINCT k FROM item_window),
text_window AS (
  SELECT r, a, k, array_to_string(w[a + 1:a + k], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS a FROM text_words, widths WHERE len(w) >= k)),
found AS (SELECT r, a, k, item, text, i FROM text_window JOIN item_window USING (k, g)),
hits AS (SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest(range(a, a + k)) AS p FROM found) GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY r),
-- windows that follow each other along one diagonal are one match
runs AS (
  SELECT r, item, text, k, a, i, a - row_number() OVER (PARTITION BY r, item, text, k, a - i ORDER BY a) AS run FROM found),
matches AS (
  SELECT r, item, text, MIN(a) AS a, MIN(i) AS i, COUNT(*) + k - 1 AS n FROM runs GROUP BY r, item, text, k, a - i, run),
best AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY n DESC, a, item, text, i) AS place FROM matches)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(h.n, 0) AS BIGINT) AS n_hit, CAST(COALESCE(len(items), 0) AS BIGINT) AS n_items,
       sha256(COALESCE(array_to_string(items, ','), '')) AS items_sha256, COALESCE(h.n, 0) > 0 AS contaminated,
       b.n AS longest_words, b.item AS longest_item, b.a AS longest_at
FROM text_words LEFT JOIN hits h USING (r) LEFT JOIN named USING (r) LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (r)"""
