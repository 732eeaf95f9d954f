"""Benchmark decontamination with suffix arrays over the training text.

Words of documents and benchmark items are numbered by the benchmark's
vocabulary.  Each Arrow batch of documents is a shard: its word positions from
which a match of the shortest window could start (all words known, all
neighbouring pairs known: a lossless test) are put into one array, and a
suffix array sorts them.  Every suffix of every benchmark item is located by
binary search; the interval of suffixes that begin with its window gives all
places of it, and the sorted test suffixes around a training suffix give the
longest verbatim match that begins there.  Two suffixes are compared by names
of their stretches of 1, 2, 4, ... words (equal names, equal words), so that a
comparison takes steps by the logarithm of the match and repeated words cost
no more than others.  Documents never leave their task: there is no shuffle.

The benchmark is read in blocks of about BLOCK_BYTES of text by item hash; a
block is what the driver and a worker hold at a time, whatever the size of
the benchmark.

Defined results: null texts and texts without words have no words and are
clean; ``matches`` has every longest verbatim match with a window in it that
is not the tail of one beginning a word earlier, in document order (where
several items have it, one of them is named); an item without words has no window; an item with fewer words than the
window is one window; repeated items and equal windows count once per item
identifier; a null item identifier is written as ``null``; an empty benchmark
leaves all documents clean.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, map_texts, table, utf8

WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20
PAIR_SLOTS = 1 << 22  # of the table that tests neighbouring word pairs; false hits cost time only

#: Bytes that belong to words: digits, letters (lower-cased) and everything beyond ASCII.
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
                   for c in range(256))

MATCH = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_word", T.IntegerType()),
                      T.StructField("doc_word", T.IntegerType()), T.StructField("n_words", T.IntegerType())])
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest", MATCH),
          T.StructField("matches", T.ArrayType(MATCH))]


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


def slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) * 1_000_003 + right) & (PAIR_SLOTS - 1)


class Block:
    """Benchmark items prepared for searching: words as numbers from 1, every
    item followed by 0, and the distinct windows with the items they occur in."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        tokens: list[int] = []
        self.item_ids: list[str] = []
        self.item_of: list[int] = []
        self.place: list[int] = []
        windows: dict[tuple, int] = {}
        self.window_items: list[set[str]] = []
        self.window_at: list[int] = []
        self.window_len: list[int] = []
        for ident, data in items:
            ids = [number.setdefault(w, len(number) + 1) for w in words_of(data)]
            if not ids:
                continue
            base, size = len(tokens), min(window, len(ids))
            for i in range(len(ids) - size + 1):
                key = tuple(ids[i:i + size])
                k = windows.setdefault(key, len(windows))
                if k == len(self.window_items):
                    self.window_items.append(set())
                    self.window_at.append(base + i)
                    self.window_len.append(size)
                self.window_items[k].add(ident)
            self.item_of += [len(self.item_ids)] * (len(ids) + 1)
            self.place += range(len(ids) + 1)
            self.item_ids.append(ident)
            tokens += [*ids, 0]
        self.tokens = np.array([*tokens, 0], dtype=np.int32)
        self.shortest = min(self.window_len, default=window)
        self.window_at = np.array(self.window_at, dtype=np.int64)
        self.window_len = np.array(self.window_len, dtype=np.int64)
        self.starts = suffix_array(self.tokens)  # every test suffix, sorted

    def pairs(self) -> np.ndarray:
        seen = np.zeros(PAIR_SLOTS, dtype=bool)
        left, right = self.tokens[:-1], self.tokens[1:]
        both = (left > 0) & (right > 0)
        seen[slots(left[both], right[both])] = True
        return seen


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Suffixes of ``tokens`` (0 ends a stretch) that start at a word, sorted; by prefix doubling."""
    n = len(tokens)
    rank = tokens.astype(np.int64)
    step = 1
    # words left before the stretch ends bound the depth at which suffixes can differ
    longest = int(np.diff(np.flatnonzero(np.concatenate([[0], tokens, [0]]) == 0)).max()) if n else 0
    while step < longest:
        after = np.zeros(n, dtype=np.int64)
        after[:n - step] = rank[step:]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new + 1
        rank[tokens == 0] = 0
        step *= 2
    order = np.argsort(rank, kind="stable")
    return order[tokens[order] > 0]


class Names:
    """Names of the stretches of 1, 2, 4, ... words of the test words and of the
    training words: equal exactly where the words are; 0 where a stretch ends
    sooner or, in the training words, where no test stretch is equal.  Levels go
    as far as some training stretch is equal."""

    def __init__(self, test: np.ndarray, train: np.ndarray):
        self.test, self.train = [test.astype(np.int32)], [train.astype(np.int32)]
        size = 1
        while self.train[-1].any() and size < len(test):
            x, y = self._codes(self.test[-1], size), self._codes(self.train[-1], size)
            known, names = np.unique(x, return_inverse=True)
            if len(known) < 2:
                break  # no test stretch is that long
            at = np.minimum(np.searchsorted(known, y), len(known) - 1)
            # code 0 sorts first and keeps the name 0
            self.test.append(names.astype(np.int32) if known[0] == 0 else names.astype(np.int32) + 1)
            self.train.append(np.where((y > 0) & (known[at] == y), at if known[0] == 0 else at + 1, 0).astype(np.int32))
            size *= 2

    @staticmethod
    def _codes(names: np.ndarray, size: int) -> np.ndarray:
        after = np.zeros(len(names), dtype=np.int64)
        after[:max(len(names) - size, 0)] = names[size:]
        return np.where((names > 0) & (after > 0), (names.astype(np.int64) << 32) | after, 0)

    def same(self, at: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Equal words of pairs of a test suffix and a training suffix."""
        length = np.zeros(len(at), dtype=np.int64)
        for level in range(len(self.test) - 1, -1, -1):
            # a stretch and the 0 behind it lie within the words, so the places do too
            x, y = self.test[level][at + length], self.train[level][where + length]
            length += ((x == y) & (x > 0)).astype(np.int64) << level
        return length

    def sign(self, at: np.ndarray, where: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """Of test - training suffixes, looking at ``most`` words at most."""
        length = self.same(at, where)
        out = np.sign(self.test[0][at + length].astype(np.int64) - self.train[0][where + length])
        return out if most is None else np.where(length >= most, 0, out)


def insertion(names: Names, at: np.ndarray, order: np.ndarray, most: np.ndarray | None = None, after_equal: bool = False) -> np.ndarray:
    """Binary search of all test suffixes at once in the sorted training suffixes."""
    low = np.zeros(len(at), dtype=np.int64)
    high = np.full(len(at), len(order), dtype=np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        sign = names.sign(at[open_], order[mid], None if most is None else most[open_])
        right = sign >= 0 if after_equal else sign > 0
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]


def shard(block: Block, pairs: np.ndarray, docs: list[list[bytes]]):
    """(tokens, document, word place) of the stretches of the documents in which
    a window of the block can occur."""
    get = block.vocabulary.get
    lens = np.array([len(w) for w in docs], dtype=np.int64)
    total = int(lens.sum())
    ids = np.fromiter((get(w, 0) for words in docs for w in words), dtype=np.int32, count=total)
    doc = np.repeat(np.arange(len(docs)), lens)
    joined = np.zeros(total, dtype=bool)  # is the pair (i, i+1) one of the benchmark's, within a document
    if total > 1:
        near = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0) & (doc[:-1] == doc[1:]))
        joined[near] = pairs[slots(ids[near], ids[near + 1])]
    known = ids > 0
    begins = known.copy()
    begins[1:] &= ~joined[:-1]
    stretch = np.cumsum(begins)  # of a known word: its stretch, from 1
    size = np.bincount(stretch[known], minlength=int(stretch[-1]) + 1 if total else 1)
    keep = np.flatnonzero(known & (size[stretch] >= block.shortest)) if total else np.zeros(0, np.int64)
    first_of_doc = np.concatenate([[0], np.cumsum(lens)])
    # a 0 before each stretch but the first, and two at the end
    gap = np.cumsum(np.concatenate([[0], (stretch[keep][1:] != stretch[keep][:-1]).astype(np.int64)])) if len(keep) else keep
    n = len(keep) + (int(gap[-1]) + 2 if len(keep) else 2)
    tokens = np.zeros(n, dtype=np.int32)
    owner = np.zeros(n, dtype=np.int64)
    place = np.zeros(n, dtype=np.int64)
    to = np.arange(len(keep)) + gap
    tokens[to], owner[to], place[to] = ids[keep], doc[keep], keep - first_of_doc[doc[keep]]
    return tokens, owner, place


def search(block: Block, pairs: np.ndarray, docs: list[list[bytes]]):
    """Per document of the batch: hit word places, items, matches."""
    hit: dict[int, np.ndarray] = {}
    items: dict[int, set[str]] = {}
    matches: dict[int, list[tuple]] = {}
    tokens, owner, place = shard(block, pairs, docs)
    order = suffix_array(tokens)
    if not len(order) or not len(block.window_at):
        return hit, items, matches
    test, starts = block.tokens, block.starts
    names = Names(test, tokens)
    at = insertion(names, starts, order)  # ascending, as the test suffixes are sorted
    # the sorted test suffixes on both sides of a training suffix have its longest match
    best = np.zeros(len(tokens), dtype=np.int64)
    best_at = np.zeros(len(tokens), dtype=np.int64)
    after = np.searchsorted(at, np.arange(len(order)), side="right")
    for side in (after - 1, after):
        ok = np.flatnonzero((side >= 0) & (side < len(starts)))
        spot, of = order[ok], starts[side[ok]]
        same = names.same(of, spot)
        better = same > best[spot]
        best[spot[better]], best_at[spot[better]] = same[better], of[better]
    # all places of all windows
    q, most = block.window_at, block.window_len
    low = insertion(names, q, order, most)
    high = insertion(names, q, order, most, True)
    count = high - low
    which = np.repeat(np.arange(len(q)), count)
    if not len(which):
        return hit, items, matches
    spot = order[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
    change = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.add.at(change, spot, 1)
    np.add.at(change, spot + most[which], -1)
    covered = np.flatnonzero(np.cumsum(change)[:-1] > 0)
    docs_hit, begins = np.unique(owner[covered], return_index=True)  # the array is in document order
    for d, places in zip(docs_hit.tolist(), np.split(place[covered], begins[1:])):
        hit[d] = places
    of = owner[spot]
    for code in np.unique(of * len(q) + which).tolist():
        items.setdefault(code // len(q), set()).update(block.window_items[code % len(q)])
    # matches: they begin with a window, or the window lies further inside and the match begins before it
    tail = np.zeros(len(tokens), dtype=bool)  # the match is the rest of the one a word earlier
    tail[1:] = (best[:-1] == best[1:] + 1) & (best[1:] > 0)
    windows = np.zeros(len(tokens) + 1, dtype=np.int64)  # smallest end of a window beginning at or after a place
    windows[:] = len(tokens) + 1
    np.minimum.at(windows, spot, spot + most[which])
    windows = np.minimum.accumulate(windows[::-1])[::-1]
    heads = np.flatnonzero((best > 0) & ~tail)
    for i in heads[windows[heads] <= heads + best[heads]].tolist():
        k = int(best_at[i])
        matches.setdefault(int(owner[i]), []).append((block.item_ids[block.item_of[k]], block.place[k], int(place[i]), int(best[i])))
    return hit, items, matches


def blocks_of(benchmark: DataFrame, text: str, item: str, window: int, block_bytes: int):
    """Broadcast blocks of the benchmark; each passes the driver on its own."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(col(item).cast("string"), F.lit("null")).alias("i"),
                            F.coalesce(col(text), F.lit("")).cast("binary").alias("t")).distinct()  # equal rows share a block
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    out = []
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        # the order of the items is fixed, so that retried tasks name the same longest match
        items = sorted((r["i"], bytes(r["t"])) for r in part.toLocalIterator())
        out.append(spark.sparkContext.broadcast(Block(items, window)))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", item: str = "item_id",
                       benchmark_text: str = "text", window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` and n_words, n_hit, items (sorted), longest match and all matches of every document."""
    shared = blocks_of(benchmark, benchmark_text, item, window, block_bytes)

    def make_kernel():
        tables: dict[int, np.ndarray] = {}

        def kernel(texts: pa.Array) -> list[pa.Array]:
            docs_words = [words_of(d) for d in utf8(texts)]
            hits: dict[int, np.ndarray] = {}
            items: dict[int, set[str]] = {}
            matches: dict[int, list[tuple]] = {}
            for k, b in enumerate(shared):
                block = b.value
                if k not in tables:
                    if len(shared) > 1:
                        tables.clear()
                    tables[k] = block.pairs()
                found = search(block, tables[k], docs_words)
                for d, places in found[0].items():
                    hits[d] = np.union1d(hits[d], places) if d in hits else places
                for d, names in found[1].items():
                    items.setdefault(d, set()).update(names)
                for d, more in found[2].items():
                    matches.setdefault(d, []).extend(more)
                if len(shared) > 1:
                    b.__dict__.pop("_value", None)  # hold one block at a time
            n = len(docs_words)
            names = ("item_id", "item_word", "doc_word", "n_words")
            # the order is by content, whatever the blocks; the longest is the first of the longest ones
            every = [[dict(zip(names, m)) for m in sorted(matches.get(d, ()), key=lambda m: (m[2], -m[3], m[0], m[1]))] for d in range(n)]
            longest = [max(ms, key=lambda m: m["n_words"], default=None) for ms in every]
            kind = pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())])
            return [pa.array([len(w) for w in docs_words], pa.int64()),
                    pa.array([len(hits.get(d, ())) for d in range(n)], pa.int64()),
                    pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.string())),
                    pa.array(longest, kind), pa.array(every, pa.list_(kind))]

        return kernel

    return map_texts(docs, text, carry, FIELDS, make_kernel)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.filter("n_hit = 0").select("row.*")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS br, coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS k
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT DISTINCT r, p, dw.n, item FROM dw JOIN win ON dw.k = win.k AND dw.n = win.n),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM occ) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM occ GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
