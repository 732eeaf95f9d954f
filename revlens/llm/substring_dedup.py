"""Substring dedup by content-defined chunking.

The query (``find_passages``) reports every passage of at least ``min_words``
whole words that occurs, byte for byte, in a document with a smaller
identifier too: spans are the unions of the overlapping windows of
``min_words`` words that do.  The document with the smallest identifier keeps
the passage.  Two steps find them without comparing documents:

1. A gear hash rolls over the UTF-8 bytes of every text and sees the last 16
   bytes only.  The smallest hash of every ANCHOR_WINDOW places in a row ends
   a chunk, so no stretch is without ends.  Two places where the same at least
   2 * ANCHOR_WINDOW + 15 = 95 bytes stand share a chunk (with the 16 bytes
   before it), and what lies outside the shared chunks is under ANCHOR_WINDOW
   bytes a side.  Texts that repeat one word need 55 bytes and a period.
2. Only around chunks that occur under several identifiers are the windows of
   ``min_words`` words made, and grouped by digest.

So passages of ``min_words`` words and 95 bytes are all found, whatever stands
around them, 48 words of any length among them; shorter ones may be missed.
A word of the passage that is joined to its surroundings does not count.

``find_spans`` is the older and coarser form: chunks end where the chosen bits
of the hash are zero, consecutive repeated chunks make a span, and a passage
loses up to its first and last chunk, or all, where chunk ends are sparse.

Defined results: null and empty texts have no chunk; documents with the same
identifier, and repeats inside one document, are not repeats of each other;
rows with a null identifier neither give nor lose passages; ``find_spans``
cuts text without chunk ends every MAX_CHUNK bytes.  Whole texts of any length
are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, map_texts, staged, table, utf8, worker_state

CHUNK_BITS = 5  # a chunk has about 2^5 bytes
MIN_CHUNK = 8  # of chunk ends closer than this the first one counts
MAX_CHUNK = 1_024
MIN_WORDS = 18
REACH = 16  # bytes that the gear hash sees
ANCHOR_WINDOW = 40  # the smallest hash of so many places in a row ends a chunk
BYTES_AT_ONCE = 1 << 22
WORD = re.compile(rb"\S+")
NO_SPACE = np.array([not bytes([b]).isspace() for b in range(256)])
#: Slices share running sums over a block and what lies up to SLICE_BYTES behind it.
SLICE_BLOCK = 1 << 18
SLICE_BYTES = 1 << 12
SLICE_BASES = (1_103_515_245, 1_664_525_007)
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def gear_table() -> np.ndarray:
    """256 pseudo-random 16-bit numbers from a fixed linear congruential generator."""
    x, out = 0x9E3779B9, []
    for _ in range(256):
        x = (x * 6364136223846793005 + 1442695040888963407) & (2**64 - 1)
        out.append(x >> 48)
    return np.array(out, dtype=np.uint16)


GEAR = gear_table()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash h(i) = 2 h(i-1) + gear(byte i) at every byte, by doubling the reach."""
    h = GEAR[data]
    reach = 1
    while reach < 16:
        older = np.zeros_like(h)
        older[reach:] = h[:-reach] << np.uint16(reach)
        h = h + older
        reach *= 2
    return h


def chunk_ends(data: bytes, bits: int = CHUNK_BITS) -> np.ndarray:
    """Ends (exclusive) of the chunks of a text."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    found = []
    for begin in range(0, n, BYTES_AT_ONCE):
        back = min(begin, 15)
        h = gear_hash(raw[begin - back:begin + BYTES_AT_ONCE])[back:]
        found.append(np.flatnonzero(h >> np.uint16(16 - bits) == 0) + begin + 1)
    ends = np.concatenate(found)
    if len(ends):
        far = np.concatenate([[True], np.diff(ends) >= MIN_CHUNK])
        ends = ends[far]
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    sizes = np.diff(np.concatenate([[0], ends]))
    if sizes.max() > MAX_CHUNK:
        parts, begin = [], 0
        for e in ends.tolist():
            parts += [*range(begin + MAX_CHUNK, e, MAX_CHUNK), e]
            begin = e
        ends = np.array(parts, dtype=np.int64)
    return ends


def chunks(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``row`` and the digests and ends of the chunks of every text, as arrays."""
    fields = [T.StructField("digests", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.IntegerType()))]

    def make_kernel():
        import xxhash

        digest = xxhash.xxh3_64_intdigest

        def kernel(texts: pa.Array) -> list[pa.Array]:
            digests, ends_all, sizes = [], [], [0]
            for data in utf8(texts):
                ends = chunk_ends(data).tolist()
                digests += [digest(data[b:e]) for b, e in zip([0, *ends], ends)]
                ends_all += ends
                sizes.append(len(ends_all))
            offsets = pa.array(sizes, pa.int32())
            values = pa.array(np.array(digests, dtype=np.uint64).view(np.int64), pa.int64())
            return [pa.ListArray.from_arrays(offsets, values), pa.ListArray.from_arrays(offsets, pa.array(ends_all, pa.int32()))]

        return kernel

    return map_texts(docs, text, carry, fields, make_kernel)


SPAN = T.StructType([T.StructField("first_byte", T.IntegerType()), T.StructField("end_byte", T.IntegerType()),
                     T.StructField("n_words", T.IntegerType()), T.StructField("source_doc_id", T.LongType())])


def spans_of(data: bytes, marks: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int, int, int]]:
    """(first byte, end, words, source) of the runs of repeated chunks (begin, end, source) with enough words."""
    out, k = [], 0
    marks.sort()
    while k < len(marks):
        begin, end, source = marks[k]
        k += 1
        while k < len(marks) and marks[k][0] == end:
            end, source = marks[k][1], min(source, marks[k][2])
            k += 1
        words = len(WORD.findall(data[begin:end]))
        if words >= min_words:
            out.append((begin, end, words, source))
    return out


def repeated_chunks(chunked: DataFrame) -> DataFrame:
    """id, h (content hash of the row), begin, end, source: chunks that also occur in a smaller document."""
    slim = chunked.select("id", "h", F.posexplode("digests").alias("k", "digest"), "ends")
    slim = slim.select("id", "h", "digest", F.when(F.col("k") == 0, 0).otherwise(F.expr("ends[k - 1]")).alias("begin"),
                       F.expr("ends[k]").alias("end"))
    known = chunked.filter("id is not null")
    firsts = staged(known.select("id", F.explode("digests").alias("digest")).groupBy("digest")
                    .agg(F.min("id").alias("source"), F.max("id").alias("last")).filter("source < last")
                    .select("digest", "source"), "repeated-digests")
    return slim.join(firsts, "digest").filter("source < id").select("id", "h", "begin", "end", "source")


def find_spans(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_words: int = MIN_WORDS,
               carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns) and spans of the documents that have a repeated span.
    Identical rows share their spans."""
    carry = list(carry or [ident])
    h = F.xxhash64(col(ident), col(text))
    slim = docs.select(col(ident).cast("long").alias("id"), h.alias("h"), col(text).alias("t"))
    chunked = staged(chunks(slim, ["id", "h"], "t").select("row.*", "digests", "ends"), "chunks")
    repeats = repeated_chunks(chunked)
    # a run of enough words has enough bytes: documents below that need no look at their text
    # (a set, because identical rows give the same chunks twice)
    per_doc = staged(repeats.groupBy("id", "h").agg(F.collect_set(F.struct("begin", "end", "source")).alias("marks"),
                                                    F.sum(F.col("end") - F.col("begin")).alias("n"))
                     .filter(F.col("n") >= 2 * min_words - 1).drop("n"), "repeats-by-document")
    rows = docs.select(F.struct(*[col(c) for c in carry]).alias("carried"), col(ident).cast("long").alias("id"), h.alias("h"),
                       F.coalesce(col(text), F.lit("")).alias("t"))
    joined = rows.join(per_doc, ["id", "h"]).select("carried", F.struct("t", "marks").alias("x"))

    def make_kernel():
        def kernel(pairs: pa.Array) -> list[pa.Array]:
            out = []
            for data, marks in zip(utf8(pairs.field(0)), pairs.field(1).to_pylist()):
                found = spans_of(data, [(m["begin"], m["end"], m["source"]) for m in marks], min_words)
                out.append([dict(zip(SPAN.names, s)) for s in found])
            kind = pa.list_(pa.struct([(f.name, pa.int64() if f.name == "source_doc_id" else pa.int32()) for f in SPAN.fields]))
            return [pa.array(out, kind)]

        return kernel

    found = map_texts(joined, "x", ["carried"], [T.StructField("spans", T.ArrayType(SPAN))], make_kernel)
    return found.filter(F.size("spans") > 0).select(F.col("row.carried").alias("row"), "spans")


# ---- passages -----------------------------------------------------------------------------

def anchors(data: bytes) -> np.ndarray:
    """Ends (exclusive) of the chunks between smallest hashes: the last smallest one of every
    ANCHOR_WINDOW places whose 16 bytes lie in the text, and the end of the text."""
    n = len(data)
    raw = np.frombuffer(data, dtype=np.uint8)
    found = [np.zeros(0, dtype=np.int64)]
    for begin in range(REACH - 1, n - ANCHOR_WINDOW + 1, BYTES_AT_ONCE):
        stop = min(begin + BYTES_AT_ONCE, n - ANCHOR_WINDOW + 1)
        h = gear_hash(raw[begin - REACH + 1:stop + ANCHOR_WINDOW - 1])[REACH - 1:]
        m = len(h)
        low = (h.astype(np.int64) << 32) | np.arange(m, 0, -1)
        reach = 1
        while 2 * reach <= ANCHOR_WINDOW:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < ANCHOR_WINDOW:
            low = np.minimum(low[:reach - ANCHOR_WINDOW], low[ANCHOR_WINDOW - reach:])
        at = m - (low & 0xFFFFFFFF) + begin
        found.append(at[np.concatenate([[True], at[1:] != at[:-1]])] + 1)
    return np.unique(np.concatenate([*found, [n][:n]])).astype(np.int64)


class PowerSums:
    """Digests of many slices of a text: a polynomial over its bytes, modulo 2^31 - 1, for two
    bases, from running sums that all slices share.  Slices over SLICE_BYTES have an own digest."""

    def __init__(self, modulus: int = (1 << 31) - 1):
        self.modulus = modulus
        n = SLICE_BLOCK + SLICE_BYTES
        self.tables = [(self.powers(base, n), self.powers(pow(base, -1, modulus), SLICE_BLOCK)) for base in SLICE_BASES]

    def powers(self, base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), self.modulus)) % np.uint64(self.modulus)])
        return out[:n]

    def __call__(self, data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        import xxhash

        raw, p = np.frombuffer(data, dtype=np.uint8), np.uint64(self.modulus)
        out = np.zeros(len(begins), np.uint64)
        short = len(data) <= SLICE_BLOCK
        for block in [0][:len(begins)] if short else np.unique(begins // SLICE_BLOCK).tolist():
            at = block * SLICE_BLOCK
            mine = slice(None) if short else np.flatnonzero(begins // SLICE_BLOCK == block)
            b, e = begins[mine] - at, np.minimum(ends[mine] - at, SLICE_BLOCK + SLICE_BYTES)
            part = raw[at:at + int(e.max())].astype(np.uint64) + np.uint64(1)
            for up, down in self.tables:
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)])])  # below 2^60
                out[mine] = (out[mine] << np.uint64(31)) | ((sums[e] - sums[b]) % p * down[b] % p)
        for i in np.flatnonzero(ends - begins > SLICE_BYTES).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[begins[i]:ends[i]])
        return out


def anchored_chunks(data: bytes, digests_of: PowerSums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests, begins and ends of the chunks, each with the 16 bytes before it; equal
    neighbours (repeated words) are one."""
    ends = anchors(data)
    begins = np.maximum(np.concatenate([[0], ends[:-1]])[:len(ends)] - REACH, 0)
    digests = digests_of(data, begins, ends)
    first = np.flatnonzero(np.concatenate([[True], digests[1:] != digests[:-1]])[:len(ends)])
    last = np.append(first[1:], len(ends))[:len(first)] - 1
    return digests[first], begins[first], ends[last]


def word_windows(data: bytes, marks: list[tuple[int, int]], min_words: int,
                 digests_of: PowerSums) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests, begins, ends and first word of the windows of ``min_words`` whole words within
    ANCHOR_WINDOW bytes of the marks.  Words are numbered within a stretch of marks."""
    stretches: list[list[int]] = []
    for begin, end in sorted(marks):
        begin, end = max(begin - ANCHOR_WINDOW, 0), min(end + ANCHOR_WINDOW, len(data))
        if stretches and begin <= stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], end)
        else:
            stretches.append([begin, end])
    raw = np.frombuffer(data, dtype=np.uint8)
    none = np.zeros(0, np.int64)
    out = [[none], [none], [none]]
    for begin, end in stretches:
        black = np.concatenate([[False], NO_SPACE[raw[begin:end]], [False]])
        starts, stops = (np.flatnonzero(x) + begin for x in (black[1:] & ~black[:-1], black[:-1] & ~black[1:]))
        if len(starts) and starts[0] == begin > 0 and NO_SPACE[raw[begin - 1]]:
            starts, stops = starts[1:], stops[1:]
        if len(starts) and stops[-1] == end < len(data) and NO_SPACE[raw[end]]:
            starts, stops = starts[:-1], stops[:-1]
        n = len(starts) - min_words + 1
        if n > 0:
            for column, value in zip(out, (starts[:n], stops[min_words - 1:], np.arange(n))):
                column.append(value)
    begins, ends, first = (np.concatenate(c) for c in out)
    return digests_of(data, begins, ends), begins, ends, first


def merged_windows(marks: pa.ListArray, min_words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(offsets, [first byte, end, words, source]): the unions of overlapping windows (place, first
    word, source) in each list, a union's words counted and its smallest source."""
    sizes = np.diff(marks.offsets.to_numpy())
    place, word, source = (c.to_numpy() for c in marks.flatten().flatten())
    row = np.repeat(np.arange(len(sizes)), sizes)
    begin = place >> 32
    order = np.lexsort((source, word, place, row))
    row, begin, end, word, source = row[order], begin[order], (begin + (place & 0xFFFFFFFF))[order], word[order], source[order]
    # a window that begins before the one before it has ended belongs to its union
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (begin[1:] >= end[:-1])])[:len(row)])
    last = np.append(first[1:], len(row))[:len(first)] - 1
    found = [begin[first], end[last], word[last] - word[first] + min_words,
             np.minimum.reduceat(source, first) if len(first) else source]
    return np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=len(sizes)))]), found


def released(df: DataFrame, name: str) -> DataFrame:
    """``staged``, and the shuffle files of the step are let go when it is written."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        return staged(df, name)
    finally:
        conf.unset(RELEASE) if before is None else conf.set(RELEASE, before)


def discard(made: DataFrame) -> None:
    """Delete the staged table that ``made`` reads, after its last use."""
    spark = made.sparkSession
    for file in made.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pieces(docs: DataFrame, column: str, names: list[str], make_lists) -> DataFrame:
    """id, h and one row per piece: its digest and the named integers.  ``make_lists(text, marks,
    digests_of)`` gives the digests and integers of a row's pieces as arrays."""
    piece = T.StructType([T.StructField("digest", T.LongType()), *[T.StructField(n, T.IntegerType()) for n in names]])

    def make_kernel():
        digests_of = worker_state(("power-sums",), PowerSums)

        def kernel(values: pa.Array) -> list[pa.Array]:
            columns, sizes = [[np.zeros(0, np.int64)] for _ in piece.names], [0]
            texts = utf8(values.field(0)) if pa.types.is_struct(values.type) else utf8(values)
            marks = values.field(1).to_pylist() if pa.types.is_struct(values.type) else [None] * len(texts)
            for data, m in zip(texts, marks):
                found = make_lists(data, m, digests_of)
                columns[0].append(found[0].view(np.int64))
                for c, x in zip(columns[1:], found[1:]):
                    c.append(x)
                sizes.append(sizes[-1] + len(found[0]))
            arrays = [pa.array(np.concatenate(columns[0]))]
            arrays += [pa.array(np.concatenate(c).astype(np.int32)) for c in columns[1:]]
            return [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(arrays, names=piece.names))]

        return kernel

    made = map_texts(docs, column, ["id", "h"], [T.StructField("pieces", T.ArrayType(piece))], make_kernel)
    kept = released(made.filter(F.size("pieces") > 0).select("row.*", "pieces"), "pieces")
    return kept.select("id", "h", F.explode("pieces").alias("p")).select("id", "h", "p.*")


def shared_digests(found: DataFrame) -> DataFrame:
    """digest, source: the digests under more than one identifier, with the smallest."""
    return released(found.groupBy("digest").agg(F.min("id").alias("source"), F.max("id").alias("last"))
                    .filter("source < last").select("digest", "source"), "shared-digests")


def find_passages(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_words: int = MIN_WORDS,
                  carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns) and spans of the documents that have a repeated passage.
    Identical rows share their spans."""
    carry = list(carry or [ident])
    ident_col, h = col(ident).cast("long").alias("id"), F.xxhash64(col(ident), col(text)).alias("h")
    slim = docs.select(ident_col, h, col(text).alias("t")).filter("id is not null and t <> ''")
    chunked = pieces(slim, "t", ["begin", "end"], lambda data, _, digests_of: anchored_chunks(data, digests_of))
    # the windows of the first document are needed as well as those of the later ones; begin and size travel as one number
    place = (F.shiftleft(F.col("begin").cast("long"), 32) + F.col("end") - F.col("begin")).alias("place")
    placed = chunked.select("h", "digest", place)
    marks = released(placed.join(shared_digests(chunked).select("digest"), "digest")
                     .groupBy("h").agg(F.collect_set("place").alias("marks")), "marks")
    discard(chunked)
    near = slim.join(marks, "h").select("id", "h", F.struct("t", "marks").alias("x"))
    windows = pieces(near, "x", ["begin", "end", "word"],
                     lambda data, m, digests_of: word_windows(
                         data, [(p >> 32, (p >> 32) + (p & 0xFFFFFFFF)) for p in m], min_words, digests_of))
    # a set, because identical rows give the same windows twice
    repeats = windows.select("id", "h", "digest", place, "word").join(shared_digests(windows), "digest") \
        .filter("source < id").groupBy("id", "h").agg(F.collect_set(F.struct("place", "word", "source")).alias("marks"))

    def make_kernel():
        def kernel(marks: pa.Array) -> list[pa.Array]:
            offsets, columns = merged_windows(marks, min_words)
            values = [pa.array(c, pa.int64() if f.name == "source_doc_id" else pa.int32()) for c, f in zip(columns, SPAN.fields)]
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(values, names=SPAN.names))]

        return kernel

    spans = released(map_texts(repeats, "marks", ["id", "h"], [T.StructField("spans", T.ArrayType(SPAN))], make_kernel)
                     .select("row.*", "spans"), "spans")
    discard(windows)
    rows = docs.select(F.struct(*[col(c) for c in carry]).alias("row"), ident_col, h)
    return rows.join(spans, ["id", "h"]).select("row", "spans")


def cut(text: str | None, spans: list) -> str:
    """A text without its repeated spans (bytes that no longer form a character are dropped)."""
    data, out, at = (text or "").encode(), b"", 0
    for s in spans:
        out += data[at:s["first_byte"]]
        at = s["end_byte"]
    return (out + data[at:]).decode("utf-8", "ignore")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per repeated span: where it is and the smallest document that has a window of it."""
    found = find_passages(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
