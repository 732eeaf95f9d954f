"""Best-fit packing of documents into sequences of a fixed number of tokens.

Best-two-fit: a sequence is filled greedily with the longest documents that
still fit; then its smallest document is replaced by the two unpacked documents
that together fit the gap so expanded most tightly, if they fit it more tightly
than the document did.

What a sequence holds depends on lengths alone, so the packing is worked out on
the number of documents of each length (at most ``capacity`` numbers, however
large the table): a pattern of lengths is used as often as the counts allow
before the next one is sought.  Every document then looks its place up: its
rank among the documents of its length falls into the interval of ranks that a
pattern took of that length.  Ranks are counted within the tasks that encode,
plus the counts of the tasks before, so no length, however common, is gathered
in one task.

Only documents longer than ``capacity`` are cut: the first piece takes what is
left over by whole pieces of ``capacity`` tokens.

Defined results: a null text is the end id alone; repeated rows and identifiers
are documents of their own; null identifiers stay null; an empty table gives an
empty result.  Texts of any length are one row; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.bpe import default_path, tokenizer_json
from revlens.llm.common import col, map_texts, staged, table, worker_state
from revlens.llm.token_batches import BatchEncoder

CAPACITY = 2048
END_ID = 0
RANK_BITS = 48


# ---- patterns of lengths ------------------------------------------------------------------

def fill(counts: dict[int, int], lengths: list[int], capacity: int) -> tuple[dict[int, int], int, bool]:
    """(length -> number, gap, whether a length ran out while more of it would have fitted)."""
    taken, gap, short, top = {}, capacity, False, len(lengths)
    while True:
        top = bisect_right(lengths, gap, 0, top)
        if not top:
            return taken, gap, short
        top -= 1
        length = lengths[top]
        n = min(counts[length], gap // length)
        short |= n < gap // length
        taken[length] = n
        gap -= n * length


def best_pair(counts: dict[int, int], lengths: list[int], above: int, room: int) -> tuple[int, int] | None:
    """Two documents that leave the least of ``room`` and together exceed ``above``; of equal
    sums the pair with the longest document."""
    best, found = above, None
    low, high = 0, bisect_right(lengths, room) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > room:
            high -= 1
        elif low == high and counts[a] < 2:
            break
        else:
            if a + b > best:
                best, found = a + b, (b, a)
                if best == room:
                    break
            low += 1
    return found


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(copies, length -> number) of all sequences by best-two-fit."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(counts)
    if lengths and not 0 < lengths[0] <= lengths[-1] <= capacity:
        raise ValueError("lengths lie between 1 and the capacity")
    out = []
    while lengths:
        taken, gap, short = fill(counts, lengths, capacity)
        need, net = dict(taken), dict(taken)
        smallest = min(taken)
        if gap and sum(taken.values()) > 0:
            # what is left beside the sequence; all of it is longer than the gap
            left = {n: counts[n] - taken.get(n, 0) for n in lengths[bisect_right(lengths, gap):bisect_right(lengths, smallest)]}
            free = [n for n, c in left.items() if c > 0]
            pair = best_pair(left, free, smallest, gap + smallest)
            if pair:
                net[smallest] -= 1
                for n in pair:
                    need[n] = need.get(n, 0) + 1
                    net[n] = net.get(n, 0) + 1
        net = {n: c for n, c in net.items() if c}
        # the same choices come again while every length still has what this sequence needed
        copies = 1 if short else min((counts[n] - need[n]) // c for n, c in net.items()) + 1
        for n, c in net.items():
            counts[n] -= copies * c
            if not counts[n]:
                del counts[n]
                lengths.remove(n)
        out.append((copies, net))
    return out


class Places:
    """Sequence and offset of the r-th document of a length.

    Arrays over (pattern, length): the first rank, the documents of that length
    in each copy, the first sequence and the first offset."""

    def __init__(self, found: list[tuple[int, dict[int, int]]]):
        rows, taken, sequence = [], {}, 0
        for copies, numbers in found:
            offset = 0
            for length in sorted(numbers, reverse=True):
                n = numbers[length]
                rows.append(((length << RANK_BITS) + taken.get(length, 0), n, sequence, offset))
                taken[length] = taken.get(length, 0) + copies * n
                offset += n * length
            sequence += copies
        rows.sort()
        self.key, self.number, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 4).T
        self.sequences = sequence

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << RANK_BITS) + rank
        at = np.searchsorted(self.key, key, side="right") - 1
        copy, within = np.divmod(key - self.key[at], self.number[at])
        return self.sequence[at] + copy, self.offset[at] + within * length


# ---- operator -----------------------------------------------------------------------------

def pieces(docs: DataFrame, spec: str, carry: list[str], text: str = "text", capacity: int = CAPACITY,
           end_id: int | None = END_ID, with_ids: bool = False) -> DataFrame:
    """``row``, piece, start, length, ids_crc32, part and nth (place among the pieces of its
    length in its task) of every piece, with its ids if wanted; not yet written."""
    kinds = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
             ("ids_crc32", T.LongType()), ("nth", T.LongType())]
    if with_ids:
        kinds.append(("ids", T.ArrayType(T.IntegerType())))
    item = T.StructType([T.StructField(n, t) for n, t in kinds])

    def make_kernel():
        encoder = worker_state(("token-batches", hash(spec), end_id), lambda: BatchEncoder(spec, end_id))
        seen = np.zeros(capacity + 1, np.int64)

        def kernel(texts: pa.Array) -> list[pa.Array]:
            offsets, ids = encoder.encode(texts)
            sizes = np.diff(offsets)
            counts = -(-sizes // capacity)
            firsts = np.cumsum(counts) - counts
            piece = np.arange(int(counts.sum())) - np.repeat(firsts, counts)
            head = np.repeat(sizes - (counts - 1) * capacity, counts)  # tokens of each document's first piece
            length = np.where(piece == 0, head, capacity)
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            begin = np.repeat(offsets[:-1], counts) + start
            data = memoryview(np.ascontiguousarray(ids, "<i4")).cast("B")
            crc = [zlib.crc32(data[4 * x:4 * (x + n)]) for x, n in zip(begin.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            of_length = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(of_length) - of_length, of_length)
            nth += seen[length]
            seen[:] += of_length
            columns = [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                       pa.array(nth)]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)).astype(np.int32)),
                                                        pa.array(ids, pa.int32())))
            rows = pa.StructArray.from_arrays(columns, names=[n for n, _ in kinds])
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), rows)]

        return kernel

    source = docs.select(F.struct(*[col(c) for c in carry]).alias("row"), F.spark_partition_id().alias("part"),
                         col(text).alias("t"))
    return map_texts(source, "t", ["row", "part"], [T.StructField("pieces", T.ArrayType(item))], make_kernel) \
        .select("row.row", "row.part", F.explode("pieces").alias("p")).select("row", "part", "p.*")


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The written rows of ``pieces`` with sequence_id and offset instead of part and nth."""
    by_part = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(patterns(histogram, capacity))
    # one row per task and length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = found.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "part")
    schema = T.StructType([f for f in ranked.schema if f.name != "rank"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = ranked.columns
    length_at, rank_at = names.index("length"), names.index("rank")

    def run(batches):
        for b in batches:
            sequence, offset = places(b.column(length_at).to_numpy(), b.column(rank_at).to_numpy())
            columns = [b.column(i) for i in range(len(names)) if i != rank_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the joined ids of every sequence, from packed pieces with their ids."""
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("x")) \
        .select("sequence_id", F.flatten(F.transform("x", lambda p: p["ids"])).alias("ids"))


def op13_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """The place of every piece of every document in sequences of 2,048 tokens."""
    spec = tokenizer_json(path or default_path("byte_bpe_50k.json"))
    found = staged(pieces(table(spark, sf_dir, "documents"), spec, ["doc_id"]), "packing-pieces")
    return pack(found).select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
