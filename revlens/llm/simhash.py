"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document has a 64-bit fingerprint (majority of its shingle hashes, bit
by bit).  For a radius r each of the 64 bits is given one of 2^(r+1)-1 labels;
table v keeps the bits whose label has an odd scalar product with v.  The
labels of at most r differing bits span a space of dimension at most r, so
some v is orthogonal to all of them and its mask leaves all these bits out:
every pair within the radius meets in the same bucket of some table.

Only distinct fingerprints enter the tables.  Within a bucket no pairs are
emitted: a member is linked to the smallest member of its component there.
A bucket above BUCKET_MEMBERS members is not gathered in a task; its members
go through one-bit neighbours instead (two fingerprints within distance two
share a neighbour, and a neighbour has at most 65 of them), which is exact.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; fewer words than the shingle
length make one shingle of the whole sequence; rows with a null identifier
get the component of their fingerprint; a component of null identifiers only
has a null ``component_id``.  Whole texts of any length are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, map_texts, staged, table, utf8, worker_state
from revlens.llm.components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
HASH_SEED = 42
#: A bucket with more distinct fingerprints takes the one-bit-neighbour way.
BUCKET_MEMBERS = 4_096
HASHES_AT_ONCE = 65_536


# ---- fingerprints -------------------------------------------------------------------------

def fingerprint(data: bytes, shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """Unsigned fingerprint of a UTF-8 text (bytes.lower and bytes.split know
    ASCII letters and white space only, as the operator wants)."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = data.lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n <= 1:
        return digest(b" ".join(words), seed)
    counts = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, n, HASHES_AT_ONCE):
        part = words[begin:begin + HASHES_AT_ONCE + shingle - 1]
        hashes = np.array([digest(b" ".join(s), seed) for s in zip(*[part[k:] for k in range(shingle)])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, carry: list[str], text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``row`` with the carried columns and the fingerprint as a signed 64-bit number."""
    def make_kernel():
        def kernel(texts: pa.Array) -> list[pa.Array]:
            found = np.array([fingerprint(d, shingle) for d in utf8(texts)], dtype=np.uint64)
            return [pa.array(found.view(np.int64), pa.int64())]

        return kernel

    return map_texts(docs, text, carry, [T.StructField("fp", T.LongType())], make_kernel)


# ---- covering tables ----------------------------------------------------------------------

def masks(radius: int = MAX_DISTANCE) -> list[int]:
    """The 2^(radius+1)-1 masks as unsigned numbers; labels go round so each
    mask keeps about 4/7 (radius 2) of the bits."""
    tables = (1 << (radius + 1)) - 1
    labels = [1 + i % tables for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if bin(labels[i] & v).count("1") % 2) for v in range(1, tables + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def roots_within(members: np.ndarray, radius: int) -> np.ndarray:
    """For each of the distinct fingerprints of a bucket (uint64, ascending) the
    smallest member of its component under links of at most ``radius`` bits."""
    m = len(members)
    label = np.arange(m)
    if m == 2:
        near = int(np.bitwise_count(members[0] ^ members[1])) <= radius
        return members[[0, 0]] if near else members
    if m <= 256:
        near = np.bitwise_count(members[:, None] ^ members[None, :]) <= radius
        while True:
            new = np.where(near, label[None, :], m).min(axis=1)
            if (new == label).all():
                return members[label]
            label = new
    if radius != 2:
        raise ValueError("buckets of more than 256 members are resolved for radius 2 only")
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(BITS, dtype=np.uint64)])
    keys = (members[None, :] ^ flips[:, None]).ravel()
    owner = np.tile(np.arange(m), len(flips))
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    while True:
        low = np.repeat(np.minimum.reduceat(label[owner], starts), sizes)
        new = label.copy()
        np.minimum.at(new, owner, low)
        if (new == label).all():
            return members[label]
        label = new


def _bucket_links(radius: int, most: int):
    """Kernel over rows sorted by (t, key, fp): kind 0 links (a, b), kind 1 the
    members a of a bucket above ``most``."""
    def run(batches):
        held: list[np.ndarray] = []  # the members so far of the bucket at the end of the last batch
        held_key = None
        over = False

        def close():
            if over or not held:
                return None
            members = np.concatenate(held)
            if len(members) < 2:
                return None
            roots = roots_within(members, radius)
            moved = roots != members
            return (members[moved], roots[moved]) if moved.any() else None

        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(0).to_numpy()
            key = batch.column(1).to_numpy()
            fp = (batch.column(2).to_numpy() ^ np.int64(-2**63)).view(np.uint64) ^ np.uint64(1 << 63)
            cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            begins, ends = np.concatenate([[0], cut]), np.append(cut, len(t))
            out_a, out_b, spill = [], [], []
            first_same = held_key == (t[0], key[0])
            # buckets of one member that neither continue nor may be continued need no look
            busy = (ends - begins > 1)
            busy[0] = busy[-1] = True
            if not first_same:
                done = close()
                if done:
                    out_a.append(done[0])
                    out_b.append(done[1])
                held, over = [], False
            for k in np.flatnonzero(busy):
                part = fp[begins[k]:ends[k]]
                if k > 0:
                    done = close()
                    if done:
                        out_a.append(done[0])
                        out_b.append(done[1])
                    held, over = [], False
                if not over and sum(map(len, held)) + len(part) > most:
                    spill += held
                    held, over = [], True
                if over:
                    spill.append(part)
                else:
                    held.append(part)
            held_key = (t[-1], key[-1])
            if out_a or spill:
                a = np.concatenate(out_a + spill)
                links = sum(map(len, out_a))
                b = np.concatenate(out_b + spill) if out_b else np.concatenate(spill)
                kind = np.ones(len(a), dtype=np.int32)
                kind[:links] = 0
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                 names=["kind", "a", "b"])
        done = close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(done[0]), dtype=np.int32)), pa.array(done[0].view(np.int64)),
                 pa.array(done[1].view(np.int64))], names=["kind", "a", "b"])

    return run


def links(distinct: DataFrame, radius: int = MAX_DISTANCE, most: int = BUCKET_MEMBERS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) whose closure
    equals that of all pairs within ``radius`` bits."""
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for t, m in enumerate(masks(radius))])).alias("x")).select("x.t", "x.key", "fp")
    sorted_buckets = keyed.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    found = staged(sorted_buckets.mapInArrow(_bucket_links(radius, most), "kind int, a long, b long"), "bucket-links")
    direct = found.filter("kind = 0").select("a", "b")
    crowded = found.filter("kind = 1").select(F.col("a").alias("fp")).distinct()
    if not crowded.limit(1).count():
        return direct
    if radius != 2:
        raise ValueError("crowded buckets are resolved for radius 2 only")
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(BITS)])
    near = crowded.select("fp", F.explode(flips).alias("neighbour"))
    low = near.select(F.col("fp").alias("a"), F.min("fp").over(Window.partitionBy("neighbour")).alias("b"))
    return direct.union(low.filter("a <> b"))


def near_duplicates(docs: DataFrame, carry: list[str], text: str = "text", ident: str = "doc_id",
                    shingle: int = SHINGLE_WORDS, radius: int = MAX_DISTANCE) -> DataFrame:
    """``row``, fp, component_id (the smallest identifier reachable over links) and root (the smallest
    fingerprint reachable, which tells components apart that share an identifier) per document."""
    names = list(dict.fromkeys([*carry, ident]))
    marked = staged(fingerprints(docs, names, text, shingle), "fingerprints")
    ids = marked.select("fp", F.col("row")[ident].alias("id"))
    groups = staged(ids.groupBy("fp").agg(F.min("id").alias("low")), "fingerprint-groups")
    roots = components(links(groups.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = staged(groups.join(roots, "fp").select("fp", "root", "low"), "linked")
    lowest = staged(linked.groupBy("root").agg(F.min("low").alias("lowest")), "lowest")
    moved = linked.join(lowest, "root").select("fp", "root", "lowest")
    place = staged(groups.join(moved, "fp", "left").select("fp", F.coalesce("lowest", "low").alias("component_id"),
                                                           F.coalesce("root", "fp").alias("root")), "place")
    return marked.join(place, "fp", "left").select("row", "fp", "component_id", "root")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the row with the component's identifier
    (of several rows with that identifier the one of smallest content hash, of
    identical rows one).  A component without any identifier also keeps one.

    The decision is made on identifiers and hashes; the texts are shuffled once."""
    h1, h2 = F.xxhash64(col("doc_id"), col("text")), F.hash(col("text"), col("doc_id"))
    slim = docs.select(col("doc_id").alias("id"), col("text").alias("t"), h1.alias("h1"), h2.alias("h2"))
    found = near_duplicates(slim, ["id", "h1", "h2"], text="t", ident="id").select("row.*", "fp", "component_id", "root")
    own = found.filter(F.col("id").eqNullSafe(F.col("component_id")))
    stays = staged(own.groupBy("root").agg(F.min(F.struct("h1", "h2")).alias("h")).select("h.h1", "h.h2"), "stays")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), h1.alias("h1"), h2.alias("h2"))
    once = Window.partitionBy("h1", "h2").orderBy("h1")
    return rows.join(stays, ["h1", "h2"]).withColumn("k", F.row_number().over(once)).filter("k = 1").select("row.*")
