"""Token ids as ORC files.

Documents are range-partitioned and sorted by identifier, encoded inside the
sorted partitions, and written as ORC: integer run-length encoded id lists in
stripes (read in parallel), row indexes and a Bloom filter on the identifier
(pruned by metadata).  Every document ends with the end id.  Readers get the
ids, the place of each document in the whole sequence and a checksum from the
files.

Defined results: a null text is the end id alone; documents with the same
identifier are ordered by their text's hash (equal hashes in any order) and
may span several parts; null identifiers come first; an empty table gives an
empty dataset.  Texts of any length are one row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.bpe import default_path, tokenizer_json
from revlens.llm.common import col, map_texts, staged, table, worker_state
from revlens.llm.token_batches import BatchEncoder
from revlens.session import scratch_path

END_ID = 0
#: Layout of the files.
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1_000
BLOOM_FALSE_POSITIVES = 0.01

FILE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()),
                            T.StructField("place", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def write(docs: DataFrame, path: str, spec: str, text: str = "text", ident: str = "doc_id", end_id: int = END_ID) -> None:
    """Encode and write; ``part`` and ``place`` (row within the part) give the order of the documents."""
    slim = docs.select(col(ident).cast("long").alias("doc_id"), col(text).alias("t"), F.xxhash64(col(text)).alias("h"),
                       F.monotonically_increasing_id().alias("salt"))
    # hash and salt split the rows of one identifier, equal texts included
    ordered = slim.repartitionByRange("doc_id", "h", "salt").sortWithinPartitions("doc_id", "h") \
        .withColumn("part", F.spark_partition_id())

    def make_kernel():
        encoder = worker_state(("token-batches", hash(spec), end_id), lambda: BatchEncoder(spec, end_id))
        at = [0]

        def kernel(texts: pa.Array) -> list[pa.Array]:
            offsets, ids = encoder.encode(texts)
            n = len(texts)
            at[0] += n
            place = np.arange(at[0] - n, at[0], dtype=np.int64)
            return [pa.array(place), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))]

        return kernel

    rows = map_texts(ordered, "t", ["doc_id", "part"], [FILE_SCHEMA["place"], FILE_SCHEMA["ids"]], make_kernel)
    (rows.select("row.doc_id", "row.part", "place", "ids").write
     .option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES).option("orc.create.index", "true")
     .option("orc.row.index.stride", INDEX_STRIDE).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", BLOOM_FALSE_POSITIVES).orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, place, ids as written; filters on doc_id skip stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def positions(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    A running sum within each part and the sums of the parts before it: the
    only single-task step reads one row per part."""
    def measure(batches):
        for b in batches:
            lists = b.column(3)
            offsets = lists.offsets.to_numpy()
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(data[4 * x:4 * y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(offsets).astype(np.int64)),
                 pa.array(crc, pa.int64())], names=["doc_id", "part", "place", "n_tokens", "ids_crc32"])

    rows = staged(read(spark, path).mapInArrow(
        measure, "doc_id long, part int, place long, n_tokens long, ids_crc32 long"), "token-places")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("local", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    # one row per part: a bound that does not grow with the documents
    return local.join(F.broadcast(parts), "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"),
                                                         "n_tokens", "ids_crc32")


def op9_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Write every document's ids as ORC, read the files back, and report each document's place in them."""
    spec = tokenizer_json(path or default_path("byte_bpe_50k.json"))
    out = scratch_path(spark, "token-files")
    write(table(spark, sf_dir, "documents"), out, spec)
    return positions(spark, out)
