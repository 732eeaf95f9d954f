"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage is
    cut, the files survive lost executors, and the optimizer sees their size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_col: str) -> Column:
    """Documents kept out of training: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def worker_state(key, make: Callable[[], object]):
    """An object built once per Python worker and kept across its tasks."""
    store = sys.__dict__.setdefault("_revlens_llm_state", {})
    if key not in store:
        store[key] = make()
    return store[key]


def map_texts(docs: DataFrame, text: str, carry: list[str], fields: list[T.StructField],
              make_kernel: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Apply a batch kernel to the column ``text`` inside the tasks that read it.

    The result has a struct column ``row`` with the ``carry`` columns, whatever
    their names, and the kernel's result columns beside it.  ``make_kernel()``
    runs once per task; the kernel gets the texts of an Arrow batch (nulls
    included) and returns one array per result field."""
    cols = list(carry) + ([] if text in carry else [text])
    at, n_carry = cols.index(text), len(carry)
    source = docs.select(F.struct(*[col(c) for c in cols]).alias("row"))
    row_type = T.StructType(source.schema["row"].dataType.fields[:n_carry])
    schema = T.StructType([T.StructField("row", row_type), *fields])
    names = schema.names
    carry_names = list(carry)

    def run(batches):
        kernel = make_kernel()
        for batch in batches:
            rows = batch.column(0)
            results = kernel(rows.field(at))
            if len(cols) > n_carry:
                if n_carry:
                    parts = [rows.field(i) for i in range(n_carry)]
                    rows = pa.StructArray.from_arrays(parts, fields=[
                        pa.field(n, p.type, nullable=True) for n, p in zip(carry_names, parts)])
                else:
                    rows = pa.array([{}] * batch.num_rows, type=pa.struct([]))
            yield pa.RecordBatch.from_arrays([rows, *results], names=names)

    return source.mapInArrow(run, schema)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    binary = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [b or b"" for b in texts.cast(binary).to_pylist()]


def strings(texts: pa.Array) -> list[str]:
    """The texts as Python strings; null is empty."""
    return [t or "" for t in texts.to_pylist()]
