"""Sampling, splits and ordering (K2-K6).

Splits and samples hash a business key instead of drawing random numbers,
so they do not depend on partitioning or task retries and the same rows
come out on every run (and in the DuckDB twin)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.fixtures import hash32
from revlens.operators.ordered import null_safe_join


def split_edges(weights: list[float]) -> list[int]:
    """Upper ends of all splits but the last on the 32-bit hash scale."""
    total, acc, edges = sum(weights), 0.0, []
    for w in weights[:-1]:
        acc += w
        edges.append(round(acc / total * (1 << 32)))
    return edges


def split_column(key: Column, weights: list[float], names: list[str], seed: int = 42) -> Column:
    """Assign each row to a named split by the 32-bit hash of (key, seed); a
    null key counts as the text ``null``."""
    b = hash32(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    out = None
    for e, name in zip(split_edges(weights), names):
        out = F.when(b < e, F.lit(name)) if out is None else out.when(b < e, F.lit(name))
    return out.otherwise(F.lit(names[-1])) if out is not None else F.lit(names[-1])


def stratified_split(df: DataFrame, key: str = "review_id", label: str = "label",
                     weights=(0.6, 0.2, 0.2), names=("train", "val", "test"), seed: int = 42) -> DataFrame:
    """K3: per-class split; the hash is independent of the class, so every
    class is cut in the same proportions."""
    return df.withColumn("split", split_column(F.col(key), list(weights), list(names), seed))


def holdout_split(df: DataFrame, key: str = "review_id", weights=(0.7, 0.3), seed: int = 42) -> DataFrame:
    """K4: train/test holdout."""
    return df.withColumn("split", split_column(F.col(key), list(weights), ["train", "test"], seed))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """K5: positional-by-name union keeping duplicates."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def shuffle_key(key: Column, seed: int = 42) -> Column:
    """K6: a reproducible pseudo-random order key."""
    return hash32(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def cap_per_group(df: DataFrame, group: str, n: int, order_key: str, tie: str,
                  coarse_bits: int = 16) -> DataFrame:
    """K2: keep the ``n`` rows of each group with the smallest
    (order_key, tie); ``order_key`` is a non-negative 32-bit hash.

    A group may hold a third of all rows, so rows are never gathered per
    group: a histogram of the key's top ``coarse_bits`` bits per group
    (partially aggregated, at most 2^bits rows per group) locates the
    cut-off bucket; rows below it are kept as is, and only the cut-off
    bucket (about 1/2^bits of the group) is ranked."""
    shift = 32 - coarse_bits
    rows = df.withColumn("__coarse", F.shiftright(F.col(order_key), shift))
    hist = rows.groupBy(group, "__coarse").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(group).orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("__before", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    keep = (hist.filter(F.col("__before") < n)
                .select(group, "__coarse", F.least(F.col("__cnt"), F.lit(n) - F.col("__before")).alias("__quota"),
                        "__cnt"))
    joined = null_safe_join(rows, keep, [group, "__coarse"])
    full = joined.filter(F.col("__quota") == F.col("__cnt"))
    part = joined.filter(F.col("__quota") < F.col("__cnt"))
    rn = F.row_number().over(Window.partitionBy(group, "__coarse").orderBy(order_key, tie))
    part = part.withColumn("__rn", rn).filter(F.col("__rn") <= F.col("__quota")).drop("__rn")
    return full.unionByName(part).drop("__coarse", "__quota", "__cnt")
