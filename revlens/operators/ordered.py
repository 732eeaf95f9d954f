"""Order-dependent totals without a single-task window.

A ``Window.orderBy`` with no partition key moves every row to one task,
and a per-group window moves a whole group to one task.  Here rows are
range-partitioned on (group, order key) by Spark's range partitioner and
tagged with their range id, and that tagging is pinned once by a reliable
checkpoint: every consumer of the ids (local running sums, per-range
totals) and every retry after a lost executor reads the same ids.  (Two
independent range exchanges would sample different split points.)  Each
(range, group) computes local running sums; the per-(range, group)
totals are prefix-summed over ranges and joined back as offsets.  A null
group key is a group like any other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import materialize

OrderSpec = list[tuple[str, bool]]  # (column, ascending); descending columns must be numeric


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the keys appear once."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def running_sums(df: DataFrame, order: OrderSpec, value_cols: list[str], n_ranges: int | None = None,
                 prefix: str = "cum_", partition_by: list[str] | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows up to and including this
    one under ``order`` (keys unique, or equal keys pre-aggregated),
    restarting per ``partition_by`` group when given.  A group holding a
    third of all rows spans many ranges, so it is spread over many tasks."""
    keys = list(partition_by or [])
    sort_cols = [F.col(c).asc() if asc else F.col(c).desc() for c, asc in [(k, True) for k in keys] + list(order)]
    parts = df.repartitionByRange(n_ranges, *sort_cols) if n_ranges else df.repartitionByRange(*sort_cols)
    ranged = materialize(parts.withColumn("__range", F.spark_partition_id()))
    part = ["__range", *keys]
    order_cols = [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]
    w_run = Window.partitionBy(*part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(w_run).alias(f"__run_{c}") for c in value_cols])
    totals = ranged.groupBy(*part).agg(*[F.sum(c).alias(f"__tot_{c}") for c in value_cols])
    w_prev = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[F.coalesce(F.sum(f"__tot_{c}").over(w_prev), F.lit(0)).alias(f"__off_{c}")
                                     for c in value_cols])
    # without groups the offsets table has one row per range: a proven bound
    out = null_safe_join(local, F.broadcast(offsets) if not keys else offsets, part)
    return out.select(*df.columns, *[(F.col(f"__run_{c}") + F.col(f"__off_{c}")).alias(f"{prefix}{c}")
                                     for c in value_cols])


def dense_rank_by(df: DataFrame, order: OrderSpec, name: str = "rank", n_ranges: int | None = None,
                  partition_by: list[str] | None = None) -> DataFrame:
    """1-based position of each row under ``order`` (keys unique within each
    ``partition_by`` group), without a single-task or per-group window."""
    ones = df.withColumn("__one", F.lit(1))
    return running_sums(ones, order, ["__one"], n_ranges, prefix="__cum", partition_by=partition_by) \
        .withColumnRenamed("__cum__one", name).drop("__one")
