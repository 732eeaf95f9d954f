"""Joins (J1-J4).

No join strategy is forced: Catalyst broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans with the measured size of a materialised shuffle, so a broadcast
always rests on a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ordered import null_safe_join
from revlens.session import materialize


def exclude_keys(df: DataFrame, keys: DataFrame, key: str = "asin") -> DataFrame:
    """Left anti join - drop rows whose key is listed; null keys stay.
    Duplicate keys do not change an anti join, so no distinct() is taken:
    both inputs stay plain shuffle stages, which lets AQE broadcast the key
    list by measured size or split the partition of a hot key."""
    return df.join(keys.select(key), on=key, how="left_anti")


def attach(left: DataFrame, right: DataFrame, key: str = "asin", how: str = "inner") -> DataFrame:
    """Equi-join on one key."""
    return left.join(right, on=key, how=how)


SLOT_ATTRS = ["product_name", "brand", "avg_rating", "total_ratings",
              "avg_rating_last_year", "num_reviews_last_year", "num_reviews_last_month"]


def enrich_slots_wide(base: DataFrame, products: DataFrame, n_slots: int = 5,
                      key: str = "asin", attrs: list[str] = SLOT_ATTRS,
                      null_keys_match: bool = False) -> DataFrame:
    """One left join of the product table per similar-product slot,
    each slot's attributes suffixed with the slot number."""
    out = base
    for s in range(1, n_slots + 1):
        slot_key = f"sim_prod{s}"
        right = products.select(F.col(key).alias(f"__k{s}"), *[F.col(a).alias(f"{a}_sim{s}") for a in attrs])
        cond = (F.col(slot_key).eqNullSafe(F.col(f"__k{s}")) if null_keys_match
                else F.col(slot_key) == F.col(f"__k{s}"))
        out = out.join(right, cond, "left").drop(f"__k{s}")
    return out


def enrich_slots_long(base: DataFrame, products: DataFrame, n_slots: int = 5,
                      key: str = "asin", attrs: list[str] = SLOT_ATTRS,
                      null_keys_match: bool = False) -> DataFrame:
    """The same rows as J3 with one join of the product table: unpivot the
    slots, join once, and bring each slot's matches back to its row.  Rows are
    identified by a key of their own, so repeated base keys stay apart; a
    product that occurs several times multiplies the row, as in J3."""
    row = "__row"
    rows = materialize(base.withColumn(row, F.monotonically_increasing_id()))
    slot_cols = [F.col(f"sim_prod{s}") for s in range(1, n_slots + 1)]
    longf = rows.select(row, F.posexplode(F.array(*slot_cols)).alias("slot", "sim"))
    if not null_keys_match:
        longf = longf.filter(F.col("sim").isNotNull())
    right = products.select(F.col(key).alias("sim"), F.struct(*attrs).alias("p"))
    met = null_safe_join(longf, right, ["sim"]) if null_keys_match else longf.join(right, on="sim")
    found = met.groupBy(row).agg(*[
        F.collect_list(F.when(F.col("slot") == s, F.col("p"))).alias(f"__p{s + 1}") for s in range(n_slots)])
    out = rows.join(found, row, "left")
    for s in range(1, n_slots + 1):
        out = out.withColumn(f"__p{s}", F.explode_outer(f"__p{s}"))
    return out.select(*base.columns, *[F.col(f"__p{s}")[a].alias(f"{a}_sim{s}")
                                       for s in range(1, n_slots + 1) for a in attrs])
