"""Product KPIs (X1) and most similar products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import materialize


def product_kpis(ratings: DataFrame, anchor: str, product: str = "asin", rating: str = "rating",
                 ts: str = "ts") -> DataFrame:
    """Per product average rating and count overall, average and count
    in the year before ``anchor``, count in the month before it.  One
    grouped pass with conditional aggregates (partial aggregation before
    the shuffle)."""
    a = F.lit(anchor).cast("timestamp")
    t = F.col(ts).cast("timestamp")
    last_year = (t > a - F.expr("INTERVAL 1 YEAR")) & (t <= a)
    last_month = (t > a - F.expr("INTERVAL 1 MONTH")) & (t <= a)
    r = F.col(rating).cast("double")
    return ratings.groupBy(product).agg(
        F.round(F.avg(r), 6).alias("avg_rating"),
        F.count(F.lit(1)).alias("total_ratings"),
        F.round(F.avg(F.when(last_year, r)), 6).alias("avg_rating_last_year"),
        F.count(F.when(last_year, F.lit(1))).alias("num_reviews_last_year"),
        F.count(F.when(last_month, F.lit(1))).alias("num_reviews_last_month"),
    )


def product_table(meta: DataFrame, kpis: DataFrame) -> DataFrame:
    """The product table the enrichment joins read: metadata + KPIs."""
    return meta.select(
        "asin", F.col("title").alias("product_name"), F.col("title").alias("product_description"),
        F.col("main_cat").alias("product_category"), "brand",
    ).join(kpis, on="asin", how="left")


_PAIR_SCHEMA = "id long, nbr long, sim double"
#: Query rows whose similarities a kernel holds at once.
SLAB_ROWS = 256


def _block_topk(k: int, slab: int = SLAB_ROWS):
    def vectors(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        u = tile["u"].combine_chunks()
        return tile["id"].to_numpy(), u.flatten().to_numpy().reshape(len(u), -1).astype(np.float64, copy=False)

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        ids, nbrs, sims = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if queries.num_rows and index.num_rows:
            (a_ids, A), (b_ids, B) = vectors(queries), vectors(index)
            kk = min(k, len(b_ids))
            for at in range(0, len(a_ids), slab):
                own = a_ids[at:at + slab]
                S = np.round(A[at:at + slab] @ B.T, 6)
                S[own[:, None] == b_ids[None, :]] = -np.inf  # no self match
                # similarity descending, then neighbour id ascending; only what reaches the k-th place is ordered
                least = np.partition(S, len(b_ids) - kk, axis=1)[:, len(b_ids) - kk]
                row, col = np.nonzero((S >= least[:, None]) & np.isfinite(S))
                order = np.lexsort((b_ids[col], -S[row, col], row))
                row, col = row[order], col[order]
                first = np.searchsorted(row, np.arange(len(own)))
                best = np.arange(len(row)) - first[row] < kk
                row, col = row[best], col[best]
                ids.append(own[row])
                nbrs.append(b_ids[col])
                sims.append(S[row, col])
        return pa.table({"id": np.concatenate(ids), "nbr": np.concatenate(nbrs), "sim": np.concatenate(sims)})
    return run


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str, block_col: str) -> DataFrame:
    """id, blk, dim and the vector u of length one of every row that takes part.

    A null identifier, label or vector, and a vector with a null, NaN or
    infinite entry, take no part; vectors are compared with vectors of their
    own length only.  A zero vector stays zero (cosine 0 with every vector)
    instead of failing the division under ANSI mode."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.coalesce(~bad & (F.size(v) > 0), F.lit(False)) & F.col(id_col).isNotNull() & F.col(block_col).isNotNull())
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(block_col).alias("blk"), F.size(v).alias("dim"),
        F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm))
         .otherwise(F.transform(v, lambda x: x.cast("double") * 0.0)).alias("u"))


def tiled_search(queries: DataFrame, index: DataFrame, key: list[str], k: int, block_rows: int, b_factor: int) -> DataFrame:
    """(id, nbr, sim): candidates for the k nearest (id, u) of ``index`` to every (id, u) of
    ``queries`` with the same ``key``.

    Rows of a key are cut into query tiles of about ``block_rows`` and candidate
    tiles ``b_factor`` times larger.  Every row is sent to the tile pairs that it
    takes part in, and a vectorised kernel gets one tile pair at a time and emits
    each query's local top-k: its memory does not grow with the tables."""
    count = lambda rows, name: rows.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    # one row per key, joined back to every vector: materialised so AQE
    # broadcasts it by measured size (or splits a hot key's rows)
    sizes = count(queries, "na").join(count(index, "nb"), key)
    sizes = materialize(sizes.select(*key, F.ceil(F.col("na") / F.lit(block_rows)).cast("long").alias("na"),
                                     F.ceil(F.col("nb") / F.lit(block_rows * b_factor)).cast("long").alias("nb")))

    def tiles(rows: DataFrame, own: str, other: str):
        # new columns: both sides may come from one table
        return (rows.select(*key, "id", "u").join(sizes, key)
                    .select(*[F.col(c).alias(c) for c in (*key, "id", "u")], F.pmod(F.xxhash64("id"), F.col(f"n{own}")).alias(f"t{own}"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{other}") - 1)).alias(f"t{other}"))
                    .groupBy(*key, "ta", "tb"))
    return tiles(queries, "a", "b").cogroup(tiles(index, "b", "a")).applyInArrow(_block_topk(k), _PAIR_SCHEMA)


def best_neighbours(candidates: DataFrame, k: int) -> DataFrame:
    """(id, nbr, sim, rank): the k nearest of (id, nbr, sim); a neighbour found several times counts once."""
    rn = F.row_number().over(Window.partitionBy("id").orderBy(F.col("sim").desc(), F.col("nbr").asc()))
    once = candidates.groupBy("id", "nbr").agg(F.max("sim").alias("sim"))
    return once.withColumn("rank", rn).filter(F.col("rank") <= k)


def similar_topk(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                 block_col: str = "label", block_rows: int = 4096, b_factor: int = 2) -> DataFrame:
    """For every vector, the ``k`` most cosine-similar vectors of the
    same block (``label``); ties by rounded similarity, then id.

    Exact search over tile pairs (``tiled_search``); the final top-k per
    vector merges at most k x (candidate tiles) rows.  Rows with one
    identifier are one product with several vectors."""
    unit = unit_vectors(vectors, id_col, vec_col, block_col)
    return best_neighbours(tiled_search(unit, unit, ["blk", "dim"], k, block_rows, b_factor), k)


def similar_wide(topk: DataFrame, k: int = 5, prefix: str = "P") -> DataFrame:
    """Pivot a long top-k table to (asin, sim_prod1..k)."""
    aggs = [F.max(F.when(F.col("rank") == r, F.concat(F.lit(prefix), F.col("nbr").cast("string"))))
            .alias(f"sim_prod{r}") for r in range(1, k + 1)]
    return (topk.groupBy("id").agg(*aggs)
                .select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("asin"),
                        *[f"sim_prod{r}" for r in range(1, k + 1)]))
