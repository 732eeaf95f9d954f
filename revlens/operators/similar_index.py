"""Most similar products through an index (X2 for large labels).

The exact search compares every vector with every vector of its label.  Here
vectors are filed under random-hyperplane codes: the signs of their products
with fixed random directions, whose agreement falls with the angle between two
vectors.  The number of signs grows with the label, so that a cell keeps about
``cell_rows`` vectors and the work per vector does not grow with its label;
a label that fits one cell is searched whole.  Several independent tables, and
in each the cells behind the signs that are least certain, are looked up, and
every candidate found is ranked by its exact cosine.

Equal vectors are filed once, under their smallest identifier; the k + 1
smallest identifiers of a group of copies are all that any top-k list can show
of it, so a large group costs no more than one vector and loses nothing.  Cells
of any size are cut into tiles; nothing is capped."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.ordered import null_safe_join
from revlens.operators.products import best_neighbours, tiled_search, unit_vectors
from revlens.session import materialize

CELL_ROWS = 1024
TABLES = 4
PROBES = 8
MAX_SIGNS = 40
SEED = 42


def directions(dim: int, table: int, seed: int = SEED) -> np.ndarray:
    """The random directions of a table, the same on every worker."""
    return np.random.default_rng([seed, dim, table]).standard_normal((MAX_SIGNS, dim))


def probe_codes(products: np.ndarray, signs: int, probes: int) -> np.ndarray:
    """Codes of the rows of ``products`` and of their ``probes`` next cells.

    Column 0 is the cell of the vector itself; the others turn one sign or two
    around, those whose products lie nearest to zero first."""
    bits = np.int64(1) << np.arange(signs, dtype=np.int64)
    own = ((products >= 0) * bits).sum(axis=1)
    if not signs or not probes:
        return own[:, None]
    weak = np.argsort(np.abs(products), axis=1, kind="stable")[:, :probes]
    cost = np.take_along_axis(np.abs(products), weak, axis=1)
    flips, costs = [bits[weak]], [cost]
    i, j = np.triu_indices(weak.shape[1], 1)
    if len(i):
        flips.append(bits[weak[:, i]] | bits[weak[:, j]])
        costs.append(np.hypot(cost[:, i], cost[:, j]))
    flip, cost = np.concatenate(flips, axis=1), np.concatenate(costs, axis=1)
    first = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    return np.concatenate([own[:, None], own[:, None] ^ np.take_along_axis(flip, first, axis=1)], axis=1)


def cells(rows: DataFrame, tables: int, probes: int, seed: int) -> DataFrame:
    """(id, blk, dim, u, cells): the cells (table, code) of every row, its own first in each table."""
    cell = T.StructType().add("table", T.IntegerType()).add("code", T.LongType()).add("own", T.BooleanType())
    schema = T.StructType([*rows.drop("signs").schema, T.StructField("cells", T.ArrayType(cell))])

    def run(batches):
        for pdf in batches:
            found: list = [[] for _ in range(len(pdf))]
            for (dim, signs), part in pdf.reset_index(drop=True).groupby(["dim", "signs"]):
                u = np.stack(part["u"].to_list())
                for t in range(tables if signs else 1):
                    codes = probe_codes(u @ directions(int(dim), t, seed)[:int(signs)].T, int(signs), probes)
                    for at, row in zip(part.index, codes.tolist()):
                        found[at].extend({"table": t, "code": c, "own": i == 0} for i, c in enumerate(row))
            yield pdf.drop(columns="signs").assign(cells=pd.Series(found, index=pdf.index, dtype=object))

    return rows.mapInPandas(run, schema)


def similar_topk_indexed(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                         block_col: str = "label", cell_rows: int = CELL_ROWS, tables: int = TABLES, probes: int = PROBES,
                         seed: int = SEED, block_rows: int = 1024, b_factor: int = 8) -> DataFrame:
    """X2 through the index: (id, nbr, sim, rank) as ``similar_topk``, where a neighbour in none of
    the cells looked up is missed.  Exact for labels of up to ``cell_rows`` different vectors.

    Rows with one identifier are one product with several vectors; rows that
    ``unit_vectors`` leaves out take no part."""
    unit = materialize(unit_vectors(vectors, id_col, vec_col, block_col))
    group = ["blk", "u"]
    reps = materialize(unit.groupBy(*group).agg(F.min("id").alias("rep"), F.first("dim").alias("dim")))
    per_label = materialize(reps.groupBy("blk", "dim").agg(F.count(F.lit(1)).alias("n")))
    signs = F.least(F.lit(MAX_SIGNS), F.ceil(F.log2(F.greatest(F.col("n") / F.lit(float(cell_rows)), F.lit(1.0)))).cast("int"))
    # a group is known by its vector's number: two groups can have one smallest identifier (repeated ids)
    filed = materialize(reps.join(per_label, ["blk", "dim"])
                        .select(F.monotonically_increasing_id().alias("id"), "blk", "dim", "u", "rep", signs.alias("signs")))
    at = materialize(cells(filed.drop("rep"), tables, probes, seed).select("id", "blk", "dim", "u", F.explode("cells").alias("c"))
                     .select("id", "blk", "dim", "u", "c.*"))
    key = ["blk", "dim", "table", "code"]
    found = tiled_search(at, at.filter("own"), key, k + 1, block_rows, b_factor)
    near = best_neighbours(found, k + 1).select(F.col("id").alias("group"), F.col("nbr").alias("other"), "sim")
    # a vector's own copies: its cosine with itself, 0 for a zero vector
    itself = filed.select(F.col("id").alias("group"), F.col("id").alias("other"),
                          F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x), 6).alias("sim"))
    members = materialize(null_safe_join(unit.select("id", "blk", "u"), filed.select(F.col("id").alias("group"), "blk", "u"), group)
                          .select("id", "group").distinct())
    nth = F.row_number().over(Window.partitionBy("group").orderBy("id"))
    shown = members.withColumn("nth", nth).filter(F.col("nth") <= k + 1).select(F.col("group").alias("other"), F.col("id").alias("nbr"))
    best = F.row_number().over(Window.partitionBy("group").orderBy(F.col("sim").desc(), F.col("nbr").asc()))
    lists = near.unionByName(itself).join(shown, "other").groupBy("group", "nbr").agg(F.max("sim").alias("sim")) \
        .withColumn("nth", best).filter(F.col("nth") <= k + 1).drop("nth")
    return best_neighbours(members.join(lists, "group").filter("id <> nbr").select("id", "nbr", "sim"), k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours found, where a neighbour as similar as the last exact one counts."""
    worst = exact.groupBy("id").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
    hits = found.join(worst, "id").filter(F.col("sim") >= F.col("least")).groupBy("id").agg(F.count(F.lit(1)).alias("h"))
    r = worst.join(hits, "id", "left").agg(F.sum(F.least("h", "n")).alias("h"), F.sum("n").alias("n")).head()
    return (r["h"] or 0) / r["n"] if r["n"] else 1.0


