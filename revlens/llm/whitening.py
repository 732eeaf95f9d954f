"""Whitening of embedding vectors.

The centred scatter of the vectors is summed exactly: every vector is centred
at the integers nearest the mean, its products are summed as integers, and the
remaining shift of less than one half is taken off in integer arithmetic, so
that the covariance is correctly rounded and does not depend on how Spark cuts
the rows.  It is factored by Cholesky with diagonal pivoting, and one-sided
Jacobi rotations work directly on the triangular factor until its columns are
orthogonal: their squared norms are the eigenvalues, the normalised columns the
components.  The driver gets sums over dimensions only.

Defined results: rows whose vector is null, or holds a null, NaN or infinite
entry, or one of 2^45 or beyond, take no part; nor do vectors of another length
than most have (of equally common lengths the longest counts).  Directions
without variance (beyond the rank of the factor) have no component.  Repeated
rows and identifiers count each time and give a row each; null identifiers stay
null; an empty table gives an empty result.  Extra columns are not read.  A
deviation is exact in ``deviation_exact`` (38 digits, else null); ``deviation``
is null where a long cannot hold it, which takes tens of millions of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, staged, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Entries of this size or beyond count as not finite: their scaled integers would not be exact in a double.
ENTRY_BOUND = float(1 << 45)
#: A pivot below this share of the largest variance ends the factorisation; rotations below this cosine are left out.
PIVOT_SHARE = 1e-14
COSINE = 1e-16
SWEEPS = 60


# ---- eigenvectors of a covariance ---------------------------------------------------------

def pivoted_cholesky(a: np.ndarray, share: float = PIVOT_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): a[order][:, order] = factor @ factor.T, with as many columns as the rank."""
    a = a.astype(np.float64, copy=True)
    n = len(a)
    order, factor = np.arange(n), np.zeros((n, n))
    least = share * max(float(a.diagonal().max(initial=0.0)), 0.0)
    for k in range(n):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            return factor[:, :k], order
        if p != k:
            a[[k, p]] = a[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
            factor[[k, p]] = factor[[p, k]]
            order[[k, p]] = order[[p, k]]
        factor[k, k] = math.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def jacobi_columns(factor: np.ndarray, cosine: float = COSINE, sweeps: int = SWEEPS) -> np.ndarray:
    """The factor with its columns rotated until all are orthogonal.

    A round rotates disjoint pairs at once; the rounds of a tournament meet every pair once a sweep."""
    u = np.array(factor, np.float64)
    k = u.shape[1]
    if k < 2:
        return u
    players = list(range(k)) + ([-1] if k % 2 else [])
    half = len(players) // 2
    for _ in range(sweeps):
        turned = 0
        for _ in range(len(players) - 1):
            pairs = [(min(p, q), max(p, q)) for p, q in zip(players[:half], players[half:][::-1]) if p >= 0 and q >= 0]
            i, j = np.array(pairs).T
            x, y = u[:, i], u[:, j]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(c) > cosine * len(u) * np.sqrt(a * b)
            turned += int(turn.sum())
            safe = np.where(turn, c, 1.0)
            zeta = (b - a) / (2.0 * safe)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            cos = 1.0 / np.sqrt(1.0 + t * t)
            sin = cos * t
            u[:, i], u[:, j] = cos * x - sin * y, sin * x + cos * y
            players = [players[0], players[-1], *players[1:-1]]
        if not turned:
            break
    return u


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a covariance, as many as its rank.

    The largest entry of each vector is positive."""
    factor, order = pivoted_cholesky(covariance)
    rotated = jacobi_columns(factor)
    u = np.empty_like(rotated)
    u[order] = rotated
    values = (u * u).sum(axis=0)
    by_size = np.argsort(-values, kind="stable")
    values, u = values[by_size], u[:, by_size]
    if not u.size:
        return values, u
    u = u / np.sqrt(values)
    largest = np.take_along_axis(u, np.abs(u).argmax(axis=0)[None, :], axis=0)
    return values, u * np.sign(largest)


# ---- sums over the vectors ----------------------------------------------------------------

def integers(vectors: DataFrame, ident: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x (array of long) of the vectors that take part."""
    v = col(vector)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) >= ENTRY_BOUND))
    # null vectors fail both conditions
    usable = vectors.filter(F.coalesce(~bad & (F.size(v) > 0), F.lit(False)))
    rows = usable.select(col(ident).alias("vec_id"),
                         F.transform(v, lambda e: F.floor(e.cast("double") * float(scale)).cast("long") + shift).alias("x"))
    common = rows.groupBy(F.size("x").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).head()
    return rows.filter(F.size("x") == (common["k"] if common else 0))


def exact_sums(values: np.ndarray) -> list[int]:
    """Sums of the columns of an integer matrix as Python integers."""
    if not len(values) or int(np.abs(values).max()) * len(values) < 1 << 62:
        return values.sum(axis=0).tolist()
    return values.astype(object).sum(axis=0).tolist()


def exact_products(values: np.ndarray) -> np.ndarray:
    """values.T @ values of an integer matrix; float products where these are exact."""
    largest = int(np.abs(values).max(initial=0))
    total = np.zeros((values.shape[1],) * 2, object)
    if largest < 1 << 26:
        step = max(1, (1 << 53) // max(1, largest * largest))
        for at in range(0, len(values), step):
            part = values[at:at + step].astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
        return total
    wide = values.astype(object)
    return total + wide.T @ wide


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of an Arrow column as rows."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def task_sums(rows: DataFrame, make, n_numbers: int, kind: str) -> list:
    """Sum over all rows of ``make(batch)``, a flat sequence of numbers.  Tasks add up their
    batches, Spark the tasks'; the driver gets ``n_numbers`` numbers."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                mine = make(b)
                total = mine if total is None else total + mine
        if total is not None:
            values = pa.array(map(str, total), pa.string()) if kind != "double" else pa.array(np.asarray(total, np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], names=["i", "v"])

    parts = rows.mapInArrow(run, f"i int, v {'double' if kind == 'double' else 'string'}")
    got = parts.groupBy("i").agg(F.sum(F.col("v").cast(kind)).alias("v")).collect()
    out = [0] * n_numbers
    for r in got:
        out[r["i"]] = r["v"] if kind == "double" else int(r["v"])
    return out


def covariance_of(rows: DataFrame, k: int) -> tuple[int, list[int], list[int], np.ndarray]:
    """(n, S, centre, covariance) of the integer vectors x, exact up to the last division."""
    def first(b):
        v = matrix(b.column(0))
        return np.array([len(v), *exact_sums(v)], object)

    n, *sums = task_sums(rows.select("x"), first, k + 1, "decimal(38,0)")
    if not n:
        return 0, sums, sums, np.zeros((k, k))
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the integer nearest the mean
    middle = np.array(centre, np.int64)
    upper = np.triu_indices(k)

    def second(b):
        return exact_products(matrix(b.column(0)) - middle)[upper]

    scatter = task_sums(rows.select("x"), second, len(upper[0]), "decimal(38,0)")
    shift = [s - n * c for s, c in zip(sums, centre)]
    cov = np.zeros((k, k))
    for i, j, s in zip(*(u.tolist() for u in upper), scatter):
        cov[i, j] = cov[j, i] = (n * s - shift[i] * shift[j]) / (n * n)
    return n, sums, centre, cov


# ---- operator -----------------------------------------------------------------------------

def whiten(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, dict]:
    """(vec_id, deviation, whitened (array of double)) of every vector that takes part, written,
    and what was fitted: n, sums, values, vectors, trace, identity_error."""
    rows = integers(vectors, ident, vector, scale, shift)
    first = rows.select(F.size("x").alias("k")).head()
    k = first["k"] if first else 0
    n, sums, centre, cov = covariance_of(rows, k)
    values, axes = eigen(cov)
    values, axes = values[:components], axes[:, :components]
    middle = np.array(centre, np.int64)
    shifts = [s - n * c for s, c in zip(sums, centre)]
    rest = np.array([s / n for s in shifts], np.float64)  # mean less the centre
    weights = axes / np.sqrt(values)
    exact_shift = np.array(shifts, object)
    ident_type = vectors.schema[ident].dataType
    # deviations may be beyond a long: decimals, written as text
    schema = T.StructType([T.StructField("vec_id", ident_type), T.StructField("deviation", T.StringType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    span = max((abs(s) for s in shifts), default=0)

    def run(batches):
        for b in batches:
            d = matrix(b.column(1)) - middle if b.num_rows else np.zeros((0, k), np.int64)
            largest = (int(np.abs(d).max(initial=0)) * n + span) ** 2 * max(k, 1)
            if largest < 1 << 62:
                t = d * n - np.array(shifts, np.int64)
                deviation = (t * t).sum(axis=1).tolist()
            else:
                t = d.astype(object) * n - exact_shift
                deviation = (t * t).sum(axis=1).tolist()
            w = (d - rest) @ weights
            ends = np.arange(len(d) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(str, deviation), pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))], names=schema.names)

    found = staged(rows.mapInArrow(run, schema).withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)")), "whitened")
    return found, {"n": n, "sums": sums, "values": values, "vectors": axes, "trace": float(np.trace(cov)),
                   "identity_error": identity_error(found, n, len(values))}


def identity_error(found: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    if not n or not k:
        return 0.0
    mean = np.array(task_sums(found.select("whitened"), lambda b: matrix(b.column(0)).sum(axis=0), k, "double")) / n

    def products(b):
        w = matrix(b.column(0)) - mean
        return (w.T @ w).ravel()

    cov = np.array(task_sums(found.select("whitened"), products, k * k, "double")).reshape(k, k) / n
    return float(np.abs(cov - np.eye(k)).max())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every vector."""
    found, fit = whiten(table(spark, sf_dir, "embeddings"))
    share = [float(v / fit["trace"]) for v in fit["values"]]
    explained: Column = F.array(*[F.lit(s) for s in share]) if share else F.array().cast("array<double>")
    return found.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"),
                        F.col("deviation").alias("deviation_exact"), F.posexplode("whitened").alias("at", "whitened")) \
        .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit["n"]).cast("long").alias("n"), "deviation", "whitened",
                F.element_at(explained, F.col("at") + 1).alias("explained"),
                F.lit(fit["identity_error"]).alias("identity_error"), "deviation_exact")
