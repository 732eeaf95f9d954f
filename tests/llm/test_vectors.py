"""Whitening and hard-negative mining against brute force."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm import hard_negatives as hn
from revlens.llm import whitening
from tests.conftest import SF_SMALL

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), i % 3) for i in range(1, 260)]
    rows += [(300, [0.5] * 6, 1)] * 40 + [(400, [0.5] * 6, 2)] * 3
    rows += [(500, None, 1), (501, [None] + [1.0] * 5, 1), (502, [float("nan")] + [1.0] * 5, 1), (503, [float("inf")] * 6, 1),
             (504, [], 1), (505, [1.0], 1), (600, [1.0] * 6, None), (None, [0.4] * 6, 2), (None, [0.3] * 6, 1), (700, [0.0] * 6, 0)]
    return rows


def finite(v, k=6):
    return v is not None and len(v) == k and all(x is not None and np.isfinite(x) for x in v)


# ---- whitening ----------------------------------------------------------------------------

@pytest.mark.parametrize("k", [1, 2, 5, 64])
def test_eigen_equals_library(k):
    rng = np.random.default_rng(k)
    a = rng.normal(size=(k, k + 3)) * np.logspace(0, -2, k)[:, None]
    values, axes = whitening.eigen(a @ a.T)
    assert np.allclose(values, np.linalg.eigvalsh(a @ a.T)[::-1], rtol=1e-9)
    assert np.allclose(axes.T @ axes, np.eye(k), atol=1e-12)
    assert np.allclose(a @ a.T @ axes, axes * values, atol=1e-12 * values[0])


def test_eigen_stops_at_the_rank():
    a = np.random.default_rng(1).normal(size=(6, 3))
    values, axes = whitening.eigen(a @ a.T)
    assert len(values) == 3 and np.allclose((axes * values) @ axes.T, a @ a.T)
    assert whitening.eigen(np.zeros((4, 4)))[0].size == 0
    assert whitening.eigen(np.eye(3))[0].tolist() == [1, 1, 1]


def test_sums_are_exact_for_large_numbers():
    v = np.array([[1 << 50, 3], [-(1 << 49), 5], [(1 << 50) + 1, 7]], np.int64)
    wide = v.astype(object)
    assert (whitening.exact_products(v) == wide.T @ wide).all()
    small = v % 1000
    assert (whitening.exact_products(small) == small.astype(object).T @ small.astype(object)).all()
    big = np.full((4, 1), (1 << 62) - 1, np.int64)
    assert whitening.exact_sums(big) == [4 * ((1 << 62) - 1)]


def brute_whitening(rows, components=32):
    kept = [(i, v) for i, v, _ in rows if finite(v)]
    x = [[int(np.floor(64 * float(e))) + 1_000_000 for e in v] for _, v in kept]
    n, k = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(k)]
    centred = np.array([[float(Fraction(n * r[j] - sums[j], n)) for j in range(k)] for r in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for (i, _), r, c in zip(kept, x, centred):
        dev = sum((n * r[j] - sums[j]) ** 2 for j in range(k))
        for j in range(min(k, components)):
            out.append((i, j + 1, n, dev, abs(c @ axes[:, j]) / np.sqrt(values[j]), values[j] / np.trace(cov)))
    return out


def test_whitening_equals_brute_force(spark, save, odd_vectors):
    df = spark.createDataFrame(odd_vectors, VECTORS).repartition(5).withColumn("x", F.lit("clash")).withColumn("whitened", F.lit(1))
    got = whitening.op11_whitening(spark, save(embeddings=df)).collect()
    expected = brute_whitening(odd_vectors)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], round(r[4], 6))
    mine = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got), key=key)
    expected.sort(key=key)
    assert len(mine) == len(expected)
    for a, b in zip(mine, expected):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-8, abs=1e-9) and a[5] == pytest.approx(b[5], rel=1e-10)
    assert max(r["identity_error"] for r in got) < 1e-10
    assert all(int(r["deviation_exact"]) == r["deviation"] for r in got)


def test_whitening_does_not_depend_on_partitions(spark, save, odd_vectors):
    rows = [r for r in odd_vectors if finite(r[1])]
    found = []
    for n in (1, 7):
        df = spark.createDataFrame(rows, VECTORS).repartition(n)
        found.append(sorted((str(r["vec_id"]), r["component"], r["whitened"]) for r in whitening.op11_whitening(spark, save(embeddings=df)).collect()))
    assert found[0] == found[1]


def test_whitening_of_few_rows(spark, save):
    empty = spark.createDataFrame([], VECTORS)
    got = whitening.op11_whitening(spark, save(embeddings=empty))
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and not got.collect()
    same = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 4, VECTORS)
    assert whitening.op11_whitening(spark, save(embeddings=same)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(5)], VECTORS)
    assert {r["component"] for r in whitening.op11_whitening(spark, save(embeddings=line)).collect()} == {1}


def test_deviation_beyond_a_long(spark, save):
    rows = [(i, [float(1 << 30) * (-1) ** i, 1.0 * i], 0) for i in range(4)]
    got = whitening.op11_whitening(spark, save(embeddings=spark.createDataFrame(rows, VECTORS))).collect()
    x = [[int(64 * e) + 1_000_000 for e in v] for _, v, _ in rows]
    for r in got:
        dev = sum((4 * x[r["vec_id"]][j] - sum(y[j] for y in x)) ** 2 for j in range(2))
        assert int(r["deviation_exact"]) == dev and r["deviation"] is None


# ---- residues -----------------------------------------------------------------------------

@pytest.mark.parametrize("k,size", [(1, 300), (64, 256), (64, 40_000), (300, 1 << 20), (1000, 100)])
def test_products_from_residues_are_exact(k, size):
    rng = np.random.default_rng(k + size)
    a, b = rng.integers(-size, size + 1, (9, k)), rng.integers(-size, size + 1, (13, k))
    a[0], b[0], b[1] = size, size, -size
    bound = int(max((a * a).sum(axis=1).max(), (b * b).sum(axis=1).max()))
    primes, step = hn.moduli(bound, k)
    assert len(set(primes)) == len(primes) >= 2 and np.prod([float(p) for p in primes]) > 2 * bound
    parts = [hn.product_residue(hn.residues(a, p), hn.residues(b, p), p, step) for p in primes]
    assert all(x.dtype == np.float32 for x in parts)
    assert (hn.remaindered(parts, primes) == a @ b.T).all()


def test_best_prefers_high_scores_then_first_columns():
    s = np.array([[5, 7, 7, 1, 7], [1, 1, 1, 1, 1]])
    at, top = hn.best(s, s > 0, 3)
    assert at.tolist() == [[1, 2, 4], [0, 1, 2]] and top.tolist() == [[7, 7, 7], [1, 1, 1]]
    huge = s * (1 << 58)
    at, top = hn.best(huge, s > 1, 4)
    assert at[0].tolist()[:4] == [1, 2, 4, 0] and (top[1] == hn.LEAST).all()


# ---- mining -------------------------------------------------------------------------------

def brute_mining(rows, k=6):
    kept = []
    for r, (i, v, label) in enumerate(rows):
        if label is not None and finite(v, k):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            kept.append((i, label, [int(np.floor(256 * float(x))) for x in v], r))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, label, v, r in kept:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w, s in kept if s != r]
        positives = sorted((x for x in scored if x[2] == label), key=order)[:5]
        for score, p, _ in positives:
            fits = sorted((x for x in scored if x[2] != label and 80 * score <= 100 * x[0] <= 100 * score), key=order)[:5]
            out += [(i, p, n + 1, q, score, s) for n, (s, q, _) in enumerate(fits)]
    return out


def by_text(rows):
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("partitions", [1, 6])
def test_mining_equals_brute_force(spark, save, odd_vectors, partitions):
    df = spark.createDataFrame(odd_vectors, VECTORS).repartition(partitions)
    df = df.withColumn("anchors", F.lit("clash")).withColumn("tile", F.lit(1)).withColumn("rank", F.lit(None).cast("int"))
    got = hn.op12_hard_negatives(spark, save(embeddings=df)).collect()
    expected = brute_mining(odd_vectors)
    assert expected and by_text(got) == by_text(expected)


def test_small_tiles_give_the_same(spark, odd_vectors):
    df = spark.createDataFrame(odd_vectors, VECTORS).repartition(4)
    small = hn.mine(df, every=10, row_tile=7, anchor_tile=3).collect()
    whole = hn.mine(df, every=10).collect()
    assert whole and by_text(small) == by_text(whole)


def test_mining_of_the_given_table_and_of_none(spark, save):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = hn.op12_hard_negatives(spark, SF_SMALL).collect()
    assert got and by_text(got) == by_text(brute_mining(rows, 64))
    empty = hn.op12_hard_negatives(spark, save(embeddings=spark.createDataFrame([], VECTORS)))
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
