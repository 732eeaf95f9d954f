"""X2 through the hyperplane index: exact for small labels, recall and work for large ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import products as PR
from revlens.operators import similar_index as SI
from tests.conftest import SF_SMALL, rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(n, dim=32, size=8, seed=1):
    """n vectors in clusters of ``size`` around random centres: near neighbours exist, as among products."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // size, dim))
    v = np.repeat(centres, size, axis=0) + 0.25 * rng.standard_normal((n // size * size, dim))
    return [(i, x.astype(float).tolist(), 0) for i, x in enumerate(v)]


def test_small_labels_are_exact(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert rows(SI.similar_topk_indexed(e)) == rows(PR.similar_topk(e))


def test_null_vectors_and_ids_take_no_part(spark):
    good = [(1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (3, [0.0, 1.0], 0), (4, [0.0, 0.0], 0)]
    bad = [(None, [1.0, 0.0], 0), (5, None, 0), (6, [None, 1.0], 0), (7, [float("nan"), 1.0], 0), (8, [float("inf"), 1.0], 0),
           (9, [], 0), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 0)]
    base = rows(PR.similar_topk(spark.createDataFrame(good, SCHEMA), k=2))
    assert len(base) == 8
    for search in (PR.similar_topk, SI.similar_topk_indexed):
        assert rows(search(spark.createDataFrame(good + bad, SCHEMA), k=2)) == base
        assert search(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_cost_one_vector_and_lose_nothing(spark):
    some = [(i, [float(i % 7), 1.0 + i % 3, -1.0], i % 2) for i in range(60)]
    copies = [(100 + i, [1.0, 2.0, 3.0], 0) for i in range(300)]
    scaled = [(500, [2.0, 4.0, 6.0], 0), (500, [5.0, 0.0, 0.0], 0)]
    e = spark.createDataFrame(some + copies + scaled, SCHEMA)
    assert rows(SI.similar_topk_indexed(e)) == rows(PR.similar_topk(e))


def test_recall_of_large_labels(spark):
    e = spark.createDataFrame(clustered(4000), SCHEMA).repartition(4)
    found = SI.similar_topk_indexed(e, cell_rows=250).cache()
    assert SI.recall(found, PR.similar_topk(e)) >= 0.95
    exact = {(r["id"], r["nbr"]): r["sim"] for r in PR.similar_topk(e, k=50).collect()}
    assert all(exact.get((r["id"], r["nbr"]), r["sim"]) == r["sim"] for r in found.collect())
    found.unpersist()


@pytest.mark.parametrize("n", [2000, 8000])
def test_work_per_vector_does_not_grow(spark, n):
    unit = PR.unit_vectors(spark.createDataFrame(clustered(n), SCHEMA), "vec_id", "embedding", "label")
    signs = int(np.ceil(np.log2(n / 125)))
    at = SI.cells(unit.withColumn("signs", F.lit(signs)), SI.TABLES, SI.PROBES, 1).select("id", F.explode("cells").alias("c")).select("id", "c.*")
    sizes = at.filter("own").groupBy("table", "code").count()
    compared = at.join(sizes, ["table", "code"]).agg(F.sum("count")).head()[0] / n
    assert compared < 125 * SI.TABLES * (1 + SI.PROBES) * 2.5


def test_probe_codes_turn_the_least_certain_signs():
    p = np.array([[0.1, -5.0, 0.2, 3.0]])
    assert SI.probe_codes(p, 4, 3).tolist() == [[0b1101, 0b1100, 0b1001, 0b1000]]
    assert SI.probe_codes(p[:, :0], 0, 3).tolist() == [[0]]


def test_a_kernel_sees_one_tile_pair(spark):
    from revlens.operators import products as PR
    v = spark.createDataFrame([(i, [float(i % 7) - 3, float(i % 11) - 5, 1.0], 0) for i in range(300)], "vec_id long, embedding array<double>, label int")
    small = sorted(map(tuple, PR.similar_topk(v, k=5, block_rows=16, b_factor=2).collect()))
    assert small == sorted(map(tuple, PR.similar_topk(v, k=5).collect())) and len(small) == 1500
    plan = PR.similar_topk(v, k=5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInPandas" not in plan
