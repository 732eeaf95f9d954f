"""ROC from bounded thresholds, collinear points, one output file, and the options of the quirks."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import aspects as A
from revlens.operators import evaluation as EV
from revlens.operators import filters as FL
from revlens.operators import joins as J
from revlens.sources import files as S
from tests.conftest import rows


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(8)
    data = [(int(rng.random() < 0.3), None) for _ in range(20_000)]
    data = [(y, rng.gauss(0.8 * y, 1.0)) for y, _ in data] + [(1, 0.25)] * 3000 + [(1, None), (0, float("nan")), (None, 1.0)]
    return spark.createDataFrame(data, "label int, score double").repartition(6).cache()


def test_sketched_curve_is_bounded_and_on_the_exact_one(spark, scores):
    exact = {(r["threshold"], r["cum_tp"], r["cum_fp"]) for r in EV.roc_points(scores, "label", "score", 1).collect()}
    some = EV.roc_points_sketched(scores, "label", "score", 1, max_points=100).collect()
    assert 80 <= len(some) <= 100
    assert {(r["threshold"], r["cum_tp"], r["cum_fp"]) for r in some} <= exact
    assert max(r["tpr"] for r in some) == max(r["fpr"] for r in some) == 1.0


def test_sketched_area_is_within_its_bound(scores):
    exact = EV.roc_auc(scores, "label", "score", 1).head()["auc"]
    for points in (20, 200):
        r = EV.roc_auc_sketched(scores, "label", "score", 1, max_points=points).head()
        assert abs(r["auc"] - exact) <= r["error"] + 1e-9
    assert r["error"] < 0.01


def test_sketched_curve_of_few_scores(spark):
    few = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.7)], "label int, score double")
    assert rows(EV.roc_points_sketched(few, "label", "score", 1)) == rows(EV.roc_points(few, "label", "score", 1))
    assert EV.roc_points_sketched(few.limit(0), "label", "score", 1).collect() == []


def test_collinear_points_are_dropped(spark):
    # thresholds falling: steps (tp, fp) = (1, 0), (1, 0), (0, 1), (0, 1), (0, 1), (1, 1), (1, 1)
    steps = [(1, 0), (1, 0), (0, 1), (0, 1), (0, 1), (1, 1), (1, 1)]
    data = [(y, 1.0 - 0.1 * i) for i, (p, n) in enumerate(steps) for y in [1] * p + [0] * n]
    pts = EV.roc_points(spark.createDataFrame(data, "label int, score double"), "label", "score", 1)
    kept = rows(EV.drop_collinear(pts), "cum_fp", "cum_tp")
    assert kept == [(0, 0), (0, 2), (3, 2), (5, 4)]


def read_one(folder):
    files = glob.glob(f"{folder}/part-*")
    assert len(files) == 1 and not glob.glob(f"{folder}/_header*") and not glob.glob(f"{folder}/_joining*")
    with open(files[0], "rb") as f:
        return f.read()


def test_one_file_without_one_task(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select("id", F.concat(F.lit('a "quoted", '), F.col("id")).alias("na,me"))
    d = str(tmp_path)
    S.write_csv(df, f"{d}/csv", single_file=True)
    lines = read_one(f"{d}/csv").decode().split("\n")
    assert lines[0] == 'id,"na,me"' and lines[-1] == "" and len(lines) == 1002
    assert [int(x.split(",")[0]) for x in lines[1:-1]] == list(range(1000))
    df.coalesce(1).write.options(header="true", **{k: v for k, v in S.CSV_OPTS.items() if k != "header"}) \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{d}/one")
    assert read_one(f"{d}/csv") == read_one(f"{d}/one")
    S.write_json(df, f"{d}/json", single_file=True)
    df.coalesce(1).write.json(f"{d}/json1")
    assert read_one(f"{d}/json") == read_one(f"{d}/json1")
    S.write_text(df.select("na,me"), f"{d}/text", single_file=True)
    assert len(read_one(f"{d}/text").splitlines()) == 1000
    assert spark.read.text(f"{d}/text").count() == 1000


def test_one_file_of_no_rows(spark, tmp_path):
    S.write_csv(spark.range(0).withColumnRenamed("id", "x"), f"{tmp_path}/none", single_file=True)
    assert read_one(f"{tmp_path}/none").decode().strip() == "x"
    S.write_json(spark.range(0), f"{tmp_path}/nothing", single_file=True)
    assert read_one(f"{tmp_path}/nothing") == b""


def test_null_ratings_and_null_keys(spark):
    r = spark.createDataFrame([(None,), (5.0,), (1.0,)], "overall double")
    assert [x["l"] for x in r.select(FL.rating_label(F.col("overall"), null_ratings=False).alias("l")).collect()] == [None, 2.0, 0.0]
    slots = ", ".join(f"sim_prod{i} string" for i in range(1, 6))
    base = spark.createDataFrame([("A", None, "B", None, None, None), ("C", "B", "X", None, None, "A")], f"asin string, {slots}")
    attrs = ["product_name"]
    products = spark.createDataFrame([("A", "a"), ("B", "b"), (None, "none"), (None, "nil")], "asin string, product_name string")
    for match in (False, True):
        wide = rows(J.enrich_slots_wide(base, products, attrs=attrs, null_keys_match=match).fillna("-"))
        assert rows(J.enrich_slots_long(base, products, attrs=attrs, null_keys_match=match).fillna("-")) == wide


def test_rule_five_can_score_its_token(spark):
    tokens = spark.createDataFrame([
        (1, "P", 0, "sound", 2, "nsubj", "NOUN", "NN", False), (1, "P", 1, "is", 2, "cop", "AUX", "VBZ", False),
        (1, "P", 2, "great", 2, "ROOT", "ADJ", "JJ", False), (1, "P", 3, "truly", 2, "advmod", "ADV", "RB", False)],
        "doc_id long, asin string, idx int, text string, head_idx int, dep string, pos string, tag string, is_stop boolean")
    five = {s: A.aspect_pairs(tokens, rule5_scores_token=s).filter("rule = 5").head()["score_phrase"] for s in (False, True)}
    assert five == {False: "truly", True: "great"}
