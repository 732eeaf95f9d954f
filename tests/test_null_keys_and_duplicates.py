"""Null keys, repeated keys, empty documents: no operator loses or mixes rows."""

import json

import pytest
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.functions import text as T
from revlens.operators import evaluation as EV
from revlens.operators import features as FE
from revlens.operators import grouping as GR
from revlens.operators import joins as J
from revlens.operators import models as MD
from revlens.operators import polarity as POL
from revlens.operators import sampling as K
from revlens.plans import jobs
from revlens.session import ensure_checkpoint_dir
from revlens.sources import files as S
from revlens.streaming import cleaning as ST

REVIEWS = "asin string, review_id long, review_text string"


def test_null_product_keeps_its_reviews(spark):
    df = spark.createDataFrame([(None, 1, "aa"), ("n", 2, "bb"), (None, 3, "cc")], REVIEWS)
    got = sorted((tuple(r) for r in GR.reviews_per_product(df).collect()), key=str)
    assert got == sorted([(None, 1, 1, "aa"), (None, 2, 3, "cc"), ("n", 1, 2, "bb")], key=str)
    chunks = sorted((tuple(r) for r in GR.greedy_chunks(df, 10).collect()), key=str)
    assert chunks == sorted([(None, 0, 2, "aa cc"), ("n", 0, 1, "bb")], key=str)


def test_null_label_is_capped_like_any_other(spark):
    df = spark.createDataFrame([(i, None if i % 3 else 1.0, i * 7919 % (1 << 32)) for i in range(30)],
                               "id long, label double, k long")
    got = K.cap_per_group(df, "label", 4, "k", "id").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {None: 4, 1.0: 4}


def test_small_splits_are_not_rounded_away(spark):
    df = spark.range(100_000).withColumnRenamed("id", "review_id")
    n = K.holdout_split(df, weights=(0.997, 0.003)).filter("split = 'test'").count()
    assert 200 < n < 400


def test_slot_enrichment_with_repeated_rows_and_products(spark):
    attrs = J.SLOT_ATTRS
    slots = ["sim_prod1", "sim_prod2", "sim_prod3", "sim_prod4", "sim_prod5"]
    base = spark.createDataFrame([("B", "A", "C", None, "A", "?"), ("B", "B", None, None, None, None),
                                  (None, "A", "D", "D", "B", "A"), ("B", "A", "C", None, "A", "?")],
                                 "asin string, " + ", ".join(f"{s} string" for s in slots))
    rows = [("A", "a1"), ("B", "b"), ("C", "c"), ("D", "d1"), ("D", "d2"), (None, "none")]
    products = spark.createDataFrame([(k, n, *[float(i) for i in range(len(attrs) - 1)]) for k, n in rows],
                                     "asin string, product_name string, " + ", ".join(f"{a} double" for a in attrs[1:]))
    wide, long = J.enrich_slots_wide(base, products), J.enrich_slots_long(base, products)
    assert long.columns == wide.columns
    assert sorted(map(str, long.collect())) == sorted(map(str, wide.collect())) and long.count() == 7


def test_emoticons_go_one_after_the_other(spark):
    cases = {"::|)": "", ":)(": "(", "::)(": "", ":::)(/": "", "a:|b": "ab", ": )": ": )"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.o for r in df.select("t", T.strip_emoticons(F.col("t")).alias("o")).collect()} == cases


def test_demojize_with_a_full_size_table(spark):
    table = {chr(0x1F300 + i % 700) + chr(0x1F3FB + i // 700): f":n{i}:" for i in range(3_500)}
    table |= {chr(0x1F300 + i): f":s{i}:" for i in range(700)} | {"*\\E]": ":odd:", "^": ":caret:"}
    text = "x " + chr(0x1F300 + 5) + chr(0x1F3FB + 2) + chr(0x1F300 + 5) + " ^*\\E] y" + chr(0x1F900)
    want = f"x :n1405::s5: :caret::odd: y{chr(0x1F900)}"
    df = spark.createDataFrame([(text,), ("plain",), (None,)], "t string")
    got = [r.o for r in df.select(T.demojize(F.col("t"), table).alias("o")).collect()]
    assert sorted(got, key=str) == sorted([want, "plain", None], key=str)


@pytest.mark.parametrize("phrase, want", [("hardly good", 0.3832), ("without good", -0.3412), ("not good", -0.3412),
                                          ("very good", 0.4927), ("good", 0.4404)])
def test_scorer_has_its_own_word_lists(spark, phrase, want):
    """Expected values by hand: v = 1.9 shifted by 0.293 or times -0.74, then v / sqrt(v^2 + 15)."""
    lexicon = spark.createDataFrame([("good", 1.9)], "word string, valence double")
    neg = S.values_table(spark, D.SCORER_NEGATIONS, ["word"])
    got = POL.phrase_polarity(spark.createDataFrame([(phrase,)], "phrase string"), lexicon, neg,
                              S.values_table(spark, D.DEFAULT_BOOSTERS, ["word", "scalar"])).first()
    assert got.polarity == want


def test_confusion_row_for_a_class_seen_as_prediction_only(spark):
    p = spark.createDataFrame([(0, 0), (0, 3), (1, 1)], "label int, prediction int")
    got = {r.label: (r.pred_0, r.pred_1, r.pred_3) for r in EV.confusion_matrix(p, [0, 1, 3]).collect()}
    assert got == {0: (1, 0, 1), 1: (0, 1, 0), 3: (0, 0, 0)}


def test_report_reads_the_predictions_once(spark, tmp_path):
    spark.createDataFrame([(0, 0), (0, 3), (1, 1)], "label int, prediction int").write.parquet(f"{tmp_path}/p")
    df = EV.classification_report(spark.read.parquet(f"{tmp_path}/p"))
    assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r["class"] for r in df.collect()} == {"0", "1", "3", "accuracy", "macro avg", "weighted avg"}


def test_roc_starts_at_the_origin(spark):
    p = spark.createDataFrame([(2, 0.9), (0, 0.5), (2, 0.1)], "label int, score double")
    got = sorted(((r.threshold, r.fpr, r.tpr) for r in EV.roc_points(p, "label", "score", 2).collect()), reverse=True)
    assert got == [(float("inf"), 0.0, 0.0), (0.9, 0.0, 0.5), (0.5, 1.0, 0.5), (0.1, 1.0, 1.0)]
    assert EV.roc_points(p.limit(0), "label", "score", 2).count() == 0


def test_documents_without_words_are_padding_only(spark):
    docs = spark.createDataFrame([(1, ["a"], 1.0), (2, [], 0.0), (3, None, None)], "review_id long, words array<string>, label double")
    vocab = spark.createDataFrame([("a", 1, 4)], "word string, cnt long, id int")
    got = {r.review_id: r for r in FE.encode_fixed_length(docs, vocab, max_len=4).collect()}
    assert got[1].input_ids == [D.CLS_ID, 4, D.SEP_ID, D.PAD_ID] and got[1].attention_mask == [1, 1, 1, 0]
    for k in (2, 3):
        assert got[k].input_ids == [D.CLS_ID, D.SEP_ID, D.PAD_ID, D.PAD_ID] and got[k].attention_mask == [1, 1, 0, 0]
    table = MD.fit_bag_model(spark.createDataFrame([([4, 5], 1), ([4], None)], "input_ids array<int>, targets int"), buckets=8)
    assert table.shape == (9, 3)
    with pytest.raises(ValueError, match="label 7"):
        MD.fit_bag_model(spark.createDataFrame([([4], 7)], "input_ids array<int>, targets int"))


def test_restarted_stream_reads_the_new_file(spark, tmp_path):
    def put(name, asin):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps({"overall": 5.0, "asin": asin, "reviewText": "Nice", "reviewerID": "u"}))
    for name, asin in (("1.json", "P1"), ("2.json", "P2")):
        put(name, asin)
        ST.start_cleaning(spark, f"{tmp_path}/in", f"{tmp_path}/out").awaitTermination()
    assert sorted(r.asin for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["P1", "P2"]


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, master):
        self.sparkContext = FakeContext(master)
        self.conf = {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(FakeSession(master))


def test_command_line_pins_no_master(monkeypatch):
    import revlens.__main__ as M
    seen = {}
    monkeypatch.setattr(M, "build_session", lambda **kw: seen.update(kw) or type("S", (), {"stop": lambda self: None})())
    monkeypatch.setattr(M.jobs, "extract_aspects", lambda spark, *a, **kw: seen.update(kw))
    M.main(["aspects", "--tokens", "t", "--lexicon", "l", "--out", "o", "--negations", "n", "--boosters", "b", "--top-k", "3"])
    assert "master" not in seen and "shuffle_partitions" not in seen
    assert seen["negations_path"] == "n" and seen["boosters_path"] == "b" and seen["top_k"] == 3


def make_model():
    def predict(ids):
        return (ids > 0).sum(axis=1).astype("int32") % 3
    return predict


def test_split_score_and_aspect_input_jobs(spark, tmp_path):
    rows = [{"overall": 1.0 + i % 5, "vote": str(i % 9), "reviewerID": f"u{i}", "asin": None if i % 10 == 0 else "P1",
             "reviewText": f"it was word{i % 4}", "label": float(i % 3)} for i in range(120)]
    (tmp_path / "clean").mkdir()
    (tmp_path / "clean" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    sets = jobs.split_sets(spark, f"{tmp_path}/clean", f"{tmp_path}/sets", per_label=30)
    assert sets.count() == 90
    read = {n: spark.read.option("header", "true").csv(f"{tmp_path}/sets/{n}") for n in ("train", "val", "test")}
    assert sum(d.count() for d in read.values()) == 90 and read["train"].columns == ["reviewText", "label"]
    out = jobs.score(spark, f"{tmp_path}/clean", make_model, f"{tmp_path}/pred")
    assert out.count() == 120 and spark.read.option("header", "true").csv(f"{tmp_path}/pred").columns == ["label", "prediction"]
    (tmp_path / "c.csv").write_text("short,long\nit,it is\n")
    ready = jobs.aspect_input(spark, f"{tmp_path}/clean", f"{tmp_path}/c.csv", f"{tmp_path}/ready")
    assert ready.count() == sum(i % 9 >= 5 for i in range(120))
    assert all(r.reviewText.startswith("it is was word") for r in S.read_json(spark, f"{tmp_path}/ready", None).collect())
