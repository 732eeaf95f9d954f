import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IDF
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.functions import text as T
from revlens.operators import features as FE
from revlens.operators import models as MD
from revlens.plans import catalog as C
from revlens.session import scratch_path
from tests.conftest import SF_SMALL

DOCS = [(1, "good good phone", 2.0), (2, "bad phone", 0.0), (3, "ok sound good", 1.0), (4, "bad bad bad", 0.0)]


def docs(spark):
    df = spark.createDataFrame(DOCS, "review_id long, review_text string, label double")
    return df.withColumn("words", T.tokenize(F.col("review_text")))


def test_tfidf_exact_equals_hashed_when_no_collision(spark):
    d = docs(spark)
    exact = {(r.review_id, r.word): r.tfidf for r in FE.tfidf_exact(d).collect()}
    htf = HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 18)
    tf = htf.transform(d)
    model = IDF(inputCol="tf", outputCol="f").fit(tf)
    out = model.transform(tf).collect()
    vocab = {w for _, t, _ in DOCS for w in t.split(" ")}
    idx = {w: htf.indexOf(w) for w in vocab}
    assert len(set(idx.values())) == len(vocab)
    for r in out:
        for w in set(r.words):
            assert math.isclose(r.f[idx[w]], exact[(r.review_id, w)], abs_tol=1e-9)


def test_naive_bayes_closed_form(spark):
    d = docs(spark)
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=64).transform(d)
    m = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(tf)
    rows = tf.collect()
    n = len(rows)
    for c in range(3):
        nc = sum(1 for r in rows if r.label == c)
        assert math.isclose(m.pi[c], math.log(nc + 1) - math.log(n + 3), abs_tol=1e-9)
        w = np.zeros(64)
        for r in rows:
            if r.label == c:
                w += r.features.toArray()
        exp = np.log(w + 1) - np.log(w.sum() + 64)
        assert np.allclose(m.theta.toArray()[c], exp, atol=1e-9)


def test_model_round_trip_same_predictions(spark):
    train, test = C._train_test(spark, SF_SMALL)
    model = MD.naive_bayes_pipeline().fit(train)
    again = MD.save_and_load(model, scratch_path(spark, "t-model"))
    assert isinstance(again, PipelineModel)
    a = model.transform(test).select("review_id", "prediction")
    b = again.transform(test).select("review_id", "prediction")
    assert a.exceptAll(b).count() == 0


def test_encoding_shape(spark):
    enc = C.encoded(spark, SF_SMALL).collect()
    assert enc
    for r in enc:
        assert len(r.input_ids) == D.MAX_LEN and len(r.attention_mask) == D.MAX_LEN
        assert r.input_ids[0] == D.CLS_ID
        n = sum(r.attention_mask)
        assert r.input_ids[n - 1] == D.SEP_ID and all(x == D.PAD_ID for x in r.input_ids[n:])


def test_vocabulary_ranks(spark):
    v = FE.build_vocabulary(docs(spark)).orderBy("id").collect()
    assert [r.word for r in v][:2] == ["bad", "good"]   # 4 and 3 uses, then by word
    assert [r.id for r in v] == list(range(D.FIRST_WORD_ID, D.FIRST_WORD_ID + len(v)))


def test_score_batches(spark):
    enc = C.encoded(spark, SF_SMALL)
    table = MD.fit_bag_model(enc, buckets=256)
    assert table.shape == (257, 3)
    out = MD.score_batches(enc, MD.bag_model(table), batch_size=16).select("targets", "prediction").collect()
    assert out and all(r.prediction in (0, 1, 2) for r in out)
    # the batch path equals the same model applied in plain numpy
    ids = np.array([list(r.input_ids) for r in enc.select("input_ids").orderBy("review_id").collect()])
    exp = MD.bag_model(table)()(ids)
    got = [r.prediction for r in MD.score_batches(enc, MD.bag_model(table), batch_size=7)
           .orderBy("review_id").select("prediction").collect()]
    assert list(exp) == got


def test_similar_topk_zero_vector_and_ties(spark):
    from revlens.operators import products as PR
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 1.0], 0), (4, [0.0, 0.0], 0), (5, [1.0, 1.0], 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    top = {(r.id, r.rank): r.nbr for r in PR.similar_topk(v, k=2, block_rows=2).collect()}
    assert top[(1, 1)] == 2 and top[(2, 1)] == 1           # parallel vectors first
    assert top[(4, 1)] == 1 and top[(4, 2)] == 2           # zero vector: all ties at 0, by id
    assert (5, 1) not in top                               # alone in its block


def test_similar_topk_independent_of_tiling(spark):
    from revlens import fixtures as FX
    from revlens.operators import products as PR
    e = FX.table(spark, SF_SMALL, "embeddings")
    base = sorted(tuple(r) for r in PR.similar_wide(PR.similar_topk(e, k=5)).collect())
    for rows, factor in [(7, 1), (3, 5), (50, 2)]:
        got = sorted(tuple(r) for r in PR.similar_wide(PR.similar_topk(e, k=5, block_rows=rows, b_factor=factor))
                     .collect())
        assert got == base
