"""Operators on empty and degenerate inputs."""

from pyspark.sql import functions as F

from revlens.operators import aspects as A
from revlens.operators import evaluation as EV
from revlens.operators import features as FE
from revlens.operators import grouping as GR
from revlens.operators import sampling as K
from revlens.plans.cleaning import clean_reviews
from tests.test_aspects import SCHEMA


def test_empty_inputs(spark):
    reviews = spark.createDataFrame([], "review_id long, asin string, overall float, vote string, "
                                        "reviewer_id string, review_text string")
    meta = spark.createDataFrame([], "asin string, main_cat string")
    assert clean_reviews(reviews, meta).count() == 0
    assert GR.reviews_per_product(reviews).count() == 0
    assert GR.greedy_chunks(reviews, 100).count() == 0
    tokens = spark.createDataFrame([], SCHEMA)
    assert A.aspect_pairs(tokens).count() == 0
    pred = spark.createDataFrame([], "label int, prediction int, score double")
    assert EV.weighted_metrics(pred).count() == 1
    assert EV.roc_points(pred, "label", "score", 2).count() == 0
    docs = spark.createDataFrame([], "review_id long, label double, words array<string>")
    assert FE.tfidf_exact(docs).count() == 0
    assert FE.build_vocabulary(docs).count() == 0
    c = spark.createDataFrame([], "label double, review_id long, k long")
    assert K.cap_per_group(c, "label", 10, "k", "review_id").count() == 0


def test_one_hot_product_is_chunked_across_blocks(spark):
    rows = [("HOT", i, "x" * (i % 9 + 1)) for i in range(1, 3001)] + [("COLD", 1, "y")]
    df = spark.createDataFrame(rows, "asin string, review_id long, review_text string")
    out = GR.greedy_chunks(df, limit=40, block_reviews=64)
    hot = out.filter(F.col("asin") == "HOT")
    assert hot.agg(F.sum("n_reviews")).first()[0] == 3000
    texts = [r.text for r in hot.orderBy("chunk").collect()]
    assert all(len(t.replace(" ", "")) <= 40 for t in texts)
    # greedy: no two neighbouring chunks would fit together
    lens = [len(t.replace(" ", "")) for t in texts]
    assert all(a + len(b.split(" ")[0]) > 40 for a, b in zip(lens, texts[1:]))
    pos = GR.reviews_per_product(df).filter(F.col("asin") == "HOT").agg(F.min("pos"), F.max("pos")).first()
    assert tuple(pos) == (1, 3000)


def test_contractions_with_nulls_and_repeated_keys(spark):
    from revlens.operators import lexical as LX
    df = spark.createDataFrame([(1, "it was on it"), (1, "it"), (2, ""), (3, "x  it"), (4, None), (None, "was")], "id long, t string")
    d = spark.createDataFrame([("it", "it is"), ("was", "was not"), ("on", "on the"), ("it", "zzz"), (None, "n")],
                              "short string, long string")
    got = sorted((tuple(r) for r in LX.expand_contractions_df(df, "id", "t", d).collect()), key=str)
    assert got == sorted([(1, "it is was not on the it is"), (1, "it is"), (2, ""), (3, "x  it is"), (4, None), (None, "was not")], key=str)
