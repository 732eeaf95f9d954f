"""File-to-file jobs: the pipeline's entry points as a user runs them.

Each job reads its inputs with declared schemas, runs the operators and
writes its outputs (distributed sinks; ``single_file`` only on request).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import dictionaries as D
from revlens import schemas
from revlens.fixtures import hash32 as FX_hash32
from revlens.functions import text as TX
from revlens.operators import evaluation as EV
from revlens.operators import features as FE
from revlens.operators import filters as FL
from revlens.operators import joins as J
from revlens.operators import lexical as LX
from revlens.operators import models as MD
from revlens.operators import polarity as POL
from revlens.operators import sampling as K
from revlens.plans import aspect_job, cleaning
from revlens.session import materialize
from revlens.sources import files as S

RAW_TO_INTERNAL = {"reviewText": "review_text", "reviewerID": "reviewer_id"}
INTERNAL_TO_RAW = {v: k for k, v in RAW_TO_INTERNAL.items()}


def _internal(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(RAW_TO_INTERNAL.get(c, c)) for c in df.columns])


def _raw(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(INTERNAL_TO_RAW.get(c, c)) for c in df.columns])


def preprocess(spark: SparkSession, reviews_path: str, meta_path: str, out_path: str,
               exclude_category: str = "Books", emoji_path: str | None = None) -> DataFrame:
    """Clean and label raw JSON-lines reviews, dropping one category; write JSON lines."""
    reviews = _internal(S.read_json(spark, reviews_path, schemas.REVIEWS_RAW))
    meta = S.read_json(spark, meta_path, schemas.META)
    emoji = None
    if emoji_path:
        emoji = TX.dictionary_to_map(S.read_csv(spark, emoji_path, T.StructType([
            T.StructField("ch", T.StringType()), T.StructField("name", T.StringType())])), "ch", "name")
    out = _raw(cleaning.clean_reviews(reviews, meta, exclude_category, emoji=emoji))
    S.write_json(out, out_path)
    return out


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return _internal(S.read_json(spark, path, schemas.REVIEWS_CLEAN))


TOKENS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("asin", T.StringType()),
                       T.StructField("idx", T.IntegerType()), T.StructField("text", T.StringType()),
                       T.StructField("head_idx", T.IntegerType()), T.StructField("dep", T.StringType()),
                       T.StructField("pos", T.StringType()), T.StructField("tag", T.StringType()),
                       T.StructField("is_stop", T.BooleanType())])
LEXICON = T.StructType([T.StructField("word", T.StringType()), T.StructField("valence", T.DoubleType())])
BOOSTERS = T.StructType([T.StructField("word", T.StringType()), T.StructField("scalar", T.DoubleType())])


def extract_aspects(spark: SparkSession, tokens_path: str, lexicon_path: str, out_path: str,
                    negations: list[str] = D.NEGATION_WORDS, boosters_path: str | None = None,
                    top_k: int = 5, negations_path: str | None = None,
                    scorer_negations: list[str] = D.SCORER_NEGATIONS, scorer: str = "core") -> DataFrame:
    """Parsed tokens (Parquet) + valence lexicon (CSV word,valence) ->
    (asin, aspect, modifier, polarity) JSON lines.  ``negations`` are the words
    of the determiner rule; the phrase scorer has its own negation words.
    ``scorer`` "full" adds idioms, contrast and emphasis to its core."""
    tokens = spark.read.schema(TOKENS).parquet(tokens_path)
    lexicon = S.read_csv(spark, lexicon_path, LEXICON, multi_line=True)  # a small file whose words may hold line ends
    neg = (S.read_text(spark, negations_path).select(F.col("value").alias("word")) if negations_path
           else S.values_table(spark, list(scorer_negations), ["word"]))
    bst = (S.read_csv(spark, boosters_path, BOOSTERS) if boosters_path
           else S.values_table(spark, D.DEFAULT_BOOSTERS, ["word", "scalar"]))
    out = aspect_job.product_aspect_table(tokens, lexicon, neg, bst, negations, k=top_k,
                                          scorer={"core": POL.phrase_polarity, "full": POL.text_polarity}[scorer])
    S.write_json(out, out_path)
    return out


def train_classifier(spark: SparkSession, clean_path: str, model_path: str, predictions_path: str,
                     kind: str = "naive_bayes", test_fraction: float = 0.3, seed: int = 42) -> DataFrame:
    """Fit TF-IDF + Naive Bayes or logistic regression on a hash split of
    the cleaned reviews, save the model, write (label, prediction) CSV with
    a header; returns the weighted metrics."""
    data = read_clean(spark, clean_path).select(F.xxhash64("reviewer_id", "asin", "review_text").alias("uid"),
                                                "review_text", F.col("label").cast("double").alias("label"))
    # read by the IDF fit, the model fit and the scoring
    split = materialize(K.holdout_split(data, key="uid", weights=(1 - test_fraction, test_fraction), seed=seed))
    pipe = MD.naive_bayes_pipeline() if kind == "naive_bayes" else MD.logistic_pipeline()
    model = pipe.fit(split.filter(F.col("split") == "train"))
    model.write().overwrite().save(model_path)
    pred = model.transform(split.filter(F.col("split") == "test"))
    S.write_csv(pred.select(F.col("label").cast("int"), F.col("prediction").cast("int")), predictions_path)
    return EV.weighted_metrics(pred)


PREDICTIONS = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("prediction", T.IntegerType())])


def evaluate(spark: SparkSession, predictions_path: str, classes: list[int] = (0, 1, 2)) -> dict[str, DataFrame]:
    """Metrics of a (label, prediction) CSV with header."""
    pred = S.read_csv(spark, predictions_path, PREDICTIONS)
    return {"weighted": EV.weighted_metrics(pred), "confusion": EV.confusion_matrix(pred, list(classes)),
            "report": EV.classification_report(pred)}


PRODUCTS = T.StructType([T.StructField(c, T.StringType()) for c in
                         ["asin", "product_name", "product_description", "product_category", "brand"]] +
                        [T.StructField("avg_rating", T.DoubleType()), T.StructField("total_ratings", T.LongType()),
                         T.StructField("avg_rating_last_year", T.DoubleType()),
                         T.StructField("num_reviews_last_year", T.LongType()),
                         T.StructField("num_reviews_last_month", T.LongType())])
SIMILAR = T.StructType([T.StructField(c, T.StringType()) for c in ["asin"] + [f"sim_prod{i}" for i in range(1, 6)]])


def enrich_products(spark: SparkSession, products_path: str, similar_path: str, out_path: str) -> DataFrame:
    """Products CSV + similar-products CSV -> products with the attributes
    of their five similar products (one join, long form), CSV with header."""
    products = S.read_csv(spark, products_path, PRODUCTS)
    similar = S.read_csv(spark, similar_path, SIMILAR)
    out = J.enrich_slots_long(J.attach(products, similar), products)
    S.write_csv(out, out_path)
    return out


def filter_metadata(spark: SparkSession, lines_path: str, keywords: list[str], out_path: str,
                    rejects_path: str | None = None) -> DataFrame:
    """Keep JSON lines mentioning any keyword; undecodable lines go to rejects."""
    lines = S.read_text(spark, lines_path)
    kept = FL.json_keyword_filter(lines, keywords)
    S.write_text(kept, out_path)
    if rejects_path:
        S.write_text(FL.json_rejects(lines), rejects_path)
    return kept


CONTRACTIONS = T.StructType([T.StructField("short", T.StringType()), T.StructField("long", T.StringType())])


def aspect_input(spark: SparkSession, clean_path: str, contractions_path: str, out_path: str, votes: int = 5) -> DataFrame:
    """Cleaned reviews with at least ``votes`` votes, contractions written out,
    as JSON lines: the texts that the parser of the aspect job reads."""
    clean = FL.min_votes(read_clean(spark, clean_path), votes)
    out = LX.expand_contractions_df(clean, "reviewer_id", "review_text", S.read_csv(spark, contractions_path, CONTRACTIONS))
    S.write_json(_raw(out), out_path)
    return out


def split_sets(spark: SparkSession, clean_path: str, out_path: str, per_label: int = 20_000,
               weights=(0.6, 0.2, 0.2), seed: int = 42) -> DataFrame:
    """At most ``per_label`` cleaned reviews of each label, split and shuffled
    into the CSV folders train, val and test (reviewText, label)."""
    data = read_clean(spark, clean_path).select("reviewer_id", "asin", "review_text", "label")
    data = FL.surrogate_id(data, ["reviewer_id", "asin", "review_text"], "uid") \
        .withColumn("order_key", FX_hash32(F.concat(F.col("uid").cast("string"), F.lit(f":{seed}"))))
    capped = K.cap_per_group(data, "label", per_label, "order_key", "uid")
    sets = materialize(K.stratified_split(capped, key="uid", weights=weights, seed=seed))
    for name in ("train", "val", "test"):
        part = sets.filter(F.col("split") == name).orderBy(K.shuffle_key(F.col("uid"), seed), "uid")
        S.write_csv(part.select(F.col("review_text").alias("reviewText"), "label"), f"{out_path.rstrip('/')}/{name}")
    return sets


def score(spark: SparkSession, clean_path: str, make_predict_fn, predictions_path: str) -> DataFrame:
    """Encode cleaned reviews, apply the user's model in Arrow batches, write
    (label, prediction) CSV with a header."""
    words = materialize(read_clean(spark, clean_path).filter(F.col("review_text").isNotNull())
                        .select(F.monotonically_increasing_id().alias("review_id"), "label",
                                TX.tokenize(F.col("review_text")).alias("words")))
    encoded = FE.encode_fixed_length(words, FE.build_vocabulary(words))
    out = MD.score_batches(encoded, make_predict_fn).select(F.col("targets").alias("label"), "prediction")
    S.write_csv(out, predictions_path)
    return out
