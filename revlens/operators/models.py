"""Classifiers, persistence and batch scoring."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from revlens.operators import features as FE


def naive_bayes_pipeline(text_col: str = "review_text", smoothing: float = 1.0) -> Pipeline:
    """L5 + L7: tokenizer -> hashed TF -> IDF -> multinomial Naive Bayes."""
    return Pipeline(stages=[FE.tokenizer(text_col), FE.hashing_tf(), FE.idf(),
                            NaiveBayes(smoothing=smoothing, modelType="multinomial")])


def logistic_pipeline(text_col: str = "review_text", max_iter: int = 10, reg: float = 0.01) -> Pipeline:
    """L6 + L7: same features, multinomial logistic regression."""
    return Pipeline(stages=[FE.tokenizer(text_col), FE.hashing_tf(), FE.idf(),
                            LogisticRegression(maxIter=max_iter, regParam=reg)])


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Persist fitted state and read it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def probabilities(pred: DataFrame, col: str = "probability") -> Column:
    """M5: ML vector -> plain array<double>."""
    return vector_to_array(pred[col])


def fit_bag_model(encoded: DataFrame, buckets: int = 4096, n_classes: int = 3, ids_col: str = "input_ids",
                  target: str = "targets", alpha: float = 1.0) -> np.ndarray:
    """A hashed bag-of-ids multinomial Naive Bayes, learned by one
    distributed aggregation: counts per (id bucket, class) over the real
    positions (special ids excluded), partially aggregated before the
    shuffle.  Returns log P(bucket | class) + log P(class) as a
    (buckets + 1, classes) array: a fixed-size table, whatever the data
    size (the last row holds the class priors)."""
    from pyspark.sql import functions as F
    from revlens import dictionaries as D
    # rows without a label teach nothing; a label outside the classes is an error of the caller
    encoded = encoded.filter(F.col(target).isNotNull())
    wrong = encoded.filter(~F.col(target).between(0, n_classes - 1)).select(target).first()
    if wrong:
        raise ValueError(f"label {wrong[0]} is not one of the {n_classes} classes")
    toks = (encoded.select(F.col(target).alias("y"), F.explode(ids_col).alias("id"))
                   .filter(F.col("id") >= D.FIRST_WORD_ID)
                   .select("y", F.pmod(F.col("id"), F.lit(buckets)).alias("b")))
    counts = np.full((buckets, n_classes), alpha)
    for r in toks.groupBy("b", "y").count().collect():     # at most buckets x classes rows
        counts[r["b"], r["y"]] += r["count"]
    prior = np.full(n_classes, alpha)
    for r in encoded.groupBy(target).count().collect():     # one row per class
        prior[r[target]] += r["count"]
    logp = np.log(counts / counts.sum(axis=0, keepdims=True))
    return np.vstack([logp, np.log(prior / prior.sum())])


def bag_model(table: np.ndarray):
    """``make_predict_fn`` for ``score_batches`` from a ``fit_bag_model``
    table: sum of per-position log-likelihoods plus prior, arg-max class."""
    predict_with = _bag_predictor()
    return lambda: predict_with(table)


def _bag_predictor():
    """table -> predict function; a closure, so that workers need not import this package."""
    from revlens import dictionaries as D
    first_word = D.FIRST_WORD_ID

    def predict_with(table):
        buckets = table.shape[0] - 1
        logp, prior = table[:-1], table[-1]

        def predict(ids: np.ndarray) -> np.ndarray:
            ids = ids.astype(np.int64)
            real = (ids >= first_word)[..., None]
            scores = (logp[ids % buckets] * real).sum(axis=1) + prior
            return scores.argmax(axis=1).astype(np.int32)
        return predict
    return predict_with


def bag_model_loader():
    """A loader for ``model_of_file`` from a ``fit_bag_model`` table saved by ``numpy.save``:
    the table is mapped into memory, so the workers of a machine share its pages."""
    predict_with = _bag_predictor()

    def load(path: str):
        import numpy
        return predict_with(numpy.load(path, mmap_mode="r"))
    return load


def model_of_file(spark, path: str, load):
    """L8 + L11: ``make_predict_fn`` for ``score_batches`` from a saved model.

    Spark ships the file (any path it can read) to every executor once, instead
    of closing over it in every task; ``load(local path)`` runs once per Python
    worker and returns the predict function."""
    spark.sparkContext.addFile(path)
    name = path.rstrip("/").rsplit("/", 1)[-1]

    def make_predict_fn():
        from pyspark import SparkFiles
        return load(SparkFiles.get(name))
    return make_predict_fn


def score_batches(encoded: DataFrame, make_predict_fn, ids_col: str = "input_ids", seq_len: int = 512,
                  batch_size: int = 64, out: str = "prediction") -> DataFrame:
    """Apply a user model to encoded rows in Arrow batches; the model
    is built once per Python worker, not per row."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.IntegerType(), batch_size=batch_size,
                            input_tensor_shapes=[[seq_len]])
    return encoded.withColumn(out, udf(ids_col))
