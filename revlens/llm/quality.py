"""Quality classifier: regularised quadratic discriminant.

Each document becomes a short vector of transformed statistics of its whole
text.  Class means and covariances come from one distributed sum over the
labelled documents; each covariance is shrunk towards the pooled one and
towards a scaled identity; its Cholesky factor is computed once and kept.  The
score is the logistic of the difference of the two classes' log densities
(Mahalanobis distance and log determinant) and log priors, divided by the
number of features so that it stays graded.

Defined results: null and empty texts have the statistics of an empty text and
get a score; labels other than 0 and 1 and labels without a document are not
used; a document labelled several times counts each time; with one class only,
or none, every score is that class (0.5 for none).
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, held_out, map_texts, staged, table, utf8

#: Weight of the pooled covariance, and of the scaled identity, in each class covariance.
POOLED_SHARE = 0.1
IDENTITY_SHARE = 0.05

FEATURES = ("log_words", "word_length", "distinct_words", "top_word", "adjacent_repeats", "upper", "digits", "stops",
            "commas", "exclamations", "pipes", "symbols", "other_marks", "line_ends", "beyond_ascii", "words_per_stop")


def rate(part: float, whole: float) -> float:
    """A count per ``whole`` on a log scale, finite for zero counts."""
    return math.log((part + 0.5) / (whole + 1.0))


def statistics(data: bytes) -> list[float]:
    """The transformed statistics (FEATURES) of a UTF-8 text."""
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    n = len(words)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    size = len(data)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    marks = int(seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum())
    stops, commas, bangs, pipes = (int(seen[ord(c)]) for c in ".,!|")
    symbols = int(sum(seen[ord(c)] for c in "#$%&*"))
    return [math.log1p(n), math.log1p(size / (n + 1)), rate(len(counts), n), rate(max(counts.values(), default=0), n),
            rate(sum(map(eq, words, words[1:])), n), rate(upper, upper + lower), rate(int(seen[48:58].sum()), size),
            rate(stops, n), rate(commas, n), rate(bangs, n), rate(pipes, n), rate(symbols, n),
            rate(marks - stops - commas - bangs - pipes - symbols, n), rate(int(seen[10]), n),
            rate(int(seen[128:].sum()), size), math.log((n + 1.0) / (stops + 1.0))]


def features(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``row`` and the feature vector x of every document."""
    def make_kernel():
        def kernel(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([statistics(d) for d in utf8(texts)], pa.list_(pa.float64()))]

        return kernel

    return map_texts(docs, text, carry, [T.StructField("x", T.ArrayType(T.DoubleType()))], make_kernel)


class Discriminant:
    """Two classes: priors, means and inverse Cholesky factors."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]],
                 pooled_share: float = POOLED_SHARE, identity_share: float = IDENTITY_SHARE):
        present = [c for c in (0, 1) if c in moments and moments[c][0] > 0]
        self.only = None if len(present) == 2 else (float(present[0]) if present else 0.5)
        if self.only is not None:
            return
        total = sum(moments[c][0] for c in present)
        means, covs = {}, {}
        for c in present:
            n, s, ss = moments[c]
            means[c] = s / n
            covs[c] = ss / n - np.outer(means[c], means[c])
        pooled = sum(moments[c][0] * covs[c] for c in present) / total
        self.params = []
        for c in present:
            cov = (1 - pooled_share) * covs[c] + pooled_share * pooled
            scale = max(float(np.trace(pooled)) / len(pooled), 1e-9)
            cov = (1 - identity_share) * cov + identity_share * scale * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            self.params.append((math.log(moments[c][0] / total), means[c], np.linalg.inv(factor),
                                2.0 * float(np.log(np.diag(factor)).sum())))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        logs = []
        for prior, mean, inverse, logdet in self.params:
            z = (x - mean) @ inverse.T
            logs.append(prior - 0.5 * (logdet + (z * z).sum(axis=1)))
        return 1.0 / (1.0 + np.exp(np.clip((logs[0] - logs[1]) / x.shape[1], -60, 60)))


def fit(labelled: DataFrame, label: str = "label", x: str = "x") -> Discriminant:
    """Fit on rows (label 0 or 1, vector x).  Tasks add up their rows' moments,
    Spark adds up the tasks'; the driver gets one row per class and moment."""
    k = len(FEATURES)

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(0).to_numpy()
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), k)
            ones = np.hstack([np.ones((len(y), 1)), v])
            for c in (0, 1):
                rows = ones[y == c]
                if len(rows):
                    sums[c] = sums.get(c, 0.0) + rows.T @ rows
        for c, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([c] * m.size, pa.int32()), pa.array(range(m.size), pa.int32()),
                                              pa.array(m.ravel())], names=["c", "i", "v"])

    rows = labelled.select(col(label).cast("int").alias("c"), col(x).alias("x")).filter("c in (0, 1)")
    got = rows.mapInArrow(partial, "c int, i int, v double").groupBy("c", "i").agg(F.sum("v").alias("v")).collect()
    moments = {}
    for c in (0, 1):
        m = np.zeros((k + 1) * (k + 1))
        for r in got:
            if r["c"] == c:
                m[r["i"]] = r["v"]
        m = m.reshape(k + 1, k + 1)
        if m[0, 0]:
            moments[c] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return Discriminant(moments)


def score(rows: DataFrame, model: Discriminant, carry: list[str], x: str = "x") -> DataFrame:
    """``row`` and score of rows with feature vectors."""
    k = len(FEATURES)

    def make_kernel():
        def kernel(vectors: pa.Array) -> list[pa.Array]:
            return [pa.array(model.scores(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)), pa.float64())]

        return kernel

    return map_texts(rows, x, carry, [T.StructField("score", T.DoubleType())], make_kernel)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of the documents that are not held out."""
    vectors = staged(features(table(spark, sf_dir, "documents"), ["doc_id"]).select("row.doc_id", "x"), "quality-features")
    labels = table(spark, sf_dir, "labels").filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    training = vectors.join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
    found = score(vectors, fit(training), ["doc_id"])
    return found.select("row.doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")) \
        .withColumn("held_out", held_out("doc_id"))
