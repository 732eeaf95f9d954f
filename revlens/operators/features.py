"""Text features."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.operators.ordered import dense_rank_by
from revlens.session import materialize


def explode_words(docs: DataFrame, words: str = "words", *keep: str) -> DataFrame:
    """One row per word.  ``explode_outer`` + a null filter instead of
    ``explode``: a plain explode makes the optimizer infer a
    ``size(words) > 0`` filter and push it below joins, which would
    evaluate the whole text-cleaning expression a second time."""
    return (docs.select(*keep, F.explode_outer(words).alias("word"))
                .filter(F.col("word").isNotNull()))


def tokenizer(text_col: str = "review_text", out: str = "words") -> Tokenizer:
    """L1: lower-case, split on single whitespace characters."""
    return Tokenizer(inputCol=text_col, outputCol=out)


def hashing_tf(words: str = "words", out: str = "tf", num_features: int = 1 << 18) -> HashingTF:
    """L2: hashed term frequencies (2^18 buckets by default)."""
    return HashingTF(inputCol=words, outputCol=out, numFeatures=num_features)


def idf(tf: str = "tf", out: str = "features") -> IDF:
    """L3: inverse document frequency ln((m + 1) / (df + 1))."""
    return IDF(inputCol=tf, outputCol=out)


def tfidf_exact(docs: DataFrame, doc_id: str = "review_id", words: str = "words", digits: int = 10) -> DataFrame:
    """L4: unhashed TF-IDF with the same formula as L2+L3: one row per
    (document, word).  The document count is a scalar subquery.  Every input
    row is a document, whatever its id."""
    # read twice: for the document frequencies and for the rows
    tf = materialize(explode_words(docs.select(doc_id, words, F.monotonically_increasing_id().alias("__row")), words, doc_id, "__row")
                     .groupBy("__row", doc_id, "word").agg(F.count(F.lit(1)).alias("tf")))
    # materialised so both join inputs are shuffle stages: AQE broadcasts the
    # vocabulary by measured size or splits the partitions of common words
    df_ = materialize(tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    m = docs.select(F.count(F.lit(1))).scalar()
    # logarithm and rounding once a word, not once a row; a word that stands once in a text weighs its idf
    words_ = df_.withColumn("__idf", F.log((m + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))) \
                .withColumn("idf", F.round("__idf", digits))
    return (tf.join(words_, "word")
              .select(doc_id, "word", "tf", "df", "idf",
                      F.when(F.col("tf") == 1, F.col("idf")).otherwise(F.round(F.col("tf") * F.col("__idf"), digits)).alias("tfidf")))


def build_vocabulary(docs: DataFrame, words: str = "words", first_id: int = D.FIRST_WORD_ID) -> DataFrame:
    """Word ids by descending frequency (ties by word), after the
    special ids.  Ranking uses range-partitioned running counts, not a
    global single-task window."""
    counts = explode_words(docs, words).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = dense_rank_by(counts, [("cnt", False), ("word", True)], name="rank")
    return ranked.select("word", "cnt", (F.col("rank") + F.lit(first_id - 1)).cast("int").alias("id"))


def encode_fixed_length(docs: DataFrame, vocab: DataFrame, doc_id: str = "review_id", words: str = "words",
                        label: str = "label", max_len: int = D.MAX_LEN) -> DataFrame:
    """L9 (a document without words is start, end and padding): ids cut or padded to ``max_len`` with start and end markers and
    an attention mask (truncation to ``max_len - 2`` words is the
    operator's meaning)."""
    body = max_len - 2
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), doc_id, label, words)
    ex = (rows.select("__row", doc_id, F.col(label).cast("int").alias("targets"),
                      F.posexplode_outer(F.slice(words, 1, body)).alias("pos", "word")))
    ided = ex.join(vocab.select("word", "id"), "word", "left").withColumn("id", F.coalesce("id", F.lit(D.UNK_ID)))
    # one row out per row in, whatever its id; id and label ride along in the grouping key: no join back
    # place and id in one long, the place above the id: a quarter of the bytes of a struct, sorted as numbers
    placed = F.col("pos").cast("long") * F.lit(1 << 32) + (F.col("id").cast("long") + F.lit(1 << 31))
    seq = (ided.groupBy("__row", doc_id, "targets")
               .agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), placed))).alias("__s"))
               .select(doc_id, "targets", F.transform("__s", lambda x: (x % F.lit(1 << 32) - F.lit(1 << 31)).cast("int")).alias("__ids")))
    return seq.select(doc_id, *fixed_length(F.col("__ids"), max_len), "targets")


def fixed_length(ids: Column, max_len: int, cls_id: int = D.CLS_ID, sep_id: int = D.SEP_ID, pad_id: int = D.PAD_ID) -> list[Column]:
    """input_ids and attention_mask of at most ``max_len - 2`` ids: markers at both ends, padded to ``max_len``."""
    body = max_len - 2
    n = F.size(ids)
    full = F.concat(F.array(F.lit(cls_id)), ids, F.array(F.lit(sep_id)), F.array_repeat(F.lit(pad_id), F.lit(body) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n + 2), F.array_repeat(F.lit(0), F.lit(body) - n))
    return [full.cast("array<int>").alias("input_ids"), mask.cast("array<int>").alias("attention_mask")]
