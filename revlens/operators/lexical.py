"""Dictionary-based word rewrites.

Lemma tables are of any size: words meet them in an equi-join, which Catalyst
broadcasts only below its size threshold.  Contractions are a dictionary of
checked size, compiled into the plan.  Token-table inputs are regrouped per
document, which is bounded by one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.phrases import Phrases


def expand_contractions_df(df: DataFrame, key: str, text: str, dictionary: DataFrame,
                           short: str = "short", long: str = "long") -> DataFrame:
    """Replace every dictionary phrase in running text, next to
    punctuation, quotes and line ends too (``functions.phrases``).

    One projection: no shuffle, no checkpoint, and ``key`` may repeat or be
    null.  The dictionary is collected, behind a check of its size."""
    return df.withColumn(text, Phrases.of(dictionary, short, long).rewrite(F.col(text)))


def _rebuild(tokens: DataFrame, word: Column, keep: Column | None = None) -> DataFrame:
    item = F.struct(F.col("idx"), word.alias("w"))
    if keep is not None:
        item = F.when(keep, item)
    return (tokens.groupBy("doc_id")
                  .agg(F.array_sort(F.collect_list(item)).alias("__items"))
                  .select("doc_id", F.transform("__items", lambda x: x["w"]).alias("words")))


def pos_filter(tokens: DataFrame, keep_tags: list[str]) -> DataFrame:
    """Keep tokens whose tag is listed; text rebuilt as
    ' ' + 'w1 ' + 'w2 ' ... (a leading space, each kept word followed by one)."""
    r = _rebuild(tokens, F.col("text"), F.col("tag").isin(keep_tags))
    return r.select("doc_id", F.concat(F.lit(" "), F.array_join(F.transform("words", lambda w: F.concat(w, F.lit(" "))),
                                                                 "")).alias("text"))


def lemmatize(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Lemma of each token as a verb when its tag holds a 'v' (any
    case), else as a noun; unknown words stay; text rebuilt by spaces.
    ``lemmas`` is a (word, pos, lemma) table of any size: a left join, which
    Catalyst broadcasts when the table is small and shuffles otherwise."""
    pos = F.when(F.lower(F.col("tag")).contains("v"), F.lit("v")).otherwise(F.lit("n"))
    t = tokens.select("doc_id", "idx", "text", pos.alias("__pos"))
    lm = lemmas.select(F.col("word").alias("text"), F.col("pos").alias("__pos"), F.col("lemma").alias("__lemma")) \
               .dropDuplicates(["text", "__pos"])
    j = t.join(lm, ["text", "__pos"], "left")
    r = _rebuild(j, F.coalesce(F.col("__lemma"), F.col("text")))
    return r.select("doc_id", F.array_join("words", " ").alias("text"))
