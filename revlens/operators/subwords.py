"""Fixed-length encoding with a supplied sub-word vocabulary.

Every word is cut greedily: the longest piece of the vocabulary that the word
begins with, then again and again the longest continuation piece (marked by
``##``) of what is left.  A word that cannot be cut to its end, or is longer
than ``MAX_WORD_CHARS``, is the unknown id as a whole.

Both kinds of pieces are merged into tries, compiled to one regex, and only the
distinct words of the table are cut; pieces meet their ids, and words their
pieces, in equi-joins.  All of it is native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.functions.phrases import trie_regex
from revlens.operators.features import fixed_length
from revlens.session import materialize

CONTINUED = "##"
MAX_WORD_CHARS = 100
#: A vocabulary is part of the plan; beyond this size it is refused rather than collected.
MAX_PIECES = 500_000


def basic_words(text: Column) -> Column:
    """The words of a text; every punctuation mark or symbol is a word of its own."""
    return F.regexp_extract_all(text, F.lit(r"[^\s\p{P}\p{S}]+|[\p{P}\p{S}]"), F.lit(0))


def piece_pattern(pieces: list[str]) -> str:
    """A regex whose matches, one after the other from a word's beginning, are its pieces."""
    first = trie_regex([p for p in pieces if not p.startswith(CONTINUED)], exact=True)
    later = trie_regex([p[len(CONTINUED):] for p in pieces if p.startswith(CONTINUED)], exact=True)
    return f"(?s)^{first or '(?!)'}|(?<!^)\\G{later or '(?!)'}"


def word_pieces(words: DataFrame, vocabulary: DataFrame, word: str = "word", piece: str = "piece", ident: str = "id",
                unknown: int = D.UNK_ID) -> DataFrame:
    """(word, ids) of every distinct non-null word; of several ids for a piece the smallest counts."""
    vocab = vocabulary.filter(F.col(piece).isNotNull() & F.col(ident).isNotNull() & ~F.col(piece).isin("", CONTINUED)) \
        .groupBy(F.col(piece).alias("piece")).agg(F.min(ident).cast("int").alias("id"))
    pieces = [r["piece"] for r in vocab.select("piece").limit(MAX_PIECES + 1).collect()]
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"a vocabulary in a plan holds at most {MAX_PIECES} pieces")
    distinct = words.select(F.col(word).alias("word")).filter(F.col("word").isNotNull()).distinct()
    short = F.length("word") <= MAX_WORD_CHARS
    cut = distinct.withColumn("p", F.when(short, F.regexp_extract_all("word", F.lit(piece_pattern(pieces)), F.lit(0)))
                              .otherwise(F.array().cast("array<string>")))
    whole = (F.length(F.array_join("p", "")) == F.length("word")) & (F.size("p") > 0)
    rows = cut.select("word", F.posexplode(F.when(whole, F.col("p")).otherwise(F.array(F.lit(None).cast("string")))).alias("at", "part"))
    keyed = rows.withColumn("piece", F.when(F.col("at") > 0, F.concat(F.lit(CONTINUED), "part")).otherwise(F.col("part")))
    # pieces come from the vocabulary: only the null of an unknown word finds no id
    return keyed.join(vocab, "piece", "left").groupBy("word") \
        .agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("id", F.lit(unknown)).alias("id")))).alias("x")) \
        .select("word", F.transform("x", lambda i: i["id"]).alias("ids"))


def encode_subwords(docs: DataFrame, vocabulary: DataFrame, doc_id: str = "review_id", words: str = "words", label: str = "label",
                    max_len: int = D.MAX_LEN, cls_id: int = D.CLS_ID, sep_id: int = D.SEP_ID, pad_id: int = D.PAD_ID,
                    unknown: int = D.UNK_ID) -> DataFrame:
    """L9 with sub-words: one row out per row in, whatever its id; ids cut or padded to ``max_len``
    with markers and a mask.  Null words are skipped; a row without words is markers and padding."""
    body = max_len - 2
    # a word is one id at least: later words cannot be seen
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), doc_id, F.col(label).cast("int").alias("targets"),
                       F.slice(F.filter(words, lambda w: w.isNotNull() & (w != "")), 1, body).alias("w"))
    # read for the distinct words and for the rows; written as lists, a fraction of the bytes of a row a word
    ex = materialize(rows).select("__row", doc_id, "targets", F.posexplode_outer("w").alias("pos", "word"))
    # materialised so that AQE broadcasts it by measured size or splits the rows of a common word
    known = materialize(word_pieces(ex, vocabulary, unknown=unknown))
    seq = ex.join(known, "word", "left").groupBy("__row", doc_id, "targets") \
        .agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "ids")))).alias("s"))
    ids = F.slice(F.flatten(F.transform("s", lambda x: x["ids"])), 1, body)
    return seq.withColumn("__ids", ids).select(doc_id, *fixed_length(F.col("__ids"), max_len, cls_id, sep_id, pad_id), "targets")
