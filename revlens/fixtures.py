"""Review-shaped views derived from the driver's tables.

The given tables are TPC-H-like plus a ``documents`` prose table; these
views give them the shape the review jobs expect (see FIXTURES.md).  All
views read whole tables and whole texts; the same definitions exist as
DuckDB SQL in ``revlens.oracle.fixtures_sql`` so both engines see
identical rows.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.operators.ordered import dense_rank_by
from revlens.sources.files import values_table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bucket(e: Column, n: int) -> Column:
    """Stable hash bucket: first 8 hex digits of md5 as an integer, mod n.
    The same integer is computable in DuckDB, so splits and samples agree."""
    return F.conv(F.substring(F.md5(e.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(n)


def hash32(e: Column) -> Column:
    """The 32-bit md5 prefix as a non-negative BIGINT (ordering key)."""
    return F.conv(F.substring(F.md5(e.cast("string")), 1, 8), 16, 10).cast("bigint")


def _p(c: Column) -> Column:
    return F.concat(F.lit("P"), c.cast("string"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    return d.select(
        doc.alias("review_id"),
        _p(doc % 50).alias("asin"),
        (F.lit(1) + doc % 5).cast("float").alias("overall"),
        F.when(doc % 7 == 0, F.lit(None).cast("string"))
         .when(doc % 11 == 0, F.lit("1,234"))
         .otherwise((doc % 23).cast("string")).alias("vote"),
        F.concat(F.lit("U"), (doc % 97).cast("string")).alias("reviewer_id"),
        F.when(doc % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("review_text"),
    )


# Suffixes appended to whole review texts, one per doc_id % 10, to
# exercise every cleaning step.
NOISE_SUFFIXES = [" <br /> one; two", " [a] [[b]] z", " ///// end // x",
                  " &#34;q&#34; 5&#3; &#9;", " :) :( :/ :| ok ::|) :::)( ::/:",
                  " mid#tag a_b #one #two", " $x a&b c", " https://a.b/c @me end",
                  "  \t tab ", "\r\nLINE"]


def noisy_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    m = F.col("doc_id") % 10
    suffix = F.when(m == 0, F.lit(NOISE_SUFFIXES[0]))
    for i in range(1, 9):
        suffix = suffix.when(m == i, F.lit(NOISE_SUFFIXES[i]))
    suffix = suffix.otherwise(F.lit(NOISE_SUFFIXES[9]))
    return d.select(F.col("doc_id").alias("review_id"),
                    F.concat(F.col("text"), suffix).alias("review_text"))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        _p(F.col("p_partkey")).alias("asin"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("Books")).otherwise(F.col("p_type")).alias("main_cat"),
    )


def meta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per part; every tenth (key % 10 == 3) is cut short."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("line_no"),
        F.concat(F.lit('{"asin": "P'), k.cast("string"), F.lit('", "title": "'), F.col("p_name"), F.lit('"'),
                 F.when(k % 10 == 3, F.lit("")).otherwise(F.lit("}"))).alias("value"),
    )


def similar_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = meta(spark, sf_dir).filter(F.col("asin") != "P13")
    key = F.substring(F.col("asin"), 2, 1 << 20).cast("int")
    cols = [F.col("asin")]
    for slot, off in enumerate([11, 22, 33, 44, 55], start=1):
        cols.append(_p((key * 7 + off) % 53).alias(f"sim_prod{slot}"))
    return m.select(*cols)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir)
    rid = F.col("review_id").cast("string")
    return r.select(
        "review_id",
        F.when(F.col("overall") >= 4, 2).when(F.col("overall") > 2, 1).otherwise(0).alias("label"),
        # class 3 is never a label
        F.when(F.col("review_id") % 29 == 7, F.lit(3)).otherwise(bucket(F.concat(F.lit("y"), rid), 3)).alias("prediction"),
        bucket(F.concat(F.lit("z"), rid), 20).alias("score"),
    )


# FIXED VALUES: dependency and tag names as the parser of the rules writes them.
DEPS = ["amod", "advmod", "det", "nsubj", "dobj", "neg", "acomp", "aux", "nsubjpass", "cop", "attr"]
POS = ["ADJ", "NOUN", "VERB", "INTJ"]
TAGS = ["MD", "JJ", "NN"]


def _pick(values: list[str], b: Column) -> Column:
    # the hash behind b is worked out once, not again for each value
    return F.get(F.array(*[F.lit(v) for v in values]), b.cast("int"))


def _pick4(values: list[str], digit: Column) -> Column:
    """``_pick`` of four values by a number of which ``digit`` is the last hexadecimal one."""
    whens = [digit.isin(*"0123456789abcdef"[k::4]) for k in range(4)]
    return F.when(whens[0], values[0]).when(whens[1], values[1]).when(whens[2], values[2]).when(whens[3], values[3])


def tokens(spark: SparkSession, sf_dir: str, by_document: int = False) -> DataFrame:
    """A parsed-token table over every document, whole text.

    Annotations are hashed, not linguistic: they exercise every relation
    and position the aspect rules look at.  ``by_document``: the documents are
    spread by their id before they are cut, so that a grouping of the tokens by
    document needs no shuffle of tokens; as many partitions as the session
    shuffles into (times ``by_document``, where a number is given), not merged
    into fewer, which would not fit a task's memory."""
    d = table(spark, sf_dir, "documents")
    if by_document:
        d = d.select("doc_id", "text").repartition(int(by_document) * int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    w = d.select("doc_id", F.posexplode(F.split(F.col("text"), " ")).alias("i", "w")).filter(F.col("w") != "")
    i = F.col("i")
    # one md5 per token; four 8-hex-digit slices drive the four annotations
    h = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":"), i.cast("string")))
    w = w.select("doc_id", "i", "w", h.alias("h"))

    def part(k: int, n: int) -> Column:
        return F.conv(F.substring(F.col("h"), 8 * k + 1, 8), 16, 10).cast("bigint") % F.lit(n)

    def last(k: int) -> Column:
        # a slice's rest by four is its last digit's
        return F.substring(F.col("h"), 8 * k + 8, 1)
    return w.select(
        "doc_id",
        _p(F.col("doc_id") % 50).alias("asin"),
        i.alias("idx"),
        F.lower(F.col("w")).alias("text"),
        F.when(i % 5 == 0, i).when(i % 5 == 4, i - 1).otherwise(i - i % 5).alias("head_idx"),
        F.when(i % 5 == 0, F.lit("ROOT")).otherwise(_pick(DEPS, part(0, 11))).alias("dep"),
        _pick4(POS, last(1)).alias("pos"),
        _pick(TAGS, part(2, 3)).alias("tag"),
        last(3).isin("0", "4", "8", "c").alias("is_stop"),
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tokens(spark, sf_dir).select("text").distinct()
    return (t.filter(bucket(F.concat(F.lit("k"), F.col("text")), 3) == 0)
             .select(F.col("text").alias("word"),
                     (bucket(F.col("text"), 9) - 4).cast("double").alias("valence")))


def subword_vocabulary(words: DataFrame) -> DataFrame:
    """(piece, id) from the distinct words of a table: beginnings and inner
    parts of up to four characters that stand in three words at least."""
    w = words.select("word").filter(F.length("word") > 0).distinct()
    size, word = F.length("word"), F.col("word")

    def pieces_at(p: Column) -> Column:
        mark = F.when(p > 1, F.lit("##")).otherwise(F.lit(""))
        return F.transform(F.sequence(F.lit(1), F.least(F.lit(4), size - p + 1)), lambda n: F.concat(mark, word.substr(p, n)))

    # a word's own repeats go inside its row: no grouping of (word, piece) rows
    pieces = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), size), pieces_at)))
    kept = w.select(F.explode(pieces).alias("piece")).groupBy("piece").count().filter("count >= 3").select("piece")
    return dense_rank_by(kept, [("piece", True)], name="r").select("piece", (F.col("r") + 3).cast("int").alias("id"))


# Dictionaries of the fixture (inline VALUES in both engines).
EMOJI_MAP = [("é", ":e_acute:"), ("ß", ":sharp_s:"), ("ü", ":u_umlaut:"), ("ñ", ":n_tilde:")]
CONTRACTION_MAP = [("it", "it is"), ("that", "that is"), ("on", "on the"), ("was", "was not")]
LEMMA_MAP = [("is", "v", "be"), ("was", "v", "be"), ("are", "v", "be"), ("as", "n", "a")]
# Fixture negations: the determiner-rule list plus three frequent words so
# the negation branch fires on hashed annotations.
FIXTURE_NEGATIONS = D.NEGATION_WORDS + ["the", "of", "or"]
# Fixture boosters: two defaults plus two frequent words.
FIXTURE_BOOSTERS = [("very", 0.293), ("really", 0.293), ("and", 0.293), ("by", -0.293)]
POS_KEEP_TAGS = ["NN", "NNP", "NNPS", "NNS", "JJ", "JJR", "JJS", "VB", "VBD", "VBG", "VBN", "VBP", "VBZ"]


def emoji_map(spark):
    return values_table(spark, EMOJI_MAP, ["ch", "name"])


def contraction_map(spark):
    return values_table(spark, CONTRACTION_MAP, ["short", "long"])


def lemma_map(spark):
    return values_table(spark, LEMMA_MAP, ["word", "pos", "lemma"])


def negations(spark):
    return values_table(spark, FIXTURE_NEGATIONS, ["word"])


def boosters(spark):
    return values_table(spark, FIXTURE_BOOSTERS, ["word", "scalar"])


def pronouns(spark):
    return values_table(spark, D.PRODUCT_PRONOUNS, ["word"])
