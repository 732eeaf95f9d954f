"""Exact duplicates by content sort.  DataFrame operations only.

Rows are range-partitioned by splitters that Spark samples, sorted so that
equal texts are adjacent, and neighbours are compared in full.  The splitter
key is short and bounded: the first bytes of the text, a 64-bit hash of all
of it, and a salt.  So what sampling sends to the driver never holds whole
texts.  Within one (head, hash, salt) the sort puts equal texts side by side
and the window compares the complete texts.

The salt is 0 unless a first pass over the hashes alone finds more than
HOT_ROWS rows with that hash; such a group is spread by identifier over many
ranges, and its runs of equal texts (one row each) join by SHA-256.  All other
groups are decided where they were sorted, so a text is shuffled once.

Defined results: a null text counts as empty; of equal texts the row with the
largest (or smallest) identifier stays; identical rows, identifier included,
keep exactly one; a null identifier never wins over another one, and a group
of null identifiers only keeps one row with a null ``keep_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import col, staged, table

HEAD = 24  # characters of the text in the splitter key; the hash covers the whole text
HOT_ROWS = 1_024  # rows of one hash above which they are spread ...
SALTS = 65_536  # ... over this many pieces


def runs(docs: DataFrame, text: str, ident: str, carry: list[str], keep: str, normalise, only_first: bool) -> DataFrame:
    """One row per document (or per run of equal texts): ``row`` with the
    carried columns, sha, hot, id, first (is it the run's best row), best and
    size of its run."""
    def content(c: Column) -> Column:
        return F.coalesce(normalise(c) if normalise else c, F.lit(""))

    hashes = docs.select(F.xxhash64(content(col(text))).alias("h"))
    hot = staged(hashes.groupBy("h").count().filter(F.col("count") > HOT_ROWS).select("h", F.lit(True).alias("hot")), "hot")
    cols = list(dict.fromkeys([*carry, text]))  # the text travels once
    rows = docs.select(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(cols)]).alias("all"), col(ident).alias("id"),
                       F.substring(content(col(text)), 1, HEAD).alias("head"), F.xxhash64(content(col(text))).alias("h"))
    # hot has at most rows / HOT_ROWS rows; the planner broadcasts it only below its size threshold
    rows = rows.join(hot, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    rows = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0).cast("int"))
    ranged = rows.repartitionByRange("head", "h", "salt").withColumn("t", content(F.col("all")[f"c{cols.index(text)}"]))
    order = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    equal = Window.partitionBy("head", "h", "salt", "t").orderBy(order)
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = ranged.select("all", "id", "t", "hot", (F.row_number().over(equal) == 1).alias("first"),
                          F.first("id").over(whole).alias("best"), F.count(F.lit(1)).over(whole).alias("size"))
    if only_first:
        found = found.filter("first")
    row = F.struct(*[F.col("all")[f"c{cols.index(c)}"].alias(c) for c in carry])
    return found.select(row.alias("row"), "id", "hot", "first", "best", "size", F.sha2("t", 256).alias("sha"))


def best_of(c: Column, keep: str) -> Column:
    return F.max(c) if keep == "largest" else F.min(c)


def mark(docs: DataFrame, text: str = "text", ident: str = "doc_id", carry: list[str] | None = None,
         keep: str = "largest", normalise=None, only_first: bool = False) -> DataFrame:
    """``row`` and keep_id, group_size, kept, text_sha256 of every document
    (with ``only_first``: of one row per run of equal texts, which includes
    every kept row)."""
    found = staged(runs(docs, text, ident, list(carry or [ident]), keep, normalise, only_first), "copies")
    cold = found.filter("not hot").select("row", F.col("best").alias("keep_id"), F.col("size").alias("group_size"),
                                          F.col("first").alias("kept"), F.col("sha").alias("text_sha256"))
    hot = found.filter("hot")
    groups = staged(hot.filter("first").groupBy("sha").agg(best_of(F.col("best"), keep).alias("keep_id"),
                                                            F.sum("size").alias("group_size")), "copy-groups")
    # rows with a null identifier share one salt, so a group of such rows is one run and keeps one row
    joined = hot.join(groups, "sha").select("row", "keep_id", "group_size",
                                            (F.col("first") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                                            F.col("sha").alias("text_sha256"))
    return cold.unionByName(joined)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays, the size of its group and its digest."""
    docs = table(spark, sf_dir, "documents")
    return mark(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, with its own columns."""
    return mark(docs, carry=docs.columns, only_first=True).filter("kept").select("row.*")


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
