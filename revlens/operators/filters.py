"""Row filters and simple projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.operators.ordered import dense_rank_by


def with_text(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """keep rows that have review text."""
    return df.filter(F.col(text_col).isNotNull())


def vote_as_int(vote: Column, drop_commas: bool = False) -> Column:
    """null votes count as "0"; unparsable strings ("1,234") become null
    instead of failing under ANSI mode (set ``drop_commas`` to read them)."""
    v = F.coalesce(vote, F.lit("0"))
    if drop_commas:
        v = F.regexp_replace(v, ",", "")
    return v.try_cast("int")


def min_votes(df: DataFrame, n: int = 5, vote_col: str = "vote") -> DataFrame:
    """reviews with at least ``n`` helpful votes."""
    return df.filter(vote_as_int(F.col(vote_col)) >= n)


def rating_label(overall: Column, positive: float = D.POSITIVE_THRESHOLD,
                 negative: float = D.NEGATIVE_THRESHOLD, null_ratings: bool = True) -> Column:
    """rating -> 2.0 positive (>= 4), 1.0 neutral (> 2), else 0.0.
    A null rating falls through to 0.0, as in the original rule; without
    ``null_ratings`` it has no label (null), so that such rows can be dropped."""
    if not null_ratings:
        return F.when(overall.isNotNull(), rating_label(overall, positive, negative))
    return (F.when(overall >= positive, F.lit(2.0))
             .when(overall > negative, F.lit(1.0))
             .otherwise(F.lit(0.0)))


def category_keys(meta: DataFrame, category: str = "Books", cat_col: str = "main_cat",
                  key: str = "asin") -> DataFrame:
    """keys of products in one category."""
    return meta.filter(F.col(cat_col) == category).select(key)


def surrogate_id(df: DataFrame, key_cols: list[str], name: str = "uid") -> DataFrame:
    """a row id that does not depend on partitioning: 60 bits of the md5
    of the business key (instead of monotonically_increasing_id)."""
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key_cols])
    return df.withColumn(name, F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint"))


def unique_row_id(df: DataFrame, key_cols: list[str], name: str = "uid") -> DataFrame:
    """F13 with an id per row: 1, 2, ... in the order of the key's md5, then the
    key.  It does not depend on partitioning, repeated keys get neighbouring
    ids, and no hash can collide.  Range-partitioned running counts."""
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key_cols])
    keyed = df.withColumn("__md5", F.md5(key)).withColumn("__key", key)
    return dense_rank_by(keyed, [("__md5", True), ("__key", True)], name=name).drop("__md5", "__key")


def preview(df: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    """first ``n`` rows under an explicit order (top-k, not a sample)."""
    return df.orderBy(*order_cols).limit(n)


def json_keyword_filter(lines: DataFrame, keywords: list[str], value_col: str = "value") -> DataFrame:
    """keep JSON lines whose re-serialised record contains any keyword
    (case-sensitive; keys or values).  Undecodable lines are dropped here
    and routed by ``json_rejects``."""
    # one parse per line: a line that does not parse re-serialises to null,
    # which fails the match; keywords are matched literally (\Q...\E)
    pattern = "|".join("\\Q" + k.replace("\\E", "\\E\\\\E\\Q") + "\\E" for k in keywords)
    return lines.filter(F.to_json(F.try_parse_json(F.col(value_col))).rlike(pattern))


def json_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """lines that are not one valid JSON value."""
    return lines.filter(F.try_parse_json(F.col(value_col)).isNull())
