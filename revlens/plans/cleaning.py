"""Review cleaning and labelling (T18 and the minimum slice)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import filters as FL
from revlens.operators import joins as J


def clean_reviews(reviews: DataFrame, meta: DataFrame | None = None, exclude_category: str = "Books",
                  emoji: dict[str, str] | None = None, text_col: str = "review_text",
                  full_chain: bool = False) -> DataFrame:
    """Drop reviews of an excluded category (J1), keep rows with text
    (F1), votes to int (F2), clean the text in one projection, label (F7)."""
    df = reviews
    if meta is not None:
        df = J.exclude_keys(df, FL.category_keys(meta, exclude_category))
    df = FL.with_text(df, text_col)
    clean = T.clean_text_full if full_chain else T.clean_text
    cols = []
    for c in df.columns:
        if c == "vote":
            cols.append(FL.vote_as_int(F.col("vote")).alias("vote"))
        elif c == text_col:
            cols.append(clean(F.col(c), emoji).alias(c))
        else:
            cols.append(F.col(c))
    cols.append(FL.rating_label(F.col("overall")).alias("label"))
    return df.select(*cols)


def label_summary(clean: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Minimum slice output: per label, review count and mean cleaned length."""
    return (clean.groupBy("label")
                 .agg(F.count(F.lit(1)).alias("n_reviews"),
                      F.round(F.avg(F.length(text_col)), 6).alias("avg_len")))
