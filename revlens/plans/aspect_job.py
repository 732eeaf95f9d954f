"""The product-aspect job (A12): tokens -> rule pairs -> polarity -> top-5
aspects per product -> flat (asin, aspect, modifier, polarity) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.operators import aspects as A
from revlens.operators import polarity as POL
from revlens.session import materialize, stored

# mentions per page of the aspect -> modifiers map (M2)
MAP_PAGE_SIZE = 1000


def scored(pairs: DataFrame, lexicon: DataFrame, negations_df: DataFrame, boosters: DataFrame,
           scorer=POL.phrase_polarity) -> DataFrame:
    """A11 on materialized pairs: the distinct phrases are scored once and
    joined back to their uses.  ``scorer`` is ``phrase_polarity`` (the core of
    the method) or ``text_polarity`` (all of it)."""
    phrases = pairs.select(F.col("score_phrase").alias("phrase")).filter(F.col("phrase").isNotNull()).distinct()
    # Materialised so that both join inputs are shuffle stages: AQE then
    # broadcasts the phrase table by its measured size, or splits the pair
    # partitions of a very common phrase (skew join).  Left partitioned by
    # phrase from its own window, the join could do neither.
    pol = materialize(scorer(phrases, lexicon, negations_df, boosters))
    return A.score_pairs(pairs, pol)


def scored_aspect_pairs(tokens: DataFrame, lexicon: DataFrame, negations_df: DataFrame, boosters: DataFrame,
                        negation_words: list[str] = D.NEGATION_WORDS, by_document: bool = False) -> DataFrame:
    """A10 + A11.  The pairs feed two consumers (distinct phrases to score,
    and the rows to score), so they are written once to the shared
    checkpoint folder: the token pass runs once and a lost executor does
    not send the job back to the token table."""
    return scored(stored(A.aspect_pairs(tokens, negation_words, by_document=by_document), "pairs"), lexicon, negations_df, boosters)


def product_aspect_table(tokens: DataFrame, lexicon: DataFrame, negations_df: DataFrame, boosters: DataFrame,
                         negation_words: list[str] = D.NEGATION_WORDS, k: int = 5, scorer=POL.phrase_polarity,
                         by_document: bool = False) -> DataFrame:
    """A12.  The top aspects come from the pairs; only the rows are scored."""
    pairs = stored(A.aspect_pairs(tokens, negation_words, by_document=by_document), "pairs")
    top = A.top_aspects(A.aspect_frequency(pairs), k)
    return A.product_aspects(scored(pairs, lexicon, negations_df, boosters, scorer), top)
