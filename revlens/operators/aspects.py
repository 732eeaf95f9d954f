"""Aspect extraction over a parsed-token table.

Input: one row per token ``(doc_id, asin, idx, text, head_idx, dep, pos,
tag, is_stop)``.  A token's *children* are the tokens whose ``head_idx``
points at it (a token is never its own child).  Each token is emitted once
as itself and, if a rule reads it there, once as a child of its head; a
window over ``(doc_id, asin, token)`` sees a head together with these
children and finds the pairs.  What stands before an adverbial or
adjectival modifier is a child of the modifier, not of the head: the pairs
and the ``advmod`` tokens, few of all, meet in a second window.  "The last
matching child wins" is ``max_by(text, idx)``, "the first" is
``min_by(text, idx)``.  The only exchange is keyed by document, never by
product, so a popular product does not concentrate work in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens import dictionaries as D


def effective_stop(tokens: DataFrame, pronouns: list[str] = D.PRODUCT_PRONOUNS) -> DataFrame:
    """Pronouns never count as stop words (they become "product")."""
    return tokens.withColumn("is_stop", F.col("is_stop") & ~F.col("text").isin(pronouns))


def _aspect(a: Column, pronouns: list[str]) -> Column:
    """Product pronouns become "product"."""
    return F.when(a.isin(pronouns), F.lit("product")).otherwise(a)


def _prefixed(prefix: Column, m: Column) -> Column:
    return F.when(prefix.isNotNull(), F.concat(prefix, F.lit(" "), m)).otherwise(m)


# What a row of the window is: a token as itself (below 0; an interjection, and
# a modifier that is its own head, are told apart), or a child that a rule reads.
SELF, SELF_INTJ, SELF_AMOD, SELF_AMOD_INTJ = -1, -2, -3, -4
(AMOD, DET_NEG, NSUBJ, NSUBJPASS, DOBJ_ADJ, NEG, ACOMP, MODAL, ADVMOD, ADVMOD_STOP, COP, ATTR) = range(1, 13)


def _child_kind(negations: list[str]) -> Column:
    """What a token is to its head, null where no rule reads it."""
    dep, ns = F.col("dep"), ~F.col("is_stop")
    return (F.when((dep == "amod") & ns, AMOD)
             .when((dep == "det") & F.col("text").isin(negations), DET_NEG)
             .when((dep == "nsubj") & ns, NSUBJ).when((dep == "nsubjpass") & ns, NSUBJPASS)
             .when((dep == "dobj") & (F.col("pos") == "ADJ") & ns, DOBJ_ADJ)
             .when(dep == "neg", NEG).when((dep == "acomp") & ns, ACOMP)
             .when((dep == "aux") & (F.col("tag") == "MD"), MODAL)
             .when((dep == "advmod") & ns, ADVMOD).when(dep == "advmod", ADVMOD_STOP)
             .when((dep == "cop") & ns, COP).when((dep == "attr") & ns, ATTR))


def _roles(tokens: DataFrame, negations: list[str]) -> DataFrame:
    """Each token once as itself (key = idx) and once as a child of its head
    (key = head_idx, where a rule reads it); a Generate, so the input's
    partitioning by doc_id is kept and the windows need no shuffle.  A token
    without a place is nobody's head or child."""
    t = tokens.filter(F.col("idx").isNotNull()).select(
        "doc_id", "asin", "idx", "text", "head_idx", _child_kind(negations).alias("kind"),
        F.coalesce((F.col("pos") == "INTJ") & ~F.col("is_stop"), F.lit(False)).alias("intj"))
    own = F.col("idx") == F.col("head_idx")
    me = F.when(own & (F.col("kind") == AMOD), F.when(F.col("intj"), SELF_AMOD_INTJ).otherwise(SELF_AMOD)) \
        .when(F.col("intj"), SELF_INTJ).otherwise(SELF)
    roles = F.array(F.struct(F.col("idx").alias("key"), me.alias("kind")),
                    F.when(F.col("kind").isNotNull() & ~own, F.struct(F.col("head_idx").alias("key"), F.col("kind").alias("kind"))))
    return (t.select("doc_id", "asin", "idx", "text", F.explode(roles).alias("r")).filter(F.col("r").isNotNull())
             .select("doc_id", "asin", "r.key", "r.kind", "idx", "text"))


# With no order the frame is the whole group, so each aggregate is computed
# once per group.  Windows beat a grouped aggregate here: keys are nearly
# unique, so a partial + final aggregation would only double the work.
def _group(key: str):
    return Window.partitionBy("doc_id", "asin", key)


def _last(value: Column, *kinds: int) -> Column:
    # rows without a place are passed over, so the value needs no condition
    return F.max_by(value, F.when(F.col("kind").isin(*kinds), F.col("idx"))).over(_group("key"))


def head_view(tokens: DataFrame, negations: list[str]) -> DataFrame:
    """Every row of ``_roles`` that yields a pair or is an ``advmod``, with the
    head's text and, over the head's children, what each rule reads ("last
    wins" = max_by idx)."""
    text, kind = F.col("text"), F.col("kind")
    # sorted before, not by, the window: what its functions read would be in the sorted rows
    rows = _roles(tokens, negations).sortWithinPartitions("doc_id", "asin", "key")
    # most heads have neither a subject (2) nor a modifier (1): no rule finds anything there
    amods = kind.isin(AMOD, SELF_AMOD, SELF_AMOD_INTJ)
    use = F.max(F.when(kind.isin(NSUBJ, NSUBJPASS), 2).when(amods, 1)).over(_group("key"))
    rows = rows.withColumn("use", use).filter(
        (F.col("use") == 2) | ((F.col("use") == 1) & ((kind < 0) | kind.isin(AMOD, DET_NEG))) | kind.isin(ADVMOD, ADVMOD_STOP)).drop("use")
    v = rows.select(
        "doc_id", "asin", "key", "kind", "idx", "text",
        F.max(F.when(kind < 0, text)).over(_group("key")).alias("h_text"),
        _last(text, NSUBJ).alias("nsubj"),
        _last(text, NSUBJ, NSUBJPASS).alias("nsubj_any"),
        _last(text, DOBJ_ADJ).alias("dobj_adj"),
        _last(text, NEG).alias("neg"),
        _last(text, ACOMP).alias("acomp"),
        _last(F.when(kind == NEG, text).otherwise(F.lit("not")), MODAL, NEG).alias("pfx_modal"),
        _last(text, ADVMOD).alias("advmod"),
        F.max(F.when(kind == ADVMOD, F.col("idx"))).over(_group("key")).alias("advmod_idx"),
        _last(text, COP).alias("cop"),
        _last(text, ATTR).alias("attr"),
        F.max(kind == DET_NEG).over(_group("key")).alias("det_neg"),
    )
    return v.filter(kind.isin(ADVMOD, ADVMOD_STOP)
                    | (amods & F.col("h_text").isNotNull())
                    | ((kind < 0) & (F.col("nsubj").isNotNull() | F.col("nsubj_any").isNotNull())))


def aspect_pairs(tokens: DataFrame, negations: list[str] = D.NEGATION_WORDS,
                 pronouns: list[str] = D.PRODUCT_PRONOUNS, rule5_scores_token: bool = False,
                 by_document: bool = False) -> DataFrame:
    """A1-A7 + A10: every (aspect, modifier) pair with its rule and the
    emitting token; ``score_phrase`` is the phrase whose polarity the pair
    carries (rule 5 scores rule 4's modifier of the same token, null when
    rule 4 found none; with ``rule5_scores_token`` its own token).

    One exchange: tokens are hash-partitioned by document, then two
    windows keyed by (doc_id, asin, token) reuse that partitioning.
    ``by_document``: the tokens are spread by document already, none is
    shuffled.  Tokens without a document take no part: nothing tells whose
    they are."""
    t = (effective_stop(tokens.filter(F.col("doc_id").isNotNull()), pronouns)
         .select("doc_id", "asin", "idx", "text", "head_idx", "dep", "pos", "tag", "is_stop"))
    hv = head_view(t if by_document else t.repartition("doc_id"), negations)

    kind, text, nsubj = F.col("kind"), F.col("text"), F.col("nsubj")
    m2 = _prefixed(F.col("neg"), F.col("dobj_adj"))
    m3 = _prefixed(F.col("pfx_modal"), F.col("acomp"))
    m7 = _prefixed(F.col("neg"), F.col("attr"))
    none = F.lit(None).cast("string")

    def found(rule: int, when: Column, aspect: Column, modifier: Column, at: Column = F.col("idx"), lead: Column = none,
              base: Column = none) -> Column:
        """A pair; one with a ``base`` gets the first advmod child of the token ``at`` put before it."""
        return F.when(when, F.struct(F.lit(rule).alias("rule"), aspect.alias("aspect"), modifier.alias("modifier"),
                                     at.alias("at"), lead.alias("lead"), base.alias("base")))

    me = kind < 0
    amod = kind.isin(AMOD, SELF_AMOD, SELF_AMOD_INTJ) & F.col("h_text").isNotNull()
    adv = {"at": F.col("advmod_idx"), "lead": F.col("neg"), "base": F.col("advmod")}
    structs = [
        # Rule 1: a non-stop amod token (seen as its head's child, or as its own
        # head) -> (head, [not] [first advmod child] token)
        found(1, amod, F.col("h_text"), none, F.col("idx"), F.when(F.col("det_neg"), F.lit("not")), text),
        found(2, me & nsubj.isNotNull() & m2.isNotNull(), nsubj, m2),
        found(3, me & nsubj.isNotNull() & m3.isNotNull(), nsubj, m3),
        found(4, me & F.col("nsubj_any").isNotNull() & F.col("advmod").isNotNull(), F.col("nsubj_any"), none, **adv),
        found(5, me & nsubj.isNotNull() & F.col("cop").isNotNull() & text.isNotNull(), nsubj, text,
              **({} if rule5_scores_token else {**adv, "at": F.coalesce("advmod_idx", "idx")})),
        found(6, kind.isin(SELF_INTJ, SELF_AMOD_INTJ) & nsubj.isNotNull() & text.isNotNull(), nsubj, text),
        found(7, me & nsubj.isNotNull() & m7.isNotNull(), nsubj, m7),
        # no pair: an advmod token, a child of the token ``at``
        found(0, kind.isin(ADVMOD, ADVMOD_STOP), none, none, F.col("key"), none, text),
    ]
    p = (hv.select("doc_id", "asin", "idx", F.explode(F.array(*structs)).alias("p")).filter(F.col("p").isNotNull())
           .select("doc_id", "asin", "idx", "p.*"))
    rule, is_adv = F.col("rule"), F.col("rule") == 0
    first = F.min_by(F.col("base"), F.when(is_adv, F.col("idx"))).over(_group("at"))
    p = p.sortWithinPartitions("doc_id", "asin", "at").withColumn("first_adv", first).filter(~is_adv)
    whole = F.when(rule == 1, F.concat_ws(" ", "lead", "first_adv", "base")) \
        .otherwise(_prefixed(F.col("lead"), _prefixed(F.col("first_adv"), F.col("base"))))
    scored_whole = [1, 4] if rule5_scores_token else [1, 4, 5]
    return p.select("doc_id", "asin", "rule", "idx", _aspect(F.col("aspect"), pronouns).alias("aspect"),
                    F.when(rule.isin(1, 4), whole).otherwise(F.col("modifier")).alias("modifier"),
                    F.when(rule.isin(*scored_whole), whole).otherwise(F.col("modifier")).alias("score_phrase"))


def score_pairs(pairs: DataFrame, polarity: DataFrame) -> DataFrame:
    """Attach the polarity of each pair's score phrase (0 when none)."""
    # rows without a phrase are no join key: they would all meet in one partition
    some = (pairs.filter(F.col("score_phrase").isNotNull())
                 .join(polarity.withColumnRenamed("phrase", "score_phrase"), on="score_phrase", how="left")
                 .withColumn("polarity", F.coalesce(F.col("polarity"), F.lit(0.0))).drop("score_phrase"))
    none = pairs.filter(F.col("score_phrase").isNull()).drop("score_phrase").withColumn("polarity", F.lit(0.0))
    return some.unionByName(none)


def aspect_frequency(pairs: DataFrame) -> DataFrame:
    """Mentions per (product, aspect) and the first mention's position
    (rule, doc, token) - the tie-break of the original insertion order."""
    return pairs.groupBy("asin", "aspect").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.min(F.struct("rule", "doc_id", "idx")).alias("first_seen"))


def top_aspects(freq: DataFrame, k: int = 5) -> DataFrame:
    """K1: the ``k`` most mentioned aspects per product, ties by first
    mention.  ``row_number() <= k`` lets Spark insert a partial
    WindowGroupLimit before the exchange, so at most k rows per product
    and map task are shuffled."""
    w = Window.partitionBy("asin").orderBy(F.col("mentions").desc(), F.col("first_seen").asc())
    return freq.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def product_aspects(scored_pairs: DataFrame, top: DataFrame) -> DataFrame:
    """A12 (+ M3/M4 flattening): one row per mention of a top aspect:
    (asin, aspect, modifier, polarity), rows with nulls dropped."""
    return (scored_pairs.join(top.select("asin", "aspect"), on=["asin", "aspect"], how="inner")
                        .select("asin", "aspect", "modifier", "polarity").dropna())


def aspect_map_pages(scored_pairs: DataFrame, top: DataFrame, page_size: int = 1000) -> DataFrame:
    """M2, bounded: the original builds, per product, a map from each top
    aspect to the list of all its (modifier, polarity) mentions - a list
    that grows with the product's reviews.  Here the list is cut into
    pages of at most ``page_size`` mentions in mention order (rule, doc,
    token): (asin, aspect, part, modifiers, polarities).  Positions come from
    range-partitioned running counts, so a hot aspect spans many tasks."""
    from revlens.operators.ordered import dense_rank_by
    m = scored_pairs.join(top.select("asin", "aspect"), on=["asin", "aspect"], how="inner") \
                    .select("asin", "aspect", "rule", "doc_id", "idx", "modifier", "polarity")
    ranked = dense_rank_by(m, [("rule", True), ("doc_id", True), ("idx", True)], name="pos",
                           partition_by=["asin", "aspect"])
    paged = ranked.withColumn("part", ((F.col("pos") - 1) / page_size).cast("int"))
    item = F.struct("pos", F.col("modifier").alias("adj"), F.col("polarity").alias("polarity"))
    # the (modifier, polarity) list as two aligned arrays
    return (paged.groupBy("asin", "aspect", "part")
                 .agg(F.array_sort(F.collect_list(item)).alias("__m"))
                 .select("asin", "aspect", "part",
                         F.transform("__m", lambda x: x["adj"]).alias("modifiers"),
                         F.transform("__m", lambda x: x["polarity"]).alias("polarities")))
