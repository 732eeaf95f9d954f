"""Preference formatting.  DataFrame operations only.

Input: the turns of chosen and rejected conversations in long form (pair,
side, turn, role, text).  The longest common prefix of the two turn lists is
rendered once as the prompt; what follows on each side is rendered as that
side's completion, with the character ranges that the loss is taken on (the
contents of assistant turns, end mark included).

No pair is gathered in one task.  Turns get their positions from
range-partitioned running counts, the two sides meet by (pair, position), the
prompt ends before the smallest position at which they differ, and the result
comes in pages of at most PAGE_TURNS turns of prompt and of each completion.

Defined results: turns are ordered by (turn, role, text), nulls first; equal
turns have equal role and text, nulls equal to nulls; a null role is written
as ``unknown`` and a null text as empty; turns without a pair identifier form
the pair null; a pair with one side only has an empty completion on the other
and its whole common prefix is empty; identical sides give a prompt and two
empty completions.  One pair of up to PAGE_TURNS turns is one row; a longer one
has a row for each page, whose ranges count from the page's first character;
``whole_pairs`` (the registered query) puts the pages of a pair together again.
Sides other than ``chosen`` and ``rejected`` count as neither; a pair without
turns of either has one row of empty texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import col, staged, table
from revlens.operators.ordered import dense_rank_by, null_safe_join

PAGE_TURNS = 256
# fixed values: the marks around a turn
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit(MIDDLE),
                    F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def masks(turns: Column) -> Column:
    """``begin-end`` character ranges of the assistant contents of rendered turns, joined by ``;``."""
    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(rendered(turn)) - F.length(F.coalesce(turn["text"], F.lit(""))) - len(CLOSE)
        end = state["at"] + F.length(rendered(turn)) - 1  # the line feed after the end mark is not learned
        here = F.when(turn["role"].eqNullSafe("assistant"),
                      F.array(F.concat(begin.cast("string"), F.lit("-"), end.cast("string")))) \
            .otherwise(F.array().cast("array<string>"))
        return F.struct((state["at"] + F.length(rendered(turn))).alias("at"), F.concat(state["spans"], here).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, start, add, lambda s: s["spans"]), ";")


def with_positions(turns: DataFrame, group: list[str]) -> DataFrame:
    """Add ``k``, the position from 1 of a turn within its group by (turn, role, text)."""
    numbered = turns.withColumn("__row", F.monotonically_increasing_id())  # so that many equal turns spread over ranges
    order = [(name, True) for name in ("turn", "role", "text", "__row")]
    return dense_rank_by(numbered, order, "k", partition_by=group).drop("__row")


def format_pairs(turns: DataFrame, pair: str = "pair_id", side: str = "side", turn: str = "turn", role: str = "role",
                 text: str = "text", page_turns: int = PAGE_TURNS) -> DataFrame:
    """pair_id, page (from 0), n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask of every pair."""
    plain = turns.select(col(pair).alias("pair_id"), F.when(col(side).isin("chosen", "rejected"), col(side)).alias("side"),
                         col(turn).alias("turn"), col(role).alias("role"), col(text).alias("text"))
    return of_placed(with_positions(plain, ["pair_id", "side"]), page_turns)


def of_placed(placed: DataFrame, page_turns: int = PAGE_TURNS) -> DataFrame:
    """``format_pairs`` of turns (pair_id, side, k, role, text) that know their positions."""
    one = F.struct("role", "text")
    keys = placed.withColumn("k", F.when(F.col("side").isNotNull(), F.col("k")))  # a turn of neither side only names its pair
    both = staged(keys.groupBy("pair_id", "k").agg(F.max(F.when(F.col("side") == "chosen", one)).alias("c"),
                                                   F.max(F.when(F.col("side") == "rejected", one)).alias("r")), "chat-aligned")
    same = F.col("c").isNotNull() & F.col("r").isNotNull() & F.col("c.role").eqNullSafe(F.col("r.role")) \
        & F.col("c.text").eqNullSafe(F.col("r.text"))
    cuts = staged(both.groupBy("pair_id").agg(F.coalesce(F.min(F.when(~same, F.col("k"))) - 1, F.max("k"), F.lit(0)).alias("n")), "chat-cuts")
    cut = null_safe_join(both, cuts, ["pair_id"])
    shared = F.col("k") <= F.col("n")
    first = F.when(shared, F.lit(1)).otherwise(F.col("n") + 1)  # of the section the turn is in
    rows = cut.withColumn("page", F.coalesce(F.floor((F.col("k") - first) / page_turns), F.lit(0)).cast("long"))

    def listed(which: Column, name: str) -> Column:
        got = F.collect_list(F.when(which & F.col(name).isNotNull(),
                                    F.struct("k", F.col(f"{name}.role").alias("role"), F.col(f"{name}.text").alias("text"))))
        return F.sort_array(got)

    pages = rows.groupBy("pair_id", "page", F.col("n").alias("n_prompt_turns")).agg(
        listed(shared, "c").alias("p"), listed(~shared, "c").alias("c"), listed(~shared, "r").alias("r"))
    render = lambda name: F.array_join(F.transform(name, rendered), "")
    return pages.select("pair_id", "page", F.col("n_prompt_turns").cast("long"), render("p").alias("prompt"), render("c").alias("chosen"),
                        render("r").alias("rejected"), masks(F.col("c")).alias("chosen_mask"), masks(F.col("r")).alias("rejected_mask"))


def whole_pairs(pages: DataFrame) -> DataFrame:
    """One row per pair from the pages of ``format_pairs``: whole texts, and ranges that count from the
    beginning of the whole completion.  A pair's pages meet, not its turns."""
    names = ("prompt", "chosen", "rejected")
    p = pages.groupBy("pair_id", "n_prompt_turns").agg(
        F.sort_array(F.collect_list(F.struct("page", *names, "chosen_mask", "rejected_mask"))).alias("p"))

    def mask(name: str) -> Column:
        def moved(spans: Column, at: Column) -> Column:
            ends = F.transform(F.split(spans, "-"), lambda x: (x.cast("int") + at).cast("string"))
            return F.array_join(ends, "-")

        def add(state: Column, page: Column) -> Column:
            here = F.transform(F.filter(F.split(page[f"{name}_mask"], ";"), lambda x: x != ""), lambda x: moved(x, state["at"]))
            return F.struct((state["at"] + F.length(page[name])).alias("at"), F.concat(state["spans"], here).alias("spans"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
        long = F.array_join(F.aggregate("p", start, add, lambda s: s["spans"]), ";")
        return F.when(F.size("p") == 1, F.col("p")[0][f"{name}_mask"]).otherwise(long).alias(f"{name}_mask")

    text = lambda name: F.array_join(F.transform("p", lambda x: x[name]), "").alias(name)
    return p.select("pair_id", "n_prompt_turns", *map(text, names), mask("chosen"), mask("rejected"))


def preference_turns(conversations: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations (pair_id, side, k, role, text):
    chosen is the conversation itself; rejected has, instead of each last
    assistant turn's text, the text of the turn before it (an answer that
    echoes), and stops there.  Both sides keep the conversation's positions."""
    placed = staged(with_positions(conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text"), ["pair_id"])
                    .drop("turn"), "chat-placed")
    lasts = placed.groupBy("pair_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("k"))).alias("last_k"))
    # a second row per conversation at most: the turn before its last answer
    before = placed.select("pair_id", (F.col("k") + 1).alias("last_k"), F.col("text").alias("echo"))
    echoes = staged(null_safe_join(lasts, before, ["pair_id", "last_k"], "left"), "chat-echoes")
    known = null_safe_join(placed, echoes, ["pair_id"])
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
                    F.struct(F.lit("rejected").alias("side"),
                             F.when(F.col("k") == F.col("last_k"), F.col("echo")).otherwise(F.col("text")).alias("text")))
    kept = F.filter(sides, lambda s: (s["side"] == "chosen") | F.col("last_k").isNull() | (F.col("k") <= F.col("last_k")))
    return known.select("pair_id", "k", "role", F.explode(kept).alias("s")).select("pair_id", "s.side", "k", "role", "s.text")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every conversation's preference pair, one row each."""
    return whole_pairs(of_placed(preference_turns(table(spark, sf_dir, "conversations"))))


ORACLE = """
WITH placed AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER w AS k, lag(text) OVER w AS echo,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
lasts AS (SELECT *, max(CASE WHEN role = 'assistant' THEN k END) OVER (PARTITION BY conv_id) AS last_k FROM placed),
r AS (SELECT *, CASE WHEN k = last_k THEN echo ELSE text END AS rtext,
             last_k IS NULL OR k <= last_k AS in_r FROM lasts),
-- the sides part at the echo unless it equals the answer; then at the first turn the rejected side lacks
p AS (SELECT *, min(CASE WHEN NOT in_r OR rtext IS DISTINCT FROM text THEN k END) OVER (PARTITION BY conv_id) AS part FROM r),
s AS (SELECT *, coalesce(k < part, true) AS shared,
             '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head,
             coalesce(text, '') AS ct, coalesce(rtext, '') AS rt, '<|end|>' || chr(10) AS tail FROM p),
o AS (SELECT *, coalesce(sum(CASE WHEN NOT shared THEN length(head || ct || tail) END) OVER v, 0) AS cat,
             coalesce(sum(CASE WHEN NOT shared AND in_r THEN length(head || rt || tail) END) OVER v, 0) AS rat
      FROM s WINDOW v AS (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id AS pair_id, count(*) FILTER (shared) AS n_prompt_turns,
       coalesce(string_agg(head || ct || tail, '' ORDER BY k) FILTER (shared), '') AS prompt,
       coalesce(string_agg(head || ct || tail, '' ORDER BY k) FILTER (NOT shared), '') AS chosen,
       coalesce(string_agg(head || rt || tail, '' ORDER BY k) FILTER (NOT shared AND in_r), '') AS rejected,
       coalesce(string_agg(CAST(cat + length(head) AS BIGINT) || '-' || CAST(cat + length(head) + length(ct) + 7 AS BIGINT), ';' ORDER BY k)
                FILTER (NOT shared AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(CAST(rat + length(head) AS BIGINT) || '-' || CAST(rat + length(head) + length(rt) + 7 AS BIGINT), ';' ORDER BY k)
                FILTER (NOT shared AND in_r AND role = 'assistant'), '') AS rejected_mask
FROM o GROUP BY conv_id
"""
