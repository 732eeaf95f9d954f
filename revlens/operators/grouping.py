"""Per-product review lists (G1, re-aimed).

The original job collects every review text of a product into one row;
a product may hold a third of all reviews, so here the list stays in
long form: one row per review with its position in the product's
ordered list.  Positions come from range-partitioned running counts, so
a hot product is spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ordered import dense_rank_by, running_sums
from revlens.session import materialize


def reviews_per_product(df: DataFrame, product: str = "asin", order_key: str = "review_id",
                        text: str = "review_text") -> DataFrame:
    """(product, pos, order_key, text) for every non-null text, pos 1-based
    in ``order_key`` order within the product."""
    rows = df.filter(F.col(text).isNotNull()).select(product, order_key, text)
    ranked = dense_rank_by(rows, [(order_key, True)], name="pos", partition_by=[product])
    return ranked.select(product, F.col("pos").cast("int").alias("pos"), order_key, text)


def _ckpt(df: DataFrame) -> DataFrame:
    return materialize(df)


def greedy_chunks(df: DataFrame, limit: int = 1_000_000, product: str = "asin", order_key: str = "review_id",
                  text: str = "review_text", block_reviews: int = 65536) -> DataFrame:
    """Per product, reviews in ``order_key`` order are appended to a
    chunk while the chunk's character sum (joining spaces not counted)
    stays within ``limit``; a review that would pass it starts a new chunk.
    A first review longer than ``limit`` leaves an empty chunk 0 before it.
    Output: (product, chunk, n_reviews, text) with texts joined by spaces.

    Exact and distributed.  With P the prefix sum of lengths, the chunk
    starting at review s ends before next(s) = max(s+1, first j with
    P(j) > P(s-1) + limit); that j is found by an equi-join on
    character-offset buckets of width ``limit``.  The chain of chunk
    starts from the first review is then recovered block-wise (see
    ``_chain_starts``).  No step gathers a product in one task; a block of
    ``block_reviews`` positions and a chunk (at most ``limit`` characters,
    or one long review) are the only groups collected.

    Every row has a key of its own, so ``order_key`` may repeat or be null
    (nulls first; equal keys in the order of their texts' hashes)."""
    spark = df.sparkSession
    # every join below is on the product: a null product gets a key of its own
    kind = df.schema[product].dataType
    keyed = F.when(F.col(product).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(product).cast("string")))
    # read for the lengths and for the texts: written once, so that the row keys stay.  The null filter
    # stands above the row keys: below them it would work out the whole text expression a second time
    rows = _ckpt(df.select(keyed.alias(product), order_key, text, F.monotonically_increasing_id().alias("row"))
                   .filter(F.col(text).isNotNull()))
    skel_in = rows.select(product, order_key, "row", F.xxhash64(text).alias("h"), F.length(text).cast("long").alias("len"),
                          F.lit(1).alias("one"))
    skel = running_sums(skel_in, [(order_key, True), ("h", True), ("row", True)], ["one", "len"], partition_by=[product])
    skel = _ckpt(skel.select(product, "row", "len", F.col("cum_one").alias("pos"), F.col("cum_len").alias("P"))
                     .withColumn("P0", F.col("P") - F.col("len")))
    # per-product sizes are joined back to per-review rows: materialised so
    # AQE can broadcast them by measured size or split a hot product's rows
    sizes = _ckpt(skel.groupBy(product).agg(F.max("pos").alias("n"),
                                            F.max(F.when(F.col("pos") == 1, F.col("len") > limit)).alias("first_long")))
    # next chunk start of every review (as if it started a chunk)
    cover = (skel.filter(F.col("len") > 0)
                 .select(product, F.col("pos").alias("j"), F.col("P0").alias("jp0"), F.col("P").alias("jp"),
                         F.explode(F.sequence(F.floor(F.col("P0") / limit), F.floor((F.col("P") - 1) / limit)))
                          .alias("bucket")))
    tgt = skel.select(product, F.col("pos").alias("s"), (F.col("P0") + limit).alias("T"),
                      F.floor((F.col("P0") + limit) / limit).alias("bucket"))
    hit = tgt.join(cover, [tgt[product] == cover[product], tgt["bucket"] == cover["bucket"],
                           cover["jp0"] <= tgt["T"], tgt["T"] < cover["jp"]], "left") \
             .select(tgt[product].alias(product), "s", "j")
    succ = (hit.join(sizes, product)
               .select(product, "s",
                       # no review holds the cut-off offset: the chain ends (greatest() skips nulls)
                       F.when(F.col("j").isNull(), F.col("n") + 1)
                        .otherwise(F.greatest(F.col("s") + 1, F.col("j"))).alias("nxt"),
                       "n"))
    starts = _chain_starts(spark, succ, sizes, product, block_reviews)
    # chunk number of every review: chunk starts up to its position
    marked = (skel.join(starts.select(product, F.col("s").alias("pos"), F.lit(1).alias("is_start")),
                        [product, "pos"], "left")
                  .select(product, "row", "pos", F.coalesce("is_start", F.lit(0)).alias("is_start")))
    numbered = running_sums(marked, [("pos", True)], ["is_start"], partition_by=[product])
    numbered = numbered.join(sizes.select(product, "first_long"), product).select(
        "row", "pos",
        (F.col("cum_is_start") - 1 + F.when(F.col("first_long"), 1).otherwise(0)).cast("int").alias("chunk"))
    full = (rows.join(numbered, "row")
                .groupBy(product, "chunk")
                .agg(F.count(F.lit(1)).alias("n_reviews"),
                     F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", text))), lambda x: x[text]),
                                  " ").alias("text")))
    empty = sizes.filter(F.col("first_long")).select(product, F.lit(0).alias("chunk"),
                                                      F.lit(0).cast("long").alias("n_reviews"), F.lit("").alias("text"))
    back = F.when(F.col(product) != "n", F.expr(f"substring(`{product}`, 2)")).cast(kind)
    return full.unionByName(empty).withColumn(product, back)


_EXIT_SCHEMA = "prod string, e long, x long"
_START_SCHEMA = "prod string, s long"


def _kernels():
    """The two per-block kernels, defined as closures so that they are
    shipped to the Python workers by value: a worker does not need this
    package on its path."""
    import numpy as np
    import pandas as pd

    def block_exits(pdf):
        """For every entry node of the block, the first chain node outside
        it (vectorised pointer jumping over the block's successor array)."""
        pdf = pdf.sort_values("s")
        pos = pdf["s"].to_numpy(np.int64)
        nxt = pdf["nxt"].to_numpy(np.int64)
        first, end = pos[0], pos[-1] + 1
        jump = nxt.copy()
        for _ in range(max(1, int(len(pos)).bit_length()) + 1):
            inside = jump < end
            if not inside.any():
                break
            jump = np.where(inside, jump[np.clip(jump - first, 0, len(pos) - 1)], jump)
        ent = pdf["is_entry"].to_numpy(bool)
        return pd.DataFrame({"prod": pd.Series(pdf["prod"].to_numpy()[ent], dtype=object),
                             "e": pos[ent], "x": jump[ent]})

    def block_starts(pdf):
        """Chain nodes of an entered block, from its actual entry while inside."""
        pdf = pdf.sort_values("s")
        pos = pdf["s"].to_numpy(np.int64)
        nxt = pdf["nxt"].to_numpy(np.int64)
        first, end = pos[0], pos[-1] + 1
        out = []
        for e in pdf.loc[pdf["entry"], "s"].to_numpy(np.int64):
            x = e
            while x < end:
                out.append(x)
                x = nxt[x - first]
        return pd.DataFrame({"prod": pd.Series([pdf["prod"].iloc[0]] * len(out), dtype=object),
                             "s": np.asarray(out, dtype=np.int64)})

    return block_exits, block_starts


def _chain_starts(spark, succ: DataFrame, sizes: DataFrame, product: str, block_reviews: int) -> DataFrame:
    """Chunk starts = the chain 1 -> next(1) -> ... per product.

    Positions are cut into blocks of ``block_reviews``.  A block can only be
    entered at review 1 or at the target of a successor edge from an
    earlier block; a per-block kernel maps each such entry to the first
    chain node past the block.  Pointer doubling then runs over entries
    only (log2(blocks) rounds of joins, each checkpointed), and a second
    per-block kernel lists the chain inside every block actually entered."""
    R = block_reviews
    nodes = succ.select(F.col(product).alias("prod"), "s", "nxt", "n",
                        F.floor((F.col("s") - 1) / R).alias("blk"))
    cross = (nodes.filter((F.floor((F.col("nxt") - 1) / R) > F.col("blk")) & (F.col("nxt") <= F.col("n")))
                  .select("prod", F.col("nxt").alias("s"), F.lit(True).alias("is_entry")))
    entries = cross.unionByName(nodes.filter(F.col("s") == 1).select("prod", "s", F.lit(True).alias("is_entry"))) \
                   .dropDuplicates(["prod", "s"])
    flagged = _ckpt(nodes.join(entries, ["prod", "s"], "left")
                         .withColumn("is_entry", F.coalesce("is_entry", F.lit(False))))
    block_exits, block_starts = _kernels()
    exits = _ckpt(flagged.select("prod", "blk", "s", "nxt", "is_entry")
                         .groupBy("prod", "blk").applyInPandas(block_exits, _EXIT_SCHEMA))
    nmax = sizes.select(F.col(product).alias("prod"), "n")
    # doubling over the entry graph e -> x (x is an entry of a later block or n + 1)
    level = _ckpt(exits.join(nmax, "prod"))
    levels = [level]
    max_blocks = (sizes.agg(F.max("n")).first()[0] or 0) // R + 1
    for _ in range(1, max(1, int(max_blocks).bit_length())):
        a, b = levels[-1].alias("a"), levels[-1].alias("b")
        nxt_level = (a.join(b, (F.col("a.prod") == F.col("b.prod")) & (F.col("a.x") == F.col("b.e")), "left")
                      .select(F.col("a.prod").alias("prod"), F.col("a.e").alias("e"),
                              F.coalesce(F.col("b.x"), F.col("a.x")).alias("x"), F.col("a.n").alias("n")))
        levels.append(_ckpt(nxt_level))
    reached = nmax.select("prod", F.lit(1).cast("long").alias("e"), "n")
    for lv in reversed(levels):
        step = reached.join(lv.select("prod", "e", "x"), ["prod", "e"]).select("prod", F.col("x").alias("e"), "n")
        reached = _ckpt(reached.unionByName(step.filter(F.col("e") <= F.col("n"))).dropDuplicates(["prod", "e"]))
    blocks = flagged.join(reached.select("prod", F.col("e").alias("s"), F.lit(True).alias("entry")), ["prod", "s"],
                          "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    starts = blocks.select("prod", "blk", "s", "nxt", "entry").groupBy("prod", "blk") \
                   .applyInPandas(block_starts, _START_SCHEMA)
    return starts.select(F.col("prod").alias(product), "s")
