"""Connected components of an undirected link table, as joins and groupings.

Rounds of contraction: every node points to its smallest neighbour if that is
smaller, pointers are followed to their roots by doubling, and links between
roots go to the next round.  At least half of the linked nodes that are not
alone disappear in each round, so the number of rounds is logarithmic.  Every
table is a written one; joins have a plain exchange on both sides, which
adaptive execution can split on a hot root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import staged


def _rooted(links: DataFrame) -> DataFrame:
    """node, root: pointers to the smallest neighbour, followed to the end."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    pointers = staged(both.groupBy("node").agg(F.min("other").alias("other"))
                      .select("node", F.least("node", "other").alias("root")), "pointers")
    while True:
        onward = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = staged(pointers.join(onward, "root").select("node", F.col("next").alias("root"),
                                                             (F.col("next") != F.col("root")).alias("moved")), "pointers")
        pointers = jumped.select("node", "root")
        if not jumped.filter("moved").limit(1).count():
            return pointers


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in ``links`` (columns a, b):
    root is the smallest node of its component."""
    links = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), "links")
    result = None
    while True:
        rooted = _rooted(links)
        if result is None:
            result = rooted
        else:
            onward = rooted.select(F.col("node").alias("root"), F.col("root").alias("next"))
            result = staged(result.join(onward, "root", "left")
                            .select("node", F.coalesce("next", "root").alias("root")), "components")
        left = rooted.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = rooted.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = staged(links.join(left, "a").select("ra", "b").join(right, "b").filter("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if not links.limit(1).count():
            return result
