"""Training-corpus pipeline: language, exact copies, near copies, benchmark
passages, tokens.  Every stage reads what its predecessor kept, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.llm import bpe, decontaminate, exact_dedup, language_id, simhash
from revlens.llm.common import staged, table

STAGES = [
    ("language_id", language_id.stage),
    ("exact_dedup", exact_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("decontaminate", decontaminate.stage),
    ("bpe", bpe.stage),
]

#: Language ID, SimHash and BPE have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = staged(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
