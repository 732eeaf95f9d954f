"""Language identification by compression.

Each language gets a raw-content zstandard dictionary: excerpts of a bounded
sample of its labelled documents.  A text is cut into blocks, every block is
encoded once per dictionary, and the language whose dictionary gives the
smallest total wins.  Only letters and their word order take part (lower
case, everything else becomes one space).

A text of a few words alone gains nothing from any dictionary (the encoder
stores it raw, and all languages tie).  It is therefore encoded behind several
short leads of each language's sample, which are not in its dictionary, and
its size is what it adds to them.

Defined results: a text that is null or has no letter is ``und`` with score 0
and is rejected; a tie or a margin below ``min_margin`` is still given its
best language (ties go to the language with more training rows, then by
name) but marked ``rejected``; without any labelled row every text is
``und``.  Whole texts are encoded, however long: memory is one batch.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, held_out, map_texts, table

UNKNOWN = "und"

#: The training sample: about SAMPLE_DOCS (at most SAMPLE_DOCS + SALTS) excerpts of EXCERPT_CHARS characters per
#: language, of which DICT_BYTES normalised bytes make the dictionary.  These bounds hold at any input size.
#: Every language that has a labelled text is learned; the driver and each worker hold one dictionary a language.
SAMPLE_DOCS = 384
EXCERPT_CHARS = 1_200
DICT_BYTES = 65_536
SALTS = 64
#: Encoding: zstandard level, bytes per block, and the relative gap between the best
#: and second-best size under which a text is rejected.
LEVEL = 9
BLOCK = 2_048
MIN_MARGIN = 0.003
#: Texts of at most SHORT_BYTES follow LEADS leads of at most LEAD_BYTES each.
SHORT_BYTES = 256
LEADS = 8
LEAD_BYTES = 256

LETTERS = re.compile(r"[^\W\d_]+")

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())]


def normalise(text: str) -> bytes:
    return " ".join(LETTERS.findall(text.lower())).encode("utf-8", "replace")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS,
          excerpt_chars: int = EXCERPT_CHARS, dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary) pairs, the language with most rows first.

    The sample of a language is about ``sample_docs`` texts, those of smallest
    hash in each of SALTS parts (a partial top-k before the shuffle); each
    gives an excerpt at a place that depends on the hash."""
    rows = labelled.select(col(text).alias("t"), col(lang).alias("l")).filter(
        F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
    counts = rows.groupBy("l").count().orderBy(F.desc("count"), "l").collect()
    hashed = rows.withColumn("h", F.xxhash64("t"))
    start = F.pmod("h", F.greatest(F.length("t") - excerpt_chars, F.lit(0)) + 1).cast("int") + 1
    cut = hashed.select("l", "h", F.substring("t", start, F.lit(excerpt_chars)).alias("e"))
    # a language may hold most rows: an equal share of the sample from each of SALTS parts of the hashes
    share = math.ceil(sample_docs / SALTS)
    best = Window.partitionBy("l", F.pmod(F.hash("h"), F.lit(SALTS))).orderBy("h", "e")
    sample = cut.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= share)
    texts: dict[str, list[str]] = {}
    for r in sample.select("l", "h", "e").orderBy("l", "h", "e").collect():
        texts.setdefault(r["l"], []).append(r["e"])
    out = []
    for r in counts:
        parts = [normalise(e) for e in dict.fromkeys(texts.get(r["l"], []))]
        # the leads come first, each from another excerpt
        parts = [p[:LEAD_BYTES] for p in parts[:LEADS]] + [p[LEAD_BYTES:] for p in parts[:LEADS]] + parts[LEADS:]
        out.append((r["l"], b" ".join(p for p in parts if p)[:dict_bytes]))
    return [(name, content) for name, content in out if content]


def leads_of(content: bytes) -> tuple[list[bytes], bytes]:
    """The leads of a language's sample (at most a quarter of it) and the rest, its dictionary."""
    size = min(LEAD_BYTES, len(content) // (4 * LEADS))
    return [content[i * size:(i + 1) * size] + b" " for i in range(LEADS)], content[LEADS * size:]


def coders(dictionaries: list[tuple[str, bytes]], level: int):
    """(encode, leads, their total size) per language."""
    import zstandard

    out = []
    for _, content in dictionaries:
        leads, rest = leads_of(content)
        d = zstandard.ZstdCompressionDict(rest, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        encode = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                          write_checksum=False, write_dict_id=False).compress
        out.append((encode, leads, sum([len(encode(x)) for x in leads])))
    return out


def sizes_of(data: bytes, languages, block: int) -> list[float]:
    """Encoded size of a normalised text per language."""
    if len(data) <= SHORT_BYTES:
        return [(sum([len(encode(x + data)) for x in leads]) - alone) / LEADS for encode, leads, alone in languages]
    blocks = [data[i:i + block] for i in range(0, len(data), block)]
    return [sum([len(encode(b)) for b in blocks]) for encode, _, _ in languages]


def judge(sizes: list[float], names: list[str], min_margin: float) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected) of the encoded sizes.  The score is
    the best language's share when a size in bytes counts as a code length."""
    best = min(sizes)
    at = sizes.index(best)
    others = [s for i, s in enumerate(sizes) if i != at]
    margin = (min(others) - best) / max(best, 1) if others else 1.0
    score = 1.0 / (1.0 + sum(2.0 ** -min(s - best, 60) for s in others))
    return names[at], score, margin, margin < min_margin


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], carry: list[str], text: str = "text",
             level: int = LEVEL, block: int = BLOCK, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``row`` (the carried columns), lang_pred, score, margin, rejected."""
    names = [n for n, _ in dictionaries]

    def make_kernel():
        languages = coders(dictionaries, level)

        def kernel(texts: pa.Array) -> list[pa.Array]:
            out = []
            for t in texts.to_pylist():
                data = normalise(t) if t else b""
                if not data or not languages:
                    out.append((UNKNOWN, 0.0, 0.0, True))
                    continue
                out.append(judge(sizes_of(data, languages, block), names, min_margin))
            a, b, c, d = zip(*out) if out else ((), (), (), ())
            return [pa.array(a, pa.string()), pa.array(b, pa.float64()), pa.array(c, pa.float64()),
                    pa.array(d, pa.bool_())]

        return kernel

    return map_texts(docs, text, carry, FIELDS, make_kernel)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    dictionaries = train(docs.filter(~held_out("doc_id")))
    found = identify(docs, dictionaries, ["doc_id"])
    return found.select("row.doc_id", "lang_pred", "score", "margin", "rejected") \
        .withColumn("held_out", held_out("doc_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is identified, with their own columns."""
    dictionaries = train(docs.filter(~held_out("doc_id")))
    return identify(docs, dictionaries, docs.columns).filter(~F.col("rejected")).select("row.*")
