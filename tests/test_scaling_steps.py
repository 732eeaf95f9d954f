"""Steps of the text queries that made their cost grow: what is worked out twice, shuffled or written too wide."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from revlens import fixtures as FX
from revlens.functions import text as T
from revlens.operators import features as FE
from revlens.operators import grouping as GR
from revlens.operators import lexical as LX
from revlens.operators import subwords as SW
from tests.conftest import SF_SMALL, rows

ODD = ["", " ", "a\r\nb\n", "x @me y", "see http://a.b/c d", "https://q", "ftp://no", "mail a@b.c\u00a0end", "caf\u00e9 @\u00e9t\u00e9 z",
       "\u00fc\u00df", "no links: here", "\r", "HTTP://UP", "tail \t\n", "\u0130 @x", "a http:/b", None]


def plan(df, stage="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


def test_cleaning_steps_on_odd_texts_and_without_a_lookup_a_character(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", T.normalize_newlines(F.col("t")).alias("n"), T.strip_links_mentions(F.col("t")).alias("l"),
                                        T.strip_non_ascii(F.col("t")).alias("a"),
                                        T.demojize(F.col("t"), {"\u00e9": ":e:", "\u00fc\u00df": ":uss:"}).alias("d")).collect()}
    for i, t in enumerate(ODD):
        if t is None:
            assert got[i][1:] == (None,) * 4
            continue
        if "\u0130" not in t:
            assert got[i]["n"] == t.replace("\r", "").replace("\n", " ").lower()
        assert got[i]["l"] == re.sub(r"@\S+|https?://\S+", "", t)
        assert got[i]["a"] == re.sub(r"[^\x00-\x7f]", "", t)
        assert got[i]["d"] == t.replace("\u00fc\u00df", ":uss:").replace("\u00e9", ":e:")
    ascii_key = df.select(T.demojize(F.col("t"), {"a": "1"}).alias("d")).filter("t = 'x @me y' or t like 'a@%' or t like 'mail%'")
    assert [r["d"] for r in ascii_key.collect()] == ["x @me y", "m1il 1@b.c\u00a0end"]
    assert "translate" not in plan(df.select(T.normalize_newlines(F.col("t"))))


def test_tokens_are_grouped_where_their_document_is(spark):
    for name in ["lemmatize_lookup", "pos_filter"]:
        df = E.queries()[name](spark, SF_SMALL)
        p = plan(df, "sparkPlan") + plan(df, "executedPlan")
        executed = plan(df, "executedPlan")
        exchanges = [m.start() for m in re.finditer(r"Exchange hashpartitioning\(doc_id", executed)]
        assert len(exchanges) == 1 and exchanges[0] > executed.index("Generate"), p
    spread = FX.tokens(spark, SF_SMALL, by_document=True)
    plain = FX.tokens(spark, SF_SMALL)
    assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0
    # the operator takes any token table
    assert rows(LX.lemmatize(plain, FX.lemma_map(spark))) == rows(LX.lemmatize(spread, FX.lemma_map(spark)))


def test_chunking_works_out_a_text_once(spark, monkeypatch):
    plans = []
    kept = GR._ckpt
    monkeypatch.setattr(GR, "_ckpt", lambda df: plans.append(plan(df)) or kept(df))
    df = spark.createDataFrame([(1, "a", "x1"), (2, "a", None), (3, "a", "yy2"), (None, "a", "z"), (1, None, "w")],
                               "review_id long, asin string, t string")
    df = df.select("review_id", "asin", F.regexp_replace("t", "[0-9]", "").alias("review_text"))
    got = sorted(((r["asin"], r["chunk"], r["n_reviews"], r["text"]) for r in GR.greedy_chunks(df, limit=2).collect()), key=repr)
    assert got == sorted([("a", 0, 2, "z x"), ("a", 1, 1, "yy"), (None, 0, 1, "w")], key=repr)
    assert plans[0].count("regexp_replace") == 1, plans[0]


def test_a_words_idf_is_worked_out_below_the_join(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a", None, ""]), (None, ["c"]), (3, [])], "review_id long, words array<string>")
    df = FE.tfidf_exact(docs)
    import math
    got = {(r["review_id"], r["word"]): tuple(r)[2:] for r in df.collect()}

    def row(tf, n):
        idf = math.log(5.0 / (n + 1.0))
        return tf, n, pytest.approx(idf, abs=1e-10), pytest.approx(tf * idf, abs=1e-10)
    assert got == {(1, "a"): row(2, 2), (1, "b"): row(1, 1), (2, "a"): row(1, 2), (2, ""): row(1, 1), (None, "c"): row(1, 1)}
    p = plan(df)
    assert re.search(r"\b(?:ln|LOG)\(", p).start() > p.index("Join"), p


@pytest.mark.parametrize("ids", [(5, 6, 7), (2 ** 31 - 1, -2 ** 31, 0), (-1, 1, -7)])
def test_encoding_carries_place_and_id_as_a_number(spark, ids):
    docs = spark.createDataFrame([(1, 0.0, ["c", "a", "b", "x", None]), (1, 1.0, []), (None, 2.0, None), (2, 2.0, ["b"] * 9)],
                                 "review_id long, label double, words array<string>")
    vocab = spark.createDataFrame(list(zip("abc", ids)), "word string, id int")
    df = FE.encode_fixed_length(docs, vocab, max_len=8)
    a, b, c = ids
    from revlens import dictionaries as D
    got = sorted((repr(r["review_id"]), r["targets"], r["input_ids"], sum(r["attention_mask"])) for r in df.collect())
    pad = [D.PAD_ID]
    assert got == sorted([("1", 0, [D.CLS_ID, c, a, b, D.UNK_ID, D.UNK_ID, D.SEP_ID] + pad, 7), ("1", 1, [D.CLS_ID, D.SEP_ID] + pad * 6, 2),
                          ("None", 2, [D.CLS_ID, D.SEP_ID] + pad * 6, 2), ("2", 2, [D.CLS_ID] + [b] * 6 + [D.SEP_ID], 8)])
    assert "collect_list(CASE WHEN isnotnull(pos" in plan(df) and "struct(pos" not in plan(df), plan(df)


def test_subword_rows_are_written_as_lists(spark, monkeypatch):
    written = []
    kept = SW.materialize
    monkeypatch.setattr(SW, "materialize", lambda df: written.append(df.columns) or kept(df))
    docs = spark.createDataFrame([(1, 0.0, ["ab", "b", "", None]), (1, 1.0, [])], "review_id long, label double, words array<string>")
    vocab = spark.createDataFrame([("a", 5), ("##b", 6), ("b", 7)], "piece string, id int")
    got = {r["targets"]: [i for i, m in zip(r["input_ids"], r["attention_mask"]) if m] for r in SW.encode_subwords(docs, vocab, max_len=8).collect()}
    assert got[0][1:-1] == [5, 6, 7] and got[1][1:-1] == []
    assert "word" not in written[0], written


def test_a_words_repeated_pieces_count_once_without_grouping_them(spark, monkeypatch):
    words = spark.createDataFrame([(w,) for w in ["aaaaa", "aab", "baa", "aa", "aa", "é😀x", "", None, "y é"]], "word string")
    counts: dict = {}
    for w in {"aaaaa", "aab", "baa", "aa", "é😀x", "y é"}:
        for piece in {("##" if p else "") + w[p:p + n] for p in range(len(w)) for n in range(1, 5) if p + n <= len(w)}:
            counts[piece] = counts.get(piece, 0) + 1
    kept = sorted(p for p, n in counts.items() if n >= 3)
    vocab = FX.subword_vocabulary(words)
    assert rows(vocab, "piece", "id") == [(p, 4 + i) for i, p in enumerate(kept)]
    seen = []
    kept_rank = FX.dense_rank_by
    monkeypatch.setattr(FX, "dense_rank_by", lambda df, *a, **k: seen.append(plan(df)) or kept_rank(df, *a, **k))
    FX.subword_vocabulary(words)
    assert seen[0].count("Aggregate [") == 2, seen[0]  # distinct words, and a piece's words
