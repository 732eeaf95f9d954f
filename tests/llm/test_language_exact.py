import zlib

import pytest
from pyspark.sql import functions as F

from revlens.llm import exact_dedup, language_id
from revlens.llm.common import held_out
from tests.conftest import SF_CHECK


def test_held_out_accuracy_and_few_rejects(spark):
    found = language_id.op1_language_id(spark, SF_CHECK)
    rows = found.join(spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert sum(r.rejected for r in rows) / len(rows) < 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_short_texts_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    dictionaries = language_id.train(docs.filter(~held_out("doc_id")))
    # the first sentence and a half of every held-out document, too short to gain from a dictionary alone
    cut = docs.filter(held_out("doc_id") & F.col("text").rlike("^[A-Z\\p{Lu}][^\\d]{60}")) \
        .withColumn("text", F.substring("text", 1, 40)).dropDuplicates(["text"])
    rows = language_id.identify(cut, dictionaries, ["doc_id", "lang"]).select("row.*", "lang_pred", "rejected").collect()
    assert len(rows) > 100
    assert sum(r.rejected for r in rows) / len(rows) < 0.04
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.9


def test_leads_are_not_in_the_dictionary():
    for content in (b"", b"abc", bytes(range(97, 123)) * 40, b"x" * 65_536):
        leads, rest = language_id.leads_of(content)
        assert len(leads) == language_id.LEADS and b"".join(x[:-1] for x in leads) + rest == content
        assert len(rest) >= len(content) * 3 // 4


def test_predictions_do_not_see_the_label(spark, make_docs):
    train = [(i, "the cat and the dog went home " * 3 + str(i), "en") for i in range(6)] + \
            [(i, "der hund und die katze gehen heim " * 3, "de") for i in range(6, 12)]
    dictionaries = language_id.train(make_docs(train))
    assert [n for n, _ in dictionaries] == ["de", "en"] or [n for n, _ in dictionaries] == ["en", "de"]
    got = language_id.identify(make_docs([(1, "the dog and the cat", "de")]), dictionaries, ["doc_id"]).first()
    assert got.lang_pred == "en" and not got.rejected


def test_sample_is_bounded(spark, make_docs):
    docs = make_docs([(i, f"word{i % 7} " + chr(97 + i % 26) * 40, "en") for i in range(300)])
    ((name, content),) = language_id.train(docs, sample_docs=20, excerpt_chars=30, dict_bytes=200)
    assert name == "en" and 0 < len(content) <= 200


def test_language_of_odd_rows(spark, odd_docs):
    dictionaries = language_id.train(odd_docs)
    rows = language_id.identify(odd_docs, dictionaries, odd_docs.columns).select("row.*", "lang_pred", "rejected").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert r.lang_pred == "und" and r.rejected
        else:
            assert r.lang_pred in {"en", "la", "xx"}


def test_language_without_labels_and_of_an_empty_table(spark, make_docs):
    docs = make_docs([(1, "some text", None)])
    assert language_id.train(docs) == []
    assert language_id.identify(docs, [], ["doc_id"]).first().lang_pred == "und"
    empty = make_docs([])
    assert language_id.stage(spark, empty, "").columns == empty.columns
    assert language_id.stage(spark, empty, "").count() == 0


def brute(rows, best=max):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return {t: (best((x for x in ids if x is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.fixture(params=[1_024, 0, 20])
def hot_rows(request, monkeypatch):
    """No group is hot, all are, some are."""
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", request.param)


def check_copies(df, rows, keep="largest"):
    got = exact_dedup.mark(df, carry=["doc_id", "text"], keep=keep).select("row.*", "keep_id", "group_size", "kept").collect()
    assert len(got) == len(rows)
    want = brute(rows, max if keep == "largest" else min)
    kept = {}
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text or ""]
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text or ""] = kept.get(r.text or "", 0) + 1
    assert kept == {t: 1 for t in want}


def test_copies_match_brute_force(spark, make_docs, hot_rows):
    rows = [(i, ["a", "b", "a ", "A", None, "", "x" * 3000, "x" * 3000 + "y"][i * i % 8]) for i in range(200)]
    check_copies(make_docs(rows), rows)
    check_copies(make_docs(rows), rows, keep="smallest")


def test_one_hot_group_and_hash_ties(spark, make_docs, hot_rows, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"cold {i}") for i in range(3_000)]
    check_copies(make_docs(rows), rows)
    # equal heads, hashes and salts: the full comparison alone tells texts apart
    monkeypatch.setattr(exact_dedup, "HEAD", 0)
    monkeypatch.setattr(exact_dedup, "SALTS", 1)
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(F.lit(1)))
    check_copies(make_docs(rows[:300]), rows[:300])


def test_copies_of_odd_rows(spark, odd_docs, hot_rows):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_copies(odd_docs, rows)
    assert exact_dedup.mark(odd_docs.limit(0)).count() == 0


def test_stage_keeps_columns_and_one_row_each(spark, odd_docs, hot_rows):
    clash = odd_docs.withColumn("kept", F.lit("mine")).withColumn("sha", F.lit(1)).withColumn("row", F.lit(2))
    out = exact_dedup.stage(spark, clash, "")
    assert out.columns == clash.columns
    assert sorted(t.text or "" for t in out.collect()) == sorted({r.text or "" for r in odd_docs.collect()})
    assert {r.kept for r in out.collect()} == {"mine"}
