"""Sub-word encoding: greedy longest match against a loop, word by word."""

import random

import pytest
from pyspark.sql import functions as F

from revlens import dictionaries as D
from revlens.operators import subwords as SW
from tests.conftest import rows

VOCAB = ["a", "b", "ab", "abc", "##c", "##a", "##ab", "##abcd", "##d", ".", "##.", "q(", "##\\E", "é", "##é", "##'", "the", "##x y"]


def greedy(word, vocab):
    """Ids of one word, by the rule's wording."""
    if len(word) > SW.MAX_WORD_CHARS:
        return [D.UNK_ID]
    out, at = [], 0
    while at < len(word):
        mark = SW.CONTINUED if at else ""
        end = next((e for e in range(len(word), at, -1) if mark + word[at:e] in vocab), None)
        if end is None:
            return [D.UNK_ID]
        out.append(vocab[mark + word[at:end]])
        at = end
    return out


@pytest.fixture(scope="module")
def table(spark):
    rows_ = [(p, i + 10) for i, p in enumerate(VOCAB)] + [("a", 99), (None, 5), ("zz", None), ("", 3), ("##", 4)]
    return spark.createDataFrame(rows_, "piece string, id int")


def test_words_equal_greedy_loop(spark, table):
    rng = random.Random(4)
    words = {"".join(rng.choice("abcdé.x' y") for _ in range(rng.randint(1, 9))) for _ in range(600)}
    words |= {"abcabcd", "the", "thea", "q(", "q((", "a\\E", "ax y", "a\nb", "a" * 100, "a" * 101, "zz", "ABC"}
    df = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,), ("the",)], "word string").repartition(3)
    got = {r["word"]: r["ids"] for r in SW.word_pieces(df, table).collect()}
    vocab = {p: i + 10 for i, p in enumerate(VOCAB)}
    assert got == {w: greedy(w, vocab) for w in words}


def test_encoded_rows(spark, table):
    docs = spark.createDataFrame([(1, ["abc", "zz", None, "abcab", ""], 2.0), (1, ["abc"] * 700, 0.0), (None, None, 1.0), (None, [], None)],
                                 "review_id long, words array<string>, label double")
    got = {(r["review_id"], sum(r["attention_mask"])): r for r in SW.encode_subwords(docs, table).collect()}
    assert len(got) == 3 and set(got) == {(1, 6), (1, 512), (None, 2)}
    assert all(len(r["input_ids"]) == len(r["attention_mask"]) == D.MAX_LEN for r in got.values())
    first = got[(1, 6)]["input_ids"]
    assert first[:7] == [D.CLS_ID, 13, D.UNK_ID, 13, 16, D.SEP_ID, D.PAD_ID]
    # pieces are cut at the length, not words
    short = SW.encode_subwords(docs, table, max_len=5).collect()
    assert sorted(r["input_ids"] for r in short)[-1] == [D.CLS_ID, 13, 13, 13, D.SEP_ID]


def test_empty_vocabulary_and_words_of_a_text(spark, table):
    df = spark.createDataFrame([("ab",)], "word string")
    assert rows(SW.word_pieces(df, table.limit(0))) == [("ab", [D.UNK_ID])]
    t = spark.createDataFrame([("Don't (stop), now…",)], "t string").select(SW.basic_words(F.col("t")).alias("w")).head()["w"]
    assert t == ["Don", "'", "t", "(", "stop", ")", ",", "now", "…"]
