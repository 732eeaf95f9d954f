"""Phrases in running text: borders, case, longest match; brute force over random texts."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.functions.phrases import MAX_PHRASES, Phrases, folded, trie_regex
from revlens.operators.lexical import expand_contractions_df
from tests.conftest import rows

ENTRIES = {"don't": "do not", "it's": "it is", "he's": "he is", "'tis": "it is", "goin'": "going", "dont": "do not",
           "going to": "gonna", "going": "walking", "c++": "see", "a.b": "dot", "I'd": "I would", "é": "e"}


def brute(text, entries):
    """The rules word for word, one place after the other."""
    table = {folded(k): v for k, v in sorted(entries.items(), reverse=True)}
    word = lambda c: c.isalpha() or c.isnumeric() or c == "_"
    apostrophes = "'’"
    out, at = [], 0
    while at < len(text):
        hit = None
        before = text[:at][-2:]
        if not (before and (word(before[-1]) or (len(before) == 2 and before[1] in apostrophes and word(before[0])))):
            for p in sorted(table, key=lambda p: -len(p)):
                end, ok = at, True
                for ch in p:
                    if ch == " ":
                        start = end
                        while end < len(text) and text[end] in " \t\n\r\x0b\x0c":
                            end += 1
                        ok = end > start
                    else:
                        ok = end < len(text) and (text[end].lower() == ch or (ch == "'" and text[end] in apostrophes))
                        end += 1
                    if not ok:
                        break
                rest = text[end:end + 2]
                if ok and not (rest and (word(rest[0]) or (len(rest) == 2 and rest[0] in apostrophes and rest[1].isalpha()))):
                    hit = (end, table[p])
                    break
        if hit:
            new, first = hit[1], text[at]
            out.append(new[:1].upper() + new[1:] if first != first.lower() else new)
            at = hit[0]
        else:
            out.append(text[at])
            at += 1
    return "".join(out)


def rewritten(spark, texts, entries):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["t"] for r in df.select("i", Phrases(entries).rewrite(F.col("t")).alias("t")).orderBy("i").collect()]


def test_contractions_next_to_punctuation_and_line_ends(spark):
    texts = ["I don't, really. \"It's\" (don't)\nit's ok", "Don't! DON’T? 'don't' don't've he's've undone don'ts",
             "'Tis goin' goin'. C++, c++x a.b aXb", "going  to town, going\nto, going.", None, "", "don't", "é É éa"]
    got = rewritten(spark, texts, ENTRIES)
    assert got == [t if t is None else brute(t, ENTRIES) for t in texts]
    assert got[0] == "I do not, really. \"It is\" (do not)\nit is ok"
    assert got[1] == "Do not! Do not? 'do not' don't've he's've undone don'ts"


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    atoms = ["don't", "it's", "he's", "'tis", "goin'", "going", "to", "don", "'", "’", "t", "s", " ", "  ", "\n", ".", ",", "(", "_", "1",
             "C++", "c", "+", "a.b", "I'd", "É", "\x01", "$1", "\\"]
    texts = ["".join(rng.choice(atoms) + rng.choice(["", " "]) for _ in range(rng.randrange(14))) for _ in range(400)]
    assert rewritten(spark, texts, ENTRIES) == [brute(t, ENTRIES) for t in texts]


def test_large_dictionary(spark):
    rng = random.Random(9)
    entries = {"".join(rng.choice("abc'") for _ in range(rng.randint(1, 7))).strip("'") or "a": str(i) for i in range(2000)}
    texts = [" ".join("".join(rng.choice("abcd'") for _ in range(rng.randint(1, 6))) for _ in range(12)) for _ in range(60)]
    assert rewritten(spark, texts, entries) == [brute(t, entries) for t in texts]


def test_found_and_matches(spark):
    df = spark.createDataFrame([("I don't. It's",), ("nothing",), (None,)], "t string")
    p = Phrases(ENTRIES)
    assert rows(df.select(p.found(F.col("t")).alias("f"), F.coalesce(F.array_join(p.matches(F.col("t")), "|"), F.lit("-")).alias("m"))
                .fillna(False)) == [(False, ""), (False, "-"), (True, "don't|It's")]


def test_dictionary_tables(spark):
    d = spark.createDataFrame([("dont", "do not"), ("dont", "a"), (None, "x"), ("x", None), ("", "y"), ("It's", "it is")], "short string, long string")
    df = spark.createDataFrame([(None, "dont x It's"), (None, None), (1, "dont"), (1, "dont")], "id int, t string")
    got = [r["t"] for r in expand_contractions_df(df, "id", "t", d).collect()]
    assert got == ["a x It is", None, "a", "a"]
    assert expand_contractions_df(df, "id", "t", d.limit(0)).collect() == df.collect()
    plan = expand_contractions_df(df, "id", "t", d)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    with pytest.raises(ValueError):
        Phrases({str(i): "" for i in range(MAX_PHRASES + 1)})


def test_trie_tries_the_longest_first():
    assert trie_regex(["ab", "abc", "abd", "b"]) == "(?:ab(?:c|d)?|b)"
