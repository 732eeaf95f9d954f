"""Every language that has a labelled text is learned, however many there are."""

import random

from pyspark.sql import functions as F

from revlens.llm import language_id


def test_three_hundred_languages(spark, make_docs):
    rng = random.Random(11)
    syllables = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiou"]
    words = {f"l{k:03d}": ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(40)] for k in range(300)}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(10 * k + i, text(lang, 120), lang) for k, lang in enumerate(words) for i in range(3 if k else 9)]
    dictionaries = language_id.train(make_docs(rows).repartition(8))
    assert len(dictionaries) == 300 and dictionaries[0][0] == "l000"
    asked = [(i, text(lang, 60), lang) for i, lang in enumerate(list(words)[::7])]
    found = language_id.identify(make_docs(asked), dictionaries, ["lang"]).select("row.lang", "lang_pred")
    assert found.filter(F.col("lang") == F.col("lang_pred")).count() == len(asked)
