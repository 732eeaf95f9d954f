import math

from revlens import dictionaries as D
from revlens.operators import aspects as A
from revlens.operators import polarity as POL

SCHEMA = "doc_id long, asin string, idx int, text string, head_idx int, dep string, pos string, tag string, is_stop boolean"


def toks(spark, doc, words, asin="P1"):
    """words: (text, head, dep, pos, tag, is_stop)"""
    return spark.createDataFrame([(doc, asin, i, *w) for i, w in enumerate(words)], SCHEMA)


def pairs(spark, df, neg=D.NEGATION_WORDS):
    return sorted((r.rule, r.aspect, r.modifier) for r in A.aspect_pairs(df, neg).collect())


def test_attribute_rule_with_pronoun(spark):
    # "this is garbage"
    df = toks(spark, 1, [("this", 1, "nsubj", "PRON", "DT", True), ("is", 1, "ROOT", "AUX", "VBZ", True),
                         ("garbage", 1, "attr", "NOUN", "NN", False)])
    assert pairs(spark, df) == [(7, "product", "garbage")]


def test_modal_complement_rule(spark):
    # "this could have been better" -> (product, not better)
    df = toks(spark, 1, [("this", 3, "nsubj", "PRON", "DT", True), ("could", 3, "aux", "AUX", "MD", True),
                         ("have", 3, "aux", "AUX", "VB", True), ("been", 3, "ROOT", "AUX", "VBN", True),
                         ("better", 3, "acomp", "ADJ", "JJR", False)])
    assert pairs(spark, df) == [(3, "product", "not better")]


def test_amod_rule_prefixes(spark):
    # "no most interesting characters": det negation + first advmod child of the modifier
    df = toks(spark, 1, [("no", 3, "det", "DET", "DT", True), ("most", 2, "advmod", "ADV", "RBS", False),
                         ("interesting", 3, "amod", "ADJ", "JJ", False), ("characters", 3, "ROOT", "NOUN", "NNS", False)])
    assert pairs(spark, df) == [(1, "characters", "not most interesting")]


def test_last_child_wins_and_neg(spark):
    # head 'has' with two nsubj children (last wins) and a neg child
    df = toks(spark, 1, [("screen", 3, "nsubj", "NOUN", "NN", False), ("sound", 3, "nsubj", "NOUN", "NN", False),
                         ("not", 3, "neg", "PART", "RB", True), ("has", 3, "ROOT", "VERB", "VBZ", False),
                         ("great", 3, "dobj", "ADJ", "JJ", False)])
    assert pairs(spark, df) == [(2, "sound", "not great")]


def test_interjection_and_stale_rule5(spark):
    # 'ok' INTJ with nsubj child -> rule 6; 'fine' with nsubj + cop -> rule 5, scored by rule 4's modifier
    df = toks(spark, 1, [("it", 1, "nsubj", "PRON", "PRP", True), ("ok", 1, "ROOT", "INTJ", "UH", False),
                         ("battery", 4, "nsubj", "NOUN", "NN", False), ("is", 4, "cop", "AUX", "VBZ", False),
                         ("fine", 4, "ROOT", "ADJ", "JJ", False), ("really", 4, "advmod", "ADV", "RB", False)])
    got = A.aspect_pairs(df).collect()
    assert sorted((r.rule, r.aspect, r.modifier, r.score_phrase) for r in got) == [
        (4, "battery", "really", "really"), (5, "battery", "fine", "really"), (6, "product", "ok", "ok")]


def test_top_aspects_ties_by_first_mention(spark):
    rows = [("P1", 2, 1, 5, "b"), ("P1", 1, 1, 9, "a"), ("P1", 2, 2, 1, "a"), ("P1", 1, 3, 1, "b")]
    df = spark.createDataFrame(rows, "asin string, rule int, doc_id long, idx int, aspect string")
    top = A.top_aspects(A.aspect_frequency(df), k=1).collect()
    # both have 2 mentions; 'a' first appears in rule 1 (doc 1), before 'b' (rule 1, doc 3)
    assert [(r.aspect, r.mentions) for r in top] == [("a", 2)]


def test_polarity(spark):
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0), (")", 5.0)], "word string, valence double")
    neg = spark.createDataFrame([("not",)], "word string")
    bst = spark.createDataFrame([("very", 0.293)], "word string, scalar double")
    ph = spark.createDataFrame([("good",), ("very good",), ("not good",), ("xyz",), ("not very good",),
                                ("very bad",), ("good!!",), ("(very) good",), (":)",)], "phrase string")
    got = {r.phrase: r.polarity for r in POL.phrase_polarity(ph, lex, neg, bst).collect()}

    def norm(s):
        return round(s / math.sqrt(s * s + 15), 4)
    assert got["good"] == norm(2.0)
    assert got["very good"] == norm(2.293)
    assert got["not good"] == norm(2.0 * -0.74)
    assert got["xyz"] == 0.0
    assert got["not very good"] == norm(2.293 * -0.74)
    assert got["very bad"] == norm(-2.293)
    assert got["good!!"] == norm(2.0) and got["(very) good"] == norm(2.293)   # outer punctuation stripped
    assert got[":)"] == 0.0                                                   # short tokens kept whole


def test_aspect_map_pages_in_mention_order(spark):
    rows = [("P1", "sound", 2, 1, 4, "loud", 0.1), ("P1", "sound", 1, 3, 1, "clear", 0.2),
            ("P1", "sound", 1, 1, 9, "deep", 0.3), ("P1", "battery", 5, 1, 1, "long", 0.4)]
    sp = spark.createDataFrame(rows, "asin string, aspect string, rule int, doc_id long, idx int, modifier string, "
                                     "polarity double")
    top = spark.createDataFrame([("P1", "sound"), ("P1", "battery")], "asin string, aspect string")
    got = sorted((r.aspect, r.part, list(r.modifiers)) for r in A.aspect_map_pages(sp, top, page_size=2).collect())
    assert got == [("battery", 0, ["long"]), ("sound", 0, ["deep", "clear"]), ("sound", 1, ["loud"])]


def test_token_annotations_are_those_of_the_md5(spark, tmp_path):
    import hashlib

    from revlens import fixtures as FX
    spark.createDataFrame([(3, "A b  c d e f"), (None, "x y"), (4, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.idx): r for r in FX.tokens(spark, str(tmp_path)).collect()}
    assert sorted(got, key=str) == sorted([(3, 0), (3, 1), (3, 3), (3, 4), (3, 5), (3, 6), (None, 0), (None, 1)], key=str)
    for (doc, i), r in got.items():
        h = hashlib.md5(f"{doc}:{i}".encode()).hexdigest()
        part = lambda k, n: int(h[8 * k:8 * k + 8], 16) % n
        want = ("ROOT" if i % 5 == 0 else FX.DEPS[part(0, 11)], FX.POS[part(1, 4)], FX.TAGS[part(2, 3)], part(3, 4) == 0)
        assert (r.dep, r.pos, r.tag, r.is_stop) == (want if doc else ("ROOT" if i == 0 else None, None, None, None))


def _pairs_rule_by_rule(rows, neg):
    """The rules as loops over one document's tokens: (rule, idx, aspect, modifier, score phrase)."""
    toks = [dict(zip(("idx", "text", "head", "dep", "pos", "tag", "stop"), r)) for r in rows]
    for t in toks:
        t["stop"] = t["stop"] and t["text"] not in D.PRODUCT_PRONOUNS
    kids = {t["idx"]: [c for c in toks if c["head"] == t["idx"] and c["idx"] != t["idx"]] for t in toks}
    asp = lambda x: "product" if x in D.PRODUCT_PRONOUNS else x
    join = lambda *x: " ".join(y for y in x if y)
    adv = lambda t: next((c["text"] for c in kids[t["idx"]] if c["dep"] == "advmod"), None)
    last = lambda cs: cs[-1] if cs else None
    out = []
    for t in toks:
        ch = kids[t["idx"]]
        of = lambda *deps, ch=ch: last([c for c in ch if c["dep"] in deps and not c["stop"]])
        h = next((x for x in toks if x["idx"] == t["head"]), None)
        if t["dep"] == "amod" and not t["stop"] and h:
            no = any(c["dep"] == "det" and c["text"] in neg for c in kids[h["idx"]])
            m = join("not" if no else "", adv(t), t["text"])
            out.append((1, t["idx"], asp(h["text"]), m, m))
        subj, any_subj, cop, attr, acomp, a = of("nsubj"), of("nsubj", "nsubjpass"), of("cop"), of("attr"), of("acomp"), of("advmod")
        dobj = last([c for c in ch if c["dep"] == "dobj" and c["pos"] == "ADJ" and not c["stop"]])
        not_ = last([c["text"] for c in ch if c["dep"] == "neg"])
        modal = last([c["text"] if c["dep"] == "neg" else "not" for c in ch if c["dep"] == "neg" or c["dep"] == "aux" and c["tag"] == "MD"])
        m4 = join(not_, adv(a), a["text"]) if a else None
        if subj:
            s = asp(subj["text"])
            out += [(2, t["idx"], s, join(not_, dobj["text"]), join(not_, dobj["text"]))] if dobj else []
            out += [(3, t["idx"], s, join(modal, acomp["text"]), join(modal, acomp["text"]))] if acomp else []
            out += [(5, t["idx"], s, t["text"], m4)] if cop else []
            out += [(6, t["idx"], s, t["text"], t["text"])] if t["pos"] == "INTJ" and not t["stop"] else []
            out += [(7, t["idx"], s, join(not_, attr["text"]), join(not_, attr["text"]))] if attr else []
        out += [(4, t["idx"], asp(any_subj["text"]), m4, m4)] if any_subj and a else []
    return out


def test_random_documents_equal_the_loop_form(spark):
    import random

    from revlens import fixtures as FX
    rng = random.Random(5)
    words = ["it", "this", "no", "not", "the", "great", "sound", "very", "is", "ok"]
    docs = {}
    for doc in range(300):
        n = rng.randint(1, 25)
        docs[doc, f"P{doc % 3}"] = [(i, rng.choice(words), rng.choice([rng.randrange(n), max(0, i - 1), i]), rng.choice([*FX.DEPS, "amod", "nsubj", "ROOT"]),
                                     rng.choice(FX.POS), rng.choice(FX.TAGS), rng.random() < 0.3) for i in range(n)]
    # two products' tokens under one document id are two texts
    docs[0, "P9"] = docs[1, "P1"]
    df = spark.createDataFrame([(d, a, *t) for (d, a), ts in docs.items() for t in ts], SCHEMA).repartition(5)
    want = sorted(((d, a, *p) for (d, a), ts in docs.items() for p in _pairs_rule_by_rule(ts, D.NEGATION_WORDS)), key=repr)
    cols = ["doc_id", "asin", "rule", "idx", "aspect", "modifier", "score_phrase"]
    assert sorted((tuple(r[c] for c in cols) for r in A.aspect_pairs(df).collect()), key=repr) == want and len(want) > 300
    assert {p[2] for p in want} == set(range(1, 8))


def test_tokens_of_the_queries_are_not_shuffled_and_sorted_narrow(spark):
    import re

    from revlens.plans import catalog as C
    from tests.conftest import SF_SMALL
    p = C.pairs(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    exchanges = [m.start() for m in re.finditer("Exchange ", p)]
    assert len(exchanges) == 1 and exchanges[0] > p.index("posexplode"), p
    # what the window functions read is worked out above the sort
    assert "_w0" not in p[p.rindex("Sort ["):], p


def test_aspect_map_scores_and_pages_only_top_aspects(spark, monkeypatch):
    from revlens.plans import aspect_job as AJ
    from revlens.plans import catalog as C
    from tests.conftest import SF_SMALL
    scored = []
    kept = AJ.scored
    monkeypatch.setattr(AJ, "scored", lambda pairs, *a, **k: scored.append(pairs) or kept(pairs, *a, **k))
    pages = C.q_aspect_map(spark, SF_SMALL).collect()
    # every mention of a top aspect, and no other, is scored and stands on a page
    assert scored[0].count() == sum(len(r["modifiers"]) for r in pages) < C.pairs(spark, SF_SMALL).count()
    assert {(r["asin"], r["aspect"]) for r in pages} == {(r["asin"], r["aspect"]) for r in C.q_top_aspects(spark, SF_SMALL).collect()}
