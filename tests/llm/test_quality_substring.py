import random

import numpy as np
from pyspark.sql import functions as F

from revlens.llm import quality, substring_dedup as S
from tests.conftest import SF_CHECK


def auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", "quality")
    rows = quality.op7_quality(spark, SF_CHECK).join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.score, r.quality) for r in rows if r.held_out and r.quality is not None]
    assert auc(held) > 0.95
    assert sum((s >= 0.5) == (y == 1) for s, y in held) / len(held) > 0.93


def test_scores_equal_the_closed_form():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(300, 3)) @ np.diag([1, 2, 0.5]), rng.normal(size=(200, 3)) + 1.5
    moments = {c: (float(len(m)), m.sum(axis=0), m.T @ m) for c, m in ((0, a), (1, b))}
    model = quality.Discriminant(moments, pooled_share=0.2, identity_share=0.1)
    x = rng.normal(size=(20, 3))
    covs = [np.cov(m.T, bias=True) for m in (a, b)]
    pooled = (300 * covs[0] + 200 * covs[1]) / 500
    want = []
    for m, cov, n in ((a, covs[0], 300), (b, covs[1], 200)):
        cov = 0.9 * (0.8 * cov + 0.2 * pooled) + 0.1 * np.trace(pooled) / 3 * np.eye(3)
        d = x - m.mean(axis=0)
        want.append(np.log(n / 500) - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp((want[0] - want[1]) / 3)))


def test_quality_of_odd_rows_and_single_classes(spark, odd_docs, save):
    for labels in ([], [(1, 1, 0), (4, 1, 0), (99, 0, 0), (None, 0, 0), (2, None, 0), (3, 7, 0)]):
        sf = save(documents=odd_docs, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        rows = quality.op7_quality(spark, sf).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert {r.score for r in rows} == ({1.0} if labels else {0.5})


def test_statistics_are_finite():
    for data in (b"", b" ", b"x", "é".encode() * 100, b"a b " * 50_000):
        assert len(quality.statistics(data)) == len(quality.FEATURES) and np.isfinite(quality.statistics(data)).all()


# ---- substring dedup ----------------------------------------------------------------------

def brute_ends(data):
    out, last = [], -S.MIN_CHUNK
    for i in range(len(data)):
        h = 0
        for b in data[max(0, i - 15):i + 1]:
            h = (2 * h + int(S.GEAR[b])) & 0xFFFF
        if h >> (16 - S.CHUNK_BITS) == 0:
            if i - last >= S.MIN_CHUNK:
                out.append(i + 1)
            last = i
    out = out + ([len(data)] if data and (not out or out[-1] != len(data)) else [])
    full, begin = [], 0
    for e in out:
        full += [*range(begin + S.MAX_CHUNK, e, S.MAX_CHUNK), e]
        begin = e
    return full


def brute_spans(docs, min_words):
    first = {}
    cut = {}
    for k, (ident, text) in enumerate(docs):
        data = (text or "").encode()
        ends = brute_ends(data)
        cut[k] = [(b, e, data[b:e]) for b, e in zip([0, *ends], ends)]
        if ident is not None:
            for _, _, c in cut[k]:
                first[c] = min(first.get(c, ident), ident)
    out = []
    for k, (ident, text) in enumerate(docs):
        if ident is None:
            continue
        marks = [(b, e, first[c]) for b, e, c in cut[k] if first[c] < ident]
        out += [(ident, *s) for s in S.spans_of((text or "").encode(), marks, min_words)]
    return sorted(out)


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghilmnoprstué") for _ in range(r.randint(2, 9))) for _ in range(n))


def got_spans(df, **kw):
    rows = S.find_spans(df, **kw).select("row.doc_id", F.explode("spans").alias("s")).collect()
    return sorted((r.doc_id, *r.s) for r in rows)


def test_chunk_ends_match_brute_force(monkeypatch):
    monkeypatch.setattr(S, "BYTES_AT_ONCE", 100)
    for data in (b"", b"x", b"nd " * 2_000, words(400, 1).encode(), bytes(3_000), words(3, 2).encode()):
        assert S.chunk_ends(data).tolist() == brute_ends(data)


def test_planted_passages_are_found_and_clean_documents_left(spark, make_docs):
    rows, planted = [], set()
    for i in range(150):
        text = words(60, 1_000 + i)
        if i % 3 == 0:
            passage = words(55, i % 15)
            text = words(20 + i, 5_000 + i) + " " + passage + " " + words(30, 7_000 + i)
            if i >= 15:
                planted.add(i)
        rows.append((i, text))
    docs = make_docs(rows)
    got = got_spans(docs)
    assert got == brute_spans(rows, S.MIN_WORDS)
    found = {r[0] for r in got}
    assert found <= planted and len(found) >= 0.95 * len(planted)
    assert all(r[4] == r[0] % 15 for r in got)


def test_insertions_do_not_hide_a_passage(spark, make_docs):
    passage = words(200, 1)
    docs = make_docs([(1, passage), (2, "inserted " + passage[:500] + "and here" + passage[500:])])
    got = got_spans(docs)
    assert {r[0] for r in got} == {2} and sum(r[3] for r in got) > 150


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter("doc_id < 400").collect()]
    assert got_spans(spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter("doc_id < 400")) == brute_spans(rows, S.MIN_WORDS)


def test_odd_rows_hot_group_and_cut(spark, odd_docs, make_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got_spans(odd_docs, min_words=2) == brute_spans(rows, 2)
    assert S.find_spans(odd_docs.limit(0)).count() == 0
    text = words(60, 3)
    hot = [(i, text if i % 3 else words(40, 100 + i)) for i in range(900)]
    got = got_spans(make_docs(hot))
    assert got == brute_spans(hot, S.MIN_WORDS) and len(got) == 599
    spans = [{"first_byte": 0, "end_byte": 3, "n_words": 1}]
    assert S.cut("one two", spans) == " two" and S.cut(None, []) == ""


# ---- passages of whole words --------------------------------------------------------------

def brute_passages(docs, m):
    """Unions of overlapping windows of m words that a document with a smaller identifier has as well."""
    found = []
    first = {}
    for ident, text in docs:
        data = (text or "").encode()
        at = [w.span() for w in S.WORD.finditer(data)]
        windows = [(at[k][0], at[k + m - 1][1], k) for k in range(len(at) - m + 1)] if ident is not None else []
        found.append((ident, data, windows))
        for b, e, _ in windows:
            first[data[b:e]] = min(first.get(data[b:e], ident), ident)
    out = []
    for ident, data, windows in found:
        spans = []
        for b, e, k in windows:
            source = first[data[b:e]]
            if source < ident:
                if spans and b < spans[-1][1]:
                    spans[-1][1:] = [e, spans[-1][2], k, min(source, spans[-1][4])]
                else:
                    spans.append([b, e, k, k, source])
        out += [(ident, b, e, k - f + m, source) for b, e, f, k, source in spans]
    return sorted(out)


def got_passages(df, **kw):
    rows = S.find_passages(df, **kw).select("row.doc_id", F.explode("spans").alias("s")).collect()
    return sorted((r.doc_id, *r.s) for r in rows)


def test_anchors_match_brute_force(monkeypatch):
    monkeypatch.setattr(S, "BYTES_AT_ONCE", 100)
    for data in (b"", b"x", b"nd " * 700, words(300, 1).encode(), bytes(2_000), words(9, 2).encode(), b"ab" * 27, b"ab" * 28):
        h = S.gear_hash(np.frombuffer(data, dtype=np.uint8)).tolist()
        want = {len(data)} if data else set()
        for begin in range(15, len(data) - S.ANCHOR_WINDOW + 1):
            want.add(min(range(begin, begin + S.ANCHOR_WINDOW), key=lambda i: (h[i], -i)) + 1)
        assert S.anchors(data).tolist() == sorted(want)


def test_sparse_and_short_passages_are_found_whole(spark, make_docs):
    """Passages that repeat a short word, of one-letter words, and of just 50 words, each in two surroundings."""
    r = random.Random(7)
    passages = [w * 50 for w in ("nd ", "a ", "the ", "été ", "to be ")]
    passages += [" ".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50)) for _ in range(15)]
    passages += [words(50, 40 + k) for k in range(30)]
    rows = []
    for k, p in enumerate(passages):
        for side in (0, 1):
            i = side * 1_000 + k
            rows.append((i, words(20 + i % 37, 20_000 + i) + " " + p.strip() + " " + words(25, 30_000 + i)))
    got = got_passages(make_docs(rows))
    assert got == brute_passages(rows, S.MIN_WORDS)
    assert {g[0]: (g[3], g[4]) for g in got} == {1_000 + k: (len(p.split()), k) for k, p in enumerate(passages)}


def test_passages_on_odd_and_given_rows(spark, odd_docs, make_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    more = [*rows, (70, "first " + rows[2][1][:3_000]), (70, "first " + rows[2][1][:3_000]), (None, rows[2][1])]
    assert got_passages(odd_docs.limit(0)) == []
    assert sorted(set(got_passages(make_docs(more)))) == sorted(set(brute_passages(more, S.MIN_WORDS)))
    given = spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter("doc_id < 400")
    want = brute_passages([(r.doc_id, r.text) for r in given.collect()], S.MIN_WORDS)
    got = got_passages(given)
    long = lambda spans: [s for s in spans if s[2] - s[1] >= 95]
    assert len(long(want)) > 50 and long(got) == long(want) and set(got) <= set(want)
