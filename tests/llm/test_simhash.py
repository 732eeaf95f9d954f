import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from revlens.llm import simhash
from revlens.llm.components import components
from tests.conftest import SF_CHECK

WHITE = "\x20\t\n\x0b\x0c\r"


def brute_fingerprint(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, radius=2):
    """identifier -> smallest reachable; fps: [(id, fp)]."""
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    a = np.array(distinct, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= radius):
            parent[root(distinct[i])] = root(distinct[i + 1 + int(j)])
    low = {}
    for i, f in fps:
        if i is not None:
            low[root(f)] = min(low.get(root(f), i), i)
    return {f: low.get(root(f)) for f in distinct}


def unsigned(x):
    return x % (1 << 64)


def test_every_pair_within_the_radius_shares_a_table():
    masks = simhash.masks(2)
    assert len(masks) == 7 and all(30 <= bin(m).count("1") <= 40 for m in masks)
    for a, b in combinations(range(64), 2):
        assert any(m >> a & 1 == 0 and m >> b & 1 == 0 for m in masks)


def test_fingerprint_matches_brute_force():
    random.seed(5)
    words = ["The", "the", "É", "cat\x85dog", "x", "Zoo", "한국어"]
    for n in [0, 1, 2, 3, 4, 50, 300]:
        text = "".join(random.choice(words) + random.choice([" ", "\n", "\t ", "\x0b", "\x1c", "\xa0"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    long = "a b c d e " * 40_000
    assert simhash.fingerprint(long.encode()) == brute_fingerprint(long)


def near(spark, fps, **kw):
    distinct = spark.createDataFrame([(simhash.signed(f),) for f in {f for f in fps}], "fp long")
    got = {unsigned(r.node): unsigned(r.root) for r in components(simhash.links(distinct, 2, **kw)).collect()}
    return {f: got.get(f, f) for f in fps}


@pytest.mark.parametrize("most", [4096, 3])
def test_links_match_brute_force(spark, most):
    """Also when nearly every bucket is above the bound and goes through one-bit neighbours."""
    random.seed(9)
    centres = [random.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1, 1 << 63]
    fps = set(centres)
    for c in centres:
        for _ in range(random.choice([1, 5, 40])):
            c2 = c
            for _ in range(random.randint(1, 3)):
                c2 ^= 1 << random.randrange(64)
            fps.add(c2)
    got = near(spark, fps, most=most)
    want = brute_components([(f, f) for f in fps])
    group = {}
    for f in fps:
        group.setdefault(got[f], set()).add(want[f])
    assert all(len(v) == 1 for v in group.values()) and len(group) == len(set(want.values()))


def test_big_bucket_components():
    random.seed(3)
    members = {random.getrandbits(64) & 0xFFFFF for _ in range(1500)}
    a = np.array(sorted(members), dtype=np.uint64)
    want = brute_components([(int(f), int(f)) for f in a])
    assert [int(x) for x in simhash.roots_within(a, 2)] == [want[int(f)] for f in a]


def test_long_chain(spark):
    """A path of links has one component, whatever its length."""
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    fps = [(i, brute_fingerprint(t)) for i, t in docs]
    places = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op3_simhash(spark, SF_CHECK).collect()}
    assert got == {i: (f"{f:016x}", places[f]) for i, f in fps}


def test_odd_rows_and_stage(spark, odd_docs):
    rows = odd_docs.collect()
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    places = brute_components(fps)
    got = simhash.near_duplicates(odd_docs, ["doc_id", "text"]).select("row.*", "fp", "component_id").collect()
    assert sorted((str(r.doc_id), unsigned(r.fp), str(r.component_id)) for r in got) == \
        sorted((str(i), f, str(places[f])) for i, f in fps)
    kept = simhash.stage(spark, odd_docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(places.values()))
    assert simhash.stage(spark, odd_docs, "").columns == odd_docs.columns
    assert simhash.stage(spark, odd_docs.limit(0), "").count() == 0


def test_stage_keeps_one_row_when_no_identifier_is_known(spark, make_docs):
    docs = make_docs([(None, "same words here now"), (None, "same words here now"), (None, "quite another text of words")])
    assert simhash.stage(spark, docs, "").count() == 2


def near_texts():
    """Two texts with different fingerprints within the radius."""
    words = [f"word{i}" for i in range(400)]
    base = " ".join(words)
    for i in range(400):
        other = " ".join([*words[:i], "changed", *words[i + 1:]])
        if 1 <= bin(brute_fingerprint(base) ^ brute_fingerprint(other)).count("1") <= 2:
            return base, other
    raise AssertionError("no near text")


def test_stage_tells_components_under_one_identifier_apart(spark, make_docs):
    base, other = near_texts()
    docs = make_docs([(1, "one clean document of its own"), (1, "quite another text of other words"), (1, base), (2, other)])
    kept = sorted((r.doc_id, r.text) for r in simhash.stage(spark, docs, "").collect())
    assert kept == sorted([(1, "one clean document of its own"), (1, "quite another text of other words"), (1, base)])


def test_stage_keeps_one_row_of_linked_texts_without_identifier(spark, make_docs):
    base, other = near_texts()
    docs = make_docs([(None, base), (None, other), (None, "quite another text of other words")])
    kept = [r.text for r in simhash.stage(spark, docs, "").collect()]
    assert len(kept) == 2 and "quite another text of other words" in kept
