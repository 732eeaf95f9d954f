import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import bpe, token_files
from tests.conftest import SF_SMALL

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'re", "É", "é", "ß", "Σ", "한", "하", "😀", "!", "!!", "1", "23",
         "<|endoftext|>", "<|startoftext|>", "\x1c", "\x00", "\xa0", "᠎", "the", "Tion", "x" * 30, "'", "ab'", "\r\n",
         "́", "İ", "ﬁ", "\x0b", " \n"]
NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.mark.parametrize("name", NAMES)
def test_pieces_equal_the_whole_text(name):
    random.seed(1)
    spec = bpe.tokenizer_json(bpe.default_path(name))
    pieces = bpe.Pieces(spec, tuple, limit=300, leaf=64)
    for k in range(6_000):
        text = "".join(random.choice(PARTS) for _ in range(random.randint(0, 60)))
        if k % 3 == 0:
            text = text.replace(" ", "").replace("\n", "").replace("\t", "") * 3
        got = [i for v in pieces.lookup(text) for i in v]
        assert got == pieces.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def changed(pattern=None, normalizer=None, step=None):
    j = json.loads(bpe.tokenizer_json(bpe.default_path("word_bpe_49k.json")))
    if pattern:
        j["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": pattern}
    if normalizer:
        j["normalizer"]["normalizers"].append({"type": "Replace", **normalizer})
    if step:
        j["pre_tokenizer"]["pretokenizers"][1].update(step)
    return json.dumps(j)


@pytest.mark.parametrize("spec, rule", [
    (changed(), "dropped"), (changed(r"\S+"), "dropped"),
    (changed(r"[^\s]+ [^\s]+|[^\s]+"), "whole"), (changed(normalizer={"pattern": {"String": " "}, "content": "x"}), "whole"),
    (changed(normalizer={"pattern": {"String": "a b"}, "content": "c"}), "whole"),
    (changed(normalizer={"pattern": {"Regex": r"\s+"}, "content": "y"}), "whole"), (changed(step={"add_prefix_space": True}), "whole")])
def test_only_safe_tokenizers_are_cut(spec, rule):
    assert bpe.cut_rule(spec) == rule
    random.seed(3)
    pieces = bpe.Pieces(spec, tuple, limit=300)
    for _ in range(400):
        text = "".join(random.choice(PARTS) for _ in range(random.randint(0, 40)))
        got = [i for v in pieces.lookup(text) for i in v]
        assert got == pieces.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", NAMES)
def test_long_pieces_do_not_outgrow_the_cache(name):
    random.seed(7)
    pieces = bpe.Pieces(bpe.tokenizer_json(bpe.default_path(name)), tuple, limit=100)
    bound = 100 * bpe.CACHE_MEAN_CHARS
    for _ in range(200):
        text = "".join(random.choice("abcé1!") for _ in range(random.randint(500, 900)))
        got = [i for v in pieces.lookup(text) for i in v]
        assert got == pieces.tokenizer.encode(text, add_special_tokens=False).ids
        assert sum(map(len, pieces.young)) <= bound and sum(map(len, pieces.old)) <= bound + 1_000


@pytest.mark.parametrize("name", NAMES)
def test_tree_concatenation_equals_one_encoding(name):
    random.seed(4)
    tokenizer = bpe.load(bpe.tokenizer_json(bpe.default_path(name)))
    for k in range(150):
        if k % 2:
            text = random.choice(["ab", "tion", "é!", "'re", "0", "😀", "aaaaaaaaab"]) * random.randint(50, 1_500)
        else:
            text = "".join(random.choice("abcdefghiéÉtionthe'!1́") for _ in range(random.randint(100, 4_000)))
        got = bpe.tree_encode(tokenizer, text, leaf=random.choice([16, 100, 700]), window=random.choice([4, 16, 64]))
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def library(name, text):
    t = Tokenizer.from_file(bpe.default_path(name))
    t.no_truncation()
    t.no_padding()
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def expected(name, text):
    ids, decoded = library(name, text)
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_query_matches_the_library(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op6_bpe(spark, SF_SMALL).collect()}
    assert got == {i: expected(NAMES[0], t) for i, t in rows.items()}


def test_odd_rows(spark, odd_docs):
    got = bpe.stage(spark, odd_docs.withColumn("n_tokens", F.lit(1)), "").collect()
    want = [(r.doc_id, *expected(NAMES[0], r.text)) for r in odd_docs.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.stage(spark, odd_docs.limit(0), "").count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_encode_and_decode_return_ids_and_texts(spark, odd_docs, name):
    spec = bpe.tokenizer_json(bpe.default_path(name))
    ids = bpe.encode(odd_docs, spec, ["text"]).select("row.text", "ids")
    got = bpe.decode(ids, spec, ["text", "ids"]).select("row.*", "decoded").collect()
    assert len(got) == odd_docs.count()
    for r in got:
        want, decoded = library(name, r.text)
        assert r.ids == want and r.decoded == decoded


def brute_files(rows, end=0):
    out, start = [], 0
    for ident, text in sorted(rows):
        ids = library(NAMES[1], text)[0] + [end]
        out.append((ident, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_files_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = token_files.op9_token_files(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == brute_files(rows)


def test_files_layout_and_pruning(spark, make_docs, tmp_path):
    path = str(tmp_path / "ids")
    docs = make_docs([(i, f"text {i} " * (i % 50)) for i in range(5_000, 0, -1)])
    spec = bpe.tokenizer_json(bpe.default_path(NAMES[1]))
    token_files.write(docs, path, spec)
    back = token_files.read(spark, path)
    one = back.filter("doc_id = 77")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in one._jdf.queryExecution().toString()
    assert one.first().ids == library(NAMES[1], "text 77 " * 27)[0] + [0]
    rows = back.orderBy("part", "place").collect()
    assert [r.doc_id for r in rows] == list(range(1, 5_001))
    import pyarrow.orc as orc
    import glob
    files = sorted(glob.glob(f"{path}/*.orc"))
    assert files and all(orc.ORCFile(f).row_index_stride == token_files.INDEX_STRIDE for f in files)
    assert any(b"BLOOM" in open(f, "rb").read() or orc.ORCFile(f).nstripe_statistics > 0 for f in files)


def test_files_of_odd_rows(spark, odd_docs, save):
    rows = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    got = token_files.op9_token_files(spark, save(documents=odd_docs)).orderBy("start").collect()
    assert len(got) == len(rows)
    assert [r.doc_id is not None for r in got] == [r[0] for r in rows]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 4)}
    assert by_id[1].n_tokens == by_id[2].n_tokens == 1
    for k in (3, 7, 8):
        text = next(r.text for r in odd_docs.collect() if r.doc_id == k)
        ids = library(NAMES[1], text)[0] + [0]
        assert by_id[k].n_tokens == len(ids) and by_id[k].ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_files_of_an_empty_table(spark, make_docs, save):
    assert token_files.op9_token_files(spark, save(documents=make_docs([]))).count() == 0
