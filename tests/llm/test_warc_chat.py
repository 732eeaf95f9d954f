import base64
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from revlens.llm import chat_format as C
from revlens.llm import warc


def brute_pages(rows):
    first = {}
    for p, _, html in rows:
        key = html or ""
        if p is not None:
            first[key] = p if first.get(key) is None else min(first[key], p)
        else:
            first.setdefault(key, None)
    return first


ROWS = [(3, "u3", "same é"), (1, "u1", "same é"), (2, None, None), (5, "u\r\nX: y", ""), (4, "u4", "x" * 200_000),
        (None, "u", "same é"), (1, "u1", "same é"), (6, "u6", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"), (None, None, "alone")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_index_matches_brute_force(spark, save):
    got = warc.op10_warc(spark, save(pages=pages(spark).withColumn("sha256", F.lit("clash")))).collect()
    first = brute_pages(ROWS)
    assert len(got) == len(ROWS)
    responses = [r for r in got if r.record_type == "response"]
    assert len(responses) == len(first)
    by = {}
    for p, _, html in ROWS:
        by.setdefault(p, set()).add(html or "")
    for r in got:
        html = next(h for h in by[r.page_id] if base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() == r.payload_digest)
        assert r.payload_bytes == len(html.encode())
        if r.record_type == "response":
            assert r.page_id == first[html] and r.refers_to is None
        else:
            assert r.refers_to == first[html]


def test_records_are_rebuilt_and_stored_once(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})
    records = {r.page: bytes(r.record) for r in warc.records(spark, path).filter("page in (2, 3, 4, 5, 6)").collect()}
    for p, url, html in ROWS:
        if p in (2, 4, 6):
            body = (html or "").encode()
            head, _, rest = records[p].partition(b"\r\n\r\n")
            assert rest == body + b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
            assert f"Content-Length: {len(body)}".encode() in head.split(b"\r\n")
    assert b"WARC-Type: revisit" in records[3] and b"WARC-Refers-To: <urn:page:1:" in records[3]
    assert b"WARC-Target-URI: uX: y" in records[5]
    full = {r.page: bytes(r.record) for r in warc.records(spark, path, expand_revisits=True).filter("page = 3").collect()}
    assert full[3].endswith("\r\n\r\nsame é\r\n\r\n".encode())


def test_record_ids_are_unique_and_revisits_name_one_record(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark, ROWS + [(1, "u1", "same é")] * 3 + [(None, None, None)] * 2), path)
    rows = [(r.id, r.kind, r.to) for r in warc.parsed(warc.records(spark, path)).select(
        warc.field("WARC-Record-ID").alias("id"), warc.field("WARC-Type").alias("kind"), warc.field("WARC-Refers-To").alias("to")).collect()]
    assert len({i for i, _, _ in rows}) == len(rows) == len(ROWS) + 5
    responses = {i for i, kind, _ in rows if kind == "response"}
    assert all(to in responses for _, kind, to in rows if kind == "revisit")


def test_buckets_spare_the_payloads_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "w")
    buckets = warc.write(pages(spark), path, buckets=3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rebuilt = warc.records(spark, path, buckets=buckets)
        got = sorted((r.page or 0, bytes(r.record)) for r in rebuilt.collect())
        plan = rebuilt._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted((r.page or 0, bytes(r.record)) for r in warc.records(spark, path).collect())
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("revlens_payloads")]


def test_a_lost_payload_is_noticed(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path)
    spark.read.parquet(f"{path}/payloads").filter("length(body) > 0").write.parquet(str(tmp_path / "v/payloads"))
    spark.read.parquet(f"{path}/headers").write.parquet(str(tmp_path / "v/headers"))
    with pytest.raises(Exception, match="record without its payload"):
        warc.index(spark, str(tmp_path / "v")).collect()


def test_small_payloads_are_not_revisited(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path, min_bytes=10)
    got = warc.index(spark, path).filter("page is not null and page <> 6").collect()
    assert {r.record_type for r in got} == {"response"}


def test_a_changed_payload_is_noticed(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path)
    stored = spark.read.parquet(f"{path}/payloads").withColumn("body", F.concat(F.col("body"), F.lit(b"!")))
    stored.write.parquet(str(tmp_path / "v/payloads"))
    spark.read.parquet(f"{path}/headers").write.parquet(str(tmp_path / "v/headers"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.index(spark, str(tmp_path / "v")).collect()


def test_empty_pages(spark, save):
    assert warc.op10_warc(spark, save(pages=pages(spark, []))).count() == 0


# ---- preference formatting ----------------------------------------------------------------

def brute_pairs(turns):
    pairs = {}
    for pair, side, turn, role, text in turns:
        pairs.setdefault(pair, {"chosen": [], "rejected": []}).setdefault(side, []).append((turn, role, text))
    key = lambda t: [(x is not None, x if x is not None else 0) for x in t]
    out = {}
    for pair, sides in pairs.items():
        c, r = (sorted(sides[s], key=key) for s in ("chosen", "rejected"))
        n = 0
        while n < min(len(c), len(r)) and c[n][1:] == r[n][1:]:
            n += 1
        show = lambda t: f"<|{t[1] or 'unknown' if t[1] is None else t[1]}|>\n{t[2] or ''}<|end|>\n"

        def mask(ts):
            at, spans = 0, []
            for t in ts:
                s = show(t)
                if t[1] == "assistant":
                    spans.append(f"{at + len(s) - len(t[2] or '') - 8}-{at + len(s) - 1}")
                at += len(s)
            return ";".join(spans)
        out[pair] = (n, "".join(map(show, c[:n])), "".join(map(show, c[n:])), "".join(map(show, r[n:])), mask(c[n:]), mask(r[n:]))
    return out


def test_pairs_match_brute_force(spark):
    turns = [(1, s, k, r, t) for s in ("chosen", "rejected") for k, (r, t) in
             enumerate([("system", "be é"), ("user", "hi"), ("assistant", "yes" if s == "chosen" else "no"), ("user", "bye")])]
    turns += [(2, "chosen", 0, "user", "only"), (3, "chosen", 0, "user", "a"), (3, "rejected", 0, "user", "a"),
              (4, "chosen", 0, None, None), (4, "rejected", 0, None, None), (4, "rejected", 1, "assistant", None),
              (None, "chosen", 0, "user", "x"), (None, "rejected", 0, "user", "x" * 100_000),
              (5, "rejected", None, "assistant", "q"), (5, "chosen", 2, "assistant", "q"), (5, "chosen", 1, "assistant", "q"),
              (6, "chosen", 0, "user", "dup"), (6, "chosen", 0, "user", "dup"), (6, "rejected", 0, "user", "dup")]
    df = spark.createDataFrame(turns, "pair_id long, side string, turn long, role string, text string").repartition(5)
    got = {r.pair_id: tuple(r[2:]) for r in C.format_pairs(df.withColumn("prompt", F.lit(0))).collect()}
    assert got == brute_pairs(turns)
    assert C.format_pairs(df.limit(0)).count() == 0


def test_masked_text_is_the_answer(spark):
    turns = [(1, "chosen", 0, "user", "q"), (1, "chosen", 1, "assistant", "good"), (1, "rejected", 0, "user", "q"),
             (1, "rejected", 1, "assistant", "bad answer")]
    r = C.format_pairs(spark.createDataFrame(turns, "pair_id long, side string, turn long, role string, text string")).first()
    a, b = map(int, r.rejected_mask.split("-"))
    assert r.prompt == "<|user|>\nq<|end|>\n" and r.rejected[a:b] == "bad answer<|end|>" and r.chosen_mask == "14-25"


def test_a_long_pair_comes_in_pages_of_the_same_turns(spark):
    turns = [("long", s, k, "assistant" if k % 2 else "user", f"t{k}" if k < 23 or s == "chosen" else f"other {k}")
             for s in ("chosen", "rejected") for k in range(60 if s == "chosen" else 41)]
    turns += [("short", s, 0, "assistant", s) for s in ("chosen", "rejected")]
    df = spark.createDataFrame(turns, "pair_id string, side string, turn long, role string, text string").repartition(4)
    got = sorted(C.format_pairs(df, page_turns=10).collect(), key=lambda r: (r.pair_id, r.page))
    whole = brute_pairs(turns)
    assert [(r.pair_id, r.page) for r in got] == [("long", 0), ("long", 1), ("long", 2), ("long", 3), ("short", 0)]
    long = [r for r in got if r.pair_id == "long"]
    assert {r.n_prompt_turns for r in long} == {23}
    for i, name in enumerate(("prompt", "chosen", "rejected")):
        assert "".join(r[name] for r in long) == whole["long"][1 + i]
    for name in ("chosen", "rejected"):
        learned = [r[name][int(a):int(b)] for r in long for a, b in (m.split("-") for m in r[f"{name}_mask"].split(";") if m)]
        mask = whole["long"][4 if name == "chosen" else 5]
        text = whole["long"][2 if name == "chosen" else 3]
        assert learned == [text[int(a):int(b)] for a, b in (m.split("-") for m in mask.split(";"))]


def test_query_equals_its_sql_on_odd_conversations(spark, save):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "system", "s"), (3, 0, "user", "x"),
            (3, 1, "assistant", "x"), (3, 2, "user", "y"), (4, 0, "assistant", "first"), (5, 0, None, None),
            (5, 1, "assistant", None), (6, None, "user", "n"), (6, 1, "assistant", "m"), (None, 0, "user", "z"), (None, 1, "assistant", "w"),
            (8, 0, "user", "twice"), (8, 0, "user", "twice"), (8, 0, "user", "twice")]
    rows += [(7, k, "assistant" if k % 3 == 1 else "user", f"turn {k}") for k in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    sf = save(conversations=df)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet/*.parquet')")
    res = con.execute(C.ORACLE)
    names = [d[0] for d in res.description]
    want = sorted((tuple(r) for r in res.fetchall()), key=str)
    got = sorted((tuple(r[n] for n in names) for r in C.op5_chat_format(spark, sf).collect()), key=str)
    assert got == want and len(got) == 9  # one whole row per conversation, the one of 700 turns too


def test_native_plan_has_no_python(spark):
    plan = C.op5_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
