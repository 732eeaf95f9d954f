import os
import shutil
import subprocess
import sys

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from revlens.llm import language_id
from revlens.llm.common import held_out
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.test_bpe_files import NAMES, expected
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_simhash import brute_components, brute_fingerprint

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def brute_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dictionaries = language_id.train(docs.filter(~held_out("doc_id")))
    names = [n for n, _ in dictionaries]
    languages = language_id.coders(dictionaries, language_id.LEVEL)
    rows = []
    for r in docs.collect():
        data = language_id.normalise(r.text or "")
        sizes = [sum(len(e(data[i:i + language_id.BLOCK])) for i in range(0, len(data), language_id.BLOCK)) for e, _, _ in languages]
        if len(data) <= 256:
            sizes = [sum(len(e(x + data)) - len(e(x)) for x in leads) / 8 for e, leads, _ in languages]
        if data and not language_id.judge(sizes, names, language_id.MIN_MARGIN)[3]:
            rows.append((r.doc_id, r.text))
    last = {}
    for i, t in rows:
        last[t] = max(last.get(t, i), i)
    rows = [(i, t) for i, t in rows if last[t] == i]
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    places = brute_components(fps)
    rows = [(i, t) for (i, t), (_, f) in zip(rows, fps) if places[f] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute_hits(rows, items) if not hit}
    return {i: expected(NAMES[0], t) for i, t in rows if i in clean}


def test_pipeline_matches_brute_force(spark):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == brute_pipeline(spark, SF_SMALL)
    assert 100 < len(got) < 200


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs.limit(40).withColumn("row", F.lit("extra")), SF_SMALL)
        assert out.columns == [*docs.columns, "row"], name


def test_stages_on_odd_and_empty_rows(spark, odd_docs, save):
    sf = save(benchmark=spark.createDataFrame([(1, "nothing here")], "item_id long, text string"))
    for rows in (odd_docs, odd_docs.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            assert function(spark, rows, sf).count() <= rows.count()


def test_every_operator_is_registered_once():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert {n for n in __spark_entry__.oracle_sql() if n.startswith("op")} == {
        "op2_exact_dedup", "op4_decontaminate", "op5_chat_format", "op10_warc", "op12_hard_negatives"}


def test_native_operators_plan_no_python(spark):
    for name in ("op2_exact_dedup", "op5_chat_format"):
        plan = __spark_entry__.queries()[name](spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_the_rest_stands_alone(tmp_path):
    """Without the subpackage and the pipeline module the entry still imports and has its other queries."""
    keep = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(REPO, tmp_path / "repo", ignore=keep)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and not any(k.startswith('op') for k in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", env=env, check=True, timeout=120)
