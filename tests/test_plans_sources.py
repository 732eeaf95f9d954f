import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from revlens import fixtures as FX
from revlens import schemas
from revlens.plans import catalog as C
from revlens.session import scratch_path
from revlens.sources import files as S
from tests.conftest import SF_SMALL
from tools.check import digest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
                "FlatMapGroupsInArrow")
# the three documented places where Python runs on workers
PYTHON_ALLOWED = {"score_batches", "similar_products_topk", "similar_products_indexed", "chunk_reviews"}


def test_no_python_workers_outside_the_documented_places(spark):
    for name, fn in C.QUERIES.items():
        if name in PYTHON_ALLOWED:      # may run Python (possibly inside checkpointed steps)
            continue
        p = plan(fn(spark, SF_SMALL))
        assert not any(node in p for node in PYTHON_NODES), name


def test_aspect_pairs_shuffle_once_by_document(spark):
    from revlens.operators import aspects as A
    p = A.aspect_pairs(FX.tokens(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    tok_exchanges = [ln for ln in p.splitlines() if "Exchange" in ln]
    assert len(tok_exchanges) == 1 and "doc_id" in tok_exchanges[0]


def test_top_k_uses_partial_group_limit(spark):
    from revlens.operators import aspects as A
    freq = spark.createDataFrame([("P1", "a", 3, (1, 1, 1))], "asin string, aspect string, mentions long, "
                                 "first_seen struct<rule:int,doc_id:long,idx:int>")
    p = A.top_aspects(freq)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_filters_pushed_to_scan(spark):
    p = plan(C.QUERIES["clean_reviews"](spark, SF_SMALL))
    assert "DataFilters: [CASE WHEN ((doc_id" in p


def test_json_csv_round_trip_tricky_text(spark):
    tricky = ['  lead and trail  ', 'quote " inside', 'multi\nline\r\ntext', 'comma, and ""', '', None]
    df = spark.createDataFrame([(float(i), str(i), None, "u", "P1", "n", t, "s") for i, t in enumerate(tricky)],
                               schemas.REVIEWS_RAW)
    pj, pc = scratch_path(spark, "t-json"), scratch_path(spark, "t-csv")
    S.write_json(df, pj)
    S.write_csv(df, pc)
    exp = sorted(map(tuple, df.collect()), key=repr)
    assert sorted(map(tuple, S.read_json(spark, pj).collect()), key=repr) == exp
    # CSV cannot tell an empty string from null (as with pandas' reader): '' comes back as null
    exp_csv = sorted((tuple(None if v == "" else v for v in r) for r in exp), key=repr)
    assert sorted(map(tuple, S.read_csv(spark, pc, schemas.REVIEWS_RAW, multi_line=True).collect()), key=repr) == exp_csv


def test_entry_and_contract(spark):
    out = E.entry(spark).collect()
    assert len(out) == 3
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("name", ["clean_reviews", "product_aspects", "eval_weighted", "encode_fixed_length",
                                  "similar_enriched_long", "balanced_sample", "roc_curve", "tfidf_exact",
                                  "clean_hashtags", "json_keyword_filter"])
def test_oracle_agrees_at_small_sf(spark, name):
    con = duckdb.connect()
    for t in FX.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_streaming_cleaning_equals_batch(spark, tmp_path):
    from revlens.plans.catalog import raw_reviews
    from revlens.plans.cleaning import clean_reviews
    from revlens.streaming.cleaning import start_cleaning
    src = str(tmp_path / "src")
    sink = str(tmp_path / "sink")
    raw = raw_reviews(spark, SF_SMALL)
    S.write_json(raw, src)
    q = start_cleaning(spark, src, sink, FX.meta(spark, SF_SMALL), checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = clean_reviews(S.read_json(spark, src).select(
        *[F.col(c).alias({"reviewText": "review_text", "reviewerID": "reviewer_id"}.get(c, c)) for c in raw.columns]),
        FX.meta(spark, SF_SMALL))
    assert streamed.count() == batch.count() > 0
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_hot_key_is_split_by_aqe(spark):
    """A key holding a third of all rows: with broadcasts disabled, the anti
    join of J1 must run as a skew-split sort-merge join, not one hot task."""
    from revlens.operators import joins as J
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(600_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
                F.concat(F.lit("P"), (F.col("id") % 50000).cast("string"))).alias("asin"), "id")
        keys = spark.range(0, 50000, 7).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("asin"))
        out = J.exclude_keys(rows, keys)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("parts", ["3", "37"])
def test_order_dependent_results_independent_of_partitioning(spark, parts):
    con = duckdb.connect()
    for t in FX.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for name in ["roc_curve", "build_vocabulary", "reviews_per_product", "chunk_reviews", "aspect_map",
                     "balanced_sample", "top_aspects"]:
            df = E.queries()[name](spark, SF_SMALL)
            res = con.execute(E.oracle_sql()[name])
            assert digest(df.columns, [tuple(r) for r in df.collect()]) == \
                digest([d[0] for d in res.description], res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
