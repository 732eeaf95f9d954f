"""SQL functions by name, the JSON scan by VARIANT, and models read from files."""

import numpy as np
from pyspark.sql import functions as F

from revlens import fixtures as FX
from revlens.functions import sql as SF
from revlens.functions import text as T
from revlens.operators import models as MD
from revlens.sources import files as S
from tests.conftest import SF_SMALL, rows

STEPS = ["normalize_newlines", "strip_links_mentions", "strip_non_ascii", "strip_punctuation", "clean_hashtags", "filter_chars",
         "collapse_spaces", "replace_br", "semicolon_to_period", "newline_to_space", "strip_brackets", "strip_slashes",
         "strip_html_entities", "strip_emoticons", "strip_nonprintable"]


def test_sql_functions_equal_the_column_functions(spark):
    emoji = dict(FX.EMOJI_MAP)
    names = SF.register(spark, emoji, prefix="rl_")
    assert "rl_clean_review_text" in names
    odd = [("#a b #c_d #e",), ("x $5 & y;z",), ("[a] [[b]] c",), ("q &#1; &#2; 3&#4; /// :) :| it's \\ \"q\"",), ("<br />\n\r  é",), (None,), ("",),
           ("mail@x http://y.z t\x1f\x1fu \x00",)]
    df = spark.createDataFrame(odd, "t string").union(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text"))
    for step in STEPS:
        wrong = df.filter(~F.expr(f"rl_{step}(t)").eqNullSafe(getattr(T, step)(F.col("t"))))
        assert wrong.count() == 0, step
    assert df.filter(~F.expr("rl_demojize(t)").eqNullSafe(T.demojize(F.col("t"), emoji))).count() == 0
    assert df.filter(~F.expr("rl_clean_review_text(t)").eqNullSafe(T.clean_text(F.col("t"), emoji))).count() == 0
    plan = df.selectExpr("rl_clean_review_text(t)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    got = spark.sql("SELECT rl_vote_to_int('7') a, rl_vote_to_int(NULL) b, rl_vote_to_int('1,2') c, rl_rating_label(4.0D) d, rl_rating_label(NULL) e").head()
    assert tuple(got) == (7, 0, None, 2.0, 0.0)


def test_json_scan_by_variant(spark, tmp_path):
    lines = ['{"a": 1, "b": "x", "c": 1.5, "d": [1, 2], "e": {"f": null}}', '{"b": "y", "c": 2}', "not json", '{"a": null, "g": true}', ""]
    path = f"{tmp_path}/lines"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = S.read_json_inferred(spark, path)
    assert got.columns == ["a", "b", "c", "d", "e", "g"]
    assert dict(got.dtypes)["c"] == "double" and dict(got.dtypes)["a"] == "bigint"
    assert [tuple(r)[:4] for r in got.collect()] == [(1, "x", 1.5, [1, 2]), (None, "y", 2.0, None), (None,) * 4, (None,) * 4, (None,) * 4]
    S.write_text(spark.createDataFrame([], "value string"), f"{tmp_path}/none")
    assert S.read_json_inferred(spark, f"{tmp_path}/none").columns == []


def test_model_of_a_file_equals_the_model(spark, tmp_path):
    rng = np.random.default_rng(0)
    table = rng.normal(size=(65, 3))
    np.save(f"{tmp_path}/bag.npy", table)
    encoded = spark.createDataFrame([(i, rng.integers(0, 90, 16).tolist()) for i in range(200)], "review_id int, input_ids array<int>").repartition(3)
    direct = MD.score_batches(encoded, MD.bag_model(table), seq_len=16)
    shipped = MD.score_batches(encoded, MD.model_of_file(spark, f"{tmp_path}/bag.npy", MD.bag_model_loader()), seq_len=16)
    assert rows(direct, "review_id", "prediction") == rows(shipped, "review_id", "prediction")
    assert len({r["prediction"] for r in shipped.collect()}) > 1
