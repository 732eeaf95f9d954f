from pyspark.sql import functions as F

from revlens import fixtures as FX
from revlens.operators import filters as FL
from revlens.operators import joins as J
from revlens.plans import catalog as C
from tests.conftest import SF_SMALL, rows


def test_vote_and_label_edges(spark):
    df = spark.createDataFrame([(None, None), ("1,234", 4.0), ("7", 2.5), ("x", 1.0)], "vote string, overall float")
    out = df.select(FL.vote_as_int(F.col("vote")).alias("v"), FL.vote_as_int(F.col("vote"), True).alias("v2"),
                    FL.rating_label(F.col("overall")).alias("l")).collect()
    assert [(r.v, r.v2, r.l) for r in out] == [(0, 0, 0.0), (None, 1234, 2.0), (7, 7, 1.0), (None, None, 0.0)]


def test_anti_join_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "B")], "id int, asin string")
    keys = spark.createDataFrame([("A",), (None,)], "asin string")
    assert rows(J.exclude_keys(df, keys), "id") == [(2,), (3,)]


def test_json_filter_and_rejects(spark):
    lines = spark.createDataFrame([('{"a": "Widget"}',), ('{"a": "x"}',), ('{"a": "Widget"',), ("NaN",)], "value string")
    assert rows(FL.json_keyword_filter(lines, ["Widget"])) == [('{"a": "Widget"}',)]
    assert rows(FL.json_rejects(lines)) == sorted([('{"a": "Widget"',), ("NaN",)])


def test_wide_equals_long_enrichment(spark):
    p = C.products(spark, SF_SMALL)
    base = J.attach(p, FX.similar_products(spark, SF_SMALL))
    wide = J.enrich_slots_wide(base, p)
    longf = J.enrich_slots_long(base, p)
    assert sorted(wide.columns) == sorted(longf.columns)
    assert wide.exceptAll(longf.select(*wide.columns)).count() == 0
    assert longf.select(*wide.columns).exceptAll(wide).count() == 0


def test_null_slot_keys(spark):
    base = spark.createDataFrame([("A", "B", None, "Z", "A", "B")],
                                 "asin string, sim_prod1 string, sim_prod2 string, sim_prod3 string, "
                                 "sim_prod4 string, sim_prod5 string")
    prods = spark.createDataFrame([("A", "a"), ("B", "b"), (None, "nullkey")], "asin string, product_name string")
    w = J.enrich_slots_wide(base, prods, attrs=["product_name"]).first()
    assert (w.product_name_sim1, w.product_name_sim2, w.product_name_sim3) == ("b", None, None)
    w2 = J.enrich_slots_wide(base, prods, attrs=["product_name"], null_keys_match=True).first()
    assert w2.product_name_sim2 == "nullkey"
    lg = J.enrich_slots_long(base, prods, attrs=["product_name"]).first()
    assert (lg.product_name_sim1, lg.product_name_sim2, lg.product_name_sim4) == ("b", None, "a")


def test_json_keywords_are_literal(spark):
    lines = spark.createDataFrame([('{"a": "a.b"}',), ('{"a": "axb"}',), ('{"a": "c+d"}',), ('{"a": "[x]"}',)],
                                  "value string")
    assert rows(FL.json_keyword_filter(lines, ["a.b", "c+d", "[x]"])) == \
        sorted([('{"a": "a.b"}',), ('{"a": "c+d"}',), ('{"a": "[x]"}',)])
