"""End-to-end file jobs on files written from the sf0.001 fixtures."""

from pyspark.sql import functions as F

from revlens import fixtures as FX
from revlens.plans import catalog as C
from revlens.plans import jobs
from revlens.sources import files as S
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark, tmp_path):
    d = str(tmp_path)
    S.write_json(C.raw_reviews(spark, SF_SMALL), f"{d}/reviews")
    S.write_json(FX.meta(spark, SF_SMALL).select("asin", "main_cat"), f"{d}/meta")
    S.write_csv(FX.emoji_map(spark), f"{d}/emoji")
    clean = jobs.preprocess(spark, f"{d}/reviews", f"{d}/meta", f"{d}/clean", emoji_path=f"{d}/emoji")
    exp = C.QUERIES["clean_reviews"](spark, SF_SMALL)
    back = jobs.read_clean(spark, f"{d}/clean")
    assert back.count() == exp.count() == clean.count()
    assert sorted(r.review_text for r in back.collect()) == sorted(r.review_text for r in exp.collect())

    FX.tokens(spark, SF_SMALL).write.parquet(f"{d}/tokens")
    S.write_csv(FX.lexicon(spark, SF_SMALL), f"{d}/lexicon")
    S.write_csv(FX.boosters(spark), f"{d}/boosters")
    asp = jobs.extract_aspects(spark, f"{d}/tokens", f"{d}/lexicon", f"{d}/aspects",
                               negations=FX.FIXTURE_NEGATIONS, scorer_negations=FX.FIXTURE_NEGATIONS,
                               boosters_path=f"{d}/boosters")
    ref = C.QUERIES["product_aspects"](spark, SF_SMALL)
    assert asp.exceptAll(ref.select(*asp.columns)).count() == 0 and asp.count() == ref.count()

    m = jobs.train_classifier(spark, f"{d}/clean", f"{d}/model", f"{d}/pred").first()
    assert 0.0 <= m.weighted_f1 <= 1.0
    ev = jobs.evaluate(spark, f"{d}/pred")
    total = sum(r.pred_0 + r.pred_1 + r.pred_2 for r in ev["confusion"].collect())
    assert total == spark.read.option("header", "true").csv(f"{d}/pred").count()

    S.write_csv(C.products(spark, SF_SMALL), f"{d}/products")
    S.write_csv(FX.similar_products(spark, SF_SMALL), f"{d}/similar")
    enr = jobs.enrich_products(spark, f"{d}/products", f"{d}/similar", f"{d}/enriched")
    assert enr.count() == C.QUERIES["similar_enriched_long"](spark, SF_SMALL).count()

    S.write_text(FX.meta_lines(spark, SF_SMALL).select("value"), f"{d}/lines")
    kept = jobs.filter_metadata(spark, f"{d}/lines", C.KEYWORDS, f"{d}/kept", f"{d}/rejects")
    assert kept.count() == C.QUERIES["json_keyword_filter"](spark, SF_SMALL).count()
    assert S.read_text(spark, f"{d}/rejects").count() == C.QUERIES["json_rejects"](spark, SF_SMALL).count()
