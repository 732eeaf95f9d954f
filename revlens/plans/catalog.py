"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import fixtures as FX
from revlens import schemas
from revlens.fixtures import hash32
from revlens.functions import sql as SF
from revlens.functions import text as T
from revlens.operators import aspects as A
from revlens.operators import evaluation as EV
from revlens.operators import features as FE
from revlens.operators import filters as FL
from revlens.operators import grouping as GR
from revlens.operators import joins as J
from revlens.operators import lexical as LX
from revlens.operators import models as MD
from revlens.operators import polarity as POL
from revlens.operators import products as PR
from revlens.operators import sampling as K
from revlens.operators import similar_index as SI
from revlens.operators import subwords as SW
from revlens.plans import aspect_job as AJ
from revlens.plans import cleaning
from revlens.session import materialize, scratch_path, stored
from revlens.sources import files as S

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def emoji(spark):
    return T.dictionary_to_map(FX.emoji_map(spark), "ch", "name")


# ---------------------------------------------------------------- cleaning
def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_reviews(FX.reviews(spark, sf_dir), FX.meta(spark, sf_dir), emoji=emoji(spark))


@register("clean_reviews")
def q_clean_reviews(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("clean_label_summary")
def q_clean_label_summary(spark, sf_dir):
    return cleaning.label_summary(cleaned(spark, sf_dir))


# ------------------------------------------------------------- text steps
def _noisy_step(fn):
    def q(spark, sf_dir):
        n = FX.noisy_reviews(spark, sf_dir)
        return n.select("review_id", fn(F.col("review_text")).alias("review_text"))
    return q


for _name, _fn in [
    ("normalize_newlines", T.normalize_newlines),
    ("strip_links_mentions", T.strip_links_mentions),
    ("strip_non_ascii", T.strip_non_ascii),
    ("strip_punctuation", T.strip_punctuation),
    ("clean_hashtags", T.clean_hashtags),
    ("filter_chars", T.filter_chars),
    ("collapse_spaces", T.collapse_spaces),
    ("strip_brackets", T.strip_brackets),
    ("strip_slashes", T.strip_slashes),
    ("strip_html_entities", T.strip_html_entities),
    ("strip_emoticons", T.strip_emoticons),
    ("strip_nonprintable", T.strip_nonprintable),
]:
    register(_name)(_noisy_step(_fn))


@register("demojize")
def q_demojize(spark, sf_dir):
    n = FX.noisy_reviews(spark, sf_dir)
    return n.select("review_id", T.demojize(F.col("review_text"), emoji(spark)).alias("review_text"))


@register("replace_markup")
def q_replace_markup(spark, sf_dir):
    n = FX.noisy_reviews(spark, sf_dir)
    t = F.col("review_text")
    return n.select("review_id", T.replace_br(t).alias("br_to_space"),
                    T.semicolon_to_period(t).alias("semicolon_to_period"),
                    T.newline_to_space(t).alias("newline_to_space"))


# ----------------------------------------------------------------- filters
@register("reviews_with_text")
def q_reviews_with_text(spark, sf_dir):
    return FL.with_text(FX.reviews(spark, sf_dir))


@register("vote_to_int")
def q_vote_to_int(spark, sf_dir):
    r = FX.reviews(spark, sf_dir)
    return r.select("review_id", "vote", FL.vote_as_int(F.col("vote")).alias("vote_int"))


@register("reviews_min_votes")
def q_reviews_min_votes(spark, sf_dir):
    return FL.min_votes(FX.reviews(spark, sf_dir), 5).select("review_id", "asin", "vote")


@register("rating_label")
def q_rating_label(spark, sf_dir):
    r = FX.reviews(spark, sf_dir)
    return r.select("review_id", "overall", FL.rating_label(F.col("overall")).alias("label"))


@register("label_casts")
def q_label_casts(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return c.select("review_id", F.col("label").cast("double").alias("label_double"),
                    F.col("label").cast("int").alias("label_int"))


@register("preview_rows")
def q_preview_rows(spark, sf_dir):
    return FL.preview(cleaned(spark, sf_dir).select("review_id", "asin", "label"), 10, ["review_id"])


@register("anti_join_books")
def q_anti_join_books(spark, sf_dir):
    r = FX.reviews(spark, sf_dir)
    return J.exclude_keys(r, FL.category_keys(FX.meta(spark, sf_dir))).select("review_id", "asin")


# ---------------------------------------------------------- sources


def raw_reviews(spark, sf_dir):
    """The review fixture under the raw source's field names."""
    r = FX.reviews(spark, sf_dir)
    d = FX.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), "source")
    return r.join(d, "review_id").select(
        "overall", "vote", F.lit(None).cast("string").alias("reviewTime"),
        F.col("reviewer_id").alias("reviewerID"), "asin", F.col("reviewer_id").alias("reviewerName"),
        F.col("review_text").alias("reviewText"), F.col("source").alias("summary"))


@register("scan_json_reviews")
def q_scan_json_reviews(spark, sf_dir):
    path = scratch_path(spark, "reviews-json")
    S.write_json(raw_reviews(spark, sf_dir), path)
    return S.read_json(spark, path, schemas.REVIEWS_RAW)


@register("scan_json_inferred")
def q_scan_json_inferred(spark, sf_dir):
    path = scratch_path(spark, "reviews-json-inferred")
    S.write_json(raw_reviews(spark, sf_dir), path)
    return S.read_json_inferred(spark, path)


@register("scan_csv_reviews")
def q_scan_csv_reviews(spark, sf_dir):
    path = scratch_path(spark, "reviews-csv")
    S.write_csv(raw_reviews(spark, sf_dir), path, header=True)
    return S.read_csv(spark, path, schemas.REVIEWS_RAW, header=True, multi_line=True)


KEYWORDS = ["Widget", "Widgets", "widget", "widgets"]


def _meta_lines_as_text(spark, sf_dir):
    path = scratch_path(spark, "meta-lines")
    S.write_text(FX.meta_lines(spark, sf_dir).select("value"), path)
    return S.read_text(spark, path)


@register("json_keyword_filter")
def q_json_keyword_filter(spark, sf_dir):
    return FL.json_keyword_filter(_meta_lines_as_text(spark, sf_dir), KEYWORDS)


@register("json_rejects")
def q_json_rejects(spark, sf_dir):
    return FL.json_rejects(_meta_lines_as_text(spark, sf_dir))


# -------------------------------------------------- products, joins (X1, J)

KPI_ANCHOR = "2000-01-01 00:00:00"


def kpis(spark, sf_dir):
    li = FX.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("asin"),
        F.col("l_quantity").alias("rating"), F.col("l_shipdate").alias("ts"))
    return PR.product_kpis(li, KPI_ANCHOR)


def products(spark, sf_dir):
    return PR.product_table(FX.meta(spark, sf_dir), kpis(spark, sf_dir))


@register("product_kpis")
def q_product_kpis(spark, sf_dir):
    return kpis(spark, sf_dir)


@register("products_with_similar")
def q_products_with_similar(spark, sf_dir):
    return J.attach(products(spark, sf_dir), FX.similar_products(spark, sf_dir), "asin", "inner")


@register("similar_enriched_wide")
def q_similar_enriched_wide(spark, sf_dir):
    p = products(spark, sf_dir)
    return J.enrich_slots_wide(J.attach(p, FX.similar_products(spark, sf_dir)), p)


@register("similar_enriched_long")
def q_similar_enriched_long(spark, sf_dir):
    p = products(spark, sf_dir)
    return J.enrich_slots_long(J.attach(p, FX.similar_products(spark, sf_dir)), p)


@register("clean_reviews_sql")
def q_clean_reviews_sql(spark, sf_dir):
    """T18 in plain SQL over the registered functions."""
    SF.register(spark, dict(FX.EMOJI_MAP))
    return spark.sql("""
        SELECT r.* EXCEPT (vote, review_text), vote_to_int(vote) AS vote, clean_review_text(review_text) AS review_text,
               rating_label(overall) AS label
        FROM {reviews} r LEFT ANTI JOIN (SELECT asin FROM {meta} WHERE main_cat = 'Books') b ON r.asin = b.asin
        WHERE review_text IS NOT NULL""", reviews=FX.reviews(spark, sf_dir), meta=FX.meta(spark, sf_dir))


@register("similar_products_indexed")
def q_similar_products_indexed(spark, sf_dir):
    """X2 through the index; labels of one cell are searched whole."""
    return PR.similar_wide(SI.similar_topk_indexed(FX.table(spark, sf_dir, "embeddings"), k=5))


@register("similar_products_topk")
def q_similar_products_topk(spark, sf_dir):
    e = FX.table(spark, sf_dir, "embeddings")
    return PR.similar_wide(PR.similar_topk(e, k=5))


# ------------------------------------------------------------ sampling (K)


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return K.stratified_split(cleaned(spark, sf_dir).select("review_id", "label"))


@register("holdout_split")
def q_holdout_split(spark, sf_dir):
    return K.holdout_split(cleaned(spark, sf_dir).select("review_id", "label"))


@register("union_splits")
def q_union_splits(spark, sf_dir):
    s = K.stratified_split(cleaned(spark, sf_dir).select("review_id", "label"))
    return K.union_all([s.filter((F.col("label") == c) & (F.col("split") == part))
                        for part in ("train", "val", "test") for c in (2.0, 1.0, 0.0)])


BALANCED_N = 150


@register("balanced_sample")
def q_balanced_sample(spark, sf_dir):
    c = cleaned(spark, sf_dir).select("review_id", "label")
    c = c.withColumn("order_key", hash32(F.concat(F.col("review_id").cast("string"), F.lit(":42"))))
    return K.cap_per_group(c, "label", BALANCED_N, "order_key", "review_id")


@register("shuffle_rows")
def q_shuffle_rows(spark, sf_dir):
    c = cleaned(spark, sf_dir).select("review_id", "label")
    return c.withColumn("shuffle_key", K.shuffle_key(F.col("review_id"))).orderBy("shuffle_key", "review_id")


# ---------------------------------------------------------- evaluation (E)


@register("eval_accuracy")
def q_eval_accuracy(spark, sf_dir):
    return EV.accuracy(FX.predictions(spark, sf_dir))


@register("eval_weighted")
def q_eval_weighted(spark, sf_dir):
    return EV.weighted_metrics(FX.predictions(spark, sf_dir))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(FX.predictions(spark, sf_dir), [0, 1, 2, 3])


@register("classification_report")
def q_classification_report(spark, sf_dir):
    return EV.classification_report(FX.predictions(spark, sf_dir))


@register("roc_curve")
def q_roc_curve(spark, sf_dir):
    return EV.roc_points(FX.predictions(spark, sf_dir), "label", "score", 2).select("threshold", "fpr", "tpr")


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return EV.roc_auc(FX.predictions(spark, sf_dir), "label", "score", 2)


# ------------------------------------------------------------- aspects (A)


# the tokens of a part are sorted by their heads in its task's memory
TOKEN_SPREAD = 3


def pairs(spark, sf_dir):
    return A.aspect_pairs(FX.tokens(spark, sf_dir, by_document=TOKEN_SPREAD), FX.FIXTURE_NEGATIONS, by_document=True)


def polarity_of(spark, sf_dir, phrases):
    return POL.phrase_polarity(phrases, FX.lexicon(spark, sf_dir), FX.negations(spark), FX.boosters(spark))


def scored_pairs(spark, sf_dir):
    return AJ.scored_aspect_pairs(FX.tokens(spark, sf_dir, by_document=TOKEN_SPREAD), FX.lexicon(spark, sf_dir), FX.negations(spark),
                                  FX.boosters(spark), FX.FIXTURE_NEGATIONS, by_document=True)


for _r in range(1, 8):
    def _rule_q(spark, sf_dir, _r=_r):
        return pairs(spark, sf_dir).filter(F.col("rule") == _r).select("doc_id", "asin", "idx", "aspect", "modifier")
    register(f"aspect_rule{_r}")(_rule_q)


@register("stopword_override")
def q_stopword_override(spark, sf_dir):
    return A.effective_stop(FX.tokens(spark, sf_dir)).select("doc_id", "idx", "text", "is_stop")


@register("aspect_pairs")
def q_aspect_pairs(spark, sf_dir):
    return scored_pairs(spark, sf_dir).select("doc_id", "asin", "rule", "idx", "aspect", "modifier", "polarity")


@register("sentence_polarity")
def q_sentence_polarity(spark, sf_dir):
    """A11 in full over every sentence of every document: sentences, mean and extreme polarities."""
    sentences = FX.table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[^.!?\n]+[.!?]*"), F.lit(0))).alias("phrase"))
    pol = materialize(POL.text_polarity(sentences, FX.lexicon(spark, sf_dir), FX.negations(spark), FX.boosters(spark)))
    return sentences.join(pol, "phrase").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("sentences"), F.round(F.avg("polarity"), 6).alias("mean_polarity"),
        F.min("polarity").alias("lowest"), F.max("polarity").alias("highest"))


@register("phrase_polarity")
def q_phrase_polarity(spark, sf_dir):
    phrases = pairs(spark, sf_dir).select(F.col("modifier").alias("phrase")).distinct()
    return polarity_of(spark, sf_dir, phrases)


def _freq(spark, sf_dir):
    return A.aspect_frequency(pairs(spark, sf_dir))


@register("aspect_frequency")
def q_aspect_frequency(spark, sf_dir):
    return _freq(spark, sf_dir).select("asin", "aspect", "mentions", F.col("first_seen.rule").alias("first_rule"),
                                       F.col("first_seen.doc_id").alias("first_doc_id"),
                                       F.col("first_seen.idx").alias("first_idx"))


@register("top_aspects")
def q_top_aspects(spark, sf_dir):
    return A.top_aspects(_freq(spark, sf_dir)).select("asin", "aspect", "mentions", "rank")


@register("aspect_map")
def q_aspect_map(spark, sf_dir):
    found = stored(pairs(spark, sf_dir), "pairs")
    top = materialize(A.top_aspects(A.aspect_frequency(found)))
    # the map holds top aspects only: no other pair is scored
    kept = stored(found.join(top, ["asin", "aspect"], "left_semi"), "top-pairs")
    sp = AJ.scored(kept, FX.lexicon(spark, sf_dir), FX.negations(spark), FX.boosters(spark))
    return A.aspect_map_pages(sp, top, page_size=AJ.MAP_PAGE_SIZE)


@register("product_aspects")
def q_product_aspects(spark, sf_dir):
    return AJ.product_aspect_table(FX.tokens(spark, sf_dir, by_document=TOKEN_SPREAD), FX.lexicon(spark, sf_dir), FX.negations(spark),
                                   FX.boosters(spark), FX.FIXTURE_NEGATIONS, by_document=True)


# ------------------------------------------------- lexical rewrites (T19-21)


@register("expand_contractions")
def q_expand_contractions(spark, sf_dir):
    c = cleaned(spark, sf_dir).select("review_id", "review_text")
    return LX.expand_contractions_df(c, "review_id", "review_text", FX.contraction_map(spark))


@register("expand_contractions_text")
def q_expand_contractions_text(spark, sf_dir):
    """T19 over whole raw texts: next to punctuation and line ends, any case."""
    return LX.expand_contractions_df(FX.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text",
                                     FX.contraction_map(spark))


@register("pos_filter")
def q_pos_filter(spark, sf_dir):
    return LX.pos_filter(FX.tokens(spark, sf_dir, by_document=True), FX.POS_KEEP_TAGS)


@register("lemmatize_lookup")
def q_lemmatize_lookup(spark, sf_dir):
    return LX.lemmatize(FX.tokens(spark, sf_dir, by_document=True), FX.lemma_map(spark))


# -------------------------------------------------- features, models (L, M5)


def tokenized(spark, sf_dir):
    """Cleaned reviews with their L1 words (native form of the Tokenizer)."""
    return cleaned(spark, sf_dir).select("review_id", "label", "review_text",
                                         T.tokenize(F.col("review_text")).alias("words"))


@register("tokenize_words")
def q_tokenize_words(spark, sf_dir):
    return FE.tokenizer().transform(cleaned(spark, sf_dir)).select("review_id", "words")


@register("hashing_tf")
def q_hashing_tf(spark, sf_dir):
    return FE.hashing_tf().transform(tokenized(spark, sf_dir)).select("review_id", "tf")


@register("idf_features")
def q_idf_features(spark, sf_dir):
    tf = FE.hashing_tf().transform(tokenized(spark, sf_dir)).select("review_id", "tf")
    return FE.idf().fit(tf).transform(tf).select("review_id", "features")


def word_lists(spark, sf_dir):
    """Tokenized cleaned reviews, checkpointed once: encoding reads them in two
    branches (vocabulary and rows) and must not clean the texts twice."""
    return materialize(tokenized(spark, sf_dir).select("review_id", "label", "words"))


@register("tfidf_exact")
def q_tfidf_exact(spark, sf_dir):
    return FE.tfidf_exact(tokenized(spark, sf_dir))


@register("build_vocabulary")
def q_build_vocabulary(spark, sf_dir):
    return FE.build_vocabulary(tokenized(spark, sf_dir))


def encoded(spark, sf_dir):
    t = word_lists(spark, sf_dir)
    return FE.encode_fixed_length(t, FE.build_vocabulary(t))


@register("encode_fixed_length")
def q_encode_fixed_length(spark, sf_dir):
    return encoded(spark, sf_dir)


@register("encode_subwords")
def q_encode_subwords(spark, sf_dir):
    """L9 with a supplied sub-word vocabulary (here cut from the words of the table)."""
    t = word_lists(spark, sf_dir)
    vocab = materialize(FX.subword_vocabulary(FE.explode_words(t, "words")))
    return SW.encode_subwords(t, vocab)


@register("score_batches")
def q_score_batches(spark, sf_dir):
    """A bag-of-ids model fitted on the training split (one distributed
    aggregation, fixed-size table), applied in Arrow batches to the test
    split of the encoded reviews."""
    enc = materialize(K.holdout_split(encoded(spark, sf_dir)))
    table = MD.fit_bag_model(enc.filter(F.col("split") == "train"))
    test = enc.filter(F.col("split") == "test")
    return MD.score_batches(test, MD.bag_model(table)).select("review_id", "targets", "prediction")


def _train_test(spark, sf_dir):
    """Holdout split of the cleaned reviews, checkpointed once: feature
    fitting, model fitting and scoring each re-read it instead of
    re-running the text cleaning."""
    # rebalance: AQE sizes the partitions by data volume, so each model
    # iteration aggregates one gradient per sizeable partition
    s = materialize(K.holdout_split(cleaned(spark, sf_dir).select("review_id", "review_text", "label"))
                    .hint("rebalance"))
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


@register("naive_bayes_predict")
def q_naive_bayes_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = MD.naive_bayes_pipeline().fit(train)
    return model.transform(test).select("review_id", "label", "prediction")


@register("naive_bayes_metrics")
def q_naive_bayes_metrics(spark, sf_dir):
    return EV.weighted_metrics(q_naive_bayes_predict(spark, sf_dir))


@register("logistic_predict")
def q_logistic_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    pred = MD.logistic_pipeline().fit(train).transform(test)
    return pred.select("review_id", "label", "prediction", MD.probabilities(pred).alias("probability"))


@register("features_as_array")
def q_features_as_array(spark, sf_dir):
    return q_logistic_predict(spark, sf_dir).select("review_id", "probability")


@register("model_round_trip")
def q_model_round_trip(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = MD.save_and_load(MD.naive_bayes_pipeline().fit(train), scratch_path(spark, "nb-model"))
    return model.transform(test).select("review_id", "label", "prediction")


@register("unique_row_id")
def q_unique_row_id(spark, sf_dir):
    return FL.unique_row_id(cleaned(spark, sf_dir).select("review_id", "asin", "label"), ["review_id"])


@register("surrogate_id")
def q_surrogate_id(spark, sf_dir):
    return FL.surrogate_id(cleaned(spark, sf_dir).select("review_id", "asin", "label"), ["review_id"])


# ------------------------------------------------------ grouping (G1 long)


def aspect_input(spark, sf_dir):
    """The aspect job's review input: cleaned, at least five votes, contractions expanded."""
    c = FL.min_votes(cleaned(spark, sf_dir), 5).select("asin", "review_id", "review_text")
    return LX.expand_contractions_df(c, "review_id", "review_text", FX.contraction_map(spark))


@register("reviews_per_product")
def q_reviews_per_product(spark, sf_dir):
    """G1 in long form over the aspect job's input."""
    # the ordering passes scan it several times (key sample, counts, rows) and must not re-clean texts
    return GR.reviews_per_product(materialize(aspect_input(spark, sf_dir)))


CHUNK_LIMIT = 20_000


@register("chunk_reviews")
def q_chunk_reviews(spark, sf_dir):
    """G2 over the aspect job's input (cleaned, >= 5 votes, contractions
    expanded), with a 20,000-character limit so the test data chunks; written once, by the operator."""
    return GR.greedy_chunks(aspect_input(spark, sf_dir), CHUNK_LIMIT)
