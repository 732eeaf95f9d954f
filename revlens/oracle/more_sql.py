"""DuckDB twins for sources, products, joins, sampling, evaluation, aspects."""

from __future__ import annotations

from revlens import dictionaries as D
from revlens import fixtures as FX
from revlens.operators.sampling import split_edges
from revlens.oracle.catalog_sql import SQL, cleaned_sql
from revlens.oracle.fixtures_sql import HASH32, with_views

# ------------------------------------------------------------------ sources
RAW = """SELECT r.overall, r.vote, CAST(NULL AS VARCHAR) AS reviewTime, r.reviewer_id AS reviewerID, r.asin,
       r.reviewer_id AS reviewerName, r.review_text AS reviewText, d.source AS summary
FROM reviews r JOIN documents d ON d.doc_id = r.review_id"""
SQL["scan_json_reviews"] = with_views(["reviews"], RAW)
SQL["scan_csv_reviews"] = with_views(["reviews"], RAW)
SQL["scan_json_inferred"] = with_views(["reviews"], """
SELECT CAST(r.overall AS DOUBLE) AS overall, r.asin, r.review_text AS reviewText, r.reviewer_id AS reviewerID,
       r.reviewer_id AS reviewerName, d.source AS summary, r.vote
FROM reviews r JOIN documents d ON d.doc_id = r.review_id""")
_kw = " OR ".join(f"contains(value, '{k}')" for k in ["Widget", "Widgets", "widget", "widgets"])
SQL["json_keyword_filter"] = with_views(["meta_lines"],
                                        f"SELECT value FROM meta_lines WHERE json_valid(value) AND ({_kw})")
SQL["json_rejects"] = with_views(["meta_lines"], "SELECT value FROM meta_lines WHERE NOT json_valid(value)")

# ------------------------------------------------------------ products, X1
ANCHOR = "TIMESTAMP '2000-01-01 00:00:00'"
KPIS = f"""
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS asin,
       round(avg(l_quantity), 6) AS avg_rating, count(*) AS total_ratings,
       round(avg(l_quantity) FILTER (WHERE l_shipdate > {ANCHOR} - INTERVAL 1 YEAR AND l_shipdate <= {ANCHOR}), 6)
         AS avg_rating_last_year,
       count(*) FILTER (WHERE l_shipdate > {ANCHOR} - INTERVAL 1 YEAR AND l_shipdate <= {ANCHOR}) AS num_reviews_last_year,
       count(*) FILTER (WHERE l_shipdate > {ANCHOR} - INTERVAL 1 MONTH AND l_shipdate <= {ANCHOR}) AS num_reviews_last_month
FROM lineitem GROUP BY l_partkey"""
PRODUCTS = """
SELECT m.asin, m.title AS product_name, m.title AS product_description, m.main_cat AS product_category, m.brand,
       k.avg_rating, k.total_ratings, k.avg_rating_last_year, k.num_reviews_last_year, k.num_reviews_last_month
FROM meta m LEFT JOIN kpis k ON k.asin = m.asin"""
SQL["product_kpis"] = KPIS.strip()
PW = ("pw", "SELECT p.*, s.* EXCLUDE (asin) FROM products p JOIN similar_products s ON s.asin = p.asin")
SQL["products_with_similar"] = with_views(["meta", "similar_products"], "SELECT * FROM pw",
                                          [("kpis", KPIS), ("products", PRODUCTS), PW])
ATTRS = ["product_name", "brand", "avg_rating", "total_ratings", "avg_rating_last_year",
         "num_reviews_last_year", "num_reviews_last_month"]
_sel = ", ".join(f"s{s}.{a} AS {a}_sim{s}" for s in range(1, 6) for a in ATTRS)
_joins = " ".join(f"LEFT JOIN products s{s} ON s{s}.asin = pw.sim_prod{s}" for s in range(1, 6))
_enriched = f"SELECT pw.*, {_sel} FROM pw {_joins}"
SQL["similar_enriched_wide"] = with_views(["meta", "similar_products"], _enriched,
                                          [("kpis", KPIS), ("products", PRODUCTS), PW])
SQL["similar_enriched_long"] = SQL["similar_enriched_wide"]

SQL["similar_products_topk"] = """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM v),
p AS (SELECT a.vec_id AS id, b.vec_id AS nbr, round(list_dot_product(a.u, b.u), 6) AS sim
      FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT id, nbr, row_number() OVER (PARTITION BY id ORDER BY sim DESC, nbr) AS rk FROM p)
SELECT 'P' || CAST(id AS VARCHAR) AS asin, """ + ", ".join(
    f"max(CASE WHEN rk = {k} THEN 'P' || CAST(nbr AS VARCHAR) END) AS sim_prod{k}" for k in range(1, 6)) + """
FROM r WHERE rk <= 5 GROUP BY id"""

SQL["similar_products_indexed"] = SQL["similar_products_topk"]  # exact where a label is one cell

# ----------------------------------------------------------------- sampling
def _split(key, weights, names, seed=42):
    b = HASH32(f"CAST({key} AS VARCHAR) || ':{seed}'")
    parts = [f"WHEN {b} < {e} THEN '{n}'" for e, n in zip(split_edges(weights), names)]
    return f"CASE {' '.join(parts)} ELSE '{names[-1]}' END"


SQL["stratified_split"] = cleaned_sql(
    f"SELECT review_id, label, {_split('review_id', [0.6, 0.2, 0.2], ['train', 'val', 'test'])} AS split FROM cleaned")
SQL["holdout_split"] = cleaned_sql(
    f"SELECT review_id, label, {_split('review_id', [0.7, 0.3], ['train', 'test'])} AS split FROM cleaned")
SQL["union_splits"] = cleaned_sql(
    f"SELECT * FROM (SELECT review_id, label, {_split('review_id', [0.6, 0.2, 0.2], ['train', 'val', 'test'])} AS split "
    "FROM cleaned)")
SQL["balanced_sample"] = cleaned_sql(f"""
SELECT review_id, label, order_key FROM (
  SELECT review_id, label, {HASH32("CAST(review_id AS VARCHAR) || ':42'")} AS order_key,
         row_number() OVER (PARTITION BY label ORDER BY {HASH32("CAST(review_id AS VARCHAR) || ':42'")}, review_id) AS rn
  FROM cleaned) WHERE rn <= 150""")
SQL["shuffle_rows"] = cleaned_sql(
    f"SELECT review_id, label, {HASH32(chr(39).join(['CAST(review_id AS VARCHAR) || ', '#42', '']))} AS shuffle_key "
    "FROM cleaned ORDER BY shuffle_key, review_id")

# --------------------------------------------------------------- evaluation
PC = [
    ("counts", """SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n
                  FROM predictions GROUP BY ALL"""),
    ("cls", "SELECT label AS cls FROM counts UNION SELECT prediction FROM counts"),
    ("pc0", """SELECT c.cls,
          coalesce((SELECT sum(n) FROM counts WHERE label = c.cls), 0) AS support,
          coalesce((SELECT sum(n) FROM counts WHERE prediction = c.cls), 0) AS predicted,
          coalesce((SELECT sum(n) FROM counts WHERE label = c.cls AND prediction = c.cls), 0) AS tp
        FROM cls c"""),
    ("pc1", """SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc0"""),
    ("pc", """SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
              AS f1 FROM pc1"""),
]


def _ev(body):
    return with_views(["reviews", "predictions"], body, PC)


SQL["eval_accuracy"] = with_views(["reviews", "predictions"],
                                  "SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy "
                                  "FROM predictions")
SQL["eval_weighted"] = _ev("""SELECT round(sum(support * precision) / sum(support), 12) AS weighted_precision,
  round(sum(support * recall) / sum(support), 12) AS weighted_recall,
  round(sum(support * f1) / sum(support), 12) AS weighted_f1,
  round(sum(tp) / sum(support), 12) AS accuracy FROM pc WHERE support > 0""")
SQL["confusion_matrix"] = _ev("SELECT CAST(label AS INTEGER) AS label, " + ", ".join(
    f"CAST(sum(CASE WHEN prediction = {k} THEN n ELSE 0 END) AS BIGINT) AS pred_{k}" for k in range(4))
    + ", CAST(sum(CASE WHEN prediction IN (0, 1, 2, 3) THEN 0 ELSE n END) AS BIGINT) AS pred_other"
    + " FROM (SELECT * FROM counts UNION ALL SELECT DISTINCT prediction, NULL, 0 FROM counts) GROUP BY label")
SQL["classification_report"] = _ev("""
SELECT CAST(CAST(cls AS INTEGER) AS VARCHAR) AS class, round(precision, 12) AS precision, round(recall, 12) AS recall,
       round(f1, 12) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 12), CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'macro avg', round(avg(precision), 12), round(avg(recall), 12), round(avg(f1), 12),
       CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(support * precision) / sum(support), 12),
       round(sum(support * recall) / sum(support), 12), round(sum(support * f1) / sum(support), 12),
       CAST(sum(support) AS BIGINT) FROM pc""")
ROC = [
    ("s", """SELECT score AS threshold, CAST(sum(CASE WHEN label = 2 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN label = 2 THEN 0 ELSE 1 END) AS BIGINT) AS fp FROM predictions GROUP BY score"""),
    ("c", """SELECT threshold, tp, fp, CAST(sum(tp) OVER (ORDER BY threshold DESC) AS BIGINT) AS cum_tp,
             CAST(sum(fp) OVER (ORDER BY threshold DESC) AS BIGINT) AS cum_fp FROM s"""),
    ("t", "SELECT sum(tp) AS P, sum(fp) AS N FROM s"),
]
SQL["roc_curve"] = with_views(["reviews", "predictions"], """
SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(cum_fp AS DOUBLE) / N AS fpr, CAST(cum_tp AS DOUBLE) / P AS tpr FROM c, t
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0 FROM t WHERE P IS NOT NULL""", ROC)
SQL["roc_auc"] = with_views(["reviews", "predictions"], """
SELECT round(sum(CAST(fp AS DOUBLE) * CAST(2 * cum_tp - tp AS DOUBLE)) / (2.0 * max(P) * max(N)), 10) AS auc
FROM c, t""", ROC)

# ------------------------------------------------------------------ aspects
PRON = ", ".join(f"'{w}'" for w in D.PRODUCT_PRONOUNS)
NEGS = ", ".join(f"'{w}'" for w in FX.FIXTURE_NEGATIONS)


def _asp(x):
    return f"CASE WHEN {x} IN ({PRON}) THEN 'product' ELSE {x} END"


def _pfx(p, m):
    return f"CASE WHEN {p} IS NOT NULL THEN {p} || ' ' || {m} ELSE {m} END"


ASPECT_CTES = [
    ("te", f"SELECT doc_id, asin, idx, text, head_idx, dep, pos, tag, is_stop AND NOT text IN ({PRON}) AS is_stop "
           "FROM tokens"),
    ("ch", "SELECT * FROM te WHERE idx <> head_idx"),
    ("fa", "SELECT doc_id, head_idx AS idx, arg_min(text, idx) AS first_adv FROM ch WHERE dep = 'advmod' "
           "GROUP BY doc_id, head_idx"),
    ("c", "SELECT ch.*, fa.first_adv FROM ch LEFT JOIN fa ON fa.doc_id = ch.doc_id AND fa.idx = ch.idx"),
    ("g", f"""SELECT doc_id, head_idx AS idx,
  arg_max(text, idx) FILTER (WHERE dep = 'nsubj' AND NOT is_stop) AS nsubj,
  arg_max(text, idx) FILTER (WHERE dep IN ('nsubj', 'nsubjpass') AND NOT is_stop) AS nsubj_any,
  arg_max(text, idx) FILTER (WHERE dep = 'dobj' AND pos = 'ADJ' AND NOT is_stop) AS dobj_adj,
  arg_max(text, idx) FILTER (WHERE dep = 'neg') AS neg,
  arg_max(text, idx) FILTER (WHERE dep = 'acomp' AND NOT is_stop) AS acomp,
  arg_max(CASE WHEN dep = 'neg' THEN text ELSE 'not' END, idx) FILTER (WHERE (dep = 'aux' AND tag = 'MD') OR dep = 'neg')
    AS pfx_modal,
  arg_max({_pfx('first_adv', 'text')}, idx) FILTER (WHERE dep = 'advmod' AND NOT is_stop) AS advmod,
  arg_max(text, idx) FILTER (WHERE dep = 'cop' AND NOT is_stop) AS cop,
  arg_max(text, idx) FILTER (WHERE dep = 'attr' AND NOT is_stop) AS attr,
  bool_or(dep = 'det' AND text IN ({NEGS})) AS det_neg
FROM c GROUP BY doc_id, head_idx"""),
    ("hg", "SELECT t.doc_id, t.asin, t.idx, t.text AS h_text, t.pos AS h_pos, t.is_stop AS h_stop, "
           "g.* EXCLUDE (doc_id, idx) FROM te t JOIN g ON g.doc_id = t.doc_id AND g.idx = t.idx"),
]
_m2, _m3, _m4, _m7 = _pfx("neg", "dobj_adj"), _pfx("pfx_modal", "acomp"), _pfx("neg", "advmod"), _pfx("neg", "attr")
_rules = [
    (2, "nsubj", _m2, _m2, "TRUE"),
    (3, "nsubj", _m3, _m3, "TRUE"),
    (4, "nsubj_any", _m4, _m4, "TRUE"),
    (5, "nsubj", "h_text", _m4, "cop IS NOT NULL"),
    (6, "nsubj", "h_text", "h_text", "h_pos = 'INTJ' AND NOT h_stop"),
    (7, "nsubj", _m7, _m7, "TRUE"),
]
_r27 = "\nUNION ALL ".join(
    f"SELECT doc_id, asin, {r} AS rule, idx, {_asp(a)} AS aspect, {m} AS modifier, {p} AS score_phrase FROM hg "
    f"WHERE {a} IS NOT NULL AND ({m}) IS NOT NULL AND {cond}" for r, a, m, p, cond in _rules)
_m1 = "concat_ws(' ', CASE WHEN gn.det_neg THEN 'not' END, fa.first_adv, a.text)"
_r1 = f"""SELECT a.doc_id, a.asin, 1 AS rule, a.idx, {_asp('h.text')} AS aspect, {_m1} AS modifier, {_m1} AS score_phrase
FROM te a JOIN te h ON h.doc_id = a.doc_id AND h.idx = a.head_idx
LEFT JOIN fa ON fa.doc_id = a.doc_id AND fa.idx = a.idx
LEFT JOIN g gn ON gn.doc_id = a.doc_id AND gn.idx = a.head_idx
WHERE a.dep = 'amod' AND NOT a.is_stop"""
ASPECT_CTES.append(("pairs", _r1 + "\nUNION ALL " + _r27))


def polarity_ctes(phrases_sql: str) -> list[tuple[str, str]]:
    def step(cur, j, decay):
        s = f"(coalesce(b{j}, 0.0) * {decay})"
        s = f"(CASE WHEN {cur} < 0 THEN -{s} ELSE {s} END)"
        shifted = f"({cur} + {s})"
        neg = f"(CASE WHEN n{j} THEN {shifted} * ({D.NEGATION_SCALAR}) ELSE {shifted} END)"
        return f"CASE WHEN l{j} IS NOT NULL AND NOT l{j} THEN {neg} ELSE {cur} END"
    lags = ", ".join(f"lag(in_lex, {j}) OVER w AS l{j}, lag(boost, {j}) OVER w AS b{j}, lag(neg, {j}) OVER w AS n{j}"
                     for j in (1, 2, 3))
    return [
        ("phr", phrases_sql),
        ("pw", "SELECT phrase, unnest(range(len(ws))) AS pos, unnest(ws) AS w FROM "
               "(SELECT phrase, string_split(phrase, ' ') AS ws FROM phr)"),
        ("pws", r"""SELECT phrase, pos, w, lower(CASE WHEN length(regexp_replace(w, '^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$', '', 'g')) <= 2
               THEN w ELSE regexp_replace(w, '^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$', '', 'g') END) AS wl FROM pw"""),
        ("pj", """SELECT pw.phrase, pw.pos, lx.valence IS NOT NULL AS in_lex,
       CASE WHEN bs.scalar IS NULL THEN lx.valence END AS v, bs.scalar AS boost,
       (ng.word IS NOT NULL OR contains(pw.wl, 'n''t')) AS neg
FROM pws pw LEFT JOIN lexicon lx ON lx.word = pw.wl LEFT JOIN negations ng ON ng.word = pw.wl
LEFT JOIN boosters bs ON bs.word = pw.wl"""),
        ("pl", f"SELECT phrase, v, {lags} FROM pj WINDOW w AS (PARTITION BY phrase ORDER BY pos)"),
        ("p1", f"SELECT *, {step('v', 1, D.BOOSTER_DECAY[0])} AS c1 FROM pl"),
        ("p2", f"SELECT *, {step('c1', 2, D.BOOSTER_DECAY[1])} AS c2 FROM p1"),
        ("p3", f"SELECT *, {step('c2', 3, D.BOOSTER_DECAY[2])} AS c3 FROM p2"),
        ("pol", f"""SELECT phrase, round(coalesce(sum(c3), 0.0) / sqrt(coalesce(sum(c3), 0.0) * coalesce(sum(c3), 0.0)
         + {D.NORMALIZE_ALPHA}), 4) AS polarity FROM p3 GROUP BY phrase"""),
    ]


ASP_VIEWS = ["tokens", "lexicon", "negations", "boosters"]


def aspect_sql(body, extra=None):
    return with_views(ASP_VIEWS, body, ASPECT_CTES + (extra or []))


for _r in range(1, 8):
    _one = _r1 if _r == 1 else _r27.split("\nUNION ALL ")[_r - 2]
    SQL[f"aspect_rule{_r}"] = with_views(["tokens"], f"SELECT doc_id, asin, idx, aspect, modifier FROM ({_one})", ASPECT_CTES[:-1])
SQL["stopword_override"] = aspect_sql("SELECT doc_id, idx, text, is_stop FROM te")
SCORED = polarity_ctes("SELECT DISTINCT score_phrase AS phrase FROM pairs WHERE score_phrase IS NOT NULL") + [
    ("sp", "SELECT p.doc_id, p.asin, p.rule, p.idx, p.aspect, p.modifier, coalesce(pol.polarity, 0.0) AS polarity "
           "FROM pairs p LEFT JOIN pol ON pol.phrase = p.score_phrase"),
    ("freq", "SELECT asin, aspect, count(*) AS mentions, min({'rule': rule, 'doc_id': doc_id, 'idx': idx}) AS fs "
             "FROM sp GROUP BY asin, aspect"),
    ("top", "SELECT * FROM (SELECT asin, aspect, mentions, CAST(row_number() OVER (PARTITION BY asin ORDER BY "
            "mentions DESC, fs.rule, fs.doc_id, fs.idx) AS INTEGER) AS rank FROM freq) WHERE rank <= 5"),
]
SQL["aspect_pairs"] = aspect_sql("SELECT * FROM sp", SCORED)
SQL["phrase_polarity"] = aspect_sql("SELECT phrase, polarity FROM pol",
                                    polarity_ctes("SELECT DISTINCT modifier AS phrase FROM pairs"))
SQL["aspect_frequency"] = aspect_sql(
    "SELECT asin, aspect, mentions, fs.rule AS first_rule, fs.doc_id AS first_doc_id, fs.idx AS first_idx FROM freq",
    SCORED)
SQL["top_aspects"] = aspect_sql("SELECT asin, aspect, mentions, rank FROM top", SCORED)
SQL["product_aspects"] = aspect_sql(
    "SELECT sp.asin, sp.aspect, sp.modifier, sp.polarity FROM sp JOIN top ON top.asin = sp.asin AND top.aspect = sp.aspect",
    SCORED)

# ------------------------------------------------------- lexical rewrites
_cm = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FX.CONTRACTION_MAP)
SQL["expand_contractions"] = cleaned_sql(
    f"SELECT review_id, array_to_string(list_transform(string_split(review_text, ' '), "
    f"lambda w: CASE w {_cm} ELSE w END), ' ') AS review_text FROM cleaned")
# words with their apostrophes, and what stands between them; quotes at a word's ends stay outside
_word = "regexp_extract(t, '(?s)^([''’]*)(.*?)([''’]*)$', {})"
_new = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FX.CONTRACTION_MAP)
_new = f"(CASE lower({_word.format(2)}) {_new} ELSE {_word.format(2)} END)"
_raised = f"(CASE WHEN {_word.format(2)}[1] <> lower({_word.format(2)}[1]) THEN upper({_new}[1]) || {_new}[2:] ELSE {_new} END)"
SQL["expand_contractions_text"] = f"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[\\pL\\pN_''’]+|[^\\pL\\pN_''’]+'),
       lambda t: {_word.format(1)} || {_raised} || {_word.format(3)}), '') AS text FROM documents"""
_tags = ", ".join(f"'{t}'" for t in FX.POS_KEEP_TAGS)
SQL["pos_filter"] = with_views(["tokens"], f"""
SELECT doc_id, ' ' || coalesce(string_agg(text || ' ', '' ORDER BY idx) FILTER (WHERE tag IN ({_tags})), '') AS text
FROM tokens GROUP BY doc_id""")
_lm = " ".join(f"WHEN '{p}|{w}' THEN '{l}'" for w, p, l in FX.LEMMA_MAP)
SQL["lemmatize_lookup"] = with_views(["tokens"], f"""
SELECT doc_id, string_agg(CASE (CASE WHEN contains(lower(tag), 'v') THEN 'v' ELSE 'n' END) || '|' || text {_lm}
                          ELSE text END, ' ' ORDER BY idx) AS text
FROM tokens GROUP BY doc_id""")

# ---------------------------------------------------------------- features
TOK = ("tok", "SELECT review_id, label, string_split_regex(review_text, '[ \\t\\n\\x0b\\f\\r]') AS words FROM cleaned")
SQL["tokenize_words"] = cleaned_sql("SELECT review_id, words FROM tok", [TOK])
SQL["tfidf_exact"] = cleaned_sql("""
SELECT review_id, word, tf, df, round(ln((m + 1.0) / (df + 1.0)), 10) AS idf,
       round(tf * ln((m + 1.0) / (df + 1.0)), 10) AS tfidf
FROM tf JOIN dfr USING (word), (SELECT count(*) AS m FROM tok)""", [
    TOK, ("tf", "SELECT review_id, word, count(*) AS tf FROM (SELECT review_id, unnest(words) AS word FROM tok) "
                "GROUP BY ALL"),
    ("dfr", "SELECT word, count(*) AS df FROM tf GROUP BY word")])
VOCAB = ("vocab", f"""SELECT word, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, word) + {D.FIRST_WORD_ID - 1} AS INTEGER) AS id
FROM (SELECT word, count(*) AS cnt FROM (SELECT unnest(words) AS word FROM tok) GROUP BY word)""")
SQL["build_vocabulary"] = cleaned_sql("SELECT * FROM vocab", [TOK, VOCAB])
_SUBWORDS = [
    TOK,
    ("dw", "SELECT DISTINCT word FROM (SELECT unnest(words) AS word FROM tok) WHERE length(word) > 0"),
    ("parts", """SELECT DISTINCT word, p > 1 AS cont, substr(word, p, n) AS body
FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM dw), (VALUES (1), (2), (3), (4)) l(n) WHERE p + n - 1 <= length(word)"""),
    ("sv", """SELECT cont, body, CAST(row_number() OVER (ORDER BY CASE WHEN cont THEN '##' ELSE '' END || body) + 3 AS INTEGER) AS id
FROM (SELECT cont, body FROM parts GROUP BY ALL HAVING count(*) >= 3)"""),
    ("cut", """SELECT word, 1 AS i, []::INTEGER[] AS ids FROM dw WHERE length(word) <= 100
UNION ALL SELECT word, i + n, ids || [id] FROM (
  SELECT c.word, c.i, c.ids, n, v.id, row_number() OVER (PARTITION BY c.word ORDER BY n DESC) AS r
  FROM cut c, (VALUES (1), (2), (3), (4)) l(n), sv v
  WHERE c.i + n - 1 <= length(c.word) AND v.body = substr(c.word, c.i, n) AND v.cont = (c.i > 1)) WHERE r = 1"""),
    ("wp", f"""SELECT dw.word, coalesce(c.ids, [{D.UNK_ID}]) AS ids
FROM dw LEFT JOIN cut c ON c.word = dw.word AND c.i = length(dw.word) + 1"""),
]
SQL["encode_subwords"] = cleaned_sql(f"""
SELECT review_id, CAST([{D.CLS_ID}] || ids || [{D.SEP_ID}] || list_resize([]::INTEGER[], {D.MAX_LEN - 2} - len(ids), {D.PAD_ID})
                       AS INTEGER[]) AS input_ids,
       CAST(list_resize([]::INTEGER[], len(ids) + 2, 1) || list_resize([]::INTEGER[], {D.MAX_LEN - 2} - len(ids), 0)
            AS INTEGER[]) AS attention_mask,
       CAST(label AS INTEGER) AS targets
FROM (SELECT tok.review_id, tok.label, coalesce(e.ids, []::INTEGER[])[1:{D.MAX_LEN - 2}] AS ids
      FROM tok LEFT JOIN (SELECT review_id, flatten(list(wp.ids ORDER BY pos)) AS ids
            FROM (SELECT review_id, unnest(range(len(words))) AS pos, unnest(words) AS word FROM tok) x
            JOIN wp USING (word) GROUP BY review_id) e USING (review_id))""", _SUBWORDS).replace("WITH ", "WITH RECURSIVE ", 1)
SQL["encode_fixed_length"] = cleaned_sql(f"""
SELECT review_id, CAST([{D.CLS_ID}] || ids || [{D.SEP_ID}] || list_resize([]::INTEGER[], {D.MAX_LEN - 2} - len(ids), {D.PAD_ID})
                       AS INTEGER[]) AS input_ids,
       CAST(list_resize([]::INTEGER[], len(ids) + 2, 1) || list_resize([]::INTEGER[], {D.MAX_LEN - 2} - len(ids), 0)
            AS INTEGER[]) AS attention_mask,
       CAST(label AS INTEGER) AS targets
FROM (SELECT e.review_id, list(coalesce(v.id, {D.UNK_ID}) ORDER BY e.pos) AS ids
      FROM (SELECT review_id, unnest(range(len(ws))) AS pos, unnest(ws) AS word
            FROM (SELECT review_id, words[1:{D.MAX_LEN - 2}] AS ws FROM tok)) e
      LEFT JOIN vocab v ON v.word = e.word GROUP BY e.review_id) s
JOIN tok USING (review_id)""", [TOK, VOCAB])

# ------------------------------------------------------------ grouping (G1)
SQL["reviews_per_product"] = cleaned_sql(f"""
SELECT asin, CAST(row_number() OVER (PARTITION BY asin ORDER BY review_id) AS INTEGER) AS pos, review_id, review_text
FROM (SELECT asin, review_id, array_to_string(list_transform(string_split(review_text, ' '),
             lambda w: CASE w {_cm} ELSE w END), ' ') AS review_text
      FROM cleaned WHERE vote >= 5 AND review_text IS NOT NULL)""")

L_CHUNK = 20000
SQL["chunk_reviews"] = ("WITH RECURSIVE " + cleaned_sql(f"""
SELECT ch.asin, CAST(ch.chunk AS INTEGER) AS chunk, CAST(ch.n_reviews AS BIGINT) AS n_reviews, ch.text FROM (
  SELECT i.asin, c.ord - 1 + CASE WHEN f.first_long THEN 1 ELSE 0 END AS chunk, count(*) AS n_reviews,
         string_agg(i.review_text, ' ' ORDER BY i.pos) AS text
  FROM items i
  JOIN (SELECT asin, s, row_number() OVER (PARTITION BY asin ORDER BY s) AS ord,
               lead(s, 1, CAST(1099511627776 AS BIGINT)) OVER (PARTITION BY asin ORDER BY s) AS e FROM chain) c
    ON c.asin = i.asin AND i.pos >= c.s AND i.pos < c.e
  JOIN firsts f ON f.asin = i.asin
  GROUP BY i.asin, c.ord, f.first_long) ch
UNION ALL SELECT asin, 0, 0, '' FROM firsts WHERE first_long""", [
    ("base", f"""SELECT asin, review_id, array_to_string(list_transform(string_split(review_text, ' '),
             lambda w: CASE w {_cm} ELSE w END), ' ') AS review_text
             FROM cleaned WHERE vote >= 5 AND review_text IS NOT NULL"""),
    ("items", """SELECT asin, review_id, review_text, length(review_text) AS len,
                 row_number() OVER (PARTITION BY asin ORDER BY review_id) AS pos,
                 sum(length(review_text)) OVER (PARTITION BY asin ORDER BY review_id ROWS UNBOUNDED PRECEDING) AS P
                 FROM base"""),
    ("sizes", "SELECT asin, max(pos) AS n FROM items GROUP BY asin"),
    ("firsts", f"SELECT asin, len > {L_CHUNK} AS first_long FROM items WHERE pos = 1"),
    ("nx", f"""SELECT a.asin, a.pos AS s,
               greatest(a.pos + 1, 1 + (SELECT count(*) FROM items b WHERE b.asin = a.asin AND b.P <= a.P - a.len + {L_CHUNK}))
               AS nxt FROM items a"""),
    ("chain", """SELECT asin, CAST(1 AS BIGINT) AS s FROM sizes
                 UNION ALL SELECT c.asin, nx.nxt FROM chain c JOIN nx ON nx.asin = c.asin AND nx.s = c.s
                 JOIN sizes z ON z.asin = c.asin WHERE nx.nxt <= z.n"""),
])).replace("WITH RECURSIVE WITH ", "WITH RECURSIVE ", 1)

SQL["aspect_map"] = aspect_sql("""
SELECT asin, aspect, part, list(modifier ORDER BY pos) AS modifiers, list(polarity ORDER BY pos) AS polarities FROM (
  SELECT sp.asin, sp.aspect, sp.modifier, sp.polarity,
         row_number() OVER (PARTITION BY sp.asin, sp.aspect ORDER BY sp.rule, sp.doc_id, sp.idx) AS pos,
         CAST((row_number() OVER (PARTITION BY sp.asin, sp.aspect ORDER BY sp.rule, sp.doc_id, sp.idx) - 1) / 1000
              AS INTEGER) AS part
  FROM sp JOIN top ON top.asin = sp.asin AND top.aspect = sp.aspect) m
GROUP BY asin, aspect, part""", SCORED)

SQL["surrogate_id"] = cleaned_sql("""
SELECT review_id, asin, label, CAST('0x' || substr(md5(CAST(review_id AS VARCHAR)), 1, 15) AS BIGINT) AS uid FROM cleaned""")

SQL["unique_row_id"] = cleaned_sql("""
SELECT review_id, asin, label, row_number() OVER (ORDER BY md5(CAST(review_id AS VARCHAR)), CAST(review_id AS VARCHAR)) AS uid
FROM cleaned""")

SQL["clean_reviews_sql"] = SQL["clean_reviews"]
