"""DuckDB SQL twins, keyed like ``revlens.plans.catalog.QUERIES``."""

from __future__ import annotations

from revlens import fixtures as FX
from revlens.oracle import text_sql as T
from revlens.oracle.fixtures_sql import with_views

SQL: dict[str, str] = {}
EMOJI = dict(FX.EMOJI_MAP)


def _clean_body(select_cols: str | None = None) -> str:
    return f"""
SELECT r.review_id, r.asin, r.overall, {T.vote_as_int('r.vote')} AS vote, r.reviewer_id,
       {T.clean_text('r.review_text', EMOJI)} AS review_text,
       {T.rating_label('r.overall')} AS label
FROM reviews r
WHERE r.review_text IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM meta m WHERE m.main_cat = 'Books' AND m.asin = r.asin)"""


CLEAN_CTE = ("cleaned", _clean_body())


def cleaned_sql(body: str, extra=None) -> str:
    return with_views(["reviews", "meta"], body, [CLEAN_CTE] + (extra or []))


SQL["clean_reviews"] = cleaned_sql("SELECT * FROM cleaned")
SQL["clean_label_summary"] = cleaned_sql(
    "SELECT label, CAST(count(*) AS BIGINT) AS n_reviews, round(avg(length(review_text)), 6) AS avg_len "
    "FROM cleaned GROUP BY label")

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
    SQL[_name] = with_views(["noisy_reviews"], f"SELECT review_id, {_fn('review_text')} AS review_text FROM noisy_reviews")

SQL["demojize"] = with_views(["noisy_reviews"],
                             f"SELECT review_id, {T.demojize('review_text', EMOJI)} AS review_text FROM noisy_reviews")
SQL["replace_markup"] = with_views(["noisy_reviews"], f"""
SELECT review_id, {T.replace_br('review_text')} AS br_to_space,
       {T.semicolon_to_period('review_text')} AS semicolon_to_period,
       {T.newline_to_space('review_text')} AS newline_to_space FROM noisy_reviews""")

SQL["reviews_with_text"] = with_views(["reviews"], "SELECT * FROM reviews WHERE review_text IS NOT NULL")
SQL["vote_to_int"] = with_views(["reviews"], f"SELECT review_id, vote, {T.vote_as_int('vote')} AS vote_int FROM reviews")
SQL["reviews_min_votes"] = with_views(["reviews"],
                                      f"SELECT review_id, asin, vote FROM reviews WHERE {T.vote_as_int('vote')} >= 5")
SQL["rating_label"] = with_views(["reviews"], f"SELECT review_id, overall, {T.rating_label('overall')} AS label FROM reviews")
SQL["label_casts"] = cleaned_sql(
    "SELECT review_id, CAST(label AS DOUBLE) AS label_double, CAST(label AS INTEGER) AS label_int FROM cleaned")
SQL["preview_rows"] = cleaned_sql("SELECT review_id, asin, label FROM cleaned ORDER BY review_id LIMIT 10")
SQL["anti_join_books"] = with_views(["reviews", "meta"], """
SELECT review_id, asin FROM reviews r
WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.main_cat = 'Books' AND m.asin = r.asin)""")
