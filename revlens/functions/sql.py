"""The text steps and small rules as SQL functions.

``register`` creates temporary SQL functions with native bodies, so that
``spark.sql`` and ``selectExpr`` callers reach the same steps as the Column
functions of ``functions.text``; the optimizer inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from revlens import dictionaries as D
from revlens.functions import text as T


def literal(s: str) -> str:
    """A string as a SQL literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replaced(value: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({value}, {literal(pattern)}, {literal(by)})"


def _demojize(emoji: dict[str, str]) -> str:
    if not emoji:
        return "t"
    pieces, first = T.emoji_patterns(emoji)
    names = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in emoji.items())
    named = f"CASE WHEN rlike(p, {literal('^' + first)}) THEN coalesce(try_element_at(map({names}), p), p) ELSE p END"
    return (f"CASE WHEN rlike(t, {literal(first)}) THEN array_join(transform(regexp_extract_all(t, {literal(pieces)}, 0), "
            f"p -> {named}), '') ELSE t END")


def bodies(emoji: dict[str, str] | None = None) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, type, body)."""
    stripped = _replaced("x", rf"(?U)^[{T.PY_SPACE}]+|[{T.PY_SPACE}]+$")
    tags = f"array_join(transform(split(t, {literal(T._TRAILING_TAG)}, -1), x -> {stripped}), ' ')"
    entities = "t"
    for pattern in (r"\&\#.+\&\#\d+?;", r"\d+\&\#\d+?;", r"\&\#\d+?;"):
        entities = _replaced(entities, pattern, " ")
    faces = "t"
    for face in D.EMOTICONS:
        faces = f"replace({faces}, {literal(face)}, '')"
    steps = {
        "demojize": _demojize(emoji or {}),
        "normalize_newlines": "lower(replace(replace(t, '\\r', ''), '\\n', ' '))",
        "strip_links_mentions": _replaced("t", rf"(?U)(?:@|https?://)[^{T.PY_SPACE}]+"),
        "strip_non_ascii": _replaced("t", r"[^\x00-\x7f]"),
        "strip_punctuation": f"translate(t, {literal(D.ASCII_PUNCTUATION)}, '')",
        "clean_hashtags": f"array_join(transform(split({tags}, '#|_', -1), x -> {stripped}), ' ')",
        "filter_chars": _replaced("t", "[^ ]*[$&][^ ]*"),
        "collapse_spaces": _replaced("t", rf"(?U)[{T.PY_SPACE}]{{2,}}", " "),
        "replace_br": _replaced("t", "<br />", " "),
        "semicolon_to_period": "replace(t, ';', '.')",
        "newline_to_space": "replace(t, '\\n', ' ')",
        "strip_brackets": _replaced("t", r"\[?\[.+?\]?\]", " "),
        "strip_slashes": _replaced("t", "/{3,}", " "),
        "strip_html_entities": entities,
        "strip_emoticons": faces,
        "strip_nonprintable": _replaced("t", r"[^\x01-\x7e]"),
    }
    out = {name: ("t STRING", "STRING", body) for name, body in steps.items()}
    out["vote_to_int"] = ("vote STRING", "INT", "try_cast(coalesce(vote, '0') AS INT)")
    out["rating_label"] = ("overall DOUBLE", "DOUBLE", f"CASE WHEN overall >= {D.POSITIVE_THRESHOLD} THEN 2D "
                                                       f"WHEN overall > {D.NEGATIVE_THRESHOLD} THEN 1D ELSE 0D END")
    return out


#: The steps of ``clean_text`` before its last two, first to last.
LIVE_STEPS = ("demojize", "normalize_newlines", "strip_links_mentions", "strip_non_ascii", "strip_punctuation")


def register(spark: SparkSession, emoji: dict[str, str] | None = None, prefix: str = "") -> list[str]:
    """Create (or replace) the functions in the session, and ``clean_review_text`` made of them; their names."""
    made = bodies(emoji)
    text = "t"
    for step in LIVE_STEPS:
        text = f"{prefix}{step}({text})"
    text = f"btrim({text}, {literal(T.ASCII_SPACE)})"
    made["clean_review_text"] = ("t STRING", "STRING", _replaced(text, r"[ \t\n\x0b\f\r\x1c-\x1f]{2,}", " "))
    for name, (parameters, kind, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {kind} RETURN {body}")
    return [prefix + name for name in made]
