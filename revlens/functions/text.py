"""Review-text cleaning steps as native Column expressions.

Each step is a ``Column -> Column`` function and runs inside whole-stage
codegen.  Regex notes: Spark uses java.util.regex.  The cleaning rules
were written for Python's ``re``, whose ``\\s`` is Unicode-aware and also
counts U+001C..U+001F as whitespace; Java's ``(?U)\\s`` lacks those four,
so they are added explicitly wherever ``\\s`` is meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import dictionaries as D

# Python's str.isspace() set as a Java character-class body (with (?U)).
PY_SPACE = r"\s\x1c-\x1f"
# The same restricted to ASCII (after non-ASCII removal).
ASCII_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def _quoted(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def demojize(c: Column, mapping: dict[str, str]) -> Column:
    """Replace each mapped character or sequence (emoji) by its name, the
    longest sequence first, in one pass.

    One regex cuts the text into mapped sequences and runs of characters that
    begin none of them; only pieces that begin like a sequence are looked up.
    The expression has the same few nodes for any number of entries.  ASCII
    texts hold no sequence of a mapping that has no ASCII beginnings."""
    if not mapping:
        return c
    keys = list(mapping)
    pattern, first = emoji_patterns(mapping)
    pieces = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    names = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(mapping[k]) for k in keys]))
    named = F.transform(pieces, lambda p: F.when(p.rlike("^" + first), F.coalesce(F.try_element_at(names, p), p)).otherwise(p))
    found = c.rlike(first) if any(k[0].isascii() for k in keys) else ~is_ascii(c) & c.rlike(first)
    return F.when(found, F.array_join(named, "")).otherwise(c)


def emoji_patterns(mapping: dict[str, str]) -> tuple[str, str]:
    """The pattern of mapped sequences and runs of other characters, and that of a sequence's first character."""
    keys = sorted(mapping, key=lambda k: (-len(k), k))
    first = "".join(_class_escape(k) for k in sorted({k[0] for k in keys}))
    return f"(?s){'|'.join(map(_quoted, keys))}|[^{first}]+|.", f"[{first}]"


def _class_escape(ch: str) -> str:
    return "\\" + ch if ch in "\\^-[]&" else ch


def dictionary_to_map(df: DataFrame, key: str, value: str) -> dict:
    """An emoji table on the driver: it is part of the regex of ``demojize``.
    Such tables are bounded by the writing system (a few thousand entries)."""
    return {r[0]: r[1] for r in df.select(key, value).filter(F.col(key).isNotNull() & (F.col(key) != "")).collect()}


def is_ascii(c: Column) -> Column:
    """Whether a text has no character above U+007F: as many bytes as characters."""
    return F.octet_length(c) == F.length(c)


def normalize_newlines(c: Column) -> Column:
    """Drop CR, LF -> space, lower-case."""
    # a byte search each: ``translate`` looks up every character
    return F.lower(F.replace(F.replace(c, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" ")))


def strip_links_mentions(c: Column) -> Column:
    """Remove @mentions and http(s):// links up to the next whitespace."""
    # the pattern is tried only in texts that hold what a match begins with
    found = c.contains("@") | c.contains("://")
    return F.when(found, F.regexp_replace(c, rf"(?U)(?:@|https?://)[^{PY_SPACE}]+", "")).otherwise(c)


def strip_non_ascii(c: Column) -> Column:
    """T4: remove characters above U+007F."""
    return F.when(is_ascii(c), c).otherwise(F.regexp_replace(c, r"[^\x00-\x7f]", ""))


def strip_punctuation(c: Column) -> Column:
    """T5: remove ASCII punctuation."""
    return F.translate(c, D.ASCII_PUNCTUATION, "")


def py_strip(c: Column) -> Column:
    """Python str.strip(): trim Unicode whitespace (incl. U+001C..U+001F)."""
    return F.regexp_replace(c, rf"(?U)^[{PY_SPACE}]+|[{PY_SPACE}]+$", "")


# The trailing run of hashtags; the tag exemption of the original rule
# is guarded by a backspace character, so it practically never applies.
_TRAILING_TAG = r"(?U)#(?!hashtag\x08)[\w-]+(?=(?:[" + PY_SPACE + r"]+#[\w-]+)*[" + PY_SPACE + r"]*$)"


def clean_hashtags(c: Column) -> Column:
    """Split off the trailing run of #tags, then split on '#' and '_';
    pieces are stripped and joined by single spaces."""
    first = F.array_join(F.transform(F.split(c, _TRAILING_TAG, -1), py_strip), " ")
    return F.array_join(F.transform(F.split(first, "#|_", -1), py_strip), " ")


def filter_chars(c: Column) -> Column:
    """Blank every space-separated word that holds '$' or '&'."""
    return F.regexp_replace(c, "[^ ]*[$&][^ ]*", "")


def collapse_spaces(c: Column) -> Column:
    """Any run of two or more whitespace characters -> one space."""
    return F.regexp_replace(c, rf"(?U)[{PY_SPACE}]{{2,}}", " ")


def replace_br(c: Column) -> Column:
    """T9: '<br />' -> space."""
    return F.regexp_replace(c, "<br />", " ")


def semicolon_to_period(c: Column) -> Column:
    """T10: ';' -> '.'."""
    return F.regexp_replace(c, ";", ".")


def newline_to_space(c: Column) -> Column:
    """Newline -> space."""
    return F.regexp_replace(c, "\\n", " ")


def strip_brackets(c: Column) -> Column:
    """Bracketed text -> space (fixed pattern)."""
    return F.regexp_replace(c, r"\[?\[.+?\]?\]", " ")


def strip_slashes(c: Column) -> Column:
    """Three or more slashes -> space."""
    return F.regexp_replace(c, "/{3,}", " ")


def strip_html_entities(c: Column) -> Column:
    """Numeric HTML entities -> space (fixed patterns: pair-greedy, digit-led, single)."""
    c = F.regexp_replace(c, r"\&\#.+\&\#\d+?;", " ")
    c = F.regexp_replace(c, r"\d+\&\#\d+?;", " ")
    return F.regexp_replace(c, r"\&\#\d+?;", " ")


def strip_emoticons(c: Column) -> Column:
    """Remove ':|', then ':)', then ':(', then ':/' (a removal may bring the next one together)."""
    for face in D.EMOTICONS:
        c = F.replace(c, F.lit(face), F.lit(""))
    return c


def strip_nonprintable(c: Column) -> Column:
    """Keep characters with 0 < code point < 127."""
    return F.regexp_replace(c, r"[^\x01-\x7e]", "")


def clean_text_full(c: Column, emoji: dict[str, str] | None = None) -> Column:
    """Every step of the review-cleaning chain, in its original order."""
    c = demojize(c, emoji or {})
    c = normalize_newlines(c)
    c = strip_links_mentions(c)
    c = strip_non_ascii(c)
    c = strip_punctuation(c)
    c = clean_hashtags(c)
    c = filter_chars(c)
    c = collapse_spaces(c)
    c = replace_br(c)
    c = semicolon_to_period(c)
    c = newline_to_space(c)
    c = strip_brackets(c)
    c = strip_slashes(c)
    c = strip_html_entities(c)
    c = strip_emoticons(c)
    c = collapse_spaces(c)
    return F.lower(c)


def clean_text(c: Column, emoji: dict[str, str] | None = None) -> Column:
    """T18 text part, live steps only.

    Once punctuation is gone the hashtag, '$'/'&', markup, bracket, slash,
    entity and emoticon steps can no longer match and the second collapse
    and lower-case are idempotent; what remains is demojize -> newlines and
    lower-case -> links/mentions -> non-ASCII -> punctuation -> strip ->
    collapse.  ``clean_text_full`` keeps the long form (tests assert equality).
    """
    c = demojize(c, emoji or {})
    c = normalize_newlines(c)
    c = strip_links_mentions(c)
    c = strip_non_ascii(c)
    c = strip_punctuation(c)
    c = F.btrim(c, F.lit(ASCII_SPACE))
    return F.regexp_replace(c, r"[ \t\n\x0b\f\r\x1c-\x1f]{2,}", " ")


# Java's default \s (the ML Tokenizer's separator): ASCII only.
JAVA_SPACE = r"[ \t\n\x0b\f\r]"


def tokenize(c: Column) -> Column:
    """L1 as a native expression, equal to ``pyspark.ml.feature.Tokenizer``:
    lower-case, split on single whitespace characters, inner empty words
    kept, trailing empty words dropped (an all-whitespace text gives no
    words, the empty text one empty word)."""
    low = F.lower(c)
    body = F.rtrim(low, F.lit(" \t\n\x0b\f\r"))
    return F.when((low != F.lit("")) & (body == F.lit("")), F.array().cast("array<string>")) \
            .otherwise(F.split(body, JAVA_SPACE, -1))
