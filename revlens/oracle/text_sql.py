"""DuckDB (RE2) forms of the text steps.

RE2 differs from java.util.regex: ``\\s`` is ASCII without \\v, there is no
look-around, ``.`` excludes only \\n.  Each helper returns an SQL
expression over the expression ``x``."""

from __future__ import annotations

from revlens import dictionaries as D

# Python's whitespace set (str.isspace) in RE2.
PS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NPS = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
# Java's "." (no DOTALL): anything but line terminators.
JDOT = r"[^\n\r\x{85}\x{2028}\x{2029}]"
# Unicode word character.
W = r"[\p{L}\p{N}\p{M}_]"
ASCII_TRIM = "(chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31))"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(repl)}, 'g')"


def demojize(x: str, mapping: dict[str, str]) -> str:
    for k in sorted(mapping, key=lambda k: (-len(k), k)):
        x = f"replace({x}, {lit(k)}, {lit(mapping[k])})"
    return x


def normalize_newlines(x):
    return f"lower(replace(replace({x}, chr(13), ''), chr(10), ' '))"


def strip_links_mentions(x):
    return rr(x, r"(?:@|https?://)" + NPS + "+", "")


def strip_non_ascii(x):
    return rr(x, r"[^\x00-\x7f]", "")


def strip_punctuation(x):
    return rr(x, r"[!-/:-@\[-`{-~]", "")


def py_strip(x):
    return rr(x, "^" + PS + "+|" + PS + "+$", "")


def clean_hashtags(x):
    cut = py_strip(rr(x, "#[\\w-]+(?:" + PS + "+#[\\w-]+)*" + PS + "*$", "").replace("[\\w-]", "[" + W[1:-1] + "-]"))
    return f"array_to_string(list_transform(string_split_regex({cut}, '#|_'), lambda p: {py_strip('p')}), ' ')"


def filter_chars(x):
    return rr(x, "[^ ]*[$&][^ ]*", "")


def collapse_spaces(x):
    return rr(x, PS + "{2,}", " ")


def replace_br(x):
    return f"replace({x}, '<br />', ' ')"


def semicolon_to_period(x):
    return f"replace({x}, ';', '.')"


def newline_to_space(x):
    return f"replace({x}, chr(10), ' ')"


def strip_brackets(x):
    return rr(x, r"\[?\[" + JDOT + r"+?\]?\]", " ")


def strip_slashes(x):
    return rr(x, "/{3,}", " ")


def strip_html_entities(x):
    x = rr(x, "&#" + JDOT + r"+&#\d+?;", " ")
    x = rr(x, r"\d+&#\d+?;", " ")
    return rr(x, r"&#\d+?;", " ")


def strip_emoticons(x):
    for face in D.EMOTICONS:
        x = f"replace({x}, {lit(face)}, '')"
    return x


def strip_nonprintable(x):
    return rr(x, r"[^\x01-\x7e]", "")


def clean_text(x, emoji=None):
    x = demojize(x, emoji or {})
    x = normalize_newlines(x)
    x = strip_links_mentions(x)
    x = strip_non_ascii(x)
    x = strip_punctuation(x)
    x = f"trim({x}, {ASCII_TRIM})"
    return rr(x, r"[ \t\n\x0b\f\r\x1c-\x1f]{2,}", " ")


def vote_as_int(x):
    return f"TRY_CAST(COALESCE({x}, '0') AS INTEGER)"


def rating_label(x):
    return (f"CAST(CASE WHEN {x} >= {D.POSITIVE_THRESHOLD} THEN 2 WHEN {x} > {D.NEGATIVE_THRESHOLD} THEN 1 "
            "ELSE 0 END AS DOUBLE)")
