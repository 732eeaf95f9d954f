"""Phrases of a dictionary in running text: a trie, compiled to one regex.

All phrases are merged into a trie whose alternatives begin differently, so a
match needs no more than one step a character however many phrases there are.
The text is cut at its matches, each match is looked up, and the pieces are
joined again; all of it is native string work inside the task that reads the
text.

A match stands between word borders: no letter, digit or underscore next to it,
and no letter behind an apostrophe next to it ("he's" is not found inside
"he's've").  Case does not matter, the curly apostrophe equals the straight one,
and a space in a phrase stands for any white space.  Of phrases that begin at
one place the longest wins, from left to right.  A replacement takes over an
upper-case first letter.  A null text stays null."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dictionary is part of the plan; beyond this size it is refused rather than collected.
MAX_PHRASES = 100_000
BEFORE = r"(?<![\p{L}\p{N}_])(?<![\p{L}\p{N}_]['’])"
AFTER = r"(?![\p{L}\p{N}_]|['’]\p{L})"
_SPECIAL = re.compile(r"[\\^$.|?*+()\[\]{}&\-#~/<>=!:,]")
_CLASSES = {" ": r"\s+", "'": r"['’]"}


def folded(phrase: str) -> str:
    """A phrase as it is looked up: lower case, straight apostrophes, single spaces."""
    return " ".join(phrase.replace("’", "'").lower().split())


def _atom(ch: str, exact: bool = False) -> str:
    return (None if exact else _CLASSES.get(ch)) or _SPECIAL.sub(r"\\\g<0>", ch)


def trie_regex(phrases: Iterable[str], exact: bool = False) -> str:
    """A regex of the phrases; at each place the longest is tried first.  ``exact``: a space and
    an apostrophe stand for themselves only."""
    root: dict = {}
    for p in phrases:
        node = root
        for ch in p:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        prefix = ""
        while len(node) == 1 and "" not in node:
            (ch, node), = node.items()
            prefix += _atom(ch, exact)
        branches = [_atom(ch, exact) + emit(child) for ch, child in sorted(node.items()) if ch]
        if not branches:
            return prefix
        # greedy: a longer phrase before the one that ends here
        return f"{prefix}(?:{'|'.join(branches)}){'?' if '' in node else ''}"

    return emit(root)


class Phrases:
    """A dictionary phrase -> replacement, ready for columns."""

    def __init__(self, entries: dict[str, str]):
        if len(entries) > MAX_PHRASES:
            raise ValueError(f"{len(entries)} phrases; a dictionary in a plan holds at most {MAX_PHRASES}")
        self.entries: dict[str, str] = {}
        for phrase in sorted(entries):  # of phrases that differ in case only the smallest counts
            self.entries.setdefault(folded(phrase), entries[phrase])
        self.entries.pop("", None)
        self.pattern = f"(?iu){BEFORE}{trie_regex(self.entries)}{AFTER}" if self.entries else None

    @classmethod
    def of(cls, table: DataFrame, phrase: str, replacement: str) -> "Phrases":
        """The dictionary of a table; null and empty phrases and null replacements are left
        out, and of several entries for a phrase the smallest counts."""
        rows = table.filter(F.col(phrase).isNotNull() & F.col(replacement).isNotNull()) \
            .groupBy(F.col(phrase).alias("p")).agg(F.min(replacement).alias("r")).limit(MAX_PHRASES + 1).collect()
        return cls({r["p"]: r["r"] for r in rows})

    def found(self, text: Column) -> Column:
        """Whether a phrase occurs."""
        return text.rlike(self.pattern) if self.pattern else F.when(text.isNotNull(), F.lit(False))

    def matches(self, text: Column) -> Column:
        """The phrases that occur, as written, in order."""
        return F.regexp_extract_all(text, F.lit(self.pattern or "(?!)"), F.lit(0))

    def rewrite(self, text: Column) -> Column:
        """The text with every phrase replaced."""
        if not self.pattern:
            return text
        keys = list(self.entries)
        table = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(self.entries[k]) for k in keys]))

        def replaced(m: Column) -> Column:
            key = F.regexp_replace(F.translate(F.lower(m), "’", "'"), r"\s+", " ")
            new = F.coalesce(F.try_element_at(table, key), m)
            first = F.substring(m, 1, 1)
            raised = F.concat(F.upper(F.substring(new, 1, 1)), F.substring(new, 2, 1 << 30))
            return F.when(first != F.lower(first), raised).otherwise(new)

        # one more gap than matches: the texts between them
        gaps = F.split(text, self.pattern, -1)
        parts = F.zip_with(gaps, F.transform(self.matches(text), replaced), lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
        return F.when(text.rlike(self.pattern), F.array_join(parts, "")).otherwise(text)
