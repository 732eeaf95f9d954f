"""The fixture views of ``revlens.fixtures`` as DuckDB SQL (CTEs).

``with_views(["tokens"], "SELECT ...")`` prefixes a query with the CTEs it
needs, dependencies first, so the oracle runs on the pre-registered base
tables only.
"""

from __future__ import annotations

from revlens import fixtures as FX


def BUCKET(e: str, n: int) -> str:
    return f"((('0x' || substr(md5(CAST({e} AS VARCHAR)), 1, 8))::BIGINT) % {n})"


def HASH32(e: str) -> str:
    return f"(('0x' || substr(md5(CAST({e} AS VARCHAR)), 1, 8))::BIGINT)"


def sql_str(s: str) -> str:
    """A DuckDB string literal; control characters via chr()."""
    parts, buf = [], ""
    for ch in s:
        if ch in "\t\r\n":
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def _pick(values, b):
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {b} {whens} END"


def _values(rows, cols):
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(float(v)) if isinstance(v, float) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


_suffix_case = "CASE review_id % 10 " + " ".join(
    f"WHEN {i} THEN {sql_str(s)}" for i, s in enumerate(FX.NOISE_SUFFIXES[:9])) + \
    f" ELSE {sql_str(FX.NOISE_SUFFIXES[9])} END"

_key = "(CAST(doc_id AS VARCHAR) || ':' || CAST(i AS VARCHAR))"


def _part(k: int, n: int) -> str:
    return f"((('0x' || substr(h, {8 * k + 1}, 8))::BIGINT) % {n})"

VIEWS: dict[str, tuple[list[str], str]] = {
    "reviews": ([], """
SELECT doc_id AS review_id, 'P' || CAST(doc_id % 50 AS VARCHAR) AS asin,
       CAST(1 + doc_id % 5 AS FLOAT) AS overall,
       CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '1,234'
            ELSE CAST(doc_id % 23 AS VARCHAR) END AS vote,
       'U' || CAST(doc_id % 97 AS VARCHAR) AS reviewer_id,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS review_text
FROM documents"""),
    "noisy_reviews": ([], f"""
SELECT review_id, text || {_suffix_case} AS review_text
FROM (SELECT doc_id AS review_id, text FROM documents) d"""),
    "meta": ([], """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS asin, p_name AS title, p_brand AS brand,
       CASE WHEN p_type = 'ECONOMY' THEN 'Books' ELSE p_type END AS main_cat
FROM part"""),
    "meta_lines": ([], """
SELECT p_partkey AS line_no,
       '{"asin": "P' || CAST(p_partkey AS VARCHAR) || '", "title": "' || p_name || '"'
       || CASE WHEN p_partkey % 10 = 3 THEN '' ELSE '}' END AS value
FROM part"""),
    "similar_products": (["meta"], "SELECT asin, " + ", ".join(
        f"'P' || CAST((CAST(substr(asin, 2) AS INT) * 7 + {off}) % 53 AS VARCHAR) AS sim_prod{s}"
        for s, off in enumerate([11, 22, 33, 44, 55], start=1)) + " FROM meta WHERE asin <> 'P13'"),
    "predictions": (["reviews"], f"""
SELECT review_id, CASE WHEN overall >= 4 THEN 2 WHEN overall > 2 THEN 1 ELSE 0 END AS label,
       CASE WHEN review_id % 29 = 7 THEN 3 ELSE {BUCKET("'y' || CAST(review_id AS VARCHAR)", 3)} END AS prediction,
       {BUCKET("'z' || CAST(review_id AS VARCHAR)", 20)} AS score
FROM reviews"""),
    "tokens": ([], f"""
SELECT doc_id, 'P' || CAST(doc_id % 50 AS VARCHAR) AS asin, CAST(i AS INTEGER) AS idx, lower(w) AS text,
       CAST(CASE WHEN i % 5 = 0 THEN i WHEN i % 5 = 4 THEN i - 1 ELSE i - i % 5 END AS INTEGER) AS head_idx,
       CASE WHEN i % 5 = 0 THEN 'ROOT' ELSE {_pick(FX.DEPS, _part(0, 11))} END AS dep,
       {_pick(FX.POS, _part(1, 4))} AS pos,
       {_pick(FX.TAGS, _part(2, 3))} AS tag,
       {_part(3, 4)} = 0 AS is_stop
FROM (SELECT doc_id, i, w, md5({_key}) AS h
      FROM (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS w
            FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)) e0
      WHERE w <> '') e"""),
    "lexicon": (["tokens"], f"""
SELECT text AS word, CAST({BUCKET("text", 9)} - 4 AS DOUBLE) AS valence
FROM (SELECT DISTINCT text FROM tokens) t WHERE {BUCKET("'k' || text", 3)} = 0"""),
    "emoji_map": ([], _values(FX.EMOJI_MAP, ["ch", "name"])),
    "contraction_map": ([], _values(FX.CONTRACTION_MAP, ["short", "long"])),
    "lemma_map": ([], _values(FX.LEMMA_MAP, ["word", "pos", "lemma"])),
    "negations": ([], _values(FX.FIXTURE_NEGATIONS, ["word"])),
    "boosters": ([], _values(FX.FIXTURE_BOOSTERS, ["word", "scalar"])),
    "pronouns": ([], _values(FX.D.PRODUCT_PRONOUNS, ["word"])),
}


# CTEs that several others read: computed once
ONCE = {"tokens", "te", "ch", "fa", "c", "g", "hg", "pairs", "sp", "tok"}


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with CTEs for ``names`` (and their dependencies),
    then any ``extra`` (name, sql) CTEs in the given order."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    kind = lambda n: "AS MATERIALIZED" if n in ONCE else "AS"
    ctes = [f"{n} {kind(n)} ({VIEWS[n][1].strip()})" for n in order]
    ctes += [f"{n} {kind(n)} ({s.strip()})" for n, s in (extra or [])]
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
