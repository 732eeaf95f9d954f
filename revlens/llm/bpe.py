"""BPE encoding and decoding with the tokenizers library.

A text is cut only where its tokenizer provably starts anew (white space that
the pre-tokenizer drops, or a single space or line feed between two other
characters for a byte-level one; only for split patterns and normalizers known
to be safe, else texts stay whole), and each distinct piece is encoded once per
worker, in a cache of bounded size.

A piece that cannot be cut and is long goes through tree concatenation: its
halves are encoded (all leaves in one parallel batch), and around each join a
growing window is encoded again until, on both sides, one of its tokens equals
a token of that side's encoding in id and end.  Two neighbouring tokens of a
BPE encoding depend only on each other, so a chain whose neighbours all come
from some valid encoding is the encoding of the whole; a window that reaches
an end of the text agrees there by itself.

Defined results: a null text is encoded as empty (no ids, empty text); the
strings of special tokens inside a text become those tokens, as in the
library; repeated rows give equal rows.  Texts of any length are read whole.
"""

from __future__ import annotations

import gc
import hashlib
import json
import operator
import os
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from revlens.llm.common import map_texts, strings, table, worker_state

#: Characters of an uncut piece above which it is encoded as a tree, and the first window on each side of a join.
LEAF_CHARS = 8_192
WINDOW_CHARS = 64
#: Pieces kept per worker in each of the two generations of the cache, and their mean length
#: above which a generation ends early (long pieces would outgrow a bound on their number).
CACHE_PIECES = 400_000
CACHE_MEAN_CHARS = 24

DROPPED_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
ODD_CONTROLS = ("\x1c", "\x1d", "\x1e", "\x1f")  # white space to str.split, not to the tokenizer
# a byte-level piece that stands in odd white space: empty, a lone line feed, or with white space inside
ODD_PIECE = re.compile(r"\n?|.*?(?:(?!^)\n|[^\S\n]|\u180e).*", re.S)
# fixed values: split patterns none of whose matches holds white space or looks at it
SPACELESS_SPLITS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", r"\S+", r"[^\s]+")
PLAIN_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")  # letters in every version of Unicode
WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([^\w\s'\0\u180e]+)")
LETTER_INSIDE = re.compile(r"[^\w\s].*[^\W\d_]", re.S)


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def load(text: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
    t = Tokenizer.from_str(text)
    t.no_truncation()
    t.no_padding()
    return t


def cut_rule(text: str) -> str:
    """How texts may be cut before encoding: ``dropped`` (white space vanishes),
    ``byte_level`` (a token may begin with one space) or ``whole``."""
    j = json.loads(text)
    pre, norm = j.get("pre_tokenizer") or {}, j.get("normalizer") or {}
    if any(a.get("lstrip") or a.get("rstrip") or re.search(r"\s", a["content"]) for a in j.get("added_tokens", [])):
        return "whole"
    if not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "byte_level"
    steps = pre.get("pretokenizers", [])
    words = (len(steps) in (1, 2) and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed"
             and steps[0].get("invert") and steps[0]["pattern"].get("Regex") in SPACELESS_SPLITS)
    marks = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps[1:])
    if words and marks and all(keeps_space(n) for n in norm.get("normalizers", [norm] if norm else [])):
        return "dropped"
    return "whole"


def keeps_space(normalizer: dict) -> bool:
    """Does the step leave white space and what touches it as they are, or squeeze it to a space?"""
    if normalizer.get("type") == "Replace":
        return normalizer["pattern"].get("Regex") == r"\s+" and normalizer.get("content") == " "
    return normalizer.get("type") in ("NFC", "Lowercase")


# ---- tree concatenation -------------------------------------------------------------------

def join(tokenizer, text: str, begin: int, mid: int, end: int, left, right, window: int):
    """Encoding (ids, ends) of text[begin:end] from those of its two sides."""
    ids_l, ends_l = left
    ids_r, ends_r = right
    while True:
        a, b = max(begin, mid - window), min(end, mid + window)
        enc = tokenizer.encode(text[a:b], add_special_tokens=False)
        ids, ends = enc.ids, [a + e for _, e in enc.offsets]
        n = len(ids)

        def meets(j, side_ids, side_ends):
            """Place after the token of the side that has the id and the end of window token j."""
            if j + 1 < n and ends[j + 1] <= ends[j]:
                return None  # inside a character
            k = bisect_right(side_ends, ends[j]) - 1
            if k < 0 or side_ends[k] != ends[j] or side_ids[k] != ids[j]:
                return None
            return k + 1

        # from the left: the first token that agrees; the window's first token may be cut
        first = (0, 0) if a == begin else None
        if first is None:
            for j in range(1, n):
                if ends[j] >= mid:
                    break
                k = meets(j, ids_l, ends_l)
                if k is not None:
                    first = (j + 1, k)
                    break
        last = (n, len(ids_r)) if b == end else None
        if last is None and first is not None:
            for j in range(n - 2, first[0] - 1, -1):
                if ends[j] <= mid:
                    break
                k = meets(j, ids_r, ends_r)
                if k is not None:
                    last = (j + 1, k)
                    break
        if first is not None and last is not None:
            keep_l = 0 if a == begin else first[1]
            return (ids_l[:keep_l] + ids[first[0]:last[0]] + ids_r[last[1]:],
                    ends_l[:keep_l] + ends[first[0]:last[0]] + ends_r[last[1]:])
        window *= 2


def tree_encode(tokenizer, text: str, leaf: int = LEAF_CHARS, window: int = WINDOW_CHARS) -> list[int]:
    """Ids of a text by halving it down to ``leaf`` characters and joining the encodings upwards."""
    bounds = [0, len(text)]
    while bounds[1] - bounds[0] > leaf or any(y - x > leaf for x, y in zip(bounds, bounds[1:])):
        bounds = sorted({*bounds, *((x + y) // 2 for x, y in zip(bounds, bounds[1:]))})
    spans = list(zip(bounds, bounds[1:]))
    encoded = tokenizer.encode_batch([text[x:y] for x, y in spans], add_special_tokens=False)
    level = [(x, y, (e.ids, [x + z for _, z in e.offsets])) for (x, y), e in zip(spans, encoded)]
    del encoded
    while len(level) > 1:
        nxt = [(p[0], q[1], join(tokenizer, text, p[0], p[1], q[1], p[2], q[2], window))
               for p, q in zip(level[::2], level[1::2])]
        level = nxt + ([level[-1]] if len(level) % 2 else [])
    return level[0][2][0]


# ---- pieces -------------------------------------------------------------------------------

def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if visible, else the next free one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


BYTE_LETTERS = byte_letters()


class Pieces:
    """Encodings of pieces, each made once while it stays in the cache (two
    generations; what is used again moves to the younger one).

    ``make`` turns the ids of a piece into what is kept, ``plus`` joins two of
    these.  Byte-level pieces leave out their leading space; a piece that
    begins with a line feed has none, and a zero mark means: as written."""

    def __init__(self, spec: str, make, plus=operator.add, limit: int = CACHE_PIECES, leaf: int = LEAF_CHARS):
        self.tokenizer, self.rule = load(spec), cut_rule(spec)
        self.make, self.plus, self.limit, self.leaf = make, plus, limit, leaf
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.chars = 0  # of the pieces in the younger generation
        gc.set_threshold(200_000)  # the cache holds strings and bytes, which the cycle collector need not visit
        j = json.loads(spec)
        # letters alone are one word to the model, unless a special token could lie in them
        self.simple_words = self.rule == "byte_level" and not j["model"].get("dropout") and all(
            LETTER_INSIDE.match(a["content"]) for a in j.get("added_tokens", []))
        self.model = self.tokenizer.model

    def lookup(self, text: str) -> list:
        """The values of the pieces of a text, in order."""
        pieces = self.cut(text)
        values = list(map(self.young.get, pieces))
        if None in values:
            if not self.learn({p for p, v in zip(pieces, values) if v is None}):
                pieces = self.cut_odd(text)
                self.learn(set(pieces))
            values = list(map(self.young.get, pieces))
            if len(self.young) > self.limit or self.chars > self.limit * CACHE_MEAN_CHARS:
                self.old, self.young, self.chars = self.young, {}, 0
        return values

    def learn(self, pieces) -> bool:
        """Put the pieces into the younger generation; False if one of them
        shows that its text must be cut the other way."""
        young, old, make, simple = self.young, self.old, self.make, self.simple_words
        plain, marked, tokenize, space = PLAIN_LETTERS.fullmatch, WORD_AND_MARKS.fullmatch, self.model.tokenize, BYTE_LETTERS[32]
        self.chars += sum(map(len, pieces))
        rest: list[str] = []
        pairs: list[tuple[str, str, str]] = []
        for p in pieces:
            v = old.get(p)
            if v is not None:
                young[p] = v
            elif simple and p.isascii() and p.isalpha():  # the library's model on one pre-token
                young[p] = make([t.id for t in tokenize(space + p)])
            elif simple and plain(p):
                young[p] = make([t.id for t in tokenize(space + "".join([BYTE_LETTERS[b] for b in p.encode()]))])
            elif simple and (m := marked(p)):
                pairs.append((p, m[1], "\0" + m[2]))
            elif self.rule == "byte_level" and p[:1] != "\0" and ODD_PIECE.fullmatch(p):
                return False
            else:
                rest.append(p)
        if pairs:
            self.learn({part for _, *parts in pairs for part in parts if part not in young})
            for p, word, marks in pairs:
                young[p] = self.plus(young[word], young[marks])
        if rest:
            texts = [self.text_of(p) for p in rest]
            done = iter(self.tokenizer.encode_batch_fast([t for t in texts if len(t) <= self.leaf], add_special_tokens=False))
            for p, t in zip(rest, texts):
                young[p] = make(next(done).ids if len(t) <= self.leaf else tree_encode(self.tokenizer, t, self.leaf))
        return True

    def text_of(self, piece: str) -> str:
        """What a cut piece stands for."""
        if self.rule != "byte_level" or piece[0] == "\n":
            return piece
        return piece[1:] if piece[0] == "\0" else " " + piece

    def cut(self, text: str) -> list[str]:
        """The pieces of a text.  In a byte-level text every space and line
        feed begins a piece, which is right unless white space is adjacent to
        it; that shows in the pieces (ODD_PIECE), which are then never kept."""
        if not text:
            return []
        if self.rule == "dropped":
            if any(c in text for c in ODD_CONTROLS):
                return [p for p in DROPPED_SPACE.split(text) if p]
            return text.split()
        if self.rule == "byte_level":
            if "\0" in text:
                return self.cut_odd(text)
            parts = text.replace("\n", " \n").split(" ")
            parts[0] = "\0" + parts[0]
            return parts
        return [text]

    def cut_odd(self, text: str) -> list[str]:
        """Cuts before single spaces and line feeds that stand between two
        characters that are no white space; the pieces as written."""
        return ["\0" + p for p in re.split(r"(?<=[^\s\u180e])(?=[ \n][^\s\u180e])", text)]


# ---- operator -----------------------------------------------------------------------------

FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
          T.StructField("decoded_sha256", T.StringType())]


def encode(docs: DataFrame, spec: str, carry: list[str], text: str = "text", leaf: int = LEAF_CHARS) -> DataFrame:
    """``row`` and ids (array of int) of every text."""
    def make_kernel():
        pieces = worker_state(("bpe-ids", hash(spec), leaf), lambda: Pieces(spec, tuple, leaf=leaf))

        def kernel(texts: pa.Array) -> list[pa.Array]:
            out = [[i for v in pieces.lookup(t) for i in v] for t in strings(texts)]
            return [pa.array(out, pa.list_(pa.int32()))]

        return kernel

    return map_texts(docs, text, carry, [T.StructField("ids", T.ArrayType(T.IntegerType()))], make_kernel)


def decode(rows: DataFrame, spec: str, carry: list[str], ids: str = "ids") -> DataFrame:
    """``row`` and the decoded text of every array of ids (null: empty)."""
    def make_kernel():
        tokenizer = worker_state(("bpe-tokenizer", hash(spec)), lambda: load(spec))

        def kernel(arrays: pa.Array) -> list[pa.Array]:
            out = tokenizer.decode_batch([a or [] for a in arrays.to_pylist()], skip_special_tokens=False)
            return [pa.array(out, pa.string())]

        return kernel

    return map_texts(rows, ids, carry, [T.StructField("decoded", T.StringType())], make_kernel)


def digests(docs: DataFrame, spec: str, carry: list[str], text: str = "text", leaf: int = LEAF_CHARS) -> DataFrame:
    """``row``, n_tokens and the digests of ids and decoded text.

    Ids and decoded text are built from the pieces: decoding without a decoder
    joins tokens by a space, so the decoded pieces join likewise.  Any other
    tokenizer decodes the ids of the whole text."""
    no_decoder = not json.loads(spec).get("decoder")

    def make_kernel():
        def make():
            box: list[Pieces] = []

            def piece(ids):
                return (" ".join(map(str, ids)), box[0].tokenizer.decode(ids, skip_special_tokens=False) if no_decoder else "")

            box.append(Pieces(spec, piece, plus=lambda a, b: tuple(" ".join(filter(None, x)) for x in zip(a, b)),
                              limit=CACHE_PIECES // 2, leaf=leaf))  # two strings a piece
            return box[0]

        pieces = worker_state(("bpe-digests", hash(spec), leaf), make)

        def kernel(texts: pa.Array) -> list[pa.Array]:
            counts, ids_sha, text_sha = [], [], []
            for t in strings(texts):
                values = pieces.lookup(t)
                ids = " ".join([v[0] for v in values if v[0]])
                if no_decoder:
                    decoded = " ".join([v[1] for v in values if v[0]])
                else:
                    decoded = pieces.tokenizer.decode([int(i) for i in ids.split()], skip_special_tokens=False)
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]

        return kernel

    return map_texts(docs, text, carry, FIELDS, make_kernel)


def op6_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Tokens and round trip of every document."""
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir, path)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Identifier, token count and digests of ids and decoded text of every document."""
    spec = tokenizer_json(path or default_path("word_bpe_49k.json"))
    return digests(docs, spec, ["doc_id"]).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
