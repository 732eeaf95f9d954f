"""Token ids of Arrow batches of texts, for tokenizers whose texts may be cut
before spaces and line feeds (byte-level BPE).

A batch is cut by Arrow, its distinct pieces are found by dictionary encoding,
and only these meet Python: a piece of letters with marks behind it falls into
both parts, and each part is encoded once by the library while it stays in a
cache of bounded size (the parts not used for longest go first).  Ids of the
texts are gathered by numpy.  Texts with adjacent white space or a zero
character, and all texts of other tokenizers, go through ``Pieces`` whole.

Ids are those of the library for the whole text; a null text is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from revlens.llm.bpe import BYTE_LETTERS, LEAF_CHARS, Pieces, tree_encode

#: Characters of text cut at once; parts kept, and their mean length above which they count as more.
SLICE_CHARS = 4 << 20
CACHE_PARTS = 500_000
CACHE_MEAN_CHARS = 24

#: Letters in every version of Unicode, and marks that end a run of letters (an apostrophe may begin a suffix).
PARTS = (r"^(?P<lead>[\x00\n]?)(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)"
         r"(?P<marks>[!-&(-/:-@\[-`{-~]*)$")
#: Pieces that show adjacent white space: empty, a lone line feed, or white space inside.
ODD = (r"(?s)^\n?$|.\n|[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
       r"\x{205f}\x{3000}]")
HIDDEN = {b: ord(c) for b, c in enumerate(BYTE_LETTERS) if chr(b) != c}
END = "\0\0"


class BatchEncoder:
    """Ids of batches of texts, each followed by ``end_id`` if there is one."""

    def __init__(self, spec: str, end_id: int | None = None, cache: int = CACHE_PARTS, slice_chars: int = SLICE_CHARS,
                 leaf: int = LEAF_CHARS):
        self.pieces = Pieces(spec, tuple, limit=max(1, cache // 20), leaf=leaf)
        self.by_words = self.pieces.rule == "byte_level" and self.pieces.simple_words
        self.end, self.limit, self.slice_chars, self.leaf = end_id, cache, slice_chars, leaf
        self.turn = 0
        self.clear()

    # ---- cache: part -> slot; the ids of slot s are arena[start[s]:start[s] + count[s]] ----

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.chars = 0
        self.start, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.used = np.zeros(1024, np.int64)
        self.arena, self.fill = np.zeros(1 << 14, np.int32), 0
        self.add([""], [[]])  # slot 0: nothing

    def add(self, parts: list[str], ids: list) -> None:
        n, first = len(parts), len(self.slots)
        counts = np.fromiter(map(len, ids), np.int64, n)
        flat = np.fromiter((i for x in ids for i in x), np.int32, int(counts.sum()))
        if first + n > len(self.start):
            more = max(first + n, 2 * len(self.start)) - len(self.start)
            self.start, self.count, self.used = (np.pad(a, (0, more)) for a in (self.start, self.count, self.used))
        if self.fill + len(flat) > len(self.arena):
            self.arena = np.pad(self.arena, (0, max(self.fill + len(flat), 2 * len(self.arena)) - len(self.arena)))
        self.arena[self.fill:self.fill + len(flat)] = flat
        self.start[first:first + n] = self.fill + np.cumsum(counts) - counts
        self.count[first:first + n] = counts
        self.fill += len(flat)
        self.slots.update(zip(parts, range(first, first + n)))
        self.chars += sum(map(len, parts))

    def evict(self) -> None:
        """Keep the half of the parts that was used last."""
        if len(self.slots) <= self.limit and self.chars <= self.limit * CACHE_MEAN_CHARS:
            return
        parts = list(self.slots)
        ages = self.used[:len(parts)]
        bound = np.partition(ages, len(parts) // 2)[len(parts) // 2]
        stay = np.flatnonzero(ages > bound)
        kept = [(parts[s], self.arena[self.start[s]:self.start[s] + self.count[s]].tolist()) for s in stay.tolist() if s]
        del parts
        self.clear()
        self.add([k[0] for k in kept], [k[1] for k in kept])

    def slots_of(self, parts: list[str]) -> np.ndarray:
        """Slots of distinct parts, learning those not in the cache."""
        found = list(map(self.slots.get, parts))
        if None in found:
            new = [p for p, s in zip(parts, found) if s is None]
            self.add(new, self.learn(new))
            found = list(map(self.slots.__getitem__, parts))
        slots = np.array(found, np.int64)
        self.used[slots] = self.turn
        return slots

    def learn(self, parts: list[str]) -> list:
        """Ids of parts: words behind a space, ``\\0`` and text as written, or ``\\n`` and text as written."""
        tokenizer, tokenize, leaf, space = self.pieces.tokenizer, self.pieces.model.tokenize, self.leaf, BYTE_LETTERS[32]
        out: list = [None] * len(parts)
        rest = []
        for i, p in enumerate(parts):
            if p == END:
                out[i] = [] if self.end is None else [self.end]
            elif len(p) <= leaf and p.isalpha() and p <= "ɏ":
                # the library's model on one pre-token
                out[i] = [t.id for t in tokenize(space + (p if p.isascii() else self.letters(p)))]
            elif p[0] == "\0" and 1 < len(p) <= leaf and p[1:].isalpha() and p[1:] <= "ɏ":
                out[i] = [t.id for t in tokenize(p[1:] if p.isascii() else self.letters(p[1:]))]
            else:
                rest.append(i)
        texts = [self.pieces.text_of(parts[i]) for i in rest]
        done = iter(tokenizer.encode_batch_fast([t for t in texts if len(t) <= leaf], add_special_tokens=False))
        for i, t in zip(rest, texts):
            out[i] = next(done).ids if len(t) <= leaf else tree_encode(tokenizer, t, leaf)
        return out

    @staticmethod
    def letters(word: str) -> str:
        """The word as the characters that stand for its bytes."""
        return word.encode().decode("latin-1").translate(HIDDEN)

    # ---- texts ----

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        parts, at = [], 0
        while at < len(texts):
            base = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, base + self.slice_chars, side="right")))
            parts.append(self.encode_slice(texts.slice(at, to - at)))
            at = to
        pa.default_memory_pool().release_unused()
        counts = np.concatenate([c for c, _ in parts]) if parts else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in parts]) if parts else np.zeros(0, np.int32)
        return np.concatenate([[0], np.cumsum(counts)]), ids

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        if not self.by_words:
            return self.spliced(texts, np.ones(n, bool), np.zeros(n, np.int64), np.zeros(0, np.int32))
        self.evict()
        self.turn += 1
        zero = pc.match_substring(texts, "\0")
        marked = pc.binary_join_element_wise("\0", pc.replace_substring(pc.if_else(zero, "", texts), "\n", " \n"), " " + END, "")
        lists = pc.split_pattern(marked, " ")
        firsts = lists.offsets.to_numpy().astype(np.int64)
        words = lists.flatten().dictionary_encode()
        del marked, lists
        which = words.indices.to_numpy(zero_copy_only=False)
        odd_piece = pc.match_substring_regex(words.dictionary, ODD).to_numpy(zero_copy_only=False)
        odd = np.add.reduceat(odd_piece[which].astype(np.int32), firsts[:-1] - firsts[0]) > 0 if n else np.zeros(0, bool)
        odd |= zero.to_numpy(zero_copy_only=False)
        starts, counts, arena = self.resolve(words.dictionary, odd_piece)
        sizes = counts[which]
        ends = np.cumsum(sizes)
        bounds = np.concatenate([[0], ends])[firsts - firsts[0]]
        total = int(ends[-1]) if len(ends) else 0
        ids = arena[np.repeat(starts[which] - (ends - sizes), sizes) + np.arange(total)]
        return self.spliced(texts, odd, np.diff(bounds), ids)

    def resolve(self, pieces: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, count, arena) of the ids of distinct pieces; odd ones have none."""
        fields = pc.extract_regex(pieces, PARTS)
        plain = fields.is_valid().to_numpy(zero_copy_only=False) & ~odd
        lead, word, marks = (pc.fill_null(pc.struct_field(fields, i), "") for i in range(3))
        bare = pc.not_equal(lead, "")  # no space in front
        as_written = pc.binary_join_element_wise("\0", word, "")
        line_feed = pc.equal(lead, "\n").to_numpy(zero_copy_only=False) & plain
        has_marks = pc.not_equal(marks, "").to_numpy(zero_copy_only=False) & plain
        one = pc.if_else(pa.array(plain), pc.if_else(bare, as_written, word), pc.if_else(pa.array(odd), "", pieces))
        two = pc.if_else(pa.array(has_marks), pc.binary_join_element_wise("\0", marks, ""), "")
        slots = np.zeros((len(pieces), 3), np.int64)
        slots[line_feed, 0] = self.slots_of(["\0\n"])[0]
        for column, parts in ((1, one.dictionary_encode()), (2, two.dictionary_encode())):
            known = self.slots_of(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
            slots[:, column] = known[parts.indices.to_numpy(zero_copy_only=False)]
        slots = slots.ravel()
        sizes = self.count[slots]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        arena = self.arena[np.repeat(self.start[slots] - (ends - sizes), sizes) + np.arange(total)]
        counts = sizes.reshape(-1, 3).sum(axis=1)
        return np.cumsum(counts) - counts, counts, arena

    def spliced(self, texts: pa.Array, odd: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids with those of the odd texts put in place."""
        if not odd.any():
            return counts, ids
        bounds, out, at = np.concatenate([[0], np.cumsum(counts)]), [], 0
        counts = counts.copy()
        end = [] if self.end is None else [self.end]
        for i in np.flatnonzero(odd).tolist():
            out.append(ids[bounds[at]:bounds[i]])
            mine = [x for v in self.pieces.lookup(texts[i].as_py()) for x in v] + end
            out.append(np.array(mine, np.int32))
            counts[i], at = len(mine), i + 1
        out.append(ids[bounds[at]:])
        return counts, np.concatenate(out)
