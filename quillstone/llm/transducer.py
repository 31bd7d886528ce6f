"""A word tokenizer compiled to a deterministic transducer over character kinds.

The split rule of the tokenizer becomes a table ``NEXT[state, kind]``. A text is cut into chunks;
each chunk's *state map* (where it leads from every state) is computed for all chunks at once, the
maps are composed by a parallel prefix scan, and then every chunk runs from its known first state.
A transition that completes a piece emits that piece's token count. The count is a weight of the
transition's label, the piece: it is filled in from the tokenizer on first sight and kept in a
bounded table, as merges inside a piece look back arbitrarily far and have no small automaton.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from tokenizers import Tokenizer

from .common import hash_spans

# Kinds of characters.
SPACE, OTHER, NUMBER, APOSTROPHE, LETTER, L_STMD, L_R, L_V, L_L, L_E = range(10)
# States: the last character ended a piece or was white space; in letters; in a number; in other
# characters; an apostrophe that may begin a contraction; the same with r, v or l; a contraction.
IDLE, LETTERS, DIGIT, OTHERS, APOS, APOS_R, APOS_V, APOS_L, SHORT = range(9)


def compile_split() -> np.ndarray:
    """The table of `'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+`, first alternative first."""
    table = np.zeros((9, 10), np.uint8)
    table[:, SPACE] = IDLE
    table[:, NUMBER] = DIGIT
    table[:, LETTER:] = LETTERS
    table[:, OTHER] = OTHERS
    table[:, APOSTROPHE] = APOS
    table[[OTHERS, APOS], APOSTROPHE] = OTHERS
    table[APOS, [L_STMD, L_R, L_V, L_L]] = SHORT, APOS_R, APOS_V, APOS_L
    table[[APOS_R, APOS_V], L_E] = SHORT
    table[APOS_L, L_L] = SHORT
    return table


NEXT = compile_split()
CHUNK = 128


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, every):
            points = np.frombuffer(m[0].encode("utf-32-le"), "<u4")
            table[points] = kind
    for letters, kind in (("stmd", L_STMD), ("r", L_R), ("v", L_V), ("l", L_L), ("e", L_E), ("'", APOSTROPHE)):
        table[[ord(c) for c in letters]] = kind
    return table


def run_states(kind: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The state after each character, from IDLE, by a prefix scan over the chunks' state maps."""
    n = len(kind)
    if not n:
        return np.zeros(0, np.uint8)
    width = -(-n // chunk)
    padded = np.zeros(width * chunk, np.uint8)
    padded[:n] = kind
    steps = np.ascontiguousarray(padded.reshape(width, chunk).T)
    flat = NEXT.ravel()
    maps = np.repeat(np.arange(9, dtype=np.uint8)[:, None], width, 1)
    for row in steps:
        maps = flat[maps * np.uint8(10) + row]
    reach = 1
    while reach < width:  # inclusive scan: maps[:, i] becomes the map of all chunks up to i
        after = maps[:, reach:]
        maps = np.concatenate([maps[:, :reach], np.take_along_axis(after, maps[:, :-reach].astype(np.intp), 0)], 1)
        reach *= 2
    state = np.concatenate([[IDLE], maps[IDLE, :-1]]).astype(np.uint8)
    out = np.empty((chunk, width), np.uint8)
    for i, row in enumerate(steps):
        state = flat[state * np.uint8(10) + row]
        out[i] = state
    return out.T.ravel()[:n]


def piece_starts(kind: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Where pieces begin. A transition may end one piece, end none, or reveal that a contraction was none."""
    before = np.concatenate([[IDLE], state[:-1]]).astype(np.uint8)
    after = np.concatenate([state[1:], [IDLE]]).astype(np.uint8)
    half = (before >= APOS_R) & (before <= APOS_L)
    starts = (state == DIGIT) | (state == APOS)
    starts |= (state == OTHERS) & (before != OTHERS) & (before != APOS)
    starts |= (state == LETTERS) & (before != LETTERS) & ~half
    starts |= (state >= APOS_R) & (state <= APOS_L) & (after != SHORT)
    return starts


class PieceTokenizer:
    """Pieces of texts, their token counts and their ids, for the lower-casing word tokenizer."""

    def __init__(self, model: bytes, keep: int = 1_000_000):
        self.tokenizer = Tokenizer.from_str(model.decode())
        self.keep = keep
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_ids = specials
        self.special_prefix = os.path.commonprefix(list(specials))  # a text without it holds no special string
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.row = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def normalise(text: str) -> str:
        """Canonical composition, then lower case character by character."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each piece in the table, index of each text's first piece).

        Special strings count as pieces of their own, found in the text as it is.
        """
        parts: list[str] = []
        marks: list[tuple[int, str]] = []
        size, stops = 0, []
        for text in texts:
            if self.special and self.special_prefix in text and self.special.search(text):
                at = 0
                for m in self.special.finditer(text):
                    part = self.normalise(text[at : m.start()])
                    parts += [part, " "]
                    size += len(part) + 1
                    marks.append((size - 1, m[0]))
                    at = m.end()
                text = text[at:]
            part = self.normalise(text)
            parts += [part, "\n"]
            size += len(part) + 1
            stops.append(size)
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = kinds()[points]
        starts = piece_starts(kind, run_states(kind))
        at = np.flatnonzero(starts)
        solid = kind != SPACE
        ends = np.flatnonzero(solid & np.concatenate([starts[1:] | ~solid[1:], [True]])) + 1
        h = hash_spans(points.view(np.uint8), at * 4, ends * 4)
        codes, unique = pd.factorize(h)
        rows = self._rows(unique, codes, joined, at, ends)[codes]
        if marks:
            where = np.searchsorted(at, [m[0] for m in marks])
            rows = np.insert(rows, where, self._special_rows([m[1] for m in marks]))
            at = np.insert(at, where, [m[0] for m in marks])
        return rows, np.concatenate([[0], np.searchsorted(at, stops)])

    def _special_rows(self, found: list[str]) -> np.ndarray:
        names = sorted(set(found))
        h = np.array([np.uint64(0xFFFF_FFFF_FFFF_0000 + self.special_ids[x] % 0x10000) for x in names], np.uint64)
        missing = [i for i, x in enumerate(h) if x not in self.known]
        if missing:
            self._learn(h[missing], np.array([self.special_ids[names[i]] for i in missing], np.uint32), np.ones(len(missing), np.int64))
        rows = dict(zip(names, self._find(h), strict=True))
        return np.array([rows[x] for x in found])

    def _find(self, h: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.row[at], -1)

    def _learn(self, h: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        rows = np.arange(len(self.count), len(self.count) + len(count))
        first = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
        self.ids = np.concatenate([self.ids, ids])
        self.begin, self.count = np.concatenate([self.begin, first]), np.concatenate([self.count, count])
        order = np.argsort(h)
        at = np.searchsorted(self.known, h[order])
        self.known, self.row = np.insert(self.known, at, h[order]), np.insert(self.row, at, rows[order])

    def _rows(self, unique: np.ndarray, codes: np.ndarray, joined: str, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.count) + len(unique) > self.keep and len(self.count):
            self._forget()
        rows = self._find(unique)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            where = np.empty(len(unique), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            spans = where[missing]
            texts = [joined[a:b] for a, b in zip(at[spans].tolist(), ends[spans].tolist(), strict=True)]
            parts = [self._encode_pieces(texts[k : k + 4096]) for k in range(0, len(texts), 4096)]
            self._learn(unique[missing], *(np.concatenate(x) for x in zip(*parts, strict=True)))
            rows = self._find(unique)
        return rows

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each piece has), from one text of all pieces: a piece's last token ends a word."""
        ids = np.array(self.tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(pieces) and ends[-1] == len(ids):
            return ids, np.diff(ends, prepend=0)
        each = [x.ids for x in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]
        return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64)

    def counts(self, texts: list[str]) -> np.ndarray:
        rows, first = self.pieces(texts)
        total = np.concatenate([[0], np.cumsum(self.count[rows])])
        return total[first[1:]] - total[first[:-1]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        rows, first = self.pieces(texts)
        count = self.count[rows]
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        source = np.repeat(self.begin[rows] - (stop - count), count) + np.arange(total)
        ids = self.ids[source].astype("<u4")
        edge = np.concatenate([[0], stop])[first]
        return [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def tokenizer_of(model: bytes) -> PieceTokenizer:
    return PieceTokenizer(model)
