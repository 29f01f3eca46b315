"""Pre-tokens of text blocks in numpy, equal to those of the tokenizers library.

Two tokenizer families are known: byte-level BPE with the contraction / letter /
number / other split that keeps white space (``space_kept``), and lower-casing
BPE with word ends that drops it. Code points below ``KNOWN`` go through class
tables; a text with any other code point, with a special token's string, or
that is not in the expected normal form goes through the library itself, so
the result is the library's in every case.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import regex

from .common import byte_hashes, same_spans

KNOWN = 0x3000
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = 0, 1, 2, 3, 4
#: The printable bytes that byte-level BPE writes as themselves.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


@lru_cache(4)
def load(path: str):
    """(tokenizer, keeps white space, special strings) of a tokenizers file."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return Tokenizer.from_file(path), spec.get("normalizer") is None, tuple(t["content"] for t in spec["added_tokens"])


@lru_cache(1)
def _byte_letters() -> dict[int, int]:
    rest = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {b: 0x100 + i for i, b in enumerate(rest)}


def as_byte_letters(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_byte_letters())


@lru_cache(2)
def _tables(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Class and (lower-cased) code point of each code point up to KNOWN."""
    kind, to = np.zeros(KNOWN + 1, np.uint8), np.arange(KNOWN + 1, dtype=np.uint32)
    letter, number, space = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\p{White_Space}")
    for c in range(KNOWN):
        s = chr(c).lower() if lower else chr(c)
        if len(s) != 1 or not unicodedata.category(s) or unicodedata.category(chr(c)) == "Cn":
            kind[c] = UNKNOWN
            continue
        to[c] = ord(s)
        kind[c] = LETTER if letter.match(s) else NUMBER if number.match(s) else SPACE if space.match(s) else OTHER
    kind[KNOWN] = UNKNOWN
    return kind, to


class Block:
    """Pre-tokens of some texts: ``starts``, ``ends`` (into ``chars``) and ``row``
    of each, ``first`` of each distinct string and the number of its string in
    ``which``; ``whole`` marks the rows that need the library (for the
    lower-casing family they have no spans here)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, path: str):
        self.tokenizer, self.keeps, special = load(path)
        text = data.tobytes().decode("utf-8")
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        self.bounds = lead[bounds]
        raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds, to = _tables(not self.keeps)
        clipped = np.minimum(raw, KNOWN)
        kind = kinds[clipped]
        self.chars = raw if self.keeps else np.where(raw < KNOWN, to[clipped], raw)
        rows = len(bounds) - 1
        odd = np.zeros(rows, bool)
        odd[self.row_of(np.flatnonzero(kind == UNKNOWN))] = True
        for s in special:
            at = text.find(s)
            while at >= 0:
                odd[self.row_of(np.array([at]))] = True
                at = text.find(s, at + 1)
        if not self.keeps and not unicodedata.is_normalized("NFC", text):
            for r in range(rows):
                odd[r] |= not unicodedata.is_normalized("NFC", text[self.bounds[r] : self.bounds[r + 1]])
        self.whole, self.raw_text = odd, text
        self.starts, self.ends = self._kept(kind) if self.keeps else self._dropped(kind)
        self.row = self.row_of(self.starts)
        if odd.any():
            fine = ~odd[self.row]
            self.starts, self.ends, self.row = self.starts[fine], self.ends[fine], self.row[fine]
            if self.keeps:
                more = [x for r in np.flatnonzero(odd) for x in self._by_library(int(r), special)]
                if more:
                    s, e, r = (np.array(x, np.int64) for x in zip(*more, strict=True))
                    self.starts, self.ends, self.row = np.concatenate([self.starts, s]), np.concatenate([self.ends, e]), np.concatenate([self.row, r])
        most = int(self.chars.max(initial=0))
        narrow = self.chars.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
        seed, same = 0, False
        while not same:  # equal hashes of unequal strings call for other hashes
            _, self.first, self.which = np.unique(byte_hashes(narrow, self.starts, self.ends, seed), return_index=True, return_inverse=True)
            seed, same = seed + 1, same_spans(narrow, self.starts, self.ends, self.first[self.which])

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, at, side="right") - 1

    def strings(self, which: np.ndarray) -> list[str]:
        text = self.raw_text if self.keeps else self.chars.astype("<u4").tobytes().decode("utf-32-le")
        return [text[s:e] for s, e in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]

    def row_text(self, r: int) -> str:
        return self.raw_text[self.bounds[r] : self.bounds[r + 1]]

    def _by_library(self, r: int, special: tuple[str, ...]):
        """Spans of a row as the library cuts it: special strings first, then its pre-tokenizer."""
        text, base = self.row_text(r), int(self.bounds[r])
        at = 0
        for part in regex.split("(" + "|".join(map(regex.escape, special)) + ")", text) if special else [text]:
            if part in special:
                yield base + at, base + at + len(part), r
            elif part:
                for _, (s, e) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    yield base + at + s, base + at + e, r
            at += len(part)

    def _runs(self, kind: np.ndarray):
        """Starts, ends and kinds of the runs of one kind that don't cross rows."""
        n = len(kind)
        edge = np.zeros(n + 1, bool)
        edge[1:n] = kind[1:] != kind[:-1]
        edge[self.bounds] = True
        edge[n] = False
        s = np.flatnonzero(edge[:n])
        return s, np.append(s[1:], n)[: len(s)], kind[s]

    def _contractions(self, s: np.ndarray, e: np.ndarray, k: np.ndarray, free: np.ndarray):
        """Runs that are one apostrophe, free to start a pre-token, with a letter
        run behind that starts as a contraction does; and its letters' number."""
        if len(s) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q = np.flatnonzero((k[:-1] == OTHER) & (e[:-1] - s[:-1] == 1) & (self.chars[s[:-1]] == ord("'")) & free[:-1] & (k[1:] == LETTER))
        q = q[self.row_of(s[q]) == self.row_of(s[q + 1])]
        at = s[q + 1]
        one, two = self.chars[at], np.where(e[q + 1] - at > 1, self.chars[np.minimum(at + 1, len(self.chars) - 1)], 0)
        letters = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for pair in ("re", "ve", "ll"):
            letters = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 2, letters)
        return q[letters > 0], letters[letters > 0]

    def _kept(self, kind: np.ndarray):
        s, e, k = self._runs(kind)
        start = np.zeros(len(kind) + 1, bool)
        if not len(s):
            return s, e
        is_space, same = k == SPACE, np.append(self.row_of(s[1:]) == self.row_of(s[:-1]), False)
        before_word = is_space & same
        start[s[is_space]] = True
        start[e[before_word] - 1] = True
        attached = np.append(False, before_word[:-1] & (self.chars[e[:-1] - 1] == 32))
        start[s[~is_space & ~attached]] = True
        q, letters = self._contractions(s, e, k, ~attached)
        start[s[q + 1]] = False
        start[s[q + 1] + letters] = True
        start[self.bounds[(self.bounds < len(kind))]] = True
        at = np.flatnonzero(start[: len(kind)])
        return at, np.append(at[1:], len(kind))

    def _dropped(self, kind: np.ndarray):
        s, e, k = self._runs(kind)
        start, end = np.zeros(len(kind) + 1, bool), np.zeros(len(kind) + 1, bool)
        words = (k == LETTER) | (k == OTHER)
        start[s[words]] = True
        end[e[words]] = True
        q, letters = self._contractions(s, e, k, np.ones(len(s), bool))
        start[s[q + 1]] = False
        end[e[q]] = False
        cut = s[q + 1] + letters
        whole = cut == e[q + 1]  # the letters are the whole run
        end[cut] = True
        start[cut[~whole]] = True
        number = np.flatnonzero(kind == NUMBER)
        start[number] = True
        end[number + 1] = True
        return np.flatnonzero(start), np.flatnonzero(end)
