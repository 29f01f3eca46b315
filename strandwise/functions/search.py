"""Places of IUPAC patterns in batches of sequences: bases and letters as 4-bit
masks, compared for all places of all sequences of one length at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .seq import AMBIGUOUS, COMPLEMENT, IUPAC

_BIT = {"A": 1, "C": 2, "G": 4, "T": 8}
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[97:123] -= 32
_TURNED = np.arange(256, dtype=np.uint8)
_TURNED[list(IUPAC.encode())] = list(COMPLEMENT.encode())
#: Plain bases only; whatever else stands in a read matches no pattern.
_MASK = np.zeros(256, np.uint8)
_MASK[list(b"ACGT")] = [1, 2, 4, 8]
#: Letters of a word that is looked up as one number, and the bases' numbers (4: none).
WORD = 6
_TWO = np.full(256, 4, np.uint8)
_TWO[list(b"ACGT")] = [0, 1, 2, 3]
#: Cells of the matrix of places that is held at once.
CELLS = 1 << 22


def pattern_masks(pattern: str) -> np.ndarray:
    """The bases that each letter stands for; a letter that is none matches nothing."""
    return np.array([sum(_BIT[b] for b in AMBIGUOUS.get(x, "")) for x in pattern.upper()], np.uint8)


def turned(x: np.ndarray) -> np.ndarray:
    """Reverse complements of the rows of letters."""
    return _TURNED[x[:, ::-1]]


def letters_by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the rows of one length, and their letters in upper case, a row each."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    if column.nbytes and not pc.all(pc.string_is_ascii(column)).as_py():
        column = pc.replace_substring_regex(column, "[^\\x00-\\x7f]", "?")
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = _UPPER[np.frombuffer(values, np.uint8)] if values is not None else np.zeros(0, np.uint8)
    sizes = np.diff(bounds)
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        for i in range(0, len(rows), max(1, CELLS // max(1, n))):
            part = rows[i : i + max(1, CELLS // max(1, n))]
            yield part, data[bounds[part][:, None] + np.arange(n)]


def word_codes(letters: np.ndarray) -> np.ndarray:
    """A number for the WORD letters from each place on; one with a letter that is no base has the last number."""
    two = _TWO[letters]
    width = max(0, letters.shape[1] - WORD + 1)
    codes = np.zeros((len(letters), width), np.uint16)
    for k in range(WORD):
        codes = codes * 4 + (two[:, k : k + width] & 3)
    bad = two == 4
    if bad.any():
        for k in range(WORD):
            codes[bad[:, k : k + width]] = 4**WORD
    return codes


def first_places(codes: np.ndarray, patterns: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """(row, start) of the places where the first WORD letters of each pattern fit, in one
    pass over the codes for eight patterns; None for a pattern with fewer letters."""
    out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(patterns)
    long = [k for k, p in enumerate(patterns) if len(p) >= WORD]
    for i in range(0, len(long), 8):
        fits = np.zeros(4**WORD + 1, np.uint8)
        for bit, k in enumerate(long[i : i + 8]):
            right = np.ones(4**WORD, bool)
            for j in range(WORD):
                right &= (1 << (np.arange(4**WORD) >> 2 * (WORD - 1 - j) & 3) & patterns[k][j]) > 0
            fits[:-1] |= right.astype(np.uint8) << bit
        found = fits[codes]
        row, start = np.divmod(np.flatnonzero(found), max(1, codes.shape[1]))
        bits = found[row, start]
        for bit, k in enumerate(long[i : i + 8]):
            here = (bits >> bit & 1).astype(bool)
            out[k] = (row[here], start[here])
    return out


def places(letters: np.ndarray, pattern: np.ndarray, most: int = 0, codes: np.ndarray | None = None, first: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, errors) of all places where at most ``most`` letters differ, by row,
    then start. Some columns are compared everywhere, the others where hope is left;
    ``codes`` of the letters, if given, tell at once where the first WORD letters fit,
    and ``first`` holds such places found before."""
    m, n = letters.shape
    number, width = len(pattern), n - len(pattern) + 1
    if width <= 0 or not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not most and first is not None:
        row, start = first[0][first[1] < width], first[1][first[1] < width]
        errors, dense = np.zeros(len(row), np.int64), WORD
    elif not most and codes is not None and number >= WORD:
        right = np.ones(4**WORD + 1, bool)
        right[-1] = False
        for k in range(WORD):
            right[:-1] &= (1 << (np.arange(4**WORD) >> 2 * (WORD - 1 - k) & 3) & pattern[k]) > 0
        row, start = np.nonzero(right[codes[:, :width]])
        errors, dense = np.zeros(len(row), np.int64), WORD
    else:
        x = _MASK[letters]
        wrong, dense = np.zeros((m, width), np.uint8), min(number, 4 + 2 * most)
        for k in range(dense):
            wrong += (x[:, k : k + width] & pattern[k]) == 0
        row, start = np.nonzero(wrong <= most)
        errors = wrong[row, start].astype(np.int64)
    for k in range(dense, number):
        errors += (_MASK[letters[row, start + k]] & pattern[k]) == 0
        keep = errors <= most
        row, start, errors = row[keep], start[keep], errors[keep]
    return row, start, errors
