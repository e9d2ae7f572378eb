"""The tokenizers' pre-tokens, found with array operations over code points.

The pattern is fixed by the public vocabularies: contractions, then letters, numbers or other
signs with one leading space, then white space, of which the last character before something
else is left to what follows.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

from tallyroll.llm.words import span_hashes

_SIGN, _LETTER, _NUMBER, _WHITE, _SPACE = range(5)
_APOSTROPHE = 39


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every code point, by the pattern's own character classes."""
    kinds = np.zeros(0x110000, np.uint8)
    for first, last in ((0, 0xD800), (0xE000, 0x110000)):
        characters = "".join(map(chr, range(first, last)))
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
            for found in regex.finditer(pattern, characters):
                kinds[first + found.start() : first + found.end()] = kind
    kinds[32] = _SPACE
    return kinds


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts side by side, and where each text begins."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return points, np.concatenate(([0], np.cumsum([len(text) for text in texts], dtype=np.int64)))


def pretoken_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of the texts begin; together they cover every character."""
    size = len(points)
    if not size:
        return np.zeros(0, np.int64)
    kinds = _kinds()[points]
    white = kinds >= _WHITE
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    grouped = np.minimum(kinds, _WHITE)
    begins = edge[:size].copy()
    begins[1:] |= grouped[1:] != grouped[:-1]
    # The last white space before something else stands alone, or leads it if it is a space.
    begins[:-1] |= white[:-1] & ~white[1:] & ~edge[1:size]
    led = np.zeros(size, bool)
    led[1:] = ~white[1:] & (kinds[:-1] == _SPACE) & ~edge[1:size]
    begins &= ~led
    _contract(points, kinds, edge, begins)
    return np.flatnonzero(begins)


def _contract(points: np.ndarray, kinds: np.ndarray, edge: np.ndarray, begins: np.ndarray) -> None:
    """Cut 's 't 're 've 'm 'll 'd off where an apostrophe begins a pre-token."""
    size = len(points)
    at = np.flatnonzero((points == _APOSTROPHE) & begins)
    at = at[at + 1 < size]
    at = at[~edge[at + 1]]
    first = points[at + 1]
    short = np.isin(first, [ord(letter) for letter in "stmd"])
    after = np.minimum(at + 2, size - 1)
    second = np.where((at + 2 < size) & ~edge[np.minimum(at + 2, size)], points[after], 0)
    long = np.zeros(len(at), bool)
    for pair in ("re", "ve", "ll"):
        long |= (first == ord(pair[0])) & (second == ord(pair[1]))
    for chosen, length in ((at[short], 2), (at[long], 3)):
        begins[chosen + 1] = False
        rest = chosen + length
        rest = rest[rest < size]
        begins[rest[kinds[rest] == _LETTER]] = True


def pretoken_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit number for each pre-token; equal pre-tokens have equal numbers, and others may share one."""
    ends = np.concatenate((starts[1:], [len(points)])).astype(np.int64)
    # A code point has four bytes.
    return span_hashes(points.view(np.uint8), 4 * starts, 4 * ends)
