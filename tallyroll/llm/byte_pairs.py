"""Ranked merges over the bytes of distinct words, and whole texts encoded through them.

The words of a batch are merged side by side: each round finds every word's lowest rank and
merges its pairs, so the work is a few array passes for each depth of merging, not a loop over
words. Encodings are remembered by word, so a word is merged once in a worker's life as long as
the memory, which is bounded, holds it. Words are found by their hash and then compared letter by
letter with the remembered one, so words that share a hash are told apart.
"""

from __future__ import annotations

import base64
import functools
import json
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd

from tallyroll.llm.pretokens import code_points, pretoken_hashes, pretoken_starts

_NONE = np.iinfo(np.int64).max
_SHIFT = np.int64(1 << 20)
# Words remembered at once, in some 60 bytes each, and the letters of the longest one that is.
REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64


@dataclass
class Merges:
    """Byte ids, and for each pair of ids that may merge its rank and the id it becomes."""

    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    pieces: list[bytes]
    specials: dict[str, int]

    @classmethod
    def of(cls, tokens: dict[bytes, int], pairs: array, specials: dict[str, int]) -> Merges:
        """``pairs`` holds left id, right id, rank and merged id of each pair, one after another."""
        left, right, ranks, merged = np.array(pairs).reshape(-1, 4).T
        keys = left * _SHIFT + right
        order = np.argsort(keys)
        pieces = pieces_by_id({**tokens, **{text.encode(): number for text, number in specials.items()}})
        byte_ids = np.array([tokens[bytes([value])] for value in range(256)], np.int64)
        return cls(byte_ids, keys[order], ranks[order], merged[order], pieces, specials)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; the rank is _NONE where they do not merge."""
        wanted = left * _SHIFT + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words side by side, and how many each has."""
        lengths = np.array([len(word) for word in words], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_words = [], []
        rank, new = self._ranked(ids, word)
        while len(ids):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            local = np.cumsum(np.concatenate(([False], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, first)
            active = (best < _NONE)[local]
            if not active.all():
                done_ids.append(ids[~active])
                done_words.append(word[~active])
                ids, word, rank, new, local = ids[active], word[active], rank[active], new[active], local[active]
                if not len(ids):
                    break
            ids, word, rank, new = self._merge_round(ids, word, rank, new, rank == best[local])
        if not done_ids:
            return np.zeros(0, np.int64), lengths
        found, owner = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        return found[order], np.bincount(owner, minlength=len(words))

    def _ranked(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, new = np.full(len(ids), _NONE), np.full(len(ids), -1, np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], new[inner] = self.find(ids[inner], ids[inner + 1])
        return rank, new

    def _merge_round(self, ids, word, rank, new, lowest):
        """Merge each word's lowest pairs, all of them where that equals one at a time from the left."""
        at = np.flatnonzero(lowest)
        # Of overlapping pairs (a run of equal ids) every second one, from the left.
        run = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (word[at[1:]] != word[at[:-1]])))
        begun = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - begun) % 2 == 0]
        # A pair that a merge creates must not come before the pairs still to be merged.
        made, limit, owner = new[at], rank[at], word[at]
        size = len(ids)
        soon = np.zeros(len(at), bool)
        right = at + 2
        inside = np.flatnonzero((right < size) & (word[np.minimum(right, size - 1)] == owner))
        soon[inside] = self.find(made[inside], ids[right[inside]])[0] <= limit[inside]
        merged_ids = ids.copy()
        merged_ids[at] = made
        gone = np.zeros(size, bool)
        gone[at + 1] = True
        left = at - 1
        left = np.where((left >= 0) & gone[left], left - 1, left)
        inside = np.flatnonzero((left >= 0) & (word[np.maximum(left, 0)] == owner))
        soon[inside] |= self.find(merged_ids[left[inside]], made[inside])[0] <= limit[inside]
        if soon.any():
            leading = np.concatenate(([True], owner[1:] != owner[:-1]))
            at = at[leading | ~np.isin(owner, owner[soon])]
            merged_ids = ids.copy()
            gone = np.zeros(size, bool)
            merged_ids[at] = new[at]
            gone[at + 1] = True
        keep = ~gone
        place = np.cumsum(keep) - 1
        ids, word, rank, new = merged_ids[keep], word[keep], rank[keep], new[keep]
        changed = np.zeros(len(ids) + 1, bool)
        changed[place[at]] = True
        changed[place[at] - 1] = True
        touched = np.flatnonzero(changed[:-1])
        following = np.minimum(touched + 1, len(ids) - 1)
        same = (touched + 1 < len(ids)) & (word[following] == word[touched])
        found, becomes = self.find(ids[touched], ids[following])
        rank[touched] = np.where(same, found, _NONE)
        new[touched] = becomes
        return ids, word, rank, new


def pieces_by_id(tokens: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(tokens.values()) + 1)
    for token, number in tokens.items():
        pieces[number] = token
    return pieces


def _ranked_tokens(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, content.splitlines())}


@functools.lru_cache(maxsize=2)
def rank_pieces(content: bytes) -> list[bytes]:
    """The pieces of a rank file by id."""
    return pieces_by_id(_ranked_tokens(content))


def merges_of_ranks(content: bytes) -> Merges:
    """From a rank file: any two pieces merge if their bytes together are a piece, whose rank is its id."""
    tokens = _ranked_tokens(content)
    pairs = array("q")
    for token, rank in tokens.items():
        for cut in range(1, len(token)):
            left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
            if left is not None and right is not None:
                pairs.extend((left, right, rank, rank))
    return Merges.of(tokens, pairs, {})


def merges_of_json(content: bytes) -> Merges:
    """From a tokenizer's description: the listed pairs merge, in the order of the list."""
    described = json.loads(content)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(value): value for value in printable}
    others = (value for value in range(256) if value not in set(printable))
    letters |= {chr(256 + number): value for number, value in enumerate(others)}
    specials = {entry["content"]: entry["id"] for entry in described["added_tokens"]}
    vocabulary = described["model"]["vocab"]
    tokens = {
        bytes(letters[letter] for letter in piece): number for piece, number in vocabulary.items() if piece not in specials
    }
    pairs = array("q")
    for rank, merge in enumerate(described["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.extend((vocabulary[left], vocabulary[right], rank, vocabulary[left + right]))
    return Merges.of(tokens, pairs, specials)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _utf8_words(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    spans = zip(starts.tolist(), (starts + sizes).tolist(), strict=True)
    return [points[start:end].tobytes().decode("utf-32-le").encode() for start, end in spans]


class _Pool:
    """Numbers that only grow, in one array."""

    def __init__(self, kind: type):
        self.data, self.used = np.zeros(1 << 16, kind), 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Where each of the runs of ``values``, as long as ``counts`` says, begins."""
        needed = self.used + len(values)
        if needed > len(self.data):
            self.data = np.concatenate((self.data, np.zeros(max(needed, len(self.data)), self.data.dtype)))
        self.data[self.used : needed] = values
        firsts = self.used + np.cumsum(counts) - counts
        self.used = needed
        return firsts


class TextEncoder:
    """Whole texts to ids, word by word, remembering words."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self._forget()

    def _forget(self) -> None:
        """Known words by ascending hash, and where in the pools each one's letters and ids lie."""
        self._hashes = np.zeros(0, np.uint64)
        self._words = np.zeros((0, 4), np.int64)
        self._letters, self._ids = _Pool(np.uint32), _Pool(np.int32)

    def _learn(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> None:
        """Add the words at some places of ``points``; their hashes ascend and are new."""
        ids, counts = self.merges.encode(_utf8_words(points, starts, sizes))
        rows = np.stack((self._letters.add(points[_spread(starts, sizes)], sizes), sizes, self._ids.add(ids, counts), counts), axis=1)
        places = np.searchsorted(self._hashes, hashes)
        self._words = np.insert(self._words, places, rows, axis=0)
        self._hashes = np.insert(self._hashes, places, hashes)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where among the known words each hash is, and whether it is there."""
        if not len(self._hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        places = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return places, self._hashes[places] == hashes

    def _spelled_alike(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Whether each word of ``points``, which they cover, has the letters of the known word beside it."""
        alike = words[:, 1] == sizes
        shift = np.where(alike, words[:, 0], 0) - starts
        at = np.minimum(np.repeat(shift, sizes) + np.arange(len(points)), self._letters.used - 1)
        return alike & ~np.logical_or.reduceat(self._letters.data[at] != points, starts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts side by side, and where each text's begin (and the end)."""
        for special in self.merges.specials:
            if any(special in text for text in texts):
                return self._encode_with_specials(texts)
        return self._encode_plain(texts)

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, bounds = code_points(texts)
        starts = pretoken_starts(points, bounds)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        sizes = np.diff(starts, append=len(points))
        codes, distinct = pd.factorize(pretoken_hashes(points, starts))
        if len(self._hashes) > REMEMBERED:
            self._forget()
        places, known = self._places(distinct)
        if not known.all():
            some = np.zeros(len(distinct), np.int64)
            some[codes[::-1]] = np.arange(len(codes))[::-1]  # the first place of each word
            unknown = np.flatnonzero(~known & (sizes[some] <= LONGEST_REMEMBERED))
            unknown = unknown[np.argsort(distinct[unknown])]
            self._learn(points, starts[some[unknown]], sizes[some[unknown]], distinct[unknown])
            places, known = self._places(distinct)
        found = np.zeros((len(starts), 2), np.int64)
        alike = np.zeros(len(starts), bool)
        if len(self._hashes):
            words = self._words[places][codes]
            found[:] = words[:, 2:]
            alike = known[codes] & self._spelled_alike(points, starts, sizes, words)
        others = np.flatnonzero(~alike)
        pool = self._ids.data[: self._ids.used]
        if len(others):
            numbers: dict[bytes, int] = {}
            which = [numbers.setdefault(word, len(numbers)) for word in _utf8_words(points, starts[others], sizes[others])]
            ids, counts = self.merges.encode(list(numbers))
            found[others] = np.stack((len(pool) + np.cumsum(counts) - counts, counts), axis=1)[which]
            pool = np.concatenate((pool, ids.astype(np.int32)))
        before = np.concatenate(([0], np.cumsum(found[:, 1])))
        return pool[_spread(*found.T)], before[np.searchsorted(starts, bounds)]

    def _encode_with_specials(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Special strings inside texts become their own ids, as the tokenizer's library has it."""
        parts: list[tuple[str, int | None]] = []
        counts = []
        for text in texts:
            split = [(text, None)]
            for special, number in self.merges.specials.items():
                split = [
                    piece
                    for part, known in split
                    for piece in ([(part, known)] if known is not None else _around(part, special, number))
                ]
            parts += split
            counts.append(len(split))
        ids, bounds = self._encode_plain(["" if known is not None else part for part, known in parts])
        pieces = [
            ids[bounds[place] : bounds[place + 1]] if known is None else np.array([known], np.int32)
            for place, (_, known) in enumerate(parts)
        ]
        ends = np.concatenate(([0], np.cumsum([len(piece) for piece in pieces])))
        return np.concatenate([np.zeros(0, np.int32), *pieces]), ends[np.concatenate(([0], np.cumsum(counts)))]


def _around(text: str, special: str, number: int) -> list[tuple[str, int | None]]:
    first, *rest = text.split(special)
    return [(first, None), *(piece for part in rest for piece in ((special, number), (part, None)))]


@functools.lru_cache(maxsize=2)
def rank_encoder(content: bytes) -> TextEncoder:
    return TextEncoder(merges_of_ranks(content))


@functools.lru_cache(maxsize=2)
def json_encoder(content: bytes) -> TextEncoder:
    return TextEncoder(merges_of_json(content))
