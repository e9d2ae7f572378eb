"""Words of texts as numbers: ASCII white space parts them, 64-bit hashes stand for them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A finalizer over 64-bit numbers: every bit of the input moves every bit of the result."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def constants(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers, the same in every process."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


# Longer spans are digested one at a time.
_LONGEST_SPAN = 512
_SEEDS = constants(2, 11)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes ``data[start:end]``; equal spans have equal hashes.

    Blocks of eight bytes are mixed in one after another, all spans' first blocks at once and then
    their next ones, so a hash is no sum of its parts and words built alike do not meet.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    sizes = ends - starts
    hashes = mix(sizes.astype(np.uint64) + _SEEDS[0])
    long = np.flatnonzero(sizes > _LONGEST_SPAN)
    for number in long.tolist():
        digest = hashlib.blake2b(data[starts[number] : ends[number]], digest_size=8).digest()
        hashes[number] ^= np.uint64(int.from_bytes(digest, "little"))
    some = np.flatnonzero((sizes > 0) & (sizes <= _LONGEST_SPAN))
    at, left = starts[some], sizes[some]
    while len(some):
        block = blocks[at]
        short = np.flatnonzero(left < 8)
        block[short] &= _HEADS[left[short]]
        hashes[some] = mix(hashes[some] ^ mix(block + _SEEDS[1]))
        more = np.flatnonzero(left > 8)
        some, at, left = some[more], at[more] + 8, left[more] - 8
    return hashes


# The bits of a block's first bytes, by their number.
_HEADS = np.array([(1 << 8 * count) - 1 for count in range(8)], np.uint64)


@dataclass
class Words:
    """Words of some documents in order: hash, number of the document, and place in its bytes."""

    hashes: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    def bounds(self) -> np.ndarray:
        """Where each document's words begin, and the end of the last."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts side by side and where each begins; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def hashed_words(texts: pa.Array, lower: bool) -> Words:
    """Every maximal run of bytes other than ASCII white space, lower-cased in A-Z if asked."""
    data, bounds = utf8(texts)
    if lower:
        data = _LOWER[data]
    size = len(data)
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    space = _SPACE[data]
    word = ~space
    begins, finishes = word.copy(), word.copy()
    begins[1:] &= space[:-1] | edge[1:size]
    finishes[:-1] &= space[1:] | edge[1:size]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    doc = np.searchsorted(bounds, starts, "right") - 1
    counts = np.bincount(doc, minlength=len(bounds) - 1)
    return Words(span_hashes(data, starts, ends), doc, counts)
