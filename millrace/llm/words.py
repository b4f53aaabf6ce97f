"""Words, word hashes and word-window hashes of whole Arrow columns of text, as numpy arrays.

A helper for operators that run inside ``mapInArrow``: texts are split on their UTF-8 bytes, many
documents at a time, without a Python object per word. Memory is bounded by the group of documents in
hand (``GROUP_BYTES`` of text, or one longer document).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are split at a time.
GROUP_BYTES = 2 << 20
U64 = np.uint64

# The word bytes of the two tokenizations, and the bytes of A-Z in lower case.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = U64(0x9E3779B97F4A7C15)
_GRAM = U64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


class Words(NamedTuple):
    """Words of a group of documents. Word i is ``data[starts[i]:ends[i]]``; document d has the words
    ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8), at


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes together, or one longer row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def split_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool) -> Words:
    """Words of consecutive documents: maximal runs of word bytes within a document."""
    data, edges = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if lower:
        data = LOWER[data]
    word = word_bytes[data]
    if not word.any():
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.zeros(len(edges), np.int64), np.empty(0, U64))
    inner = edges[(edges > 0) & (edges < len(data))]
    joined = word[1:] & word[:-1]
    joined[inner - 1] = False
    starts = np.flatnonzero(word & ~np.concatenate(([False], joined)))
    ends = np.flatnonzero(word & ~np.concatenate((joined, [False]))) + 1
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(begin, lengths)
    terms = _powers(_BASE, int(lengths.max()))[place]
    terms *= data[word].astype(U64) + U64(1)
    return Words(data, starts, ends, np.searchsorted(starts, edges), mix(np.add.reduceat(terms, begin)))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each word on; the last k - 1 places are left out."""
    if len(hashes) < k:
        return np.empty(0, U64)
    size, total, done = 1, hashes, None
    taken = 0
    rest = k
    while rest:  # joins runs of 1, 2, 4, ... words, as the bits of k ask for
        if rest & 1:
            n = len(hashes) - (taken + size) + 1
            with np.errstate(over="ignore"):
                done = total[:n].copy() if done is None else done[:n] * _power(size) + total[taken : taken + n]
            taken += size
        rest >>= 1
        if rest:
            n = len(total) - size
            with np.errstate(over="ignore"):
                total = total[:n] * _power(size) + total[size : size + n]
            size *= 2
    return mix(done + U64(k))


def _power(n: int) -> np.uint64:
    return U64(pow(int(_GRAM), n, 1 << 64))


def gram_places(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers at which a run of k words of one document starts, and how many each document has."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    begin = np.cumsum(counts) - counts
    return np.arange(int(counts.sum()), dtype=np.int64) + np.repeat(first[:-1] - begin, counts), counts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + count - 1``, one after another."""
    begin = np.cumsum(counts) - counts
    return np.arange(int(counts.sum()), dtype=np.int64) + np.repeat(starts - begin, counts)
