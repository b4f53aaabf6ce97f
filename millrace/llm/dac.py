"""Directly addressable codes: variable-length numbers with random access.

Each number is cut into chunks of eight bits, lowest first. Level 0 has the first chunk of every number and a bitmap
that says which numbers go on; level 1 has the next chunk of those, and so on. The place of a number in the next level
is the count of set bits before it, which a rank directory (one running count for 512 bits) gives at once. So any
number is read from a few bytes, wherever it stands.

A token file holds one shard of documents: a magic word, a table of sections, and the sections themselves, little-endian
and aligned to eight bytes: document ids, whether each id is set, first token of each document (and the total), then
chunks, bitmap and directory of each level.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"DACTOK01"
#: Bits of a bitmap that share an entry of the rank directory.
RANK_BITS = 512


def encode_levels(values: np.ndarray) -> list[np.ndarray]:
    """Chunks, bitmap and rank directory of each level, one after another. No values: one empty level."""
    out, rest = [], values
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS)) if len(more) else np.empty(0, np.int64)
        out += [rest.astype(np.uint8), bitmap, np.concatenate(([0], np.cumsum(counts))).astype("<u8")]
        if not more.any():
            return out
        rest = rest[more] >> rest.dtype.type(8)


def to_bytes(doc_ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray) -> bytes:
    """A token file of consecutive documents."""
    there = np.array([i is not None for i in doc_ids], np.uint8)
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8")
    starts = np.concatenate(([0], np.cumsum(lengths))).astype("<u8")
    sections = [ids, there, starts, *encode_levels(tokens)]
    table = np.array([s.nbytes for s in sections], "<u8")
    blocks = [MAGIC, np.array([len(sections)], "<u8").tobytes(), table.tobytes()]
    blocks += [s.tobytes() + bytes(-s.nbytes % 8) for s in sections]
    return b"".join(blocks)


class TokenFile:
    """A token file's bytes (or a memory map of them), read in place."""

    def __init__(self, data):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        n = int(np.frombuffer(data, "<u8", 1, 8)[0])
        sizes = np.frombuffer(data, "<u8", n, 16).astype(np.int64)
        padded = sizes + (-sizes % 8)
        at = 16 + 8 * n + np.cumsum(padded) - padded

        def section(i, kind):
            return np.frombuffer(data, kind, int(sizes[i]) // np.dtype(kind).itemsize, int(at[i]))

        self._ids, self._there, self.starts = section(0, "<i8"), section(1, np.uint8), section(2, "<u8").astype(np.int64)
        self._levels = [(section(i, np.uint8), section(i + 1, np.uint8), section(i + 2, "<u8")) for i in range(3, n, 3)]

    @property
    def doc_ids(self) -> list[int | None]:
        return [int(i) if t else None for i, t in zip(self._ids, self._there)]

    def token(self, i: int) -> int:
        """Token i of the file, without decoding any other."""
        if not 0 <= i < self.starts[-1]:
            raise IndexError(i)
        value = 0
        for shift, (chunks, bitmap, ranks) in enumerate(self._levels):
            value |= int(chunks[i]) << (8 * shift)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            before = bitmap[block * RANK_BITS // 8 : i // 8]
            part = int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[block]) + int(np.bitwise_count(before).sum()) + part.bit_count()
        return value

    def tokens(self) -> np.ndarray:
        """All tokens."""
        out = self._levels[0][0].astype(np.uint64)
        at = np.arange(len(out))
        for shift, ((chunks, bitmap, _), (higher, _, _)) in enumerate(zip(self._levels, self._levels[1:]), 1):
            at = at[np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)]
            out[at] |= higher.astype(np.uint64) << np.uint64(8 * shift)
        return out

    def document(self, d: int) -> list[int]:
        """Tokens of the file's d-th document, read one by one."""
        return [self.token(i) for i in range(self.starts[d], self.starts[d + 1])]
