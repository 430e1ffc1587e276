"""Text columns of Arrow batches as byte arrays, cut into words and hashed without a Python loop.

Words are maximal runs of bytes other than the ASCII white space (0x20, 0x09-0x0D); all other bytes,
UTF-8 continuation bytes included, belong to words. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes folded to lower case (A-Z only).
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Lower case, and every ASCII sign that is no letter or digit turned into a space.
PLAIN = LOWER.copy()
PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = 0x20

#: ASCII signs: neither letter nor digit nor white space.
SIGN = np.array([i < 128 and not chr(i).isalnum() and not WHITE[i] for i in range(256)])

#: ASCII letters and digits.
ALNUM = np.array([i < 128 and chr(i).isalnum() for i in range(256)])

#: Bytes of text taken through numpy at once. A longer text is taken alone.
BLOCK_BYTES = 2 << 20

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES) + 1
        _powers = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, x, np.uint64))]) for x in (_BASE, _INVERSE))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _BASE
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one number more than texts)."""
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of whole texts of at most `limit` bytes."""
    data, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, longest: int | None = None, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of its text.

    `longest` cuts longer words into pieces; `cut` marks bytes at which a new piece begins inside a word.
    """
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    solid = ~WHITE[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | begins[1:n]
    if cut is not None:
        start |= cut & solid
    end = solid
    end[:-1] &= ~solid[1:] | start[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if longest is not None and len(starts) and (ends - starts).max() > longest:
        pieces = -(-(ends - starts) // longest)
        of = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = starts[of] + nth * longest, np.minimum(starts[of] + (nth + 1) * longest, ends[of])
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run; equal runs have equal hashes in every batch and on every machine."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sorted_set(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def distinct_words(data, starts, ends):
    """Index of one example of each different word, for every word the number of its example, and the examples' hashes (sorted)."""
    h = hashes(data, starts, ends)
    order = np.argsort(h)
    ordered = h[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(h) else np.zeros(0, bool)
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse, ordered[new]


def column_of(name: str, columns: list[str]) -> str:
    """A name for a helper column that does not clash with the caller's."""
    while name in columns:
        name = "_" + name
    return name
