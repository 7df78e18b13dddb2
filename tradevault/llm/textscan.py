"""Flat numpy views of a column of texts: the words of a whole block of documents, their places and their hashes.

Texts stay UTF-8 bytes as Arrow delivers them, so no Python string is built per word. A block holds half a megabyte of text,
or a single document if that is longer; nothing is cut. So arrays stay small, and workers that Spark reuses keep little memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
BYTE_BASE, WORD_BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F

#: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Everything but the space and the control characters 0x09 to 0x0D.
NONSPACE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept per process and grown on demand."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // 65536) * 65536
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        have = _powers[base] = (pair[0], pair[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offs[0] : offs[-1]], offs - offs[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of rows of about ``size`` bytes."""
    data, offs = strings(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, side="right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


class Words:
    """Words of the documents of one block: byte starts and ends, and the index of each document's first word."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, kind: np.ndarray, lower: bool) -> None:
        self.data = LOWER[data] if lower else data
        inside = kind[data]
        begins, ends = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            edges = offs[1:-1]
            edges = edges[(edges > 0) & (edges < len(data))]
            begins[edges] = inside[edges]
            ends[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offs)
        self.offs = offs

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b]))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, by differences of one running sum over the block's bytes."""
        n = len(self.data)
        power, inverse = powers(BYTE_BASE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts])


def windows(hashes: np.ndarray, starts: np.ndarray, length: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of the ``length`` words from each of ``starts``; independent of the place within the block."""
    n = len(hashes)
    power, inverse = powers(base, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=total[1:])
    return mix((total[starts + length] - total[starts]) * inverse[starts])


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Word indexes at which a window of ``length`` words fits into its document."""
    total = int(first[-1])
    if total < length:
        return np.zeros(0, np.int64)
    fits = np.zeros(total + 1, np.int64)
    has = np.diff(first) >= length
    np.add.at(fits, first[:-1][has], 1)
    np.add.at(fits, first[1:][has] - length + 1, -1)
    return np.flatnonzero(np.cumsum(fits[:-1]) > 0)


def covered(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Which of ``n`` words lie in one of the windows."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
