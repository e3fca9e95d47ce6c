"""Whole texts of an Arrow batch as numpy arrays: words and their hashes.

Used inside tasks by the operators that read every word of every text; the
work is done in pieces of about a megabyte, so memory does not depend on the
batch, except that a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE = _rng.integers(1, 2**64, 256, dtype=U) | U(1)
BASE = int(_rng.integers(1, 2**62, dtype=np.int64)) * 2 + 1
MIX = _rng.integers(1, 2**64, 64, dtype=U) | U(1)

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
BYTE_LOWER = BYTE[_lower]
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

PIECE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class _Pow:
    """Powers of the hash base and of its inverse, grown on demand."""
    fwd = _powers(BASE, 1)
    inv = _powers(pow(BASE, -1, 2**64), 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.fwd) < n:
            size = max(n, PIECE + 4096)
            cls.fwd, cls.inv = _powers(BASE, size), _powers(pow(BASE, -1, 2**64), size)
        return cls.fwd[:n], cls.inv[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (uint64 in, uint64 out)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    column = column.fill_null(b"")
    n = len(column)
    _, off, val = column.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(val, dtype=np.uint8) if val is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: (first row, end row, bytes, offsets)."""
    data, offs = texts(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def runs(member: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes, cut at text ends."""
    n = len(member)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    start = member.copy()
    start[1:] &= ~member[:-1] | edge[1:n]
    end = member.copy()
    end[:-1] &= ~member[1:] | edge[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, byte: np.ndarray = BYTE) -> np.ndarray:
    """64-bit hash of each byte range (polynomial over random byte values,
    taken from one running sum, then mixed)."""
    if len(start) == 0:
        return np.zeros(0, U)
    fwd, inv = _Pow.upto(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(byte[data] * fwd[:-1], out=total[1:])
        h = (total[end] - total[start]) * inv[start]
        return mix(h + (end - start).astype(U) * MIX[0])


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every whitespace-separated word (A-Z lower-cased), and the
    index range of the words of each text: words of text i are
    first[i]:first[i + 1]."""
    s, e = runs(~SPACE[data], offs)
    return hashes(data, s, e, BYTE_LOWER), np.searchsorted(s, offs)


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all `width`-word shingles, text by text, with their index
    ranges; a text of fewer words has its whole sequence as one shingle, a
    text without words has none."""
    count = np.diff(first)
    n_sh = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(n_sh)]).astype(np.int64)
    if len(words) == 0:
        return np.zeros(0, U), bounds
    with np.errstate(over="ignore"):
        acc = np.zeros(len(words), dtype=U)
        for j in range(width):
            acc[:len(words) - j] += words[j:] * MIX[1 + j]
        owner = np.repeat(np.arange(len(count)), n_sh)
        at = first[:-1][owner] + (np.arange(bounds[-1]) - bounds[:-1][owner])
        out = mix(acc[at] + U(width) * MIX[40])
        for i in np.flatnonzero((count > 0) & (count < width)):
            w = words[first[i]:first[i + 1]]
            out[bounds[i]] = mix(np.array([(w * MIX[1:1 + len(w)]).sum(dtype=U) + U(len(w)) * MIX[40]], dtype=U))[0]
    return out, bounds
