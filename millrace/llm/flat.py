"""Vectorized views of string columns inside Arrow tasks: bytes, words, hashes and shingles.

All functions work on one Arrow batch of texts laid end to end, so a task needs a fixed number of
numpy calls per block of text instead of a Python step per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in blocks of about this many bytes; one longer text makes a block of its own.
BLOCK_BYTES = 1 << 20

MULT = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
BASE = 0xD6E8FEB86659FD93

# ASCII white space 0x20, 0x09-0x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def seed(*parts: int) -> np.uint64:
    """One well mixed 64-bit constant from small integers."""
    x = np.zeros(1, np.uint64)
    for p in parts:
        x = mix(x * MULT + np.uint64(p % (1 << 64)) + np.uint64(1))
    return x[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse mod 2**64 for i up to n; kept for blocks of the usual size, made anew for a longer text."""
    if n > BLOCK_BYTES + 1:
        return _powers_to(n + 1)
    if not _powers:
        _powers[:] = _powers_to(BLOCK_BYTES + 2)
    return _powers[0], _powers[1]


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, np.uint64(BASE))
    down = np.full(size, np.uint64(pow(BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets; null is the empty text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset: texts.offset + len(texts) + 1] if off else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def blocks(data: np.ndarray, off: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of whole texts of about ``size`` bytes."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j, data[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j
    release()


def release() -> None:
    """Give freed memory back to the system: a worker serves task after task, and what one has freed would count against the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums, from which ``piece_hash`` takes the hash of any piece."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def piece_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes [start, end): equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(pre))
    return mix((pre[end] - pre[start]) * down[start] + (end - start).astype(np.uint64) * MULT)


def words(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, per text: first word)`` of the words: maximal runs without ``sep`` bytes inside a text."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1: n + 1] = ~sep[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of each word, n + 1 offsets of the texts in it)``."""
    start, end, first = words(data, off, sep)
    return piece_hash(prefix_hash(data), start, end), first


def shingles(texts: pa.Array, width: int = 5, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``width`` words.

    A text of fewer words has one shingle of all of them; a text without words has none.
    """
    data, off = buffers(texts)
    for _, _, part, o in blocks(LOWER[data] if lower else data, off):
        w, first = word_hashes(part, o)
        h = np.zeros(len(w), np.uint64)
        for k in range(min(width, len(w))):
            h[: len(w) - k] = mix(h[: len(w) - k] * MULT + w[k:])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                yield np.unique(h[a: b - width + 1])
            elif b > a:
                one = np.zeros(1, np.uint64)
                for x in w[a:b]:
                    one = mix(one * MULT + x)
                yield mix(one + np.uint64(b - a))
            else:
                yield w[:0]
