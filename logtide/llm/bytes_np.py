"""Numpy helpers over the bytes of an Arrow batch of texts: word bounds and hashes.

They work inside Spark tasks on one batch at a time; memory is bounded by the
batch and, for hashing, by ``SPAN`` bytes of text at once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once.
SPAN = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have inverses modulo 2**64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Every ASCII byte that is neither letter nor digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for ascending, non-overlapping spans: two polynomial
    hashes modulo 2**64, mixed. Equal bytes get equal hashes wherever they stand."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + SPAN, "right")))
        s, e = starts[at:upto] - low, ends[at:upto] - low
        n = int(e[-1])
        size = SPAN if n <= SPAN else n
        part = data[low:low + n].astype(np.uint64) + np.uint64(1)
        hashes = []
        for base in _BASES:
            up, down = _powers(base, size + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(part * up[:n], out=sums[1:])
            hashes.append((sums[e] - sums[s]) * down[s])
        out[at:upto] = mix(mix(hashes[0]) + hashes[1] + (e - s).astype(np.uint64))
        at = upto
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte bounds of all words, and for each text the index of its
    first word (with one more entry at the end). Words never span two texts; ``gaps`` are
    the bytes between words."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    gap = gaps[data]
    begin, end = np.empty(n, bool), np.empty(n, bool)
    begin[0] = end[-1] = True
    begin[1:] = gap[:-1]
    end[:-1] = gap[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begin[inner] = True
    end[inner - 1] = True
    starts = np.flatnonzero(begin & ~gap)
    ends = np.flatnonzero(end & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and for each text the index of its first word."""
    starts, ends, first = word_bounds(data, offsets, gaps)
    return span_hashes(LOWER[data], starts, ends), first


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k bytes at each place; a shorter, non-empty text has one hash of all its bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    out = np.empty(n - k + 1, np.uint64)
    for a in range(0, len(out), SPAN - k):
        b = min(len(out), a + SPAN - k)
        part = data[a:b + k - 1].astype(np.uint64) + np.uint64(1)
        up, down = _powers(_BASES[0], SPAN + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        out[a:b] = mix((sums[k:] - sums[:-k]) * down[:b - a] + np.uint64(k))
    return out


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each run of ``width`` words of one text; a shorter, non-empty text has one run."""
    if not len(words):
        return words
    k = min(width, len(words))
    out = words[:len(words) - k + 1] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(1, k):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[j:len(words) - k + 1 + j]
    return mix(out + np.uint64(k))
