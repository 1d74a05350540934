"""Vectorised work on the texts of one Arrow batch: blocks, words, hashes, window minima.

Everything here is a small numpy helper that runs inside Spark tasks on one bounded block of
whole texts at a time. Hashes are two polynomials over random codes modulo a prime, mixed into one
number of 64 bits. They depend on content only, so every task and every retry agrees.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@cache
def _keep_freed_memory() -> None:
    """Let the C library of a worker keep up to 32 MB that the arrays of a block leave free.

    By default it hands them back after each block and gets zeroed pages for the next, which takes
    longer than the work on them. Elsewhere than on glibc nothing changes.
    """
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD
        libc.mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):
        pass


def release_after(run):
    """The same work on the batches of a task, after which the worker hands all free memory back.

    Workers are used again by later tasks and stages, and would else keep the most they ever held.
    """

    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass

    return tidied


#: Bytes of text worked on at once; a longer single text is a block of its own.
BLOCK_BYTES = 400_000

_RNG = np.random.default_rng(20240229)
_PRIME = np.uint64((1 << 31) - 1)
_CODES = _RNG.integers(1, int(_PRIME), (2, 256), dtype=np.uint64)
_BASES = (1_103_515_245, 1_749_832_961)
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))
_tables: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """The same residue modulo 2^31 - 1 in fewer bits, in place: 64 bits become 34, 62 become 32."""
    high = x >> np.uint64(31)
    x &= _PRIME
    x += high
    return x


def _residue(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    x -= _PRIME * (x >= _PRIME)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo the prime, at least."""
    table = _tables.get(base, np.ones(1, np.uint64))
    while len(table) < n:
        step = np.uint64(pow(base, len(table), int(_PRIME)))
        table = np.concatenate([table, _residue(table * step)])
    _tables[base] = table
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Hasher:
    """Hashes of any span of a sequence of bytes, code points or 64-bit symbols.

    Two lanes, each a polynomial modulo the prime 2^31 - 1 over random codes of its own and with a
    base of its own, so that no fixed pair of strings meets at every base. Lanes give 62 bits.
    """

    def __init__(self, symbols: np.ndarray):
        self._lanes = []
        for k, base in enumerate(_BASES):
            if symbols.dtype == np.uint8:
                codes = _CODES[k][symbols]
            else:
                codes = _residue(mix(symbols.astype(np.uint64) ^ _SEEDS[k]))
            codes *= _powers(base, len(codes))
            codes = _fold(codes)
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(codes, out=sums[1:])
            inverse = _powers(pow(base, -1, int(_PRIME)), len(sums))
            self._lanes.append((sums, inverse))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of symbols [start, end) for each pair."""
        first, second = (
            _residue(_fold(_fold(sums[end] - sums[start])) * inverse[start])
            for sums, inverse in self._lanes
        )
        return mix((first << np.uint64(32)) + second + np.uint64(1))

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` symbols from each place that has so many after it."""
        count = len(self._lanes[0][0]) - n
        if count <= 0:
            return np.zeros(0, np.uint64)
        first, second = (
            _residue(_fold(_fold(sums[n:] - sums[:count])) * inverse[:count])
            for sums, inverse in self._lanes
        )
        return mix((first << np.uint64(32)) + second + np.uint64(1))


#: One random number for each of 256 symbols at each of the first places of a word.
_PLACES = 64
_AT = mix(np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(0xA0761D6478BD642F))


def word_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end); spans are in order and do not overlap.

    A sum of random numbers, one per symbol and place in the span. No rolling is needed here, so
    no polynomial is either.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    lo, hi = int(start[0]), int(end[-1])
    inside = symbols[lo:hi].astype(np.int32)
    steps = np.diff(np.append(start, hi))
    place = np.arange(hi - lo, dtype=np.int32)
    place -= np.repeat((start - lo).astype(np.int32), steps)
    far = np.zeros(0, np.int64)
    if steps.max() > _PLACES or (symbols.dtype != np.uint8 and inside.max() > 255):
        far = np.flatnonzero((place >= _PLACES) | (inside > 255))
    late = mix((place[far].astype(np.uint64) << np.uint64(24)) + inside[far].astype(np.uint64))
    place <<= 8
    place += inside
    place[far] = 0
    value = _AT[place]
    value[far] = late
    sums = np.zeros(hi - lo + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    return mix(sums[end - lo] - sums[start - lo] + (end - start).astype(np.uint64) * _SEEDS[0])


def blocks(
    texts: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [lo, hi) at a time with their UTF-8 bytes and the offsets of each text in these.

    A null counts as an empty text.
    """
    _keep_freed_memory()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(raw[2] or b"", np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, len(texts))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case and everything else as it is."""
    return _LOWER[data]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words that white space (blank, tab to carriage return) ends.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
#: Bytes of words of folded letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of ``inside`` bytes within one text.

    The third array holds, for each text, the number of its first word; it has one more
    entry than there are texts.
    """
    flag = inside[data]
    change = np.zeros(len(data) + 1, bool)
    if len(data):
        np.not_equal(flag[1:], flag[:-1], out=change[1:-1])
        change[0] = flag[0]
        change[-1] = flag[-1]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = np.unique(cut[flag[cut] & flag[cut - 1]])
    else:
        cut = np.zeros(0, np.int64)
    edge = np.flatnonzero(change)
    start, end = edge[0::2], edge[1::2]
    if len(cut):
        start = np.sort(np.concatenate([start, cut]))
        end = np.sort(np.concatenate([end, cut]))
    return start, end, np.searchsorted(start, offsets)


def window_argmin(order: np.ndarray, width: int) -> np.ndarray:
    """For each full window of ``width`` entries the place of its smallest, leftmost entry.

    The lowest bits of ``order`` give way to the place, so entries that agree in the
    others count as ties.
    """
    count = len(order) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, len(order).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = (order & ~low) | np.arange(len(order), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        key = np.minimum(key[: len(key) - span], key[span:])
        span *= 2
    if span < width:
        rest = width - span
        key = np.minimum(key[: len(key) - rest], key[rest:])
    return (key[:count] & low).astype(np.int64)


def expand(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges [start, start + length), and the range each belongs to."""
    owner = np.repeat(np.arange(len(start)), length)
    first = np.cumsum(length) - length
    return np.arange(len(owner)) - first[owner] + start[owner], owner


def covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in at least one range [start, end)."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0
