"""64-bit hashes of words, of windows of words and of whole word sequences, for many texts at once."""

from __future__ import annotations

import numpy as np

#: The odd base of the byte polynomial and odd mixing constants.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BYTE, _BYTE_2 = np.random.default_rng(20_240_901).integers(1, 1 << 63, (2, 256)).astype(np.uint64)
_GAP = np.zeros(256, bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit."""
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least n places."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """Hash of data[begin:end] (bytes) for every pair; ``second``: another, independent one."""
    up, down = _grow(len(data) + 1)
    value = (_BYTE_2 if second else _BYTE)[data]
    value *= up[:-1]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(value, out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def words(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, in order, and how many words each text has.

    Words are runs of anything but ASCII white space. lower: A-Z count as a-z.
    """
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    gap = _GAP[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
    h = spans(data, begin, end)
    first = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    at = np.searchsorted(begin, np.append(first, len(data)))
    return h, np.diff(at)


def windows(h: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``width`` words, and how many each text has.

    A text with fewer words (but one at least) has one window: all its words.
    """
    ends = np.cumsum(counts)
    starts = ends - counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    size = np.repeat(np.minimum(counts, width), n)
    out = size.astype(np.uint64)
    padded = np.append(h, np.zeros(width, np.uint64))
    for j in range(width):
        v = padded[first + j]
        out = (out ^ (v if (size > j).all() else np.where(size > j, v, np.uint64(0)))) * _BASE
        out ^= out >> np.uint64(29)
    return mix(out), n


def sequences(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits that stand for each text's words in order, as rows of two numbers."""
    place = (np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    out = np.zeros((len(counts), 2), np.uint64)
    full = counts > 0
    starts = (np.cumsum(counts) - counts)[full]
    for k, c in enumerate((_M1, _M2)):
        if len(starts):
            out[full, k] = np.add.reduceat(mix(h + place * c), starts)
    return mix(out + counts[:, None].astype(np.uint64))
