"""Words of many texts at once, as positions and rolling hashes in flat arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
#: Digits, a-z, and every byte of a character beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(12, int(size - 1).bit_length()))


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (no word crosses a text), and where each text's words begin among them."""
    inside = word_byte[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    lasts = firsts[firsts > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Of k words each, for every start (also those that would cross into the next text)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _STEP + hashes[j : j + n]
    return mixed(out + np.uint64(k))


def inside_text(first: np.ndarray, n: int, span: int) -> np.ndarray:
    """Which of ``n`` starts have ``span`` words within their own text. first: where each text's words begin."""
    ok = np.zeros(n + 1, np.int64)
    begin, stop = first[:-1], np.maximum(first[:-1], first[1:] - span + 1)
    begin, stop = np.minimum(begin, n), np.minimum(stop, n)
    np.add.at(ok, begin, 1)
    np.add.at(ok, stop, -1)
    return np.cumsum(ok[:-1]) > 0
