"""Cutting texts into fragments that hold every pair of equal strings in one place.

The hashes of all k-byte strings of a window of L bytes have a smallest one, the window's anchor. Equal windows have equal
anchors at the same place. All windows of a text that share an anchor are one fragment, and the anchor's hash is its
key: equal strings of L bytes lie in fragments of equal keys.
"""

from __future__ import annotations

import numpy as np

#: A text is cut in stretches of this many windows; places in them need 24 bits.
STRETCH = 1 << 22
PLACES = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


BYTE = _mixed(np.arange(1, 257, dtype=np.uint64))


def string_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k-byte string, from those of half the length: binary digits of k from the left."""
    base = BYTE[data]
    have, size = base, 1
    for digit in bin(k)[3:]:
        n = len(have) - size
        have = have[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * size) + have[size:]
        size *= 2
        if digit == "1":
            n = len(have) - 1
            have = have[:n] * np.uint64(0xA0761D6478BD642F) + base[size:size + n]
            size += 1
    return _mixed(have)


def cut(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and keys of the fragments of one text; none if it is shorter than a window."""
    starts, ends, keys = [], [], []
    windows, span = len(data) - length + 1, length - k + 1
    for at in range(0, max(windows, 0), STRETCH):
        hashes = string_hashes(data[at:at + STRETCH + length - 1], k)
        low = (hashes & ~PLACES) | np.arange(len(hashes), dtype=np.uint64)  # ties go to the left
        have = 1
        while have < span:  # minima over twice as many places, then over the rest
            step = min(have, span - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        place = (low & PLACES).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:], [len(place)])) - 1
        starts.append(first + at)
        ends.append(last + at + length)
        keys.append(hashes[place[first]])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(keys)
