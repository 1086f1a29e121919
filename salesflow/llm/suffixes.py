"""Sorting the suffixes of a block of text in two stages, the common prefixes of neighbours, and the strings it repeats.

Only suffixes smaller than their successors are sorted directly. What lies between two of them is one such first byte and a
falling stretch; the ranks of these stretches come first, and doubling over the chosen suffixes alone ranks ever longer
sequences of them. Scanning the buckets of first bytes then induces all other suffixes.
"""

from __future__ import annotations

import numpy as np

#: Longest block: the ranks of two places make a key.
BLOCK = 1 << 21
#: Bytes that neighbours have in common before they are compared one pair at a time.
FIRST = 32
#: Places in a row whose common prefixes follow from the first one's.
CHAIN = 4096


def _ranked(keys: np.ndarray) -> np.ndarray:
    """For each key the number of smaller ones."""
    order = np.argsort(keys)
    ranked = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = _first_of(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    return out


def _first_of(new: np.ndarray) -> np.ndarray:
    """For every place the last one up to it where something new began."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _tied(rank: np.ndarray) -> np.ndarray:
    """Numbers of those whose rank is not theirs alone."""
    return np.flatnonzero(np.bincount(rank)[rank] > 1)


def _break_ties(rank: np.ndarray, tied: np.ndarray, keys: np.ndarray, bits: int) -> None:
    """Order the tied ones of each rank by keys of so many bits; a rank is the number of smaller ones."""
    both = rank[tied] << bits | keys
    order = np.argsort(both)
    both = both[order]
    group = both >> bits
    new = np.concatenate(([True], both[1:] != both[:-1]))
    rank[tied[order]] = group + _first_of(new) - _first_of(np.concatenate(([True], group[1:] != group[:-1])))


def stretch_ranks(text: np.ndarray, chosen: np.ndarray, direct: np.ndarray) -> np.ndarray:
    """For each chosen suffix the number of those whose stretch up to the next chosen one is smaller.

    Behind its first byte a stretch falls, and the next chosen byte, which ends it, is greater than the same byte in a
    stretch. Six bytes with this mark make a first key. What is longer and still tied is compared by the bytes that follow
    and how often each comes; a longer run of a byte is greater, as what follows it is smaller.
    """
    n, size = len(text), 6
    code = np.concatenate((text.astype(np.int64) * 2 + direct + 1, np.zeros(size, np.int64)))  # 0 is the end of the text
    after = np.append(chosen[1:], n)
    key = np.zeros(len(chosen), np.int64)
    for by in range(size):
        key = key << 10 | np.where(chosen + by <= after, code[chosen + by], 0)
    rank = _ranked(key)
    at = chosen + size
    open_ones = at <= after
    ends = which = None
    while True:
        tied = _tied(rank)
        tied = tied[open_ones[tied]]
        if not len(tied):
            return rank
        if ends is None:
            ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)  # last places of runs of one byte
            which = np.searchsorted(ends, np.arange(n))
        place, stop = at[tied], after[tied]
        here = np.minimum(place, n - 1)
        byte, falling = text[here].astype(np.int64), place < stop
        run = np.minimum(ends[which[here]] + 1, stop) - place
        keys = np.where(falling, byte << 22 | run, np.where(place < n, byte << 22 | 1 << 21, 0))
        _break_ties(rank, tied, keys, 30)
        at[tied] = place + np.where(falling, run, 0)
        open_ones[tied] = falling


def sorted_chosen(text: np.ndarray, chosen: np.ndarray, direct: np.ndarray, length: int) -> np.ndarray:
    """The chosen suffixes in order, exact for their first `length` bytes.

    Ranks of one stretch, then of two, of four ...: each stretch has a byte at least, so the number of doublings is bounded
    by the length. Only suffixes that are still tied are looked at.
    """
    if not len(chosen):
        return chosen
    rank, span = stretch_ranks(text, chosen, direct), 1
    while span <= length:
        tied = _tied(rank)
        if not len(tied):
            break
        later = tied + span
        _break_ties(rank, tied, np.where(later < len(rank), rank[np.minimum(later, len(rank) - 1)] + 1, 0), 22)
        span *= 2
    return chosen[np.argsort(rank, kind="stable")]


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last is not, as the empty one is smaller."""
    n = len(text)
    steps = np.flatnonzero(text[1:] != text[:-1])  # last places of runs of one byte, but for the last run
    run = np.searchsorted(steps, np.arange(n))
    rising = np.append(text[steps] < text[steps + 1], False)
    return rising[run]


def suffix_array(text: np.ndarray, length: int = 216) -> np.ndarray:
    """Places of a block in the order of the suffixes that start there, exact for their first `length` bytes.

    Only the suffixes smaller than their successors are sorted. Scanning the buckets of first bytes from the left then puts
    every other suffix into place: it comes when the suffix after it, which is smaller, is met. A bucket has those others
    first; they are met wave by wave, each placed by the one before.
    """
    n = len(text)
    direct = smaller_than_next(text)
    chosen = np.flatnonzero(direct)
    sorted_ones = sorted_chosen(text, chosen, direct, length)
    sizes, own = np.bincount(text, minlength=256), np.bincount(text[chosen], minlength=256)
    head = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    tail, at = head + sizes - own, np.concatenate(([0], np.cumsum(own)))
    out = np.empty(n, np.int64)

    def induce(met: np.ndarray) -> None:
        before = met[met > 0] - 1
        before = before[~direct[before]]
        if len(before):
            byte = text[before]
            order = np.argsort(byte, kind="stable")
            byte = byte[order]
            group = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1])))
            size = np.diff(np.append(group, len(byte)))
            out[head[byte] + np.arange(len(byte)) - np.repeat(group, size)] = before[order]
            head[byte[group]] += size

    induce(np.array([n]))
    done = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    for c in np.flatnonzero(sizes):
        while done[c] < head[c]:
            wave = out[done[c]:head[c]]
            done[c] = head[c]
            induce(wave)
        out[tail[c]:tail[c] + own[c]] = sorted_ones[at[c]:at[c + 1]]
        induce(sorted_ones[at[c]:at[c + 1]])
    return out


def words(text: np.ndarray) -> np.ndarray:
    """For every place the eight bytes from there on as one number; NULs follow the end."""
    word = np.concatenate((text, np.zeros(7, np.uint8))).astype(np.uint64)
    for by, bits in ((1, 8), (2, 16), (4, 32)):
        word = word[:-by] << np.uint64(bits) | word[by:]
    return word


def common_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For every suffix but the first in order the bytes it has in common with the one before it, counted up to CHAIN more
    than `least`; 0 if there are less than `least`.

    Taken in the order of the text: if both suffixes continue a pair of neighbours by a byte less, so does their common
    prefix. All others are compared, a word at a time while many are left and then each for itself.
    """
    n, data = len(text), text.tobytes()
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[:-1] >= 0) & (before[1:] == before[:-1] + 1) & (text[:-1] == text[before[:-1]])
    follows[::CHAIN] = False  # so no comparison has to go much further
    left = np.flatnonzero(~follows & (before >= 0))
    word = words(text)
    for by in range(0, min(FIRST, least - least % 8), 8):
        a, b = left + by, before[left] + by
        inside = (a + 8 <= n) & (b + 8 <= n)
        left, a, b = left[inside], a[inside], b[inside]
        left = left[word[a] == word[b]]
    common = np.zeros(n, np.int64)
    for i in left.tolist():
        j = int(before[i])
        if data[i:i + least] == data[j:j + least] and max(i, j) + least <= n:
            common[i] = least + _further(data, i + least, j + least, CHAIN)
    heads = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    rest = common[heads] - (np.arange(n) - heads)
    return np.where(rest >= least, rest, 0)[order[1:]]


def _further(data: bytes, i: int, j: int, most: int) -> int:
    """Bytes that two places have in common, `most` at most, by halving."""
    found, room = 0, min(most, len(data) - max(i, j))
    if data[i:i + room] == data[j:j + room]:
        return room
    step = 1 << most.bit_length()
    while step:
        if found + step <= room and data[i + found:i + found + step] == data[j + found:j + found + step]:
            found += step
        step //= 2
    return found


def repeated_runs(parts: list[bytes], twice: list[bool], length: int) -> list[tuple[int, int, int]]:
    """Stretches of the parts that strings of `length` bytes cover which start at two places or more.

    (part, from, to) in the order of the parts; twice says of a part that it exists more than once.
    """
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    if len(text) > BLOCK:
        raise ValueError("block too long")
    if not len(text):
        return []
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    part = np.repeat(np.arange(len(parts)), sizes)
    whole = np.arange(len(text)) + length <= (starts + sizes)[part]
    order = suffix_array(text, length)
    alike = common_prefixes(text, order, length) > 0
    kind = np.concatenate(([0], np.cumsum(~alike)))
    weight = np.where(whole, 1 + np.array(twice, np.int64)[part], 0)
    often = np.bincount(kind, weight[order])[kind] > 1
    hit = order[often]
    hit = hit[whole[hit]]
    if not len(hit):
        return []
    step = np.zeros(len(text) + 1, np.int32)
    step[hit] += 1
    np.subtract.at(step, hit + length, 1)
    covered = np.cumsum(step[:-1]) > 0
    border = np.zeros(len(text), bool)
    border[starts[sizes > 0]] = True
    before = np.concatenate(([False], covered[:-1]))
    first = np.flatnonzero(covered & (~before | border))
    after = np.append(~covered[1:] | border[1:], True)
    last = np.flatnonzero(covered & after) + 1
    home = part[first]
    return list(zip(home.tolist(), (first - starts[home]).tolist(), (last - starts[home]).tolist(), strict=True))
