"""Suffix arrays by induced sorting, vectorised with numpy.

Suffixes are classified as smaller or larger than their right neighbour.
The leftmost smaller ones of each run are sorted: their substrings by one
induction, named, and the string of names recursively.  A second induction
places all other suffixes from them in linear time.  An induction scans the
array bucket by bucket; what a bucket places in itself follows in waves.
"""

from __future__ import annotations

import numpy as np

from wagelens.llm.kernels import prefix_hash, span_hash

#: Alphabets beyond this are sorted by doubling instead of bucket scans.
SMALL_ALPHABET = 512


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the empty suffix is least)."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(np.diff(text.astype(np.int32)))
    step[-1] = -1
    # Equal neighbours take the class of what follows the run.
    nxt = np.where(step != 0, np.arange(n, dtype=np.int32), n - 1)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    return step[nxt] > 0


def _spread(slots, into, values, chars, alphabet, up: bool):
    """Put values into their characters' buckets in order, moving the slots."""
    order = np.argsort(chars, kind="stable")
    count = np.bincount(chars, minlength=alphabet)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    ordered = chars[order]
    number = np.arange(len(values)) - first[ordered]
    into[slots[ordered] + number if up else slots[ordered] - number] = values[order]
    slots += count if up else -count


def induce(text: np.ndarray, smaller: np.ndarray, alphabet: int, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost smaller ones in theirs."""
    n = len(text)
    size = np.bincount(text, minlength=alphabet)
    end = np.cumsum(size)
    begin = end - size
    larger_end = begin + np.bincount(text[~smaller], minlength=alphabet)
    out = np.full(n, -1, np.int32)

    by_char = np.argsort(text[leftmost], kind="stable")
    sorted_left = leftmost[by_char]
    left_end = np.cumsum(np.bincount(text[leftmost], minlength=alphabet))
    head = begin.copy()
    _spread(head, out, np.array([n - 1], np.int32), text[[n - 1]], alphabet, True)
    for c in np.flatnonzero(size).tolist():
        at = begin[c]
        while at < head[c]:
            wave = out[at:head[c]]
            at = head[c]
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _spread(head, out, before, text[before], alphabet, True)
        before = sorted_left[left_end[c - 1] if c else 0:left_end[c]]
        before = before[before > 0] - 1
        if len(before):
            _spread(head, out, before, text[before], alphabet, True)

    tail = end - 1
    for c in np.flatnonzero(size)[::-1].tolist():
        at = end[c] - 1
        while at > tail[c]:
            wave = out[tail[c] + 1:at + 1][::-1]
            at = tail[c]
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _spread(tail, out, before, text[before], alphabet, False)
        wave = out[begin[c]:larger_end[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[smaller[before]]
        if len(before):
            _spread(tail, out, before, text[before], alphabet, False)
    return out


def doubling(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string over a large alphabet; tied suffixes alone are
    sorted again with twice the context."""
    n = len(names)
    # Ties need no order yet: the rounds below leave none.
    order = np.argsort(names.astype(np.int32))
    place, active, key = np.arange(n), order, names[order].astype(np.int64)
    rank = np.full(2 * n + 1, -1, np.int64)  # past the end: least
    height = 1
    while True:
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[active] = place[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        tied = ~(new & np.append(new[1:], True))
        place, active = place[tied], active[tied]
        if len(active) == 0 or height > n:
            return order
        key = rank[active] * np.int64(n + 2) + rank[np.minimum(active + height, 2 * n)] + 1
        by = np.argsort(key)
        active, key = active[by], key[by]
        order[place] = active
        height *= 2


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (values below ``alphabet``) in order."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    if alphabet > SMALL_ALPHABET:
        return doubling(text).astype(np.int32)
    smaller = classify(text)
    is_left = smaller.copy()
    is_left[1:] &= ~smaller[:-1]
    is_left[0] = False
    left = np.flatnonzero(is_left).astype(np.int32)
    order = induce(text, smaller, alphabet, left)
    if len(left) < 2:
        return order
    # Names of the leftmost-smaller substrings, each up to the next one's first symbol.
    by_substring = order[is_left[order]]
    stop = np.full(n, n, np.int64)
    stop[left[:-1]] = left[1:].astype(np.int64) + 1
    if alphabet <= 256:
        same = span_hash(prefix_hash(text.astype(np.uint8)), by_substring, stop[by_substring])
    else:
        wide = text.astype("<u2").view(np.uint8)
        same = span_hash(prefix_hash(wide), 2 * by_substring.astype(np.int64), 2 * stop[by_substring])
    new = np.ones(len(by_substring), bool)
    new[1:] = same[1:] != same[:-1]
    # The last one ends with the text and equals no other.
    new[np.flatnonzero(by_substring == left[-1])] = True
    after = np.flatnonzero(by_substring == left[-1])[0] + 1
    if after < len(new):
        new[after] = True
    name = np.empty(n, np.int64)
    name[by_substring] = np.cumsum(new) - 1
    names = name[left]
    count = int(new.sum())
    ranked = by_substring if count == len(left) else left[suffix_array(names, count)]
    return induce(text, smaller, alphabet, ranked)


def shares_with_previous(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Permuted common prefixes, in text order: whether a suffix shares its
    first ``length`` bytes (8 at least) with the one before it in suffix order."""
    n = len(text)
    padded = np.concatenate((text.astype(np.uint8), np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1)).copy().view(np.uint64).ravel()
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    live = np.flatnonzero((before >= 0) & (np.maximum(before, np.arange(n)) + length <= n))
    for at in [*range(0, length - 7, 8), length - 8]:
        live = live[words[live + at] == words[before[live] + at]]
    out = np.zeros(n, bool)
    out[live] = True
    return out
