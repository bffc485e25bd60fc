"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as L or S; leftmost S ones (LMS) start the substrings that are sorted first, by inducing from any
order of them; their names make a reduced string, which is sorted by recursion; and one more induction sorts all
suffixes from the LMS ones. Over bytes a bucket's suffixes are induced from together, wave by wave, in a few numpy
calls a bucket. A reduced string has about as many buckets as names, so there two passes place one suffix at a
time. Either way the work is linear, and the recursion goes on until all names differ.
"""

from __future__ import annotations

from array import array

import numpy as np

#: Characters of LMS substrings that are compared side by side; what is equal so far is then compared pair by pair.
STEPS = 64


def classify(t: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last character is the sentinel, smaller than all others and unlike them."""
    n = len(t)
    step = t[1:].astype(np.int32) - t[:-1]
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal characters ends
    s = np.ones(n, bool)
    s[:-1] = step[np.minimum(at, n - 2)] > 0
    return s


def _give(sa, at, chars, pointer, down):
    """Puts suffixes at the pointers of their buckets, in order; down: from the end leftwards."""
    order = np.argsort(chars, kind="stable")
    c, p = chars[order], at[order]
    cut = np.flatnonzero(c[1:] != c[:-1]) + 1
    first = np.concatenate([[0], cut])
    size = np.diff(np.append(first, len(c)))
    own = c[first]
    rank = np.arange(len(c)) - np.repeat(first, size)
    base = np.repeat(pointer[own], size)
    if down:
        sa[base - 1 - rank] = p
        pointer[own] -= size
    else:
        sa[base + rank] = p
        pointer[own] += size


def induce(t, is_s, begin, end, lms, kinds) -> np.ndarray:
    """All suffixes, from LMS ones in the order given (stable within a bucket)."""
    n = len(t)
    sa = np.full(n, -1, np.int32)
    code = t.astype(np.int16) if t.dtype == np.uint8 else t  # sorts by radix either way
    lms_char = t[lms]
    order = np.argsort(lms_char, kind="stable")
    seeds = lms[order]
    seed_cut = np.searchsorted(lms_char[order], np.arange(kinds + 1)).tolist()
    head, b, e = begin.copy(), begin.tolist(), end.tolist()
    del code

    def rising(block):
        p = block - 1
        p = p[(p >= 0) & ~is_s[p]]
        if len(p):
            _give(sa, p, t[p], head, False)

    for c in range(kinds):
        low = b[c]
        while low < (high := int(head[c])):
            rising(sa[low:high])
            low = high
        if seed_cut[c] < seed_cut[c + 1]:
            rising(seeds[seed_cut[c] : seed_cut[c + 1]])
    filled = head.tolist()
    tail = end.copy()
    sa[n * 0 + e[int(t[-1])] - 1] = n - 1  # the sentinel stands alone in its bucket
    tail[int(t[-1])] -= 1

    def falling(block):
        p = block - 1
        p = p[p >= 0]
        p = p[is_s[p]]
        if len(p):
            _give(sa, p, t[p], tail, True)

    for c in range(kinds - 1, -1, -1):
        high = e[c]
        while (low := int(tail[c])) < high:
            falling(sa[low:high][::-1])
            high = low
        if b[c] < filled[c]:
            falling(sa[b[c] : filled[c]][::-1])
    return sa


def _names(t, lms, ordered) -> tuple[np.ndarray, int]:
    """Names of LMS substrings, given in sorted order: equal substrings share one. By place of the LMS suffix."""
    stop = np.append(lms[1:], len(t) - 1)
    slot = np.zeros(len(t), np.int32)
    slot[lms] = np.arange(len(lms))
    size = (stop - lms + 1)[slot[ordered]]
    a, b = ordered[:-1], ordered[1:]
    same = size[:-1] == size[1:]
    live, k = np.flatnonzero(same), 0
    while len(live) and k < STEPS:
        equal = t[a[live] + k] == t[b[live] + k]
        same[live[~equal]] = False
        live = live[equal]
        k += 1
        live = live[size[live] > k]
    for i in live.tolist():  # few and long
        same[i] = np.array_equal(t[a[i] : a[i] + size[i]], t[b[i] : b[i] + size[i]])
    name = np.concatenate([[0], np.cumsum(~same)])
    out = np.empty(len(lms), np.int32)
    out[slot[ordered]] = name
    return out, int(name[-1]) + 1


def reduced_array(t, kinds: int) -> list[int]:
    """Suffix array of names: numbers below kinds, of which the last is the least (a sentinel's) and stands there alone."""
    t = np.asarray(t, np.int32)
    n = len(t)
    if n < 3:
        return list(range(n - 1, -1, -1))
    is_s = classify(t)
    count = np.bincount(t, minlength=kinds)
    end = np.cumsum(count)
    begin = end - count
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    # the name before a place if an L (an S) suffix begins there, else -1; the last value is that of empty places
    before_l, before_s = np.full((2, n + 1), -1, np.int32)
    before_l[1:n] = np.where(is_s[:-1], -1, t[:-1])
    before_s[1:n] = np.where(is_s[:-1], t[:-1], -1)
    before_l, before_s = array("i", before_l.tobytes()), array("i", before_s.tobytes())

    def induced(order):
        by = np.argsort(t[order], kind="stable")
        c = t[order][by]
        start = np.full(n, -1, np.int32)
        start[end[c] - np.searchsorted(c, c, "right") + np.arange(len(c))] = order[by]
        sa, at = array("i", start.tobytes()), begin.tolist()
        for p in sa:  # grows to the right of where it is read
            c = before_l[p]
            if c >= 0:
                j = at[c]
                sa[j] = p - 1
                at[c] = j + 1
        at = end.tolist()
        for p in reversed(sa):  # and to the left
            c = before_s[p]
            if c >= 0:
                j = at[c] - 1
                sa[j] = p - 1
                at[c] = j
        return sa

    if len(lms) > 1:
        sa = np.frombuffer(induced(lms), np.int32)
        mark = np.zeros(n, bool)
        mark[lms] = True
        ordered = sa[mark[sa]]
        name, names = _names(t, lms, ordered)
        lms = ordered if names == len(lms) else lms[reduced_array(name, names)]
    return induced(lms).tolist()


def suffix_array(t: np.ndarray, kinds: int) -> np.ndarray:
    """t: characters 0 to kinds - 1, of which 0 is at the end and nowhere else."""
    if len(t) < 3:
        return np.arange(len(t) - 1, -1, -1, dtype=np.int32)
    is_s = classify(t)
    count = np.bincount(t, minlength=kinds)
    end = np.cumsum(count)
    begin = end - count
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + np.int32(1)
    if len(lms) > 1:
        sa = induce(t, is_s, begin, end, lms, kinds)
        mark = np.zeros(len(t), bool)
        mark[lms] = True
        ordered = sa[mark[sa]]
        name, names = _names(t, lms, ordered)
        lms = ordered if names == len(lms) else lms[np.array(reduced_array(name, names), np.int32)]
    return induce(t, is_s, begin, end, lms, kinds)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp): for each place, the suffix before it in the array (-1 for the first), and the prefix they share. Values whose
    left neighbours are equal follow from the place before, less one; just the others are compared."""
    n = len(t)
    phi = np.empty(n, np.int32)
    phi[sa[0]] = -1
    phi[sa[1:]] = sa[:-1]
    left = np.ones(n, bool)
    inner = np.flatnonzero((phi > 0) & (np.arange(n) > 0))
    left[inner] = t[inner - 1] != t[phi[inner] - 1]
    at = np.flatnonzero(left & (phi >= 0)).astype(np.int32)
    other = phi[at]
    wide = np.zeros(n + 8, np.uint32)
    padded = np.concatenate([t.astype(np.uint8), np.zeros(11, np.uint8)])
    for j in range(4):
        wide |= padded[j : j + n + 8].astype(np.uint32) << np.uint32(8 * j)
    size = np.zeros(len(at), np.int32)
    live, k = np.arange(len(at)), 0
    while len(live):
        x = wide[at[live] + k] ^ wide[other[live] + k]
        done = x != 0
        d = x[done]
        size[live[done]] = k + (d & np.uint32(0xFF) == 0) * 1 + (d & np.uint32(0xFFFF) == 0) * 1 + (d & np.uint32(0xFFFFFF) == 0) * 1
        live = live[~done]
        k += 4
    plcp = np.zeros(n, np.int32)
    plcp[at] = size
    source = np.zeros(n, np.int32)
    source[left] = np.flatnonzero(left)
    source = np.maximum.accumulate(source)
    plcp = plcp[source] - (np.arange(n, dtype=np.int32) - source)
    plcp[phi < 0] = 0
    return phi, np.maximum(plcp, 0)
