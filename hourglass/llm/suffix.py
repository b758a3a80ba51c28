"""Suffix arrays by induced sorting, and permuted common prefixes.

The sort classifies suffixes (S: smaller than the next one, L: larger), sorts the
leftmost S ones of each run by sorting the substrings between them, recursively
where two are equal, and induces the others in two scans.  Over bytes a scan
takes a bucket at a time as arrays; over the names of a recursion, whose buckets
are small, it walks the array.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are induced bucket by bucket, larger ones entry by entry.
WIDE = 512


def _types(t: np.ndarray) -> np.ndarray:
    """True for S suffixes.  The end of the text is smaller than any letter."""
    n = len(t)
    s = np.zeros(n, dtype=bool)
    if n > 1:
        differs = np.flatnonzero(t[:-1] != t[1:])
        nxt = np.searchsorted(differs, np.arange(n - 1))
        known = nxt < len(differs)
        at = differs[nxt[known]]
        s[:-1][known] = t[at] < t[at + 1]
    return s


def _induce_buckets(t, s, lms, letters):
    """All suffixes in order, given the leftmost S ones in order (or in any order
    within a bucket, to sort the substrings)."""
    n = len(t)
    waiting: dict[int, list] = {c: [] for c in letters}

    def push(pred):
        if len(pred):
            by = t[pred]
            pred = pred[np.argsort(by, kind="stable")]
            by = t[pred]
            cut = np.flatnonzero(by[1:] != by[:-1]) + 1
            for part in np.split(pred, cut):
                waiting[int(t[part[0]])].append(part)

    seeds: dict[int, np.ndarray] = {}
    if len(lms):
        by = t[lms]
        order = np.argsort(by, kind="stable")
        cut = np.flatnonzero(np.diff(by[order].astype(np.int64))) + 1
        for part in np.split(lms[order], cut):
            seeds[int(t[part[0]])] = part
    push(np.array([n - 1]))
    larger: dict[int, list] = {}
    for c in letters:
        done, cur = [], np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(cur):
            done.append(cur)
            pred = cur[cur > 0] - 1
            pred = pred[~s[pred]]
            same = t[pred] == c
            push(pred[~same])
            cur = pred[same]
        larger[c] = done
        if c in seeds:
            push(seeds[c] - 1)
    waiting = {c: [] for c in letters}
    out = []
    for c in reversed(letters):
        done, cur = [], np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(cur):
            done.append(cur)
            pred = cur[cur > 0] - 1
            pred = pred[s[pred]]
            same = t[pred] == c
            push(pred[~same])
            cur = pred[same]
        high = np.concatenate(larger[c])[::-1] if larger[c] else np.zeros(0, np.int64)
        pred = high[high > 0] - 1
        push(pred[s[pred]])
        out += [*done, high]
    return np.concatenate(out)[::-1]


def _induce_walk(t, s, lms, size):
    n = len(t)
    count = np.bincount(t, minlength=size)
    tails = np.cumsum(count)
    first, tail = (tails - count).tolist(), tails.tolist()
    # The letter of an L (S) start, -1 elsewhere and at the place before the text.
    letters = t.astype(np.int64)
    larger, smaller = np.append(np.where(s, -1, letters), -1).tolist(), np.append(np.where(s, letters, -1), -1).tolist()
    sa = [0] * n
    for p in reversed(lms.tolist()):
        c = smaller[p]
        tail[c] -= 1
        sa[tail[c]] = p
    c = larger[n - 1]
    sa[first[c]] = n - 1
    first[c] += 1
    for p in sa:  # reads what it writes ahead of itself
        c = larger[p - 1]
        if c >= 0:
            sa[first[c]] = p - 1
            first[c] += 1
    tail = tails.tolist()
    for p in reversed(sa):
        c = smaller[p - 1]
        if c >= 0:
            tail[c] -= 1
            sa[tail[c]] = p - 1
    return np.array(sa, dtype=np.int64)


def _induce(t, s, lms, size):
    return _induce_buckets(t, s, lms, np.unique(t).tolist()) if size <= WIDE else _induce_walk(t, s, lms, size)


def _names(t, lms, ordered):
    """The rank of each leftmost substring among the distinct ones, in text order."""
    m, n = len(lms), len(t)
    place = np.searchsorted(lms, ordered)
    size = np.append(lms[1:] + 1, n + 1) - lms
    a, b = ordered[:-1], ordered[1:]
    same = np.zeros(m - 1, dtype=bool)
    last = lms[-1]
    live = np.flatnonzero((size[place[:-1]] == size[place[1:]]) & (a != last) & (b != last))
    k = 0
    while len(live):
        live = live[t[a[live] + k] == t[b[live] + k]]
        k += 1
        over = size[place[live]] == k
        same[live[over]] = True
        live = live[~over]
    names = np.zeros(m, np.int64)
    names[place[1:]] = np.cumsum(~same)
    return names


def suffix_array(t: np.ndarray, size: int = 256) -> np.ndarray:
    """Starts of the suffixes of ``t`` (letters below ``size``) in order."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) > 1:
        first = _induce(t, s, lms, size)
        left = np.zeros(n, dtype=bool)
        left[lms] = True
        ordered = first[left[first]]
        names = _names(t, lms, ordered)
        count = int(names.max()) + 1
        lms = ordered if count == len(lms) else lms[suffix_array(names, count)]
    return _induce(t, s, lms, size)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start its predecessor in ``sa`` (-1 for the first), and the length of
    the prefix they share.

    Where both are preceded by one letter the length is one less than at the start
    before; only the other starts are compared, eight letters at a time."""
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int64)
    pad = np.concatenate([t, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(n + 1, np.uint64)
    for j in range(8):
        word |= pad[j : n + j + 1] << np.uint64(8 * j)
    at = np.arange(n)
    own = before < 0
    inner = (at > 0) & (before > 0)
    apart = ~inner
    apart[inner] = t[at[inner] - 1] != t[before[inner] - 1]
    heads = np.flatnonzero(apart & ~own)
    live, length = heads, 0
    while len(live):
        x, y = live + length, before[live] + length
        whole = np.minimum(n - x, n - y) >= 8
        go = np.zeros(len(live), dtype=bool)
        go[whole] = word[x[whole]] == word[y[whole]]
        rest = live[~go]
        if len(rest):
            k, run = 0, rest
            got = np.full(len(rest), length)
            where = np.arange(len(rest))
            while len(run):
                x, y = run + length + k, before[run] + length + k
                ok = (x < n) & (y < n)
                ok[ok] = t[x[ok]] == t[y[ok]]
                run, where = run[ok], where[ok]
                got[where] += 1
                k += 1
                if k >= 8:
                    break
            shared[rest] = got
        live = live[go]
        length += 8
    fixed = apart | own
    base = np.maximum.accumulate(np.where(fixed, at, 0))
    return before, np.maximum(shared[base] - (at - base), 0)


def repeated_starts(t: np.ndarray, length: int) -> np.ndarray:
    """True for each start whose next ``length`` letters also start elsewhere in ``t``."""
    out = np.zeros(len(t), dtype=bool)
    before, shared = permuted_prefixes(t, suffix_array(t))
    hit = shared >= length
    out[hit] = True
    out[before[hit]] = True
    return out
