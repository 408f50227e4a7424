"""Suffix arrays by induced sorting, vectorised with numpy.

Input: several byte strings in one symbol array, each followed by a separator 0;
bytes are 1 .. 256. Separators count as different symbols in the order of their
places, below all bytes, so no suffix compares equal to another beyond its string.

Suffixes are classified as smaller or larger than their right neighbour. The
leftmost smaller ones (LMS) are sorted by their substrings with one induction, named,
and where names repeat the shorter string of names is sorted in its turn. Their order
induces that of all others: symbol by symbol, each bucket hands the left neighbours
of its suffixes to their buckets, in order, whole slices at a time.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 257


def smaller_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one to its right (S), else L."""
    n = t.size
    at = np.full(n, n - 1, np.int32)              # where the run of equal symbols ends
    change = np.flatnonzero((t[:-1] != t[1:]) | (t[:-1] == 0))
    at[change] = change
    at = np.minimum.accumulate(at[::-1])[::-1]
    s = t[at] < t[np.minimum(at + 1, n - 1)]
    s[t == 0] = True
    return s


def _hand_out(sa, at, left, t, step):
    """Put suffixes ``left`` into the buckets of their symbols, keeping their order;
    ``at`` is the next place per symbol, ``step`` the direction."""
    sym = t[left].astype(np.uint16)
    order = np.argsort(sym, kind="stable")
    left, sym = left[order], sym[order]
    n = np.bincount(sym, minlength=SYMBOLS)
    within = np.arange(left.size) - np.repeat(np.cumsum(n) - n, n)
    sa[at[sym] + step * within] = left
    at += step * n


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array from LMS suffixes in (bucket-wise) order."""
    n = t.size
    count = np.bincount(t, minlength=SYMBOLS)
    end = np.cumsum(count)
    start = end - count
    n_lms = np.bincount(t[lms], minlength=SYMBOLS)
    sym = t[lms].astype(np.uint16)
    by_sym = lms[np.argsort(sym, kind="stable")]
    stop = np.cumsum(n_lms)
    sa = np.full(n, -1, np.int32)
    head = start.copy()
    used = np.flatnonzero(count)
    for c in used.tolist():                       # L suffixes, smallest symbol first
        done = int(start[c])
        while done < head[c]:
            part = sa[done:head[c]]
            done = int(head[c])
            left = part[part > 0] - 1
            _hand_out(sa, head, left[~s[left]], t, 1)
        part = by_sym[stop[c] - n_lms[c]:stop[c]]
        left = part[part > 0] - 1
        _hand_out(sa, head, left[~s[left]], t, 1)
    tail = end - 1
    for c in used[::-1].tolist():                 # S suffixes, largest symbol first
        if c == 0:
            break
        done = int(end[c]) - 1
        while done > tail[c]:
            part = sa[tail[c] + 1:done + 1][::-1]
            done = int(tail[c])
            left = part[part > 0] - 1
            _hand_out(sa, tail, left[s[left] & (t[left] > 0)], t, -1)
        part = sa[start[c]:head[c]][::-1]
        left = part[part > 0] - 1
        _hand_out(sa, tail, left[s[left] & (t[left] > 0)], t, -1)
    if count[0]:
        sa[:count[0]] = np.flatnonzero(t == 0)
    return sa


def sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, the last of which is unique: ranks
    of twice the length from ranks of the length, for those still equal to others."""
    n = names.size
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    rank = np.empty(n, np.int64)
    size = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, size)
    open_ = order[np.repeat(size > 1, size)]
    h = 1
    while open_.size:
        nxt = np.where(open_ + h < n, rank[np.minimum(open_ + h, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + nxt
        o = np.argsort(key, kind="stable")
        open_, key = open_[o], key[o]
        base = rank[open_]
        group = np.flatnonzero(np.r_[True, base[1:] != base[:-1]])
        group_size = np.diff(np.append(group, base.size))
        fresh = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        fresh_size = np.diff(np.append(fresh, key.size))
        in_group = np.repeat(fresh, fresh_size) - np.repeat(group, group_size)
        rank[open_] = base + in_group
        open_ = open_[np.repeat(fresh_size > 1, fresh_size)]
        h *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of symbols ``t`` (0 = separator; the last symbol is one)."""
    s = smaller_types(t)
    is_lms = s.copy()
    is_lms[0] = t[0] == 0
    is_lms[1:] &= ~s[:-1] | (t[1:] == 0)
    lms = np.flatnonzero(is_lms).astype(np.int32)
    rough = induce(t, s, lms)
    rough = rough[is_lms[rough]]                  # LMS suffixes by their substrings
    nxt = np.empty(t.size, np.int32)              # where the substring of an LMS suffix ends
    nxt[lms] = np.append(lms[1:], t.size - 1)
    size = nxt[rough] - rough + 1
    same = np.zeros(rough.size, bool)
    pair = np.flatnonzero((size[1:] == size[:-1]) & (t[rough[1:]] > 0) & (t[nxt[rough[1:]]] > 0)) + 1
    if pair.size:
        m = size[pair]
        inside = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        differ = t[np.repeat(rough[pair], m) + inside] != t[np.repeat(rough[pair - 1], m) + inside]
        same[pair] = ~np.logical_or.reduceat(differ, np.cumsum(m) - m)
    name = np.cumsum(~same) - 1
    if name[-1] + 1 < rough.size:
        names = np.empty(t.size, np.int64)
        names[rough] = name
        rough = lms[sort_names(names[lms])]
    return induce(t, s, rough)


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: per place the length of the common prefix of its suffix
    with the one before it in the suffix array. Where the symbols to the left of both
    agree the length is one less than at the place before; only the other places are
    compared, symbol by symbol while they agree."""
    n = t.size
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    fresh = (before <= 0) | (i == 0) | (t[i - 1] != t[before - 1]) | (t[i - 1] == 0)
    out = np.zeros(n, np.int32)
    at = np.flatnonzero(fresh & (before >= 0))
    other, length = before[at], np.zeros(at.size, np.int64)
    live = np.arange(at.size)
    step = 0
    while live.size:
        a, b = at[live] + step, other[live] + step
        ok = (a < n) & (b < n)
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        ok &= (t[a] == t[b]) & (t[a] > 0)
        live = live[ok]
        length[live] += 1
        step += 1
    out[at] = length
    source = np.maximum.accumulate(np.where(fresh, i, 0))
    return np.maximum(out[source] - (i - source), 0)
