"""Suffix arrays by induced sorting, and permuted common prefixes.

``suffix_array`` classifies suffixes as smaller (S) or larger (L) than their
right neighbour, sorts the leftmost-S substrings by inducing from them in text
order, names them, recurses on the string of names while names repeat, and
induces the whole array from the sorted leftmost-S suffixes. Small alphabets
are induced bucket by bucket on arrays; the recursion's large ones entry by
entry. Time is linear in the text.
"""

from __future__ import annotations

import numpy as np

from .words import span_hash


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last one is not."""
    n = len(text)
    smaller = np.zeros(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[:-1] != text[1:])
        nearest = np.searchsorted(differs, np.arange(n - 1))
        known = nearest < len(differs)
        at = differs[nearest[known]]
        smaller[:-1][known] = text[at] < text[at + 1]
    return smaller


def _place(sa, edge, chars, entries, down: bool):
    """Append entries, in order, to their buckets at the moving edges."""
    order = np.argsort(chars, kind="stable")
    chars, entries = chars[order], entries[order]
    first = np.flatnonzero(np.diff(chars, prepend=-1))
    counts = np.diff(np.append(first, len(chars)))
    rank = np.arange(len(chars)) - np.repeat(first, counts)
    if down:
        sa[edge[chars] - 1 - rank] = entries
        edge[chars[first]] -= counts
    else:
        sa[edge[chars] + rank] = entries
        edge[chars[first]] += counts


def _induce_arrays(text, smaller, starts, lms):
    n, n_chars = len(text), len(starts) - 1
    sa = np.full(n, -1, np.int64)
    chars = text[lms]
    tail = starts[1:].copy()
    _place(sa, tail, chars[::-1], lms[::-1], True)
    lms_from = tail.copy()
    head = starts[:-1].copy()
    # the suffix at the very end has nothing after it: it is the first L
    _place(sa, head, text[n - 1:], np.array([n - 1]), False)
    for c in range(n_chars):
        done = starts[c]
        while done < head[c]:
            got = sa[done:head[c]] - 1
            done = head[c]
            got = got[got >= 0]
            got = got[~smaller[got]]
            if len(got):
                _place(sa, head, text[got], got, False)
        got = sa[lms_from[c]:starts[c + 1]] - 1
        got = got[got >= 0]
        if len(got):
            _place(sa, head, text[got], got, False)
    larger_to = head.copy()
    tail = starts[1:].copy()
    for c in range(n_chars - 1, -1, -1):
        done = starts[c + 1]
        while done > tail[c]:
            got = sa[tail[c]:done][::-1] - 1
            done = tail[c]
            got = got[got >= 0]
            got = got[smaller[got]]
            if len(got):
                _place(sa, tail, text[got], got, True)
        got = sa[starts[c]:larger_to[c]][::-1] - 1
        got = got[got >= 0]
        got = got[smaller[got]]
        if len(got):
            _place(sa, tail, text[got], got, True)
    return sa


def _induce_entries(text, smaller, starts, lms):
    n = len(text)
    sa = np.full(n, -1, np.int64)
    tail = starts[1:].copy()
    _place(sa, tail, text[lms][::-1], lms[::-1], True)
    sa, letters, is_s = sa.tolist(), text.tolist(), smaller.tolist()
    head = starts[:-1].tolist()
    last = letters[n - 1]
    if sa[head[last]] < 0:
        sa[head[last]] = n - 1
    head[last] += 1
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not is_s[j]:
            c = letters[j]
            sa[head[c]] = j
            head[c] += 1
    tail = starts[1:].tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and is_s[j]:
            c = letters[j]
            tail[c] -= 1
            sa[tail[c]] = j
    return np.array(sa, np.int64)


def suffix_array(text: np.ndarray, n_chars: int | None = None) -> np.ndarray:
    """Start positions of all suffixes of an array of small integers, sorted."""
    text = np.asarray(text, np.int64)
    n = len(text)
    if n < 2:
        return np.arange(n)
    if n_chars is None:
        n_chars = int(text.max()) + 1
    smaller = suffix_types(text)
    starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_chars))))
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_arrays if n_chars <= 512 else _induce_entries
    if len(lms) > 1:
        first = induce(text, smaller, starts, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = first[is_lms[first]]
        # names: equal substrings up to the next leftmost-S position get one name
        end = np.append(lms[1:] + 1, n)
        which = np.searchsorted(lms, ordered)
        key = span_hash((text + 1).astype(np.uint64), lms, end)[which]
        length = (end - lms)[which]
        new = np.ones(len(ordered), bool)
        new[1:] = (key[1:] != key[:-1]) | (length[1:] != length[:-1])
        new[1:] |= (which[1:] == len(lms) - 1) | (which[:-1] == len(lms) - 1)  # the open last one is its own
        names = np.cumsum(new) - 1
        if names[-1] + 1 < len(lms):
            short = np.empty(len(lms), np.int64)
            short[which] = names
            lms = lms[suffix_array(short, int(names[-1]) + 1)]
        else:
            lms = ordered
    return induce(text, smaller, starts, lms)


def permuted_lcp(text: np.ndarray, sa: np.ndarray, most: int, stop: int = -1) -> np.ndarray:
    """For each position the common prefix with the suffix before it in the
    array, 0 for the first. Prefixes end at the sign ``stop`` and must not be
    longer than ``most``.

    Where the previous position's neighbour is the one before this one's and
    starts with the same sign, the prefix is one shorter than the previous;
    only the other positions are compared."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (
        text[:-1] == text[before[:-1]]) & (text[:-1] != stop)
    at = np.flatnonzero(~follows & (before >= 0))
    padded = np.concatenate((text, -np.arange(1, 2, dtype=text.dtype)))
    length = np.zeros(n, np.int64)
    a, b = at.copy(), before[at]
    alive = np.arange(len(at))
    common = np.zeros(len(at), np.int64)
    for _ in range(most):
        if not len(alive):
            break
        x, y = a[alive] + common[alive], b[alive] + common[alive]
        same = (x < n) & (y < n)
        sign = padded[np.minimum(x, n)]
        same &= (sign == padded[np.minimum(y, n)]) & (sign != stop)
        alive = alive[same]
        common[alive] += 1
    length[at] = common
    # carry on along the runs: value at the run's start less the distance
    start = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    full = length[start] - (np.arange(n) - start)
    return np.where(follows, np.maximum(full, 0), length)
