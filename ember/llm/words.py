"""Vectorised word and shingle hashing of Arrow text columns.

Texts are read straight from the Arrow buffers as UTF-8 bytes. A word is a run
of bytes other than space, tab, LF, VT, FF and CR, which is exact on bytes
because UTF-8 never uses those values inside a longer sequence. Only A-Z are
lower-cased. Null texts count as empty. Work is done in slabs of whole texts
so the temporaries stay small whatever the batch size; one text is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(20250101))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept per process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * SLAB_BYTES)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 8 * SLAB_BYTES:  # a single huge text does not stay in memory
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slabs(offsets: np.ndarray, size: int = SLAB_BYTES):
    """Ranges (lo, hi) of whole texts of about ``size`` bytes together."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def outside(*spans: tuple[int, int]) -> np.ndarray:
    """Table of the bytes that are no part of a word: those in ``spans`` (ends included)."""
    table = np.zeros(256, bool)
    for lo, hi in spans:
        table[lo:hi + 1] = True
    return table


def word_bounds(raw: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
    """Start, end and text index of every word; words never cross texts."""
    space = between[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    if len(raw):
        before[0] = True
        before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.empty(len(raw), bool)
    if len(raw):
        after[-1] = True
        after[:-1] = space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, owner


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of per-position values (uint64)."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    out = (total[ends] - total[starts]) * powers(_INVERSE, len(values) + 1)[starts]
    return mix(out + (ends - starts).astype(np.uint64) * _STEP[15])


def same_spans(raw: np.ndarray, at: np.ndarray, other: np.ndarray, there: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether raw[at:at + length] and other[there:there + length] are equal, for every span."""
    def windows(x):
        padded = np.concatenate((x, np.zeros(8, np.uint8)))
        return np.ndarray(len(x) + 1, np.uint64, padded, strides=(1,))

    x, y = windows(raw), windows(other)
    same, left = np.ones(len(at), bool), np.arange(len(at))
    step = 0
    while len(left):
        rest = np.minimum(length[left] - step, 8).astype(np.uint64) * np.uint64(8)
        unused = np.uint64(64) - rest  # bytes are read in little-endian order
        same[left] &= (x[at[left] + step] ^ y[there[left] + step]) << unused == 0
        step += 8
        left = left[length[left] > step]
    return same


def span_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Bytes of the spans one after another, and their offsets."""
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(ends - starts)))
    return raw[np.repeat(starts - at[:-1], ends - starts) + np.arange(at[-1])], at


def word_hashes(raw, offsets, lower: bool = True):
    """Hash and text index of every word, in reading order."""
    starts, ends, owner = word_bounds(raw, offsets)
    values = _BYTE[LOWER[raw] if lower else raw]
    return span_hash(values, starts, ends), owner


def shingles(hashes: np.ndarray, owner: np.ndarray, n_texts: int, k: int):
    """Hash and text index of each run of ``k`` words; a text with fewer words
    (but at least one) gives its whole sequence as one shingle."""
    counts = np.bincount(owner, minlength=n_texts)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    if len(hashes) >= k:
        full = np.flatnonzero(owner[k - 1:] == owner[:len(owner) - k + 1])
        acc = np.zeros(len(full), np.uint64)
        for j in range(k):
            acc += hashes[full + j] * _STEP[j]
        out, own = mix(acc), owner[full]
    else:
        out, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        acc = counts[short].astype(np.uint64) * _STEP[14]
        for j in range(k - 1):
            has = counts[short] > j
            acc[has] += hashes[first[short[has]] + j] * _STEP[j]
        out = np.concatenate((out, mix(acc)))
        own = np.concatenate((own, short))
        order = np.argsort(own, kind="stable")
        out, own = out[order], own[order]
    return out, own


def distinct_per_text(hashes: np.ndarray, owner: np.ndarray, n_texts: int):
    """Sorted distinct hashes of each text: (hashes, offsets of n_texts + 1)."""
    # texts are contiguous, so each is sorted in place
    h, o = hashes.copy(), owner
    at = np.concatenate(([0], np.cumsum(np.bincount(o, minlength=n_texts)))).tolist()
    for a, b in zip(at[:-1], at[1:]):
        if b - a > 1:
            h[a:b].sort()
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        h, o = h[keep], o[keep]
    counts = np.bincount(o, minlength=n_texts)
    return h, np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def shingle_sets(column, k: int, slab: int = SLAB_BYTES):
    """Yield (lo, hi, hashes, offsets): distinct shingle hashes of texts lo..hi."""
    raw, offsets = utf8(column)
    for lo, hi in slabs(offsets, slab):
        at = offsets[lo:hi + 1] - offsets[lo]
        part = raw[offsets[lo]:offsets[hi]]
        hashes, owner = word_hashes(part, at)
        h, own = shingles(hashes, owner, hi - lo, k)
        h, o = distinct_per_text(h, own, hi - lo)
        yield lo, hi, h, o
