"""Token counts by a two-tier map-side look-up of pre-token lengths.

Byte-level BPE never merges across pre-tokens, so a text's token count is the
sum over its pre-tokens of their lengths in tokens. A first pass over the
whole corpus counts pre-tokens within each task and keeps the task's commonest;
only those bounded summaries, one value a task, meet in a tree. The commonest overall go into a compact
hash table (64-bit key, length) that every task gets. In the second pass each
pre-token is looked up there; the misses are encoded once per Python worker
and kept in that worker's bounded cache. No pre-token is ever shuffled.

Pre-tokens are cut on arrays of code points by their class (letter, number,
white space, other), with the pattern of byte-level BPE:
contractions, then runs with one leading space, then white space.

Defined results: a null text is empty and has no tokens; the special token's
own string inside a text counts as one token, as the library has it by
default; repeated rows are counted each. Other columns are not read.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed, unpacked
from .words import mix, slabs, span_hash, utf8

SPACE, LETTER, NUMBER, OTHER = range(4)
SLAB = 1 << 18
CACHE_ENTRIES = 500_000


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer and its special strings; only plain byte-level BPE is accepted."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    cut = told.get("pre_tokenizer") or {}
    if told.get("normalizer") or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get(
            "add_prefix_space"):
        raise ValueError(f"{path}: not a byte-level BPE without normaliser or prefix space")
    if any(t[k] for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that take white space or whole words are not supported")
    return Tokenizer.from_file(path), tuple(t["content"] for t in told["added_tokens"])


@lru_cache(maxsize=4)
def code_point_tables(path: str):
    """Class of every code point as the library's own cutter has it.

    The Unicode tables of ``regex`` are the first guess. The library confirms
    each run of equal class with one probe (after "a", "1" or "!" the run must
    stay one pre-token); runs that fail are halved down to the code points on
    which the two Unicode versions differ."""
    cutter = load(path)[0].pre_tokenizer
    kinds = np.full(0x110000, OTHER, np.uint8)
    for lo in range(0, 0x110000, 1 << 16):
        part = "".join(chr(c) for c in range(lo, lo + (1 << 16)) if not 0xD800 <= c < 0xE000)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for run in regex.finditer(pattern, part):
                kinds[[ord(c) for c in run.group()]] = kind

    def one(kind: int, run: str) -> bool:
        return kind != SPACE and len(cutter.pre_tokenize_str("?a1!"[kind] + run)) == 1

    cuts = np.flatnonzero(np.diff(kinds, prepend=255)).tolist() + [0xD800, 0xE000, 0x110000]
    cuts = sorted(set(cuts))
    todo = [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a != 0xD800]
    while todo:
        a, b = todo.pop()
        if one(int(kinds[a]), "".join(map(chr, range(a, b)))):
            continue
        if b - a > 1:
            todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
        else:
            kinds[a] = next((k for k in (LETTER, NUMBER, OTHER) if one(k, chr(a))), SPACE)
    return kinds


@lru_cache(maxsize=1)
def code_point_values() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pretokens(raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, special: tuple[str, ...]):
    """Text of the slab, start and end (code points) and text index of every
    pre-token, and where the special strings are among them."""
    text = raw.tobytes().decode("utf-8")
    point = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(point)
    heads = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    at = heads[offsets]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    edge[n] = True
    spans = []
    if any(s in text for s in special):
        for m in regex.finditer("|".join(map(regex.escape, sorted(special, key=len, reverse=True))), text):
            if not edge[m.start() + 1:m.end()].any():  # not across two texts
                spans.append(m.span())
        for a, b in spans:
            edge[a] = edge[b] = True
    kind = kinds[point]
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(start)
    end = np.append(run[1:], n)[:len(run)]
    blank = kind[run] == SPACE
    run, end = run[blank], end[blank]
    inner = ~edge[end] if len(end) else np.zeros(0, bool)  # followed by something in the same text
    run, end = run[inner], end[inner]
    start[end[point[end - 1] == 0x20]] = False  # one space goes with what follows
    start[end[end - run > 1] - 1] = True
    # 's 't 're 've 'm 'll 'd
    mark = np.flatnonzero((point[:-1] == 0x27) & start[:-1] & (kind[1:] == LETTER) & ~edge[1:-1]) if n > 1 else []
    if len(mark):
        one = np.isin(point[mark + 1], [ord(c) for c in "stmd"])
        has = (mark + 2 < n) & ~edge[np.minimum(mark + 2, n)]
        pair = point[mark + 1].astype(np.int64) * 65536 + point[np.minimum(mark + 2, n - 1)]
        two = has & np.isin(pair, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])
        for chosen, step in ((mark[one], 2), (mark[two & ~one], 3)):
            start[chosen + 1] = False
            after = chosen + step
            start[after[after < n]] = True
    for a, b in spans:
        start[a + 1:b] = False
    first = np.flatnonzero(start)
    last = np.append(first[1:], n)[:len(first)]
    owner = np.searchsorted(at, first, "right") - 1
    whole = np.isin(first, [a for a, _ in spans]) if spans else None
    return text, point, first, last, owner, whole


def hashes(point, first, last):
    return span_hash(code_point_values()[point], first, last)


class Table:
    """Open-addressing hash table of 64-bit keys to small lengths, in arrays."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray):
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.lengths = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.probes = 1
        for key, length in zip(keys.tolist(), lengths.tolist()):
            slot, step = key >> (64 - bits), 1
            while self.lengths[slot] and self.keys[slot] != key:
                slot, step = (slot + 1) & self.mask, step + 1
            self.keys[slot], self.lengths[slot] = key, length
            self.probes = max(self.probes, step)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Length of every key, 0 where it is not in the table."""
        slot = (keys >> self.shift).astype(np.int64)
        out = np.where(self.keys[slot] == keys, self.lengths[slot], 0)
        left = np.flatnonzero((out == 0) & (self.lengths[slot] > 0))
        for _ in range(self.probes - 1):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
            hit = self.keys[slot[left]] == keys[left]
            out[left[hit]] = self.lengths[slot[left[hit]]]
            left = left[~hit & (self.lengths[slot[left]] > 0)]
        return out


_cache: dict[str, dict[int, int]] = {}


def missing_lengths(path: str, text: str, keys, first, last) -> np.ndarray:
    """Lengths of pre-tokens outside the table, through this worker's cache."""
    tokenizer, _ = load(path)
    cache = _cache.setdefault(path, {})
    unique, at, back = np.unique(keys, return_index=True, return_inverse=True)
    lengths = [cache.get(k, 0) for k in unique.tolist()]
    new = [i for i, length in enumerate(lengths) if not length]
    if new:
        if len(cache) + len(new) > CACHE_ENTRIES:
            cache.clear()
        a, b = first[at].tolist(), last[at].tolist()
        for i, coded in zip(new, tokenizer.encode_batch_fast([text[a[i]:b[i]] for i in new],
                                                             add_special_tokens=False)):
            lengths[i] = len(coded)
        if len(new) <= CACHE_ENTRIES:
            cache.update((int(unique[i]), lengths[i]) for i in new)
    return np.array(lengths, np.int64)[back]


def frequent(docs: DataFrame, path: str, sent, size: int, per_task: int, fan: int = 32) -> list[str]:
    """The commonest pre-tokens of the corpus by the tasks' summaries. A task's
    summary is one value; ``fan`` of them are merged at a time up a tree, each
    merge keeping ``size`` pre-tokens, so no pre-token is a key of a shuffle."""
    def body(held: dict[str, int], most: int):
        best = sorted(held.items(), key=lambda kv: (-kv[1], kv[0]))[:most]
        return packed(pa.RecordBatch.from_arrays([pa.array([k for k, _ in best], pa.string()),
                                                  pa.array([c for _, c in best], pa.int64())], names=["token", "count"]))

    def summary(it):
        _, special = load(path)
        kinds = sent.value
        held: dict[str, int] = {}
        for batch in it:
            raw, offsets = utf8(batch.column(0))
            for lo, hi in slabs(offsets, SLAB):
                text, point, first, last, _, whole = pretokens(
                    raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], kinds, special)
                if whole is not None:
                    first, last = first[~whole], last[~whole]
                _, at, counts = np.unique(hashes(point, first, last), return_index=True, return_counts=True)
                often = counts > 1
                for a, b, c in zip(first[at[often]].tolist(), last[at[often]].tolist(), counts[often].tolist()):
                    held[text[a:b]] = held.get(text[a:b], 0) + c
                if len(held) > 4 * per_task:
                    held = dict(sorted(held.items(), key=lambda kv: -kv[1])[:2 * per_task])
        yield pa.RecordBatch.from_pylist([{"task": TaskContext.get().partitionId(), "body": body(held, per_task)}])

    def merge(table: pa.Table) -> pa.Table:
        held: dict[str, int] = {}
        for one in table.column("body").to_pylist():
            part = unpacked(one)
            for token, count in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held[token] = held.get(token, 0) + count
        return pa.table({"task": table.column("task")[:1], "body": pa.array([body(held, size)], pa.binary())})

    rows = materialize(docs.select("text").mapInArrow(summary, "task long, body binary"), "token-summaries")
    left, step = rows.count(), 1
    while left > 1:
        step, left = step * fan, -(-left // fan)
        rows = rows.groupBy(F.floor(F.col("task") / F.lit(step)).alias("of")).applyInArrow(merge, "task long, body binary")
    held: dict[str, int] = {}
    for row in rows.collect():  # one value of ``size`` pre-tokens at most
        part = unpacked(row.body)
        for token, count in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            held[token] = held.get(token, 0) + count
    return [k for k, _ in sorted(held.items(), key=lambda kv: (-kv[1], kv[0]))[:size]]


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, table_size: int = 1 << 15, per_task: int = 1 << 14) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    ``table_size`` bounds the broadcast table (12 bytes an entry, half full),
    ``per_task`` the summary of a task."""
    docs = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    tokenizer, _ = load(path)
    sent = docs.sparkSession.sparkContext.broadcast(code_point_tables(path))  # 1.1 MB
    words = frequent(docs, path, sent, table_size, per_task)
    lengths = [len(e) for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    joined = "".join(words)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    point = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    keys = hashes(point, ends - np.array([len(w) for w in words], np.int64), ends) if words else np.zeros(0, np.uint64)
    common = Table(keys, np.array(lengths, np.int64))

    def count(it):
        _, special = load(path)
        kinds = sent.value
        for batch in it:
            raw, offsets = utf8(batch.column(0))
            for lo, hi in slabs(offsets, SLAB):
                text, point, first, last, owner, whole = pretokens(
                    raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], kinds, special)
                found = hashes(point, first, last)
                lengths = common.find(found).astype(np.int64)
                if whole is not None:
                    lengths[whole] = 1
                miss = np.flatnonzero(lengths == 0)
                if len(miss):
                    lengths[miss] = missing_lengths(path, text, found[miss], first[miss], last[miss])
                total = np.bincount(owner, weights=lengths, minlength=hi - lo).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo), pa.array(np.diff(offsets[lo:hi + 1])), pa.array(total),
                     pa.array(total > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
