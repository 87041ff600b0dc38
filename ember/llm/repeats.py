"""Repeated-passage removal with suffix arrays over content-routed shards.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed. Windows of that length are routed by content: a window
belongs to the least-hashed gram inside it, so equal windows always meet, and
neighbouring windows with the same gram travel as one segment. Segments whose
gram occurs once in the corpus hold nothing repeated. Equal segments collapse
into one with a count, and all their windows are repeats. What is left, grams
with several different segments, is dealt into shards of bounded size; each
shard's suffix array is built by induced sorting, and a window is a repeat
where the permuted common prefix reaches ``length`` on either side of it in
the array. A gram with too many different segments for one shard (a passage
with very many surroundings) compares its windows by 128-bit digests in a
grouped count instead, spread over all tasks.

Defined results: a null text is empty; texts shorter than ``length`` keep all
their bytes; strings are judged on the input; repeated rows repeat each
other. Bytes are removed, so a kept text need not be valid UTF-8. Other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .exact_dedup import located
from .suffix import permuted_lcp, suffix_array
from .words import _BASE, _BYTE, _INVERSE, mix, powers, slabs, span_hash, utf8

GRAM = 64
SLAB = 1 << 19
SEGMENT = "file long, at long, gram long, body long, first int, last int"
RANGES = "gram long, body long, ranges array<struct<a:int,b:int>>"


def gram_hashes(raw: np.ndarray, size: int, table: np.ndarray = _BYTE) -> np.ndarray:
    """Hash of every run of ``size`` bytes by its start."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(table[raw] * powers(_BASE, len(raw)), out=total[1:])
    return mix((total[size:] - total[:n]) * powers(_INVERSE, n))


def least_positions(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the least key (leftmost of equals, by its high half) of
    every run of ``width`` keys: running minima of blocks from both ends."""
    n = len(keys)
    packed = (keys & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    grid = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[:n] = packed
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = n - width + 1
    return (np.minimum(behind[:m], ahead[width - 1:width - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(texts: DataFrame, length: int) -> DataFrame:
    """(file, at, text) -> runs of windows that share their least gram.

    ``first`` and ``last`` are the first and last window start in the text;
    ``gram`` and ``body`` hash the gram and, with the gram's place, the bytes."""
    span = length - GRAM + 1

    def cut(it):
        for batch in it:
            raw, offsets = utf8(batch.column(2))
            file, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi in slabs(offsets, SLAB):
                part = raw[offsets[lo]:offsets[hi]]
                ends = offsets[lo:hi + 1] - offsets[lo]
                if len(part) < length:
                    continue
                grams = gram_hashes(part, GRAM)
                place = least_positions(grams, span)
                owner = np.repeat(np.arange(hi - lo), np.diff(ends))[:len(place)]
                valid = np.flatnonzero(np.arange(len(place)) + length <= ends[owner + 1])
                if not len(valid):
                    continue
                place, owner = place[valid], owner[valid]
                head = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
                first, last = valid[head], valid[np.append(head[1:], len(valid)) - 1]
                place, owner = place[head], owner[head]
                body = span_hash(_BYTE[part], first, last + length) + mix((place - first).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(file[lo:hi][owner]), pa.array(at[lo:hi][owner]),
                    pa.array(grams[place].view(np.int64)), pa.array(body.view(np.int64)),
                    pa.array((first - ends[owner]).astype(np.int32)), pa.array((last - ends[owner]).astype(np.int32)),
                ], names=["file", "at", "gram", "body", "first", "last"])

    return texts.mapInArrow(cut, SEGMENT)


def repeated_starts(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """Window starts of each string that are repeated within the shard."""
    gaps = np.frombuffer(b"\x00".join(bodies) + b"\x00", np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    text = gaps.astype(np.int64) + 1
    text[begin + sizes] = 0  # separators sort first and end every prefix
    sa = suffix_array(text, 257)
    prefix = permuted_lcp(text, sa, int(sizes.max()), 0)
    repeat = np.zeros(len(text) + 1, bool)
    hit = np.flatnonzero(prefix[sa] >= length)  # with the suffix before it
    repeat[sa[hit]] = True
    repeat[sa[hit - 1]] = True
    return [np.flatnonzero(repeat[a:a + max(0, n - length + 1)]) for a, n in zip(begin.tolist(), sizes.tolist())]


def _runs(starts: np.ndarray) -> list[dict]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"a": int(a), "b": int(b)} for a, b in
            zip(starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)])]


RANGE_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _range_table(gram, body, starts) -> pa.Table:
    return pa.table({"gram": gram, "body": body, "ranges": pa.array([_runs(s) for s in starts], RANGE_TYPE)})


def shard_ranges(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    """(gram, body, bytes) -> repeated window ranges, a suffix array per shard."""
    def array(table: pa.Table) -> pa.Table:
        starts = repeated_starts(table.column("bytes").to_pylist(), length)
        return _range_table(table.column("gram"), table.column("body"), starts)

    return (pieces.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
            .groupBy("shard").applyInArrow(array, RANGES))


def digest_ranges(pieces: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many segments, by digests of the windows."""
    other = mix(_BYTE)

    def windows(it):
        for batch in it:
            for gram, body, raw in zip(*(batch.column(c).to_pylist() for c in range(3))):
                raw = np.frombuffer(raw, np.uint8)
                one, two = gram_hashes(raw, length), gram_hashes(raw, length, other)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one), gram)), pa.array(np.full(len(one), body)),
                     pa.array(np.arange(len(one), dtype=np.int32)), pa.array(one.view(np.int64)),
                     pa.array(two.view(np.int64))], names=["gram", "body", "off", "x", "y"])

    rows = pieces.select("gram", "body", "bytes").mapInArrow(
        windows, "gram long, body long, off int, x long, y long")
    often = rows.groupBy("x", "y").count().filter("count > 1").select("x", "y")
    return (rows.join(often, ["x", "y"]).groupBy("gram", "body")
            .agg(F.collect_list(F.struct(F.col("off").alias("a"), F.col("off").alias("b"))).alias("ranges")))


def merged_spans(spans: DataFrame, length: int) -> DataFrame:
    """(file, at, spans of window starts) -> the maximal byte ranges they
    cover, as packed pairs of 32-bit integers."""
    def merge(it):
        for batch in it:
            packed = []
            for found in batch.column(2):
                found = found.values
                first = found.field("a").to_numpy()
                order = np.argsort(first, kind="stable")
                first = first[order]
                reach = np.maximum.accumulate(found.field("b").to_numpy()[order] + length)
                new = np.flatnonzero(np.concatenate(([True], first[1:] > reach[:-1])))
                last = np.append(new[1:], len(first)) - 1
                packed.append(np.stack((first[new], reach[last]), axis=1).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                                             names=["file", "at", "spans"])

    return spans.mapInArrow(merge, "file long, at long, spans binary")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   shard_bytes: int = 1 << 20, most_segments: int = 2048,
                   broadcast_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes
    left) for every row. ``shard_bytes`` is about the text of one suffix
    array, ``most_segments`` the different segments of one gram that go into
    one, ``broadcast_bytes`` bounds the measured lists of places that may be
    broadcast to the texts; beyond it texts and places are joined by shuffle."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    texts = located(docs).select(F.col("__file").alias("file"), F.col("__at").alias("at"),
                                 F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    whole = texts.select("file", "at", "text")
    cut = materialize(segments(whole, length), "repeat-segments")
    often = materialize(cut.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"),
                        "repeat-grams")
    twice = materialize(cut.join(often, "gram"), "repeat-twice")
    kinds = materialize(twice.groupBy("gram", "body").agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("file", "at", "first", "last"))), "repeat-kinds")
    mixed = materialize(kinds.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1"), "repeat-mixed")
    wanted = kinds.join(mixed, "gram").groupBy("file", "at").agg(
        F.collect_list(F.struct("gram", "body", "first", "last", "c")).alias("want"))
    wanted = materialize(wanted, "repeat-wanted")
    n_wanted = wanted.agg(F.sum(F.size("want") + 1)).first()[0] or 0
    wanted = F.broadcast(wanted) if 56 * n_wanted <= broadcast_bytes else wanted

    def fetch(it):
        for batch in it:
            raw, offsets = utf8(batch.column(0))
            for i, want in enumerate(batch.column(1).to_pylist()):
                text = raw[offsets[i]:offsets[i + 1]]
                yield pa.RecordBatch.from_pylist(
                    [{"gram": w["gram"], "body": w["body"], "c": w["c"],
                      "bytes": text[w["first"]:w["last"] + length].tobytes()} for w in want], PIECE)

    pieces = materialize(whole.join(wanted, ["file", "at"]).select("text", "want").mapInArrow(
        fetch, "gram long, body long, c long, bytes binary"), "repeat-pieces")
    size = pieces.filter(F.col("c") <= most_segments).agg(F.sum(F.length("bytes"))).first()[0] or 0
    some = shard_ranges(pieces.filter(F.col("c") <= most_segments), max(1, -(-size // shard_bytes)), length)
    many = digest_ranges(pieces.filter(F.col("c") > most_segments), length)
    full = kinds.filter("n > 1").select("gram", "body", F.array(F.struct(
        F.lit(0).alias("a"), (F.col("last") - F.col("first")).alias("b"))).alias("ranges"))
    found = materialize(some.unionByName(many).join(kinds.filter("n = 1").select("gram", "body"), ["gram", "body"])
                        .filter(F.size("ranges") > 0).unionByName(full), "repeat-ranges")
    spans = (twice.join(found, ["gram", "body"]).select("file", "at", "first", F.explode("ranges").alias("r"))
             .groupBy("file", "at").agg(F.collect_list(F.struct(
                 (F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b")).alias("b")))
                 .alias("spans")))
    spans = materialize(merged_spans(spans, length), "repeat-spans")
    n_spans = spans.agg(F.sum(F.length("spans") + 64)).first()[0] or 0
    spans = F.broadcast(spans) if n_spans <= broadcast_bytes else spans

    def strip(it):
        for batch in it:
            raw, offsets = utf8(batch.column(1))
            n = batch.num_rows
            removed, runs, digests, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                text = raw[offsets[i]:offsets[i + 1]].tobytes()
                if found:
                    spans = np.frombuffer(found, np.int32).reshape(-1, 2)
                    removed[i], runs[i] = int((spans[:, 1] - spans[:, 0]).sum()), len(spans)
                    ends = [0, *spans.reshape(-1).tolist(), len(text)]
                    text = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
                kept.append(text)
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(runs),
                 pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.join(spans, ["file", "at"], "left").select("doc_id", "text", "spans").mapInArrow(
        strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


PIECE = pa.schema([("gram", pa.int64()), ("body", pa.int64()), ("c", pa.int64()), ("bytes", pa.binary())])
