"""MinHash near-duplicates with sequential Bayesian verification.

Each text becomes its set of distinct word shingles, the set a signature of
``bands * rows`` minimum hashes. Texts with equal sets collapse into one node.
Nodes that agree on all hashes of a band are candidates. A candidate pair's
signatures are compared one batch after the other; after n hashes with m
matches the pair is dropped once P(similarity >= threshold | m, n), under a
uniform prior, falls below ``miss``. Survivors are verified exactly on their
full shingle sets, and connected groups take their smallest id.

Only connectivity is asked for, so a bucket never emits all its pairs. Its
members are first paired with one leader. Where a bucket then still holds
several components, members of different components meet: as untested pairs
in a small bucket, and in a large one block against block inside tasks, where
signatures and then shingle sets are compared in memory and only a spanning
forest of confirmed links is emitted. No candidate pair that could join two components stays untested.

Defined results: a null text is empty; a text without words has an empty set
and is linked with nothing; fewer words than ``k`` give one shingle of all
words; rows with equal sets are one node, whatever their ids, and rows that
share an id but not the set are different nodes. A component's id is the least
id in it; ``kept`` marks the rows with that id and the set of the row that
stays. A row with a null id is linked, but its component is null and it is
marked as kept. ``stays`` (used by ``kept_rows``) marks one row per component,
the least by id (null last) and locator. Other columns of the input are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, components, fixed_binary, materialize
from .exact_dedup import located, stored
from .words import mix, shingle_sets

SIGNATURE_SCHEMA = ("doc_id long, n_shingles long, set_key binary, bands array<long>, sig binary, "
                    "file long, at long")


def _coefficients(n: int):
    rng = np.random.Generator(np.random.PCG64(8))
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint32))


def _set_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order-free 128-bit key of each set, as (n, 16) bytes."""
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(salt)))))
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    key = np.stack([s[at[1:]] - s[at[:-1]] for s in sums], axis=1)
    return np.ascontiguousarray(key).view(np.uint8).reshape(len(at) - 1, 16)


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text, file, at) -> doc_id, set size, set key, band keys and one byte of each minimum hash."""
    n_hashes = bands * rows
    mul, add = _coefficients(n_hashes)

    def batches(it):
        for batch in it:
            ids = batch.column(0)
            for lo, hi, h, at in shingle_sets(batch.column(1), k):
                sizes = np.diff(at)
                some = np.flatnonzero(sizes)
                low = np.zeros((hi - lo, n_hashes), np.uint32)
                if len(some):
                    short = (h >> np.uint64(32)).astype(np.uint32)
                    begin = at[:-1][some]
                    for j in range(n_hashes):
                        low[some, j] = np.minimum.reduceat(short * mul[j] + add[j], begin)
                keys = np.zeros((hi - lo, bands), np.uint64)
                for b in range(bands):
                    acc = np.full(hi - lo, b + 1, np.uint64)
                    for r in range(rows):
                        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + low[:, b * rows + r])
                    keys[:, b] = acc
                ends = np.arange(hi - lo + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(sizes), fixed_binary(_set_keys(h, at)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))),
                    fixed_binary((low >> np.uint32(11)).astype(np.uint8)),
                    batch.column(2).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo),
                ], names=["doc_id", "n_shingles", "set_key", "bands", "sig", "file", "at"])

    return docs.mapInArrow(batches, SIGNATURE_SCHEMA)


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest matches of n at which P(agreement >= threshold) is at least miss.

    With a uniform prior that posterior is P(Binomial(n + 1, threshold) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def bayes_filter(pairs: DataFrame, threshold: float, miss: float, n_hashes: int, batch: int) -> DataFrame:
    """(a, b, sig_a, sig_b) -> surviving (a, b), comparing ``batch`` hashes at a time.

    One byte of each hash is kept, so unequal hashes still agree once in 256."""
    agree = threshold + (1 - threshold) / 256
    stops = [(n, least_matches(n, agree, miss)) for n in range(batch, n_hashes + 1, batch)]

    def batches(it):
        for part in it:
            n = part.num_rows
            left, right = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(n, n_hashes)
                           for c in (2, 3))
            alive, seen = np.arange(n), np.zeros(n, np.int64)
            for end, least in stops:
                seen[alive] += (left[alive, end - batch:end] == right[alive, end - batch:end]).sum(1)
                alive = alive[seen[alive] >= least]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(alive)),
                                              part.column(1).take(pa.array(alive))], names=["a", "b"])

    return pairs.mapInArrow(batches, "a long, b long")


def _passes(left: np.ndarray, right: np.ndarray, stops, batch: int):
    """Row index pairs of two signature matrices that pass every stop, those of a few rows of ``left`` at a time."""
    step = max(1, (4 << 20) // max(1, len(right) * batch))
    for lo in range(0, len(left), step):
        some = left[lo:lo + step]
        i, j, seen = None, None, None
        for end, least in stops:
            if i is None:
                hits = (some[:, None, :batch] == right[None, :, :batch]).sum(2, dtype=np.uint8)
                i, j = np.nonzero(hits >= least)
                seen = hits[i, j].astype(np.int64)
                continue
            seen = seen + (some[i, end - batch:end] == right[j, end - batch:end]).sum(1)
            alive = seen >= least
            i, j, seen = i[alive], j[alive], seen[alive]
        yield i + lo, j


class _Forest:
    """Exactly confirmed links among rows of a block, no more than a spanning
    forest of what they join. ``flat``/``at`` are the rows' sets as indexes into
    the block's distinct shingles; at most about ``held`` of them meet a row at once."""

    def __init__(self, roots, sets, sizes, nodes, percent, held=1 << 20):
        self.root = {r: r for r in roots.tolist()}
        self.roots, self.sizes, self.nodes, self.percent, self.held = roots, sizes, nodes, percent, held
        self.at = np.concatenate(([0], np.cumsum(sizes)))
        distinct, self.flat = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        self.flat = self.flat.astype(np.int32)
        self.mark = np.zeros(max(1, len(distinct)), np.int32)
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def confirm(self, i, j) -> None:
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        cuts = np.flatnonzero(np.diff(i, prepend=-1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(i)]):
            parts = np.cumsum(self.sizes[j[lo:hi]]) // self.held
            for others in np.split(j[lo:hi], np.flatnonzero(np.diff(parts)) + 1):
                self._meet(int(i[lo]), others)

    def _meet(self, row: int, others) -> None:
        own = self.find(int(self.roots[row]))
        others = np.array([o for o in others.tolist() if self.find(int(self.roots[o])) != own], np.int64)
        if not len(others):
            return
        mine = self.flat[self.at[row]:self.at[row + 1]]
        self.mark[mine] = 1
        lengths = self.sizes[others]
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        spans = np.repeat(self.at[others] - begin, lengths)
        common = np.add.reduceat(self.mark[self.flat[spans + np.arange(int(lengths.sum()))]], begin)
        self.mark[mine] = 0
        for o in others[100 * common >= self.percent * (self.sizes[row] + lengths - common)].tolist():
            x, y = self.find(int(self.roots[row])), self.find(int(self.roots[o]))
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((int(self.nodes[row]), int(self.nodes[o])))


def block_links(members: DataFrame, threshold: float, miss: float, n_hashes: int, batch: int,
                percent: int, block: int) -> DataFrame:
    """Confirmed links between different components of each large bucket.

    ``members``: key, node, label, sig, shingles, c (bucket size). A bucket is
    cut into blocks of about ``block`` members and every two blocks meet in
    one task, so a task holds two blocks whatever the bucket's size. The
    signatures are pruned and the shingle sets compared there, the pairs of a
    few rows at a time, and a task emits at most a spanning forest of its members."""
    agree = threshold + (1 - threshold) / 256
    stops = [(n, least_matches(n, agree, miss)) for n in range(batch, n_hashes + 1, batch)]

    def compare(frame):
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(len(frame), n_hashes)
        node, label = frame["node"].to_numpy(), frame["label"].to_numpy()
        size = frame["shingles"].map(len).to_numpy() // 8
        first = frame["blk"].to_numpy() == frame["i"].iloc[0]
        names, counts = np.unique(label, return_counts=True)
        main = names[counts.argmax()]
        left = np.flatnonzero(first)
        right = left if frame["i"].iloc[0] == frame["j"].iloc[0] else np.flatnonzero(~first)
        forest = None
        # at least one side is outside the commonest component
        for u, v in ((left[label[left] != main], right),
                     (left[label[left] == main], right[label[right] != main])):
            if not len(u) or not len(v):
                continue
            for i, j in _passes(sig[u], sig[v], stops, batch):
                p, q = u[i], v[j]
                fit = (label[p] != label[q]) & (100 * np.minimum(size[p], size[q])
                                                >= percent * np.maximum(size[p], size[q]))
                if fit.any():
                    forest = forest or _Forest(label, frame["shingles"], size, node, percent)
                    forest.confirm(p[fit], q[fit])
        links = forest.links if forest else []
        return pd.DataFrame({"a": [min(x) for x in links], "b": [max(x) for x in links]}, dtype="int64")

    n_blocks = F.ceil(F.col("c") / block).cast("int")
    blocks = (members.withColumn("blk", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
              .withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")))
    return (blocks.select("key", "i", "j", "blk", "node", "label", "sig", "shingles")
            .groupBy("key", "i", "j").applyInPandas(compare, "a long, b long"))


def shingle_table(docs: DataFrame, k: int) -> DataFrame:
    """(node, text) -> node, sorted distinct shingle hashes as packed 64-bit integers."""
    def batches(it):
        for batch in it:
            for lo, hi, h, at in shingle_sets(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), binary_column(h, at)],
                                                 names=["node", "shingles"])

    return docs.mapInArrow(batches, "node long, shingles binary")


def exact_filter(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, x, y) -> (a, b) with 100 * |x & y| >= percent * |x | y|."""
    def batches(it):
        for part in it:
            keep = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(batches, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80, bands: int = 32, rows: int = 5, batch: int = 32,
                    miss: float = 1e-6, small_bucket: int = 64, block: int = 2048,
                    broadcast_bytes: int = 32 << 20, broadcast_ids: int = 1 << 21) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, stays and
    the row's content locator (file, at).

    A pair at the threshold is missed by the bands with probability
    (1 - 0.8 ** rows) ** bands (about 3e-6 here) and by the pruning with at
    most about ``miss`` per batch. ``small_bucket`` and ``block`` only choose
    where the pairs of a bucket are compared. ``broadcast_bytes`` bounds the
    measured shingle sets, ``broadcast_ids`` the counted ids that may be
    broadcast for the exact check, a text's node and locator being counted as
    four; beyond them the joins shuffle."""
    docs = located(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                F.col("__file").alias("file"), F.col("__at").alias("at"))
    signed = materialize(signatures(docs, k, bands, rows), "nd-signatures")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "at")
    classes = materialize(signed.filter("n_shingles > 0").groupBy("set_key").agg(F.min(row).alias("best"))
                          .select("set_key", F.monotonically_increasing_id().alias("node"), "best"), "nd-classes")
    place = classes.select("set_key", "node", F.col("best.file").alias("file"), F.col("best.at").alias("at"))
    nodes = materialize(signed.join(place, ["set_key", "file", "at"])
                        .select("node", "n_shingles", "bands", "sig"), "nd-nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    rows_of = materialize(keys.join(keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "key"),
                          "nd-buckets")
    signature_of = nodes.select("node", "sig")

    def survivors(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(signature_of.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
                .join(signature_of.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
                .select("a", "b", "sig_a", "sig_b"))
        return bayes_filter(both, percent / 100, miss, bands * rows, batch)

    def sets_of(ends: DataFrame) -> DataFrame:
        ends = materialize(place.join(ends.distinct(), "node").select("node", "file", "at"), "nd-ends")
        ends = F.broadcast(ends) if 4 * ends.count() <= broadcast_ids else ends
        return materialize(shingle_table(docs.join(ends, ["file", "at"]).select("node", "text"), k), "nd-sets")

    def verified(alive: DataFrame) -> DataFrame:
        sets = sets_of(alive.select(F.col("a").alias("node")).unionAll(alive.select("b")))
        size = sets.agg(F.sum(F.length("shingles"))).first()[0] or 0
        sets = F.broadcast(sets) if size <= broadcast_bytes else sets
        return materialize(exact_filter(
            alive.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .select("a", "b", "x", "y"), percent).distinct(), "nd-links")

    def ordered(pairs: DataFrame) -> DataFrame:
        return (pairs.filter("p <> q")
                .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())

    leaders = rows_of.groupBy("key").agg(F.min("node").alias("q"))
    tested = materialize(ordered(rows_of.join(leaders, "key").select(F.col("node").alias("p"), "q")), "nd-pairs")
    links = verified(materialize(survivors(tested), "nd-survivors"))
    labels = components(links)
    # buckets that still hold more than one component
    at = rows_of.join(labels, "node", "left").select(
        "key", "c", "node", F.coalesce("label", "node").alias("label"))
    mixed = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    at = materialize(at.join(mixed.select("key"), "key"), "nd-mixed")
    few, many = at.filter(F.col("c") <= small_bucket), at.filter(F.col("c") > small_bucket)
    met = ordered(few.join(few.select("key", F.col("node").alias("q"), F.col("label").alias("m")), "key")
                  .filter("label <> m AND node < q").select(F.col("node").alias("p"), "q"))
    more = verified(materialize(survivors(met.join(tested, ["a", "b"], "left_anti")), "nd-survivors"))
    if not many.isEmpty():
        sets = sets_of(many.select("node"))
        more = materialize(more.unionAll(block_links(
            many.join(signature_of, "node").join(sets, "node"), percent / 100, miss, bands * rows, batch, percent,
            block)), "nd-links")
    if not more.isEmpty():
        labels = components(links.unionAll(more))
    # the row that stays, of every linked component, then of every set
    of_set = F.struct("best", "set_key")
    linked = classes.join(labels, "node").select("node", "label", of_set.alias("own"))
    stay = linked.groupBy("label").agg(F.min("own").alias("stay"))
    stay = linked.join(stay, "label").select("node", "stay")
    found = classes.join(stay, "node", "left").select("set_key", F.coalesce("stay", of_set).alias("stay"))
    first = F.col("stay.best")
    alone = F.col("stay").isNull()
    return (signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_key")).alias("set_key"),
                          "file", "at")
            .join(found, "set_key", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce(first["doc_id"], "doc_id")))
            .select("file", "at", "doc_id", "n_shingles", "component_id",
                    (alone | F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("component_id"))
                     & (F.col("set_key") == F.col("stay.set_key")))).alias("kept"),
                    (alone | ((F.col("file") == first["file"]) & (F.col("at") == first["at"]))).alias("stays")))


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, exactly one per group, with all their columns."""
    docs = stored(docs)
    dropped = near_duplicates(docs, **options).filter("NOT stays").select(
        F.col("file").alias("__file"), F.col("at").alias("__at"))
    return located(docs).join(dropped, ["__file", "__at"], "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns))
