"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word and its shape (runs of capitals, small letters, digits and each
other sign) falls into one of a fixed number of hash buckets. A bucket has a
sparse random index vector; its word vector is the sum of the index vectors of
the buckets found around it in the whole corpus. A text is the mean and the
spread of its words' vectors, with its length and share of distinct words. A
network of two dense layers in numpy maps that to a logit, and one temperature
fitted on rows kept out of the training makes the probabilities calibrated.

The bucket table has a fixed size (about 2 MB), so it may be collected and
sent to every task; tasks sum their own part of the corpus and the parts meet
by block of buckets. The network is fitted on at most ``max_train`` labelled
rows, drawn by hash of their id. Scores come from the text alone.

Defined results: a null text is empty and still gets a score; rows whose id
is null are never learnt from and not held out; of several labels for one id
the greatest counts; without any label every score is 0.5. Other columns of
the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed_binary
from .words import (_BYTE, LOWER, distinct_per_text, slabs, span_hash, utf8, word_bounds)

WORD_BUCKETS, SHAPE_BUCKETS, DIM, NONZERO, WINDOW, BLOCK = 1 << 14, 1 << 10, 32, 2, 2, 256
ROWS = WORD_BUCKETS + SHAPE_BUCKETS
FEATURES = 4 * DIM + 2
SLAB = 1 << 18

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")


def index_vectors(seed: int = 1):
    """Position and sign of the non-zero entries of every bucket's index vector."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, DIM, (ROWS, NONZERO)), rng.choice(np.array([-1, 1], np.int64), (ROWS, NONZERO)))


def tokens(raw: np.ndarray, offsets: np.ndarray):
    """Word hash, word bucket, shape bucket and text index of every word."""
    starts, ends, owner = word_bounds(raw, offsets)
    words = span_hash(_BYTE[LOWER[raw]], starts, ends)
    kind = _CLASS[raw]
    turn = np.ones(len(raw), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[starts] = True
    at = np.flatnonzero(turn)
    shapes = span_hash(_BYTE[kind[at]], np.searchsorted(at, starts), np.searchsorted(at, ends))
    return (words, (words % np.uint64(WORD_BUCKETS)).astype(np.int64),
            (shapes % np.uint64(SHAPE_BUCKETS)).astype(np.int64) + WORD_BUCKETS, owner)


def context_sums(docs: DataFrame) -> np.ndarray:
    """Sum of neighbours' index vectors of every bucket, over the whole corpus."""
    place, sign = index_vectors()

    def partial(it):
        table, seen = np.zeros(ROWS * DIM, np.int64), False
        for batch in it:
            raw, offsets = utf8(batch.column(0))
            for lo, hi in slabs(offsets, SLAB):
                _, *ids, owner = tokens(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                seen = True
                for step in range(1, WINDOW + 1):
                    near = np.flatnonzero(owner[step:] == owner[:-step])
                    for of in ids:
                        a, b = of[near], of[near + step]
                        for x, y in ((a, b), (b, a)):
                            for z in range(NONZERO):
                                np.add.at(table, x * DIM + place[y, z], sign[y, z])
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(ROWS // BLOCK), pa.int32()),
                 fixed_binary(table.reshape(ROWS // BLOCK, BLOCK * DIM))], names=["block", "sums"])

    def total(it):
        held: dict[int, np.ndarray] = {}
        for batch in it:
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(sums, np.int64)
                held[block] = held[block] + part if block in held else part
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                              fixed_binary(np.stack(list(held.values())))], names=["block", "sums"])

    kind = "block int, sums binary"
    parts = docs.select("text").mapInArrow(partial, kind).repartition("block").mapInArrow(total, kind)
    table = np.zeros((ROWS // BLOCK, BLOCK * DIM), np.int64)
    for row in parts.collect():  # ROWS // BLOCK rows, whatever the corpus
        table[row.block] = np.frombuffer(row.sums, np.int64)
    return table.reshape(ROWS, DIM)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors of the buckets seen; the others are zero."""
    sums = sums.astype(np.float64)
    length = np.sqrt((sums ** 2).sum(1, keepdims=True))
    return np.divide(sums, length, out=np.zeros_like(sums), where=length > 0).astype(np.float32)


def features(column, vectors: np.ndarray):
    """Yield (lo, hi, matrix): pooled features of texts lo..hi."""
    raw, offsets = utf8(column)
    for lo, hi in slabs(offsets, SLAB):
        n = hi - lo
        words, word_ids, shape_ids, owner = tokens(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        counts = np.bincount(owner, minlength=n)
        out = np.zeros((n, FEATURES), np.float32)
        some = np.flatnonzero(counts)
        if len(some):
            begin = np.concatenate(([0], np.cumsum(counts)))[:-1][some]
            share = (1.0 / counts[some]).astype(np.float32)[:, None]
            for k, ids in enumerate((word_ids, shape_ids)):
                each = vectors[ids]
                mean = np.add.reduceat(each, begin, axis=0) * share
                spread = np.add.reduceat(each * each, begin, axis=0) * share - mean * mean
                out[some, 2 * k * DIM:(2 * k + 1) * DIM] = mean
                out[some, (2 * k + 1) * DIM:(2 * k + 2) * DIM] = np.sqrt(np.maximum(spread, 0))
            _, at = distinct_per_text(words, owner, n)
            out[some, -2] = np.diff(at)[some] / counts[some]
        out[:, -1] = np.log1p(counts)
        yield lo, hi, out


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Network:
    """Standardised input, one tanh layer, one logit and a temperature."""

    def __init__(self, hidden: int = 24, epochs: int = 60, rate: float = 0.01, decay: float = 1e-3,
                 batch: int = 256, seed: int = 3):
        self.hidden, self.epochs, self.rate, self.decay, self.batch, self.seed = (
            hidden, epochs, rate, decay, batch, seed)
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        rng = np.random.default_rng(self.seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        self.layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], self.hidden)), np.zeros(self.hidden),
                       rng.normal(0, self.hidden ** -0.5, (self.hidden, 1)), np.zeros(1)]
        first, second, turn = [np.zeros_like(p) for p in self.layers], [np.zeros_like(p) for p in self.layers], 0
        for epoch in range(self.epochs):
            rate = self.rate * (1 - epoch / self.epochs)
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // self.batch)):
                inner = np.tanh(x[rows] @ self.layers[0] + self.layers[1])
                error = (_sigmoid(inner @ self.layers[2] + self.layers[3]) - y[rows, None]) / len(rows)
                back = error @ self.layers[2].T * (1 - inner ** 2)
                turn += 1
                for i, grad in enumerate((x[rows].T @ back, back.sum(0), inner.T @ error, error.sum(0))):
                    grad = grad + self.decay * self.layers[i]
                    first[i] = 0.9 * first[i] + 0.1 * grad
                    second[i] = 0.999 * second[i] + 0.001 * grad ** 2
                    self.layers[i] = self.layers[i] - rate * (first[i] / (1 - 0.9 ** turn)) / (
                        np.sqrt(second[i] / (1 - 0.999 ** turn)) + 1e-8)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return (np.tanh(x @ self.layers[0] + self.layers[1]) @ self.layers[2] + self.layers[3])[:, 0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Network:
        """The temperature with the least log loss on rows not trained on."""
        if len(x):
            z = self.logit(x)

            def loss(t):
                p = np.clip(_sigmoid(z / t), 1e-9, 1 - 1e-9)
                return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

            self.temperature = float(min(np.geomspace(0.5, 8, 81), key=loss))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x) / self.temperature)


def fold(doc_id):
    """crc32 of the id as text, modulo 5; fold 0 is held out, fold 1 calibrates."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label_col: str, max_train: int) -> Network | None:
    """Network fitted on labelled rows outside fold 0, at most ``max_train``."""
    drawn = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label_col).cast("double").alias("y"))
             .dropna().groupBy("label_id").agg(F.max("y").alias("y")).withColumn("fold", fold("label_id"))
             .filter("fold <> 0").orderBy(F.xxhash64("label_id"), "label_id").limit(max_train))

    def rows(it):
        for batch in it:
            for lo, hi, x in features(batch.column(0), vectors):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo),
                                                  batch.column(2).slice(lo, hi - lo), fixed_binary(x)],
                                                 names=["fold", "y", "x"])

    known = (docs.join(F.broadcast(drawn), docs["doc_id"] == drawn["label_id"])
             .select("text", "fold", "y").mapInArrow(rows, "fold long, y double, x binary").collect())
    if not known:
        return None
    x = np.frombuffer(b"".join(r.x for r in known), np.float32).reshape(len(known), FEATURES).astype(np.float64)
    y, part = np.array([r.y for r in known]), np.array([r.fold for r in known])
    order = np.lexsort((*x.T[:4], y, part))  # the same network whatever the order of arrival
    x, y, part = x[order], y[order], part[order]
    apart = part == 1 if (part != 1).any() else np.zeros(len(part), bool)
    return Network().fit(x[~apart], y[~apart]).calibrate(x[apart], y[apart])


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", threshold: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    classify = classifier(keyed, labels, label_col, max_train)
    return (classify(keyed.select("text", "doc_id"), "doc_id long", "score")
            .select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def classifier(keyed: DataFrame, labels: DataFrame, label_col: str, max_train: int):
    """A function that replaces the first column of a frame, a text, by its score (last)."""
    vectors = word_vectors(context_sums(keyed))
    network = fit(keyed, labels, vectors, label_col, max_train)

    def classify(frame: DataFrame, schema: str, name: str) -> DataFrame:
        def scored(it):
            for batch in it:
                for lo, hi, x in features(batch.column(0), vectors):
                    p = network.score(x.astype(np.float64)) if network else np.full(hi - lo, 0.5)
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(lo, hi - lo) for c in batch.columns[1:]), pa.array(p)],
                        names=[*batch.schema.names[1:], name])

        return frame.mapInArrow(scored, f"{schema}, {name} double")

    return classify


def accepted_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns kept."""
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    classify = classifier(keyed, labels, label_col, max_train)
    whole = docs.select(F.col(f"`{text_col}`").alias("__text"), *(F.col(f"`{c}`") for c in docs.columns))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return classify(whole, kept, "__score").filter(F.col("__score") >= threshold).drop("__score")
