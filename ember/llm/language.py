"""Language identification: sparse multinomial logistic regression on TF-IDF
weights of character n-grams, fitted by follow-the-regularised-leader.

Runs of 1 to ``GRAMS`` characters (A-Z lower-cased) fall into a fixed number
of hash buckets. A text's weights are (1 + ln count) * idf, scaled to length
one; idf comes from all texts that may be learnt from. The model keeps one
weight vector a language; the per-coordinate proximal updates carry an L1 and
an L2 penalty, so weights that earn too little stay exactly 0. One temperature
fitted on rows kept out of the training calibrates the probabilities.

The document counts of the buckets are the only corpus statistic and have a
fixed size. The model is fitted on at most ``max_train`` rows, drawn by hash
of their id and evenly among the languages; every row is scored on its whole
text.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text when nothing can be learnt; rows whose id is null are never
learnt from and not held out; equal probabilities go to the language that
sorts first; repeated rows count each. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .token_count import code_point_values
from .words import _STEP, LOWER, mix, slabs, utf8

BITS, GRAMS = 15, 3
BUCKETS = 1 << BITS
SLAB = 1 << 18


def gram_counts(column):
    """Yield (row, buckets, counts) of every text with a character, in order."""
    raw, offsets = utf8(column)
    for lo, hi in slabs(offsets, SLAB):
        part = LOWER[raw[offsets[lo]:offsets[hi]]]
        point = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))[offsets[lo:hi + 1] - offsets[lo]]
        value = code_point_values()[point]
        runs = []
        for n in range(1, GRAMS + 1):
            total = np.full(max(0, len(value) - n + 1), n, np.uint64) * _STEP[9]
            for j in range(n):
                total += value[j:len(value) - n + 1 + j] * _STEP[j]
            runs.append((mix(total) >> np.uint64(64 - BITS)).astype(np.int64))
        for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist()), lo):
            if b > a:  # no run crosses into the next text
                counts = np.bincount(np.concatenate([r[a:max(a, b - n)] for n, r in enumerate(runs)]), minlength=BUCKETS)
                buckets = np.flatnonzero(counts)
                yield row, buckets, counts[buckets]


def weights(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[buckets]
    length = np.sqrt(x @ x)
    return x / length if length else x


class Softmax:
    """Multinomial logistic regression by FTRL-proximal with elastic net."""

    def __init__(self, classes: list[str], idf: np.ndarray, rate: float = 0.5, beta: float = 1.0, l1: float = 0.02,
                 l2: float = 0.1, epochs: int = 3, seed: int = 5):
        self.classes, self.idf = classes, idf
        self.rate, self.beta, self.l1, self.l2, self.epochs, self.seed = rate, beta, l1, l2, epochs, seed
        self.z, self.n = np.zeros((BUCKETS, len(classes))), np.zeros((BUCKETS, len(classes)))
        self.temperature = 1.0

    def table(self, rows=slice(None)) -> np.ndarray:
        """Weights of some buckets, solved from the accumulated gradients."""
        z, n = self.z[rows], self.n[rows]
        pull = np.maximum(np.abs(z) - self.l1, 0) * np.sign(z)
        return -pull / ((self.beta + np.sqrt(n)) / self.rate + self.l2)

    def fit(self, rows) -> Softmax:
        """``rows``: (buckets, counts, class number)."""
        known = [(b, weights(b, c, self.idf), y) for b, c, y in rows]
        rng = np.random.default_rng(self.seed)
        for _ in range(self.epochs):
            for i in rng.permutation(len(known)).tolist():
                buckets, x, y = known[i]
                w = self.table(buckets)
                error = probabilities(x @ w)
                error[y] -= 1
                grad = x[:, None] * error
                before = self.n[buckets]
                after = before + grad * grad
                self.z[buckets] += grad - (np.sqrt(after) - np.sqrt(before)) / self.rate * w
                self.n[buckets] = after
        self.w = self.table()
        return self

    def calibrate(self, rows) -> Softmax:
        """The temperature with the least log loss on rows not trained on."""
        if rows:
            z = np.stack([weights(b, c, self.idf) @ self.w[b] for b, c, _ in rows])
            y = np.array([y for _, _, y in rows])

            def loss(t):
                return -np.log(np.maximum(probabilities(z / t)[np.arange(len(y)), y], 1e-12)).mean()

            self.temperature = float(min(np.geomspace(0.02, 8, 121), key=loss))
        return self

    def predict(self, buckets, counts):
        p = probabilities(weights(buckets, counts, self.idf) @ self.w[buckets] / self.temperature)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fold(doc_id):
    """crc32 of the id as text, modulo 4; fold 2 is held out, fold 1 calibrates."""
    return F.crc32(F.col(doc_id).cast("string")) % 4


def document_counts(texts: DataFrame):
    """Number of texts with a character, and of those with each bucket."""
    def sums(it):
        held, n = np.zeros(BUCKETS, np.int64), 0
        for batch in it:
            for _, buckets, _ in gram_counts(batch.column(0)):
                held[buckets] += 1
                n += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(held[at], n))],
                                         names=["bucket", "n"])

    df, total = np.zeros(BUCKETS, np.int64), 0
    for row in texts.select("text").mapInArrow(sums, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():  # one row a bucket
        if row.bucket < 0:
            total = row.n
        else:
            df[row.bucket] = row.n
    return total, df


def fit(docs: DataFrame, max_train: int) -> Softmax | None:
    """Model of the rows (doc_id, text, lang) outside fold 2."""
    known = docs.withColumn("fold", fold("doc_id")).filter("fold <> 2 AND lang IS NOT NULL AND text IS NOT NULL")
    # the rows to fetch, chosen without their texts: each language's first ones by
    # hash. Few more than are wanted of a language meet in one place.
    keys = known.select("doc_id", "lang", F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1)).alias("draw"))
    sizes = materialize(keys.groupBy("lang").agg(F.count("*").alias("of")), "language-sizes")
    share = F.lit(float(1 << 62)) * F.least(F.lit(1.0), F.lit(4.0 * max_train) / F.col("of"))
    few = keys.join(F.broadcast(sizes) if sizes.count() <= max_train else sizes, "lang").filter(F.col("draw") <= share)
    of_lang = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = (few.withColumn("place", F.row_number().over(of_lang)).filter(F.col("place") <= max_train)
              .orderBy("place", "draw", "doc_id", "lang").limit(max_train).select("doc_id", "lang").distinct())

    def rows(it):
        for batch in it:
            for row, buckets, counts in gram_counts(batch.column(0)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(row, 1), batch.column(2).slice(row, 1),
                    pa.array([buckets.astype(np.uint16).tobytes()]), pa.array([counts.astype(np.int32).tobytes()])],
                    names=["fold", "lang", "buckets", "counts"])

    sample = (known.join(F.broadcast(chosen), ["doc_id", "lang"]).select("text", "fold", "lang")
              .mapInArrow(rows, "fold long, lang string, buckets binary, counts binary").collect())
    if not sample:
        return None
    total, df = document_counts(known)
    idf = np.where(df > 0, np.log((1 + total) / (1 + df)) + 1, 0.0)
    classes = sorted({r.lang for r in sample})
    number = {c: i for i, c in enumerate(classes)}
    sample.sort(key=lambda r: (r.lang, r.buckets, r.counts, r.fold))  # the same model whatever the order of arrival
    split = {False: [], True: []}
    for r in sample:
        split[r.fold == 1].append((np.frombuffer(r.buckets, np.uint16).astype(np.int64),
                                   np.frombuffer(r.counts, np.int32).astype(np.float64), number[r.lang]))
    if not split[False]:
        split = {False: split[True], True: []}
    return Softmax(classes, idf).fit(split[False]).calibrate(split[True])


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_train: int = 4000) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    model = fit(docs, max_train)

    def predicted(it):
        for batch in it:
            lang, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            letters = batch.column(2).to_pylist()
            if model is not None:
                for row, buckets, counts in gram_counts(batch.column(0)):
                    if letters[row]:
                        lang[row], score[row] = model.predict(buckets, counts)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(3), pa.array(lang), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("text", "doc_id", letter.alias("letter"),
                       F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out")).mapInArrow(
        predicted, "doc_id long, held_out boolean, lang_pred string, score double")
