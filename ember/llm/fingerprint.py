"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash below a fixed fraction of the hash
range, so its size follows the text's, sketches of parts merge by set union,
and both likeness (Jaccard) and containment can be estimated between texts of
very unequal length. A text without such a hash has its least hash alone as
fingerprint, so no text with a word has an empty one. That hash lies over the
threshold and is no part of the sketch: ``members`` leaves it out, as merging
and estimating from fingerprints must. A fingerprint is the base64 text of the
sorted hashes, six bytes each.

``near_edited``, ``near_next`` and ``contained_edited`` are estimates from the
fingerprints: with u hashes under the threshold in the union of two sketches the
standard error of a likeness j is sqrt(j (1 - j) / u), u being about ``fraction``
of the union's shingles (0.06 for j = 0.5 and 500 shingles at 1/8). Two
fingerprints with no hash under the threshold are alike (1) if they are equal,
else not (0); so are one such and one other. The same figures from all shingles
of the texts at hand follow as ``exact_edited``, ``exact_next`` and
``exact_contained``.

Each text is also compared with its neighbour in descending id order and with
an edited text whose second half comes from that neighbour. Rows are dealt to
range blocks of ids, sorted there and streamed; the head row of each block is
sent along with the block before it, so a neighbour is always at hand.

Defined results: a null text is empty; texts without words have an empty
fingerprint, likeness 1 with each other and 0 with the rest; fewer words than
``k`` give one shingle; null ids come last; rows sharing an id are ordered by
their text. Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width
from .words import distinct_per_text, shingle_sets

WIDTH = 6  # bytes kept of each hash
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, contained_edited double, n_hashes long, exact_edited double, "
          "exact_next double, exact_contained double")


def sketch(h: np.ndarray, at: np.ndarray, fraction: float):
    """Kept hashes (top WIDTH bytes, sorted per text) and their offsets."""
    keep = h <= np.uint64(int(fraction * 2 ** 64) - 1)
    some = np.flatnonzero(np.diff(at))
    keep[at[some]] = True  # the least hash of every text with a word
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[keep]
    return distinct_per_text(h[keep] >> np.uint64(64 - 8 * WIDTH), owner, len(at) - 1)


def members(h: np.ndarray, at: np.ndarray, fraction: float):
    """The sketches without hashes over the threshold: (hashes, offsets)."""
    keep = h <= np.uint64((int(fraction * 2 ** 64) - 1) >> (64 - 8 * WIDTH))
    return h[keep], np.concatenate((np.zeros(1, np.int64), np.cumsum(keep)))[at]


def full_sets(column: pa.Array, k: int):
    """All distinct shingle hashes of all texts of a column: (hashes, offsets)."""
    parts, ends, total = [], [np.zeros(1, np.int64)], 0
    for _, _, h, at in shingle_sets(column, k):
        parts.append(h)
        ends.append(at[1:] + total)
        total += len(h)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate(ends)


def encode(h: np.ndarray, at: np.ndarray) -> list[str]:
    raw = np.ascontiguousarray(h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDTH:]).tobytes()
    at = (at * WIDTH).tolist()
    return [base64.b64encode(raw[a:b]).decode() for a, b in zip(at[:-1], at[1:])]


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, WIDTH).astype(np.uint64)
    return (raw << (np.arange(WIDTH - 1, -1, -1, dtype=np.uint64) * np.uint64(8))).sum(1, dtype=np.uint64)


def compare(x, xat, y, yat):
    """Likeness and containment (of x in y) of the sets row by row."""
    n = len(xat) - 1
    nx, ny = np.diff(xat), np.diff(yat)
    owner = np.concatenate((np.repeat(np.arange(n), nx), np.repeat(np.arange(n), ny)))
    order = np.argsort(owner, kind="stable")
    _, uat = distinct_per_text(np.concatenate((x, y))[order], owner[order], n)
    union = np.diff(uat)
    common = nx + ny - union
    with np.errstate(divide="ignore", invalid="ignore"):
        near = np.where(union > 0, common / union, 1.0)
        inside = np.where(nx > 0, common / nx, 1.0)
    return near, inside


def estimate(x, xat, y, yat, fraction: float):
    """Likeness and containment (of x in y) row by row, from sketches alone."""
    near, inside = compare(*members(x, xat, fraction), *members(y, yat, fraction))
    nx, ny = (np.diff(members(h, at, fraction)[1]) for h, at in ((x, xat), (y, yat)))
    whole, held = compare(x, xat, y, yat)  # of fingerprints that hold no member
    return (np.where(nx + ny > 0, near, np.floor(whole)), np.where(nx > 0, inside, np.floor(held)))


def merge(*fingerprints: str, fraction: float = 1 / 8) -> str:
    """The sketch of texts together, from their fingerprints (of texts whose
    shingles all come from one of them): the union of their members."""
    hashes = [decode(f) for f in fingerprints]
    h = np.unique(np.concatenate([members(x, np.array([0, len(x)]), fraction)[0] for x in hashes]))
    return encode(h, np.array([0, len(h)]))[0]


def alike(one: str, other: str, fraction: float = 1 / 8) -> tuple[float, float]:
    """Likeness of two fingerprints, and containment of the first in the other."""
    x, y = decode(one), decode(other)
    near, inside = estimate(x, np.array([0, len(x)]), y, np.array([0, len(y)]), fraction)
    return float(near[0]), float(inside[0])


def _rows(ids, texts, k, fraction):
    """Result rows of texts[:-1], each with the next text as its neighbour."""
    own, after = texts[:-1], texts[1:]
    edited = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in zip(own, after)]
    h, at = full_sets(pa.array(texts, pa.large_string()), k)
    e, eat = full_sets(pa.array(edited, pa.large_string()), k)
    n = len(own)
    exact_edited, exact_inside = compare(h[:at[n]], at[:n + 1], e, eat)
    exact_next, _ = compare(h[:at[n]], at[:n + 1], h[at[1]:], at[1:] - at[1])
    h, at = sketch(h, at, fraction)
    e, eat = sketch(e, eat, fraction)
    near_edited, inside = estimate(h[:at[n]], at[:n + 1], e, eat, fraction)
    near_next, _ = estimate(h[:at[n]], at[:n + 1], h[at[1]:], at[1:] - at[1], fraction)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(encode(h[:at[n]], at[:n + 1]), pa.string()), pa.array(encode(e, eat), pa.string()),
        pa.array(near_edited), pa.array(near_next), pa.array(inside), pa.array(np.diff(at[:n + 1])),
        pa.array(exact_edited), pa.array(exact_next), pa.array(exact_inside),
    ], names=[c.split()[0] for c in SCHEMA.split(", ")])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                 fraction: float = 1 / 8, partitions: int | None = None, slab: int = 4 << 20) -> DataFrame:
    """One row per input row, see SCHEMA. ``fraction`` is the part of the hash
    range that a sketch keeps; ``partitions`` (the session's number of shuffle
    partitions) is the number of id ranges."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    n = partitions or shuffle_width(spark)
    cuts = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    cuts = sorted(set(cuts)) or [0.0]  # at least one, as Bucketizer wants
    cut = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="bucket")
    # descending ids; a null id sorts into the last block
    dealt = (cut.transform(docs.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf")))))
             .select("doc_id", "text", (F.lit(len(cuts)) - F.col("bucket")).cast("int").alias("blk")))
    # the first id of every block that has rows: as many rows as blocks
    heads = sorted((r.blk, r.head) for r in dealt.groupBy("blk").agg(F.max("doc_id").alias("head")).collect())
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    halo = spark.createDataFrame(before, "head long, to int")
    rows = (dealt.withColumn("halo", F.lit(False)).unionByName(
        dealt.join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("head")))
        .select("doc_id", "text", F.col("to").alias("blk"), F.lit(True).alias("halo")))
        .repartitionById(len(cuts) + 1, F.col("blk"))
        .sortWithinPartitions("halo", F.col("doc_id").desc_nulls_last(), "text"))

    def batches(it):
        ids, texts, size, closed = [], [], 0, False
        for batch in it:
            for doc_id, text, halo_row in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if closed:
                    continue  # other rows that share the head's id
                texts.append(text)
                closed = halo_row
                if not closed:
                    ids.append(doc_id)
                size += len(text)
                if size > slab and len(texts) > 1:
                    yield _rows(ids[:len(texts) - 1], texts, k, fraction)
                    ids, texts = ids[len(texts) - 1:], texts[-1:]
                    size = len(texts[0])
        if len(texts) > 1:
            yield _rows(ids, texts, k, fraction)

    return rows.mapInArrow(batches, SCHEMA)
