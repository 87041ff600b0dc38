"""Phrase collocations, counted exactly in counting quotient filters.

A word's id is a 64-bit hash of its bytes and its language; the distinct words
are checked for two with one id, and counted anew with another seed if there
are any, so an id stands for one word. An n-gram packs its ids into n * 64
bits. A permutation of these that can be undone spreads it; the first bits
choose a bucket, the next are the quotient and all others the remainder, kept
in full, so a filter loses nothing and gives back every n-gram with its exact
count (``pack``, ``unpack``). Tasks fill bounded filters and send each bucket's
part; a bucket's filters, all sorted by the permuted key, are merged there.

Sizes are counted in turn: a part of an n-gram is at least as frequent as the
n-gram, so a pass only counts n-grams whose two parts of one word less passed
a sieve of the frequent ones. The sieve is a bitmap of at most ``SIEVE_BITS``
bits whatever the corpus; what it lets through wrongly is counted and dropped.

Defined results: a null text is empty, a null language is ``und``; texts
without words add nothing; repeated rows count each; equal scores are ordered
by frequency, then by the phrase's bytes; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_column, materialize, union_all
from .words import _BYTE, LOWER, mix, outside, same_spans, slabs, span_bytes, span_hash, utf8, word_bounds

_PIECE = outside((0x0A, 0x0D)) | np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
_OUTSIDE = _PIECE | outside((0x09, 0x09), (0x20, 0x20))
_TURN = mix(np.arange(1, 9, dtype=np.uint64))
SIEVE_BITS = 1 << 27
HELD = 1 << 19  # distinct n-grams that a task holds before it sends them


def word_ids(raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray, seed: int):
    """Id, start, end and text index of every word, and whether the next word
    stands in the same piece."""
    starts, ends, owner = word_bounds(raw, offsets, _OUTSIDE)
    byte = mix(_BYTE + np.uint64(seed)) if seed else _BYTE
    ids = mix(span_hash(byte[LOWER[raw]], starts, ends) ^ lang[owner])
    piece = np.cumsum(_PIECE[raw])[starts]
    follows = np.zeros(len(ids), bool)
    follows[:-1] = (owner[1:] == owner[:-1]) & (piece[1:] == piece[:-1])
    return ids, starts, ends, owner, follows


# -- counting quotient filters ----------------------------------------------


def permute(limbs: list[np.ndarray]) -> list[np.ndarray]:
    """Every 64-bit limb mixed with the one before it, the first with the last."""
    out = list(limbs)
    for i in range(1, len(out)):
        out[i] = out[i] ^ mix(out[i - 1] + _TURN[i])
    out[0] = out[0] ^ mix(out[-1] + _TURN[0])
    return out


def restore(limbs: list[np.ndarray]) -> list[np.ndarray]:
    """What ``permute`` was given."""
    out = list(limbs)
    out[0] = out[0] ^ mix(out[-1] + _TURN[0])
    for i in range(len(out) - 1, 0, -1):
        out[i] = out[i] ^ mix(out[i - 1] + _TURN[i])
    return out


def merged(limbs: list[np.ndarray], counts: np.ndarray):
    """Keys in order, each once, with the sum of its counts. Sorted runs, as
    filters give them, are merged (numpy's stable sort finds them)."""
    order = np.argsort(limbs[0], kind="stable")
    same = limbs[0][order][1:] == limbs[0][order][:-1]
    if any((x[order][1:][same] != x[order][:-1][same]).any() for x in limbs[1:]):
        order = np.lexsort(limbs[::-1])  # different keys that share the first limb
    limbs = [x[order] for x in limbs]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in limbs])
    at = np.flatnonzero(new)
    return [x[at] for x in limbs], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def pack(limbs: list[np.ndarray], counts: np.ndarray, bits: int) -> bytes:
    """A filter of sorted keys that share their first ``bits`` bits.

    The quotient is what is left of the first three (or four) bytes: a bit for
    each quotient that occurs, a bit for each key that ends its quotient's
    run, the remainders, and a byte for each count; larger ones follow."""
    head = 24 if bits <= 16 else 32
    quotient = (limbs[0] >> np.uint64(64 - head)).astype(np.int64) & ((1 << (head - bits)) - 1)
    occurs = np.zeros(1 << (head - bits), bool)
    occurs[quotient] = True
    last = np.ones(len(quotient), bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    key = np.stack(limbs, 1).astype(">u8").view(np.uint8).reshape(len(counts), -1)
    large = counts[counts >= 255]
    return b"".join((np.array([len(counts), len(large)], np.int64).tobytes(), np.packbits(occurs).tobytes(),
                     np.packbits(last).tobytes(), key[:, head // 8:].tobytes(),
                     np.minimum(counts, 255).astype(np.uint8).tobytes(), large.astype(np.int64).tobytes()))


def unpack(body: bytes, size: int, bucket: int, bits: int):
    """Keys (sorted) and counts of a filter of n-grams of ``size`` words."""
    head = 24 if bits <= 16 else 32
    n, n_large = np.frombuffer(body, np.int64, 2).tolist()
    raw, at = np.frombuffer(body, np.uint8), 16

    def take(length):
        nonlocal at
        at += length
        return raw[at - length:at]

    quotients = np.flatnonzero(np.unpackbits(take(max(1, (1 << (head - bits)) >> 3)), count=1 << (head - bits)))
    last = np.unpackbits(take((n + 7) >> 3), count=n).astype(np.int64)
    run = np.concatenate((np.zeros(1, np.int64), np.cumsum(last[:-1])))[:n]
    first = quotients[run] | (bucket << (head - bits))
    key = np.zeros((n, 8 * size), np.uint8)
    key[:, head // 8:] = take(n * (8 * size - head // 8)).reshape(n, -1)
    limbs = list(key.view(">u8").astype(np.uint64).T)
    limbs[0] = limbs[0] | (first.astype(np.uint64) << np.uint64(64 - head))
    counts = take(n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * n_large).tobytes(), np.int64)
    return limbs, counts


class Sieve:
    """Bitmap of the first limbs of frequent keys; may say yes wrongly, never no."""

    def __init__(self, keys: DataFrame, column: str):
        n = keys.count()
        self.bits = min(SIEVE_BITS, max(1 << 16, 1 << (16 * n).bit_length()))
        place = F.pmod(column, F.lit(self.bits)) + 1
        parts = keys.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p")).groupBy(
            "b").agg(F.bitmap_construct_agg("p").alias("body"))
        self.map = np.zeros(self.bits >> 3, np.uint8)
        for row in parts.collect():  # at most SIEVE_BITS / 32,768 rows of 4 KB
            self.map[(row.b - 1) << 12:row.b << 12] = np.frombuffer(row.body, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = (keys & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.map[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# -- passes over the corpus --------------------------------------------------


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(id, lang, word, n) of all distinct words; an id with two words has two rows."""
    def partial(it):
        for batch in it:
            raw, offsets = utf8(batch.column(0))
            lang = batch.column(2).to_numpy().view(np.uint64)
            for lo, hi in slabs(offsets):
                part = raw[offsets[lo]:offsets[hi]]
                ids, starts, ends, owner, _ = word_ids(part, offsets[lo:hi + 1] - offsets[lo], lang[lo:hi], seed)
                if not len(ids):
                    continue
                part = LOWER[part]
                unique, first, back, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
                twin = first[back]
                odd = np.flatnonzero((ends - starts != (ends - starts)[twin]) | (lang[lo + owner] != lang[lo + owner[twin]])
                                     | ~same_spans(part, starts, part, starts[twin], np.minimum(ends - starts, (ends - starts)[twin])))
                shown = np.concatenate((first, odd))  # another word with a known id is shown as well
                body, at = span_bytes(part, starts[shown], ends[shown])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[shown].view(np.int64)), batch.column(1).take(pa.array(lo + owner[shown])),
                    binary_column(body, at).cast(pa.string()), pa.array(np.concatenate((n, np.zeros(len(odd), np.int64)))),
                ], names=["id", "lang", "word", "n"])

    return (docs.select("text", "lang", "code").mapInArrow(partial, "id long, lang string, word string, n long")
            .groupBy("id", "lang", "word").agg(F.sum("n").alias("n")))


def count_grams(docs: DataFrame, seed: int, size: int, sieves: list[Sieve], least: int, bits: int) -> DataFrame:
    """(key, n, spot): n-grams of ``size`` words found at least ``least`` times."""
    def grams(raw, offsets, lang):
        ids, _, _, _, follows = word_ids(raw, offsets, lang, seed)
        good = sieves[0].has(ids)  # n-grams that start here and may be frequent
        for n in range(2, size + 1):
            here = np.zeros(len(ids), bool)
            here[:-1] = good[:-1] & good[1:]
            at = np.flatnonzero(here & follows)
            limbs = permute([ids[at + i] for i in range(n)])
            if n == size:
                return limbs
            good = np.zeros(len(ids), bool)
            good[at[sieves[n - 1].has(limbs[0])]] = True

    def send(limbs, counts):
        bucket = (limbs[0] >> np.uint64(64 - bits)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        for some in range(0, len(cuts) - 1, 256):
            spans = list(zip(cuts[some:some + 256], cuts[some + 1:some + 257]))
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[[a for a, _ in spans]]),
                pa.array([pack([x[a:b] for x in limbs], counts[a:b], bits) for a, b in spans], pa.binary()),
            ], names=["bucket", "body"])

    def fill(it):
        held, n = [], 0
        for batch in it:
            raw, offsets = utf8(batch.column(0))
            lang = batch.column(1).to_numpy().view(np.uint64)
            for lo, hi in slabs(offsets):
                limbs = grams(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lang[lo:hi])
                held.append(merged(limbs, np.ones(len(limbs[0]), np.int64)))
                n += len(held[-1][1])
                if n > 2 * HELD:
                    held = [merged([np.concatenate(x) for x in zip(*(k for k, _ in held))],
                                   np.concatenate([c for _, c in held]))]
                    n = len(held[0][1])
                    if n > HELD:
                        yield from send(*held[0])
                        held, n = [], 0
        if n:
            yield from send(*merged([np.concatenate(x) for x in zip(*(k for k, _ in held))],
                                    np.concatenate([c for _, c in held])))

    def meet(table: pa.Table) -> pa.Table:
        parts = [unpack(body, size, bucket, bits) for bucket, body in
                 zip(table.column("bucket").to_pylist(), table.column("body").to_pylist())]
        limbs, counts = merged([np.concatenate(x) for x in zip(*(k for k, _ in parts))],
                               np.concatenate([c for _, c in parts]))
        often = counts >= least
        limbs, counts = [x[often] for x in limbs], counts[often]
        ids = np.stack(restore(limbs), 1).reshape(-1).view(np.int64)
        at = np.arange(0, len(ids) + 1, size, dtype=np.int32)
        return pa.table({"key": pa.ListArray.from_arrays(pa.array(at), pa.array(ids)), "n": pa.array(counts),
                         "spot": pa.array(limbs[0].view(np.int64))})

    return (docs.select("text", "code").mapInArrow(fill, "bucket long, body binary")
            .groupBy("bucket").applyInArrow(meet, "key array<bigint>, n long, spot long"))


def _exact(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("decimal(19,0)")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4,
                 top: int = 2000, inside: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of
    2 to ``longest`` words found at least ``least`` times. A phrase inside a
    longer one that has ``inside`` percent of its occurrences is left out."""
    docs = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    docs = docs.filter(F.col("text").isNotNull()).withColumn("code", F.xxhash64("lang"))
    for seed in range(8):
        words = materialize(count_words(docs, seed), "phrase-words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("no seed gives every word its own id")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    often = words.filter(F.col("n") >= least)
    n_words = words.agg(F.sum("n")).first()[0] or 0
    bits = min(20, max(4, (n_words >> 19).bit_length()))
    sieves, sizes = [Sieve(often, "id")], []
    for size in range(2, longest + 1):
        sizes.append(materialize(count_grams(docs, seed, size, sieves, least, bits), f"phrases-{size}"))
        if size < longest:
            sieves.append(Sieve(sizes[-1], "spot"))
    found = union_all([t.select("key", F.col("n").alias("a")) for t in sizes])
    known = union_all([often.select(F.array("id").alias("part"), "n"),
                       *(t.select(F.col("key").alias("part"), "n") for t in sizes[:-1])])
    cuts = found.select("key", "a", F.explode(F.sequence(F.lit(1), F.size("key") - 1)).alias("k")).select(
        "key", "a", "k", F.slice("key", F.lit(1), F.col("k")).alias("first"),
        F.slice("key", F.col("k") + 1, F.size("key") - F.col("k")).alias("rest"))
    cuts = (cuts.join(known.select(F.col("part").alias("first"), F.col("n").alias("l")), "first")
            .join(known.select(F.col("part").alias("rest"), F.col("n").alias("r")), "rest")
            .withColumn("twice", _exact(2_000_000) * _exact(F.col("a"))).withColumn("both", _exact(F.col("l")) + _exact(F.col("r")))
            .withColumn("score", F.expr("twice div both")))
    scored = cuts.groupBy("key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "key", "a", "cut.score", "cut.l", "cut.r")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("key") - 1), lambda length: F.transform(
        F.sequence(F.lit(1), F.size("key") - length + 1), lambda at: F.slice("key", at, length))))
    longer = found.filter(F.size("key") > 2).select(F.explode(spans).alias("key"), F.col("a").alias("longer")).groupBy(
        "key").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, "key", "left").filter(
        F.col("longer").isNull() | (_exact(100) * _exact(F.col("longer")) < _exact(inside) * _exact(F.col("a")))).drop("longer")
    kept = kept.join(often.select(F.col("id").alias("head"), "lang"), kept["key"][0] == F.col("head"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    # ties included, so that only these need their words
    near = materialize(kept.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).select(
        "lang", "key", "a", "l", "r", "score"), "phrases-best")
    spelt = (near.select("key", F.posexplode("key").alias("at", "id")).join(often.select("id", "word"), "id")
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
             .select("key", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (near.join(spelt, "key").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r",
                                         F.col("total").alias("n"), "score"))
