"""Ranked lexical search with no random access (NRA) over impact-sorted lists.

A first pass over all texts writes shards: the postings (text, term, count) of
the query terms for some thousand neighbouring texts, with each text's length.
Corpus figures (texts, terms, texts with a term) are sums over the shards.
A term's impact in a text does not depend on the query, so in a second pass
each shard sorts its lists by impact and answers all queries: it reads every
list of a query from the top, in steps that double, and keeps for each text a
lower score (what was read) and an upper one (plus the last impact read of
each list in which it was not met). It stops when no text outside the first
``top`` can reach them, equal scores included, and their own intervals are
points. The shards' winners meet in a ranking of ``top`` rows a shard.

Queries are taken in blocks of ``block`` items, so the terms that every task
gets are bounded; each block reads the texts once.

Defined results: null and term-less texts count for nothing; items without
terms, or whose terms no text has, give no rows; rows with one item_id are one
item; every row of the corpus is a text of its own, repeated ones too; equal
scores are ordered by id, null ids last. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, union_all
from .words import _BYTE, LOWER, outside, same_spans, slabs, span_bytes, span_hash, utf8, word_bounds

_OUTSIDE = outside((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
SHARD_TEXTS, SHARD_POSTINGS = 8192, 1 << 20
SHARD = "ids array<bigint>, lengths binary, postings binary, terms binary, counts binary, texts long, words long"


def terms_of(raw: np.ndarray, offsets: np.ndarray):
    """Hash, start, end and text index of every term of lower-cased bytes."""
    starts, ends, owner = word_bounds(raw, offsets, _OUTSIDE)
    return span_hash(_BYTE[raw], starts, ends), starts, ends, owner


class Queries:
    """The distinct terms of some items, found by hash and compared in full."""

    def __init__(self, items: list[tuple[int | None, list[str]]]):
        self.names = [name for name, _ in items]
        raw, offsets = utf8(pa.array([t for _, texts in items for t in texts], pa.string()))
        raw = LOWER[raw]
        keys, starts, ends, owner = terms_of(raw, offsets)
        of = np.repeat(np.arange(len(items)), [len(texts) for _, texts in items])[owner]
        spelt = {}  # one number for each spelling
        number = np.array([spelt.setdefault(raw[a:b].tobytes(), len(spelt)) for a, b in zip(starts.tolist(), ends.tolist())],
                          np.int64)
        first = np.unique(number, return_index=True)[1]
        if len(np.unique(keys[first])) < len(first):
            raise ValueError("two query terms share a hash")
        order = np.argsort(keys[first])
        self.keys = keys[first][order]
        self.raw, self.at = span_bytes(raw, starts[first][order], ends[first][order])
        rank = np.argsort(order)
        pairs = np.unique(of * max(1, len(first)) + rank[number]) if len(number) else number
        self.item, self.term = np.divmod(pairs, max(1, len(first)))
        self.size = len(self.keys)

    def find(self, keys, raw, starts, ends):
        """Positions of the given terms that are query terms, and which."""
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.keys, keys), self.size - 1)
        hit = np.flatnonzero(self.keys[place] == keys)
        place = place[hit]
        length = self.at[place + 1] - self.at[place]
        same = length == ends[hit] - starts[hit]
        hit, place, length = hit[same], place[same], length[same]
        same = same_spans(raw, starts[hit], self.raw, self.at[place], length)
        return hit[same], place[same]


def shards(docs: DataFrame, queries: Queries) -> DataFrame:
    """The postings of the query terms, some thousand texts a row; see SHARD."""
    def one(parts):
        ids = pa.concat_arrays([p[0] for p in parts])
        base = np.cumsum([0] + [len(p[0]) for p in parts])
        lengths, counts = np.concatenate([p[1] for p in parts]), np.concatenate([p[4] for p in parts])
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([lengths.tobytes()]),
            pa.array([np.concatenate([p[2] + b for p, b in zip(parts, base)]).astype(np.int32).tobytes()]),
            pa.array([np.concatenate([p[3] for p in parts]).astype(np.int32).tobytes()]), pa.array([counts.tobytes()]),
            pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
        ], names=[c.split()[0] for c in SHARD.split(", ")])

    def fill(it):
        parts, texts, postings = [], 0, 0
        for batch in it:
            raw, offsets = utf8(batch.column(1))
            for lo, hi in slabs(offsets):
                part = LOWER[raw[offsets[lo]:offsets[hi]]]
                keys, starts, ends, owner = terms_of(part, offsets[lo:hi + 1] - offsets[lo])
                hit, term = queries.find(keys, part, starts, ends)
                pair, counts = np.unique(owner[hit] * max(1, queries.size) + term, return_counts=True)
                text, term = np.divmod(pair, max(1, queries.size))
                ids = batch.column(0).slice(lo, hi - lo)
                parts.append((ids, np.bincount(owner, minlength=hi - lo).astype(np.int64), text, term, counts.astype(np.int64)))
                texts, postings = texts + hi - lo, postings + len(pair)
                if texts >= SHARD_TEXTS or postings >= SHARD_POSTINGS:
                    yield one(parts)
                    parts, texts, postings = [], 0, 0
        if parts:
            yield one(parts)

    return docs.mapInArrow(fill, SHARD)


def figures(index: DataFrame, size: int):
    """Texts with a term, their terms in all, and texts with each query term."""
    def sums(it):
        held = np.zeros(size, np.int64)
        for batch in it:
            for body in batch.column(0).to_pylist():
                held += np.bincount(np.frombuffer(body, np.int32), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["term", "df"])

    texts, words = index.agg(F.sum("texts"), F.sum("words")).first()
    df = np.zeros(size, np.int64)
    for row in index.select("terms").mapInArrow(sums, "term long, df long").groupBy("term").agg(
            F.sum("df").alias("df")).collect():  # one row a query term
        df[row.term] = row.df
    return texts or 0, words or 0, df


def impacts(weight, counts, lengths, texts: int, words: int) -> np.ndarray:
    """w * ((10^9 * tf) div (1000 * tf + 8 * m)) of every posting."""
    if 90 * int(lengths.max(initial=0)) * texts >= 1 << 63:  # the product alone passes 64 bits
        share = np.array([90 * n * texts // words for n in lengths.tolist()], np.int64)
    else:
        share = 90 * lengths * texts // max(1, words)
    return weight * (1_000_000_000 * counts // (1000 * counts + 8 * (10 + share)))


def first_texts(lists: list[tuple[np.ndarray, np.ndarray]], rank: np.ndarray, top: int):
    """NRA over lists of (texts, impacts), impacts falling. ``rank`` orders
    texts of equal scores. Texts and scores of the first ``top``, in order."""
    n = len(rank)
    lower = np.zeros(n, np.int64)
    met = np.zeros((len(lists), n), bool)
    reach = [len(t) for t, _ in lists]
    lo, step = 0, 64
    while True:
        hi = lo + step
        for i, (texts, impact) in enumerate(lists):
            if lo < reach[i]:
                lower[texts[lo:hi]] += impact[lo:hi]
                met[i, texts[lo:hi]] = True
        edge = np.array([impact[hi - 1] if hi < reach[i] else 0 for i, (_, impact) in enumerate(lists)], np.int64)
        seen = np.flatnonzero(lower)
        open_ = np.flatnonzero(edge)
        rest = int(edge.sum())  # the most a text not met yet can have
        upper = lower[seen] + rest - edge[open_] @ met[np.ix_(open_, seen)] if len(open_) else lower[seen]
        least = np.partition(lower[seen], len(seen) - top)[len(seen) - top] if len(seen) >= top else 0
        able = upper >= max(1, least)
        if rest < max(1, least) and (upper[able] == lower[seen][able]).all():
            texts = seen[able]
            order = np.lexsort((rank[texts], -lower[texts]))[:top]
            return texts[order], lower[texts[order]]
        lo, step = hi, 2 * step


def answer(index: DataFrame, queries: Queries, top: int) -> DataFrame:
    """Each shard's first texts for every item."""
    texts, words, df = figures(index, queries.size)
    weight = np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    cuts = np.searchsorted(queries.item, np.arange(len(queries.names) + 1))

    def search(it):
        for batch in it:
            for row in batch.to_pylist():
                ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
                void = np.array([i is None for i in row["ids"]], bool)
                rank = np.empty(len(ids), np.int64)
                rank[np.lexsort((ids, void))] = np.arange(len(ids))
                lengths = np.frombuffer(row["lengths"], np.int64)
                text, term = (np.frombuffer(row[c], np.int32) for c in ("postings", "terms"))
                impact = impacts(weight[term], np.frombuffer(row["counts"], np.int64), lengths[text], texts, words)
                order = np.lexsort((-impact, term))
                text, impact = text[order], impact[order]
                at = np.searchsorted(term[order], np.arange(queries.size + 1))
                items, found, scores = [], [], []
                for i in range(len(queries.names)):
                    lists = [(text[at[t]:at[t + 1]], impact[at[t]:at[t + 1]])
                             for t in queries.term[cuts[i]:cuts[i + 1]].tolist() if at[t] < at[t + 1] and weight[t] > 0]
                    if lists:
                        best, score = first_texts(lists, rank, top)
                        items.append(np.full(len(best), i))
                        found.append(best)
                        scores.append(score)
                if items:
                    best = np.concatenate(found)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([queries.names[i] for i in np.concatenate(items).tolist()], pa.int64()),
                        pa.array(ids[best], mask=void[best]), pa.array(np.concatenate(scores))],
                        names=["item_id", "doc_id", "score"])

    return index.mapInArrow(search, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text", top: int = 10, block: int = 4096) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` texts of every item."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(query_col).alias("text")).filter("text IS NOT NULL")
    blocks = max(1, -(-items.select("item_id").distinct().count() // block))
    parts = []
    for b in range(blocks):  # the stated queries, a bounded number of items at a time
        asked: dict[int | None, list[str]] = {}
        for row in items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).distinct().collect():
            asked.setdefault(row.item_id, []).append(row.text)
        queries = Queries(sorted(asked.items(), key=lambda x: (x[0] is None, x[0])))
        parts.append(answer(materialize(shards(docs, queries), "search-shards"), queries, top))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (union_all(parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
