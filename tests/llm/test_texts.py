"""Tokens, pieces, fingerprints, mixing, quality and archives."""

import base64
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from ember.llm import fingerprint, mixture, pieces, quality, token_count, warc
from ember.llm.words import utf8

from .llm_data import edge_docs, edge_rows, empty_docs, prose, same_rows

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF_MID = "/root/testdata/sf0.01"


def test_pretokens_equal_the_library():
    tokenizer, special = token_count.load(BPE)
    rng = random.Random(1)
    signs = ["a", "s", "t", "re", "ve", "ll", "d", "'", " ", "  ", "\n", "\r\n", "1", "²", "é", "漢", " ", "　",
             "!", "<|endoftext|>", "<|endof", "'s", "​", "́", "\x1c", "\x85", "🙂", "Ⅷ", "_"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(4000)]
    raw, offsets = utf8(pa.array(texts))
    text, _, first, last, owner, _ = token_count.pretokens(raw, offsets, token_count.code_point_tables(BPE), special)
    got = defaultdict(list)
    for a, b, o in zip(first.tolist(), last.tolist(), owner.tolist()):
        got[o].append(text[a:b])
    for i, t in enumerate(texts):
        expected = []
        for j, part in enumerate(t.split(special[0])):
            expected += ([special[0]] if j else []) + [
                part[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        assert got[i] == expected, t


def test_table_finds_what_it_holds():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64)
    table = token_count.Table(keys, np.arange(1, 5001))
    assert (table.find(keys) == np.arange(1, 5001)).all() and not table.find(keys + np.uint64(1)).any()
    assert not token_count.Table(keys[:0], keys[:0]).find(keys).any()


@pytest.mark.parametrize("table_size", [1 << 15, 1])
def test_token_counts(spark, table_size):
    tokenizer, _ = token_count.load(BPE)
    got = token_count.token_counts(edge_docs(spark), BPE, table_size=table_size).collect()
    expected = []
    for i, t, *_ in edge_rows():
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 1024))
    same_rows(got, expected)
    assert token_count.token_counts(empty_docs(spark), BPE).collect() == []


def test_pieces_round_trip(spark):
    model = pieces.load(PIECES)
    rng = random.Random(2)
    signs = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "漢", "the", "<s>", "</s>", "<0x0A>", "\0", "　", "🙂", "ing"]
    rows = edge_rows() + [(1000 + i, "".join(rng.choice(signs) for _ in range(rng.randrange(14))), "en", "a")
                          for i in range(500)]
    got = pieces.encoded(edge_docs(spark, rows), PIECES, block_rows=64).collect()
    expected = []
    for i, t, *_ in rows:
        ids = model.encode(t or "")
        decoded = model.decode(ids)
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded))
    same_rows(got, expected)
    assert pieces.encoded(empty_docs(spark), PIECES).collect() == []


def test_blocks_are_bounded_by_bytes(spark):
    """Texts of 1 MB: a block holds as many as fit, and equal rows come back for any size."""
    model = pieces.load(PIECES)
    rows = [(i, prose(i % 3, 150_000 if i % 2 else 30), "en", "a") for i in range(8)] + [(9, "y" * 1_000_000, "en", "a")]
    batches = [pa.RecordBatch.from_arrays([pa.array([5] * 9), pa.array(range(9)), pa.array([r[0] for r in rows]),
                                           pa.array([r[1] for r in rows])], names=["file", "at", "doc_id", "text"])]
    for rows_most, size in ((2048, 2 << 20), (2, 1 << 30), (3, 1)):
        held = [(head, [t for b in parts for t in b.column(3).to_pylist()]) for head, parts in pieces.blocks(batches, rows_most, size)]
        assert [t for _, texts in held for t in texts] == [r[1] for r in rows]
        assert all(len(texts) <= rows_most and (len(texts) == 1 or sum(len(t.encode()) for t in texts) <= size) for _, texts in held)
        assert len({head for head, _ in held}) == len(held)
    expected = [(i, hashlib.sha256(",".join(map(str, model.encode(t))).encode()).hexdigest()) for i, t, *_ in rows]
    for size in (1, 8 << 20):
        got = pieces.encoded(edge_docs(spark, rows), PIECES, outputs=(), block_bytes=size, buckets=3).collect()
        same_rows([(r.doc_id, r.ids_sha256) for r in got], expected)


def test_answers_keep_lengths_ids_and_odd_texts():
    for lengths, ids, odd in (([1, 2], [3, 70000, 5], {1: " x"}), ([300], list(range(300)), {}), ([0, 1], [9], {0: ""}), ([], [], {})):
        got = pieces.answered(pieces.answer(np.array(lengths, np.int64), np.array(ids, np.int32), odd))
        assert (got[0].tolist(), got[1].tolist(), got[2]) == (lengths, ids, odd)
    for asked in (["", " ", "a", "  b", "é\n"], ["x" * 300, "漢"], [""], []):
        assert pieces.questioned(pieces.question(asked)) == asked


def test_summaries_meet_without_a_shuffle_by_pretoken(spark, monkeypatch):
    plans = []
    usual = token_count.materialize
    docs = edge_docs(spark).repartition(70)
    monkeypatch.setattr(token_count, "materialize", lambda frame, name: usual(frame, name))
    frame = type(docs)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()),
                                                        collect(self))[1])
    sent = spark.sparkContext.broadcast(token_count.code_point_tables(BPE))
    words = token_count.frequent(docs.select("text"), BPE, sent, 40, 64, fan=8)
    assert len(words) == 40 and len(set(words)) == 40
    assert "Exchange" in plans[-1] and "token#" not in "".join(x for x in plans[-1].splitlines() if "Exchange" in x)
    one = token_count.frequent(edge_docs(spark).coalesce(1).select("text"), BPE, sent, 40, 1 << 14)
    assert set(words[:10]) & set(one[:20])


def brute_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize("partitions", [1, 3])
def test_fingerprints(spark, partitions):
    rows = sorted(((i, t or "") for i, t, *_ in edge_rows()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = fingerprint.fingerprints(edge_docs(spark), fraction=1.0, partitions=partitions).collect()
    expected = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        x, y, z = map(brute_sets, (t, edited, after))
        near = [len(x & s) / len(x | s) if x | s else 1.0 for s in (y, z)]
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *(round(v, 9) for v in near), len(x)))
    same_rows([(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9), r.n_hashes)
               for r in got], expected)
    by_text = defaultdict(set)
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add(t)
    for r in got:
        if len(texts[r.doc_id]) == 1:
            by_text[next(iter(texts[r.doc_id]))].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprint.fingerprints(empty_docs(spark)).collect() == []


def test_sketch_estimates_likeness_and_decodes():
    rng = np.random.default_rng(5)
    both = rng.integers(0, 1 << 63, 20000, dtype=np.uint64) * np.uint64(2)
    x, y = np.sort(both[:15000]), np.sort(both[5000:])
    sx, ax = fingerprint.sketch(x, np.array([0, len(x)]), 1 / 8)
    sy, ay = fingerprint.sketch(y, np.array([0, len(y)]), 1 / 8)
    near, inside = fingerprint.compare(sx, ax, sy, ay)
    assert abs(near[0] - 0.5) < 0.05 and abs(inside[0] - 2 / 3) < 0.05
    assert fingerprint.decode(fingerprint.encode(sx, ax)[0]).tolist() == sx.tolist()


def brute_sketch(text, fraction):
    """Hashes of the fingerprint that lie under the threshold, and the fingerprint, from a plain set."""
    h = {int(x) for x in fingerprint.full_sets(pa.array([text], pa.large_string()), 5)[0]}
    under = {x >> 16 for x in h if x < int(fraction * 2 ** 64)}
    shown = under or ({min(h) >> 16} if h else set())
    return under, base64.b64encode(b"".join(x.to_bytes(6, "big") for x in sorted(shown))).decode()


def test_likeness_comes_from_the_fingerprint_at_the_fraction_in_use(spark):
    """Near and contained by threshold membership, the exact columns by all shingles; few of the short texts
    have a hash under 1/8."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(1 + i)), "en", "a") for i in range(40)]
    rows += [(100 + i, " ".join(f"w{j}" for j in range(6 + i)), "en", "a") for i in range(20)]
    rows += [(200 + i, prose(i % 3, 2000), "en", "a") for i in range(6)] + [(300, None, "en", "a"), (301, " ", "en", "a")]
    rows = [(i, t or "", *r) for i, t, *r in rows]
    texts = [t for _, t, *_ in sorted(rows, reverse=True)]
    got = {r.doc_id: r for r in fingerprint.fingerprints(edge_docs(spark, rows), partitions=2).collect()}
    for (i, t, *_), after in zip(sorted(rows, reverse=True), texts[1:] + texts[:1]):
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        x, y, z = map(brute_sets, (t, edited, after))
        exact = (len(x & y) / len(x | y) if x | y else 1, len(x & z) / len(x | z) if x | z else 1, len(x & y) / len(x) if x else 1)
        assert (got[i].exact_edited, got[i].exact_next, got[i].exact_contained) == pytest.approx(exact)
        (u, f), (v, g), (w, h) = (brute_sketch(s, 1 / 8) for s in (t, edited, after))
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (f, g)
        near = [len(u & o) / len(u | o) if u | o else float(f == k) for o, k in ((v, g), (w, h))]
        assert [got[i].near_edited, got[i].near_next] == pytest.approx(near)
        assert fingerprint.alike(f, g)[0] == pytest.approx(near[0])
        for estimated, value, union in ((near[0], exact[0], u | v), (near[1], exact[1], u | w)):
            if len(union) > 100:  # four standard errors
                assert abs(estimated - value) <= 4 * (value * (1 - value) / len(union)) ** .5 + 1e-9


def test_containment_between_very_unequal_texts_and_merged_sketches():
    long, other = prose(7, 40000, 5000), prose(8, 40000, 5000)
    part = " ".join(long.split(" ")[1000:2500])
    f, g, h = (brute_sketch(t, 1 / 8)[1] for t in (long, part, other))
    near, inside = fingerprint.alike(g, f)
    assert inside > 0.99 and near < 0.06 and fingerprint.alike(g, h) == (0, 0)
    union = fingerprint.merge(f, h)
    assert fingerprint.alike(f, union)[1] == 1 and abs(fingerprint.alike(f, union)[0] - 0.5) < 0.03
    assert fingerprint.merge(union, g) == fingerprint.merge(h, f)


def test_members_of_parts_merge():
    rng = np.random.default_rng(6)
    parts = [np.sort(rng.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2)) for _ in range(60)]
    whole = np.sort(np.concatenate(parts))
    of = [fingerprint.members(*fingerprint.sketch(x, np.array([0, len(x)]), 1 / 8), 1 / 8)[0] for x in (*parts, whole)]
    assert any(not len(x) for x in of) and sorted(np.concatenate(of[:-1])) == sorted(of[-1])


def test_rounding_keeps_word_mass():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 400)
    part = rng.random(400)
    total = np.zeros(400)
    for seed in range(300):
        extra, held, p = mixture.round_pairs(part, size, np.random.default_rng(seed))
        value = extra.astype(float)
        if held >= 0:
            value[held] = p
        assert abs((value * size).sum() - (part * size).sum()) < 1e-6
        total += value
    assert np.abs(total / 300 - part).max() < 0.15  # each text keeps its expectation


def water_fill(sizes, weights, ratio, cap):
    left, open_, out = ratio * sum(sizes), dict(enumerate(sizes)), {}
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if cap * open_[i] <= weights[i] * level + 1e-12]
        if not full:
            out.update({i: weights[i] * level for i in open_})
            break
        for i in full:
            out[i] = cap * open_.pop(i)
            left -= out[i]
    return [out[i] for i in range(len(sizes))]


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 4, "fan": 2}, {"broadcast_sources": 0}])
def test_mix(spark, options):
    rows = [(i, " ".join(["w"] * (i % 17)), "en", ("a", "b", None, "B", "é")[i % 5 if i % 3 else 0]) for i in range(300)]
    rows += [rows[5], (None, "x y", "en", "a"), (7, None, "en", "zero")]
    got = mixture.mix(edge_docs(spark, rows), **options).collect()
    again = mixture.mix(edge_docs(spark, rows[::-1]), **options).collect()
    columns = ("doc_id", "size", "source_size", "target", "taken")
    same_rows([[r[c] for c in columns] for r in got], [[r[c] for c in columns] for r in again])
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = dict(zip(order, water_fill([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2)))
    by_size = {sizes[s]: targets[s] for s in order}
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - by_size[r.source_size]) < 1e-6 and 0 <= r.taken <= 2 * r["size"]
        assert r.taken == r.copies * r["size"]
        taken[r.source_size] += r.taken
    for s in order:
        assert abs(taken[sizes[s]] - targets[s]) <= 17
    assert mixture.mixed_rows(edge_docs(spark, rows)).columns == edge_docs(spark, []).columns
    assert mixture.mix(empty_docs(spark)).collect() == []


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.score(docs, labels).collect() if r.held_out and r.doc_id in truth]
    good = [r.score for r in rows if truth[r.doc_id] == 1]
    bad = [r.score for r in rows if truth[r.doc_id] == 0]
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert sum(pairs) / len(pairs) > 0.97
    assert sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows) > 0.93


def test_quality_edge_cases(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0), (2, None, 0), (None, 1, 0), (4, 1, 1), (6, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.score(docs, labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(empty_docs(spark), labels).collect() == []
    kept = quality.accepted_rows(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_warc_round_trip_and_look_up(spark):
    rows = [(i, f"http://h{i % 3}.example.com:8{i % 2}0/p/{i}?q={i}", f"<p>{i % 11}é</p>") for i in range(60)]
    rows += [(100, None, None), (101, "http://A.b/\r\nx y?é#", ""), (None, "x", None), (5, rows[5][1], rows[5][2]),
             (207, "http://[bad", "<p>alone</p>")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    archive = warc.write(pages, block_lines=4, partitions=3)
    got = warc.read(spark, archive, archive.captures).collect()
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", i))
    responses = defaultdict(int)
    for r in got:
        responses[r.payload_digest] += r.record_type == "response"
    assert set(responses.values()) == {1} and len(got) == len(rows)
    payload = {i: (h or "") for i, _, h in rows}
    for r in got:
        raw = payload[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), warc.sha1(raw))
        kept = best[payload[r.page_id]]
        assert (r.refers_to is None and r.page_id == kept) if r.record_type == "response" else r.refers_to == kept
    missing = spark.createDataFrame([("com,example)/none 1:0:0",), ("",)], "key string")
    assert warc.read(spark, archive, missing).collect() == []
    assert warc.round_trip(pages.limit(0)).collect() == []
    large = warc.round_trip(pages, least_bytes=1 << 20).collect()
    assert {r.record_type for r in large} == {"response"}


@pytest.mark.parametrize("block_lines", [1, 4, 1024])
def test_urls_are_looked_up_across_blocks_and_archives(spark, block_lines):
    rows = [(i, f"http://h.example.com/p{i % 4}", f"<p>{i % 7}</p>") for i in range(80)]
    rows += [(200 + i, "http://h.example.com/p1x", "x") for i in range(3)] + [(300, None, "none"), (None, "http://a.b/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write(pages, block_lines=block_lines, partitions=5)
    asked = ["http://h.example.com/p1", "http://H.example.com/p1", "http://h.example.com/p1x", "http://h.example.com/p",
             "http://a.b/", None, "http://h.example.com/p3", "http://h.example.com/p3", "~"]
    urls = spark.createDataFrame([(u, 1) for u in asked], "url string, key int")
    got = warc.look_up(spark, archive, urls).collect()
    expected = [(u, i, warc.sha1((h or "").encode())) for u in set(asked) for i, v, h in rows
                if warc.surt(v) == warc.surt(u)]
    same_rows([(r.url, r.page_id, r.payload_digest) for r in got], expected)
    assert warc.look_up(spark, archive, urls.limit(0)).collect() == []
    assert warc.look_up(spark, warc.write(pages.limit(0)), urls).collect() == []


def test_surt_orders_hosts():
    assert warc.surt("http://www.Example.com/a?b=1") == "com,example,www)/a?b=1"
    assert warc.surt(None) == "-"
