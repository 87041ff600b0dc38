"""Phrase mining, ranked search and language identification."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ember.llm import language, lexical, phrases
from ember.llm.words import same_spans

from .llm_data import edge_docs, edge_rows, empty_docs, same_rows

SF_MID = "/root/testdata/sf0.01"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, least, top, inside=80):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(AZ)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        best = []
        for p, a in found.items():
            if longer[p] and 100 * longer[p] >= inside * a:
                continue
            score, _, l, r = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -score))
    return out


def phrase_rows():
    rows = edge_rows()
    lines = ["New York, new york. NEW  YORK\tcity; a b c d a b c d", "x y x y x y!x y", " é è é\x00", "one" * 3000]
    langs = ("en", None, "fr", "und")
    rows += [(2000 + i, lines[i % 4], langs[i % 3], "a") for i in range(90)]
    return rows + [(3000 + i, lines[0] + f" tail{i}", "und", "a") for i in range(40)]


@pytest.mark.parametrize("held", [phrases.HELD, 16])
def test_phrases_equal_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(phrases, "HELD", held)
    for least, top in ((2, 40), (30, 2000)):
        got = phrases.collocations(edge_docs(spark, phrase_rows()), least=least, top=top).collect()
        same_rows(got, brute_phrases(phrase_rows(), least, top))
    assert phrases.collocations(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("size,bits", [(2, 4), (3, 16), (4, 20)])
def test_filters_lose_nothing(size, bits):
    rng = np.random.default_rng(size)
    limbs = [rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) for _ in range(size)]
    limbs[0][1000:2000] = limbs[0][:1000]  # n-grams that share a word
    limbs = [np.concatenate((x, x[:500])) for x in limbs]
    counts = rng.integers(1, 400, 3500)
    expected = Counter()
    for key, c in zip(zip(*(x.tolist() for x in limbs)), counts.tolist()):
        expected[key] += c
    spread = phrases.permute(limbs)
    spread[0] = spread[0] & np.uint64((1 << (64 - bits)) - 1) | np.uint64(5 << (64 - bits))
    keys, sums = phrases.merged(spread, counts)
    got, back = phrases.unpack(phrases.pack(keys, sums, bits), size, 5, bits)
    assert all((a == b).all() for a, b in zip(keys, got)) and (sums == back).all()
    keys, sums = phrases.merged(phrases.permute(limbs), counts)
    assert dict(zip(zip(*(x.tolist() for x in phrases.restore(keys))), sums.tolist())) == expected


def test_keys_that_share_their_first_limb_are_told_apart():
    limbs = [np.full(4, 7, np.uint64), np.array([3, 1, 3, 2], np.uint64)]
    keys, counts = phrases.merged(limbs, np.ones(4, np.int64))
    assert keys[1].tolist() == [1, 2, 3] and counts.tolist() == [1, 1, 2]


def test_one_id_for_two_words_takes_another_seed(spark, monkeypatch):
    """Words whose ids clash under the first seed are counted apart under the next."""
    usual = phrases.word_ids

    def clashing(raw, offsets, lang, seed):
        ids, *rest = usual(raw, offsets, lang, seed)
        return (ids & np.uint64(1) if seed == 0 else ids, *rest)

    monkeypatch.setattr(phrases, "word_ids", clashing)
    same_rows(phrases.collocations(edge_docs(spark, phrase_rows()), least=2).collect(), brute_phrases(phrase_rows(), 2, 2000))


def test_same_spans():
    raw = np.frombuffer(b"abcdefghijklmnopq abcdefghijklmnopx abc", np.uint8)
    got = same_spans(raw, np.array([0, 0, 0, 0]), raw, np.array([0, 18, 18, 36]), np.array([17, 17, 16, 3]))
    assert got.tolist() == [True, False, True, True]


def brute_search(rows, items, top=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(i, Counter(term.findall((t or "").translate(AZ)))) for i, t, *_ in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(term.findall((t or "").translate(AZ)))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return out


ITEMS = [(0, "w1 w2 W3 é"), (1, "one TWO three"), (2, None), (3, ""), (4, "nowhere"), (5, "w7"), (5, "w8 w7"), (None, "don't stop"),
         (6, " ".join(f"w{i}" for i in range(400))), (7, "x" * 900), (7, "x" * 900)]


@pytest.mark.parametrize("texts,block", [(8192, 4096), (3, 2)])
def test_search_equals_brute_force(spark, monkeypatch, texts, block):
    monkeypatch.setattr(lexical, "SHARD_TEXTS", texts)
    monkeypatch.setattr(lexical, "slabs", lambda at, size=1: phrases.slabs(at, 1 << 14))
    items = spark.createDataFrame([(*r, 1, "x") for r in ITEMS], "item_id long, text string, rank int, score string")
    got = lexical.search(edge_docs(spark), items, block=block).collect()
    same_rows(got, brute_search(edge_rows(), ITEMS))
    assert lexical.search(empty_docs(spark), items).collect() == []
    assert lexical.search(edge_docs(spark), items.limit(0)).collect() == []


def test_nra_resolves_members_ties_and_scores():
    rng = np.random.default_rng(4)
    for turn in range(60):
        n = int(rng.integers(1, 900))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 8))):
            texts = rng.permutation(n)[:rng.integers(1, n + 1)]
            impact = np.sort(rng.integers(0, 5 if turn % 2 else 10 ** 6, len(texts)))[::-1]
            lists.append((texts, impact))
            total[texts] += impact
        rank = rng.permutation(n)
        expected = sorted((i for i in range(n) if total[i] > 0), key=lambda i: (-total[i], rank[i]))[:10]
        texts, scores = lexical.first_texts(lists, rank, 10)
        assert texts.tolist() == expected and scores.tolist() == total[expected].tolist()


def test_nra_stops_before_the_lists_end():
    """Lists that agree on their heads are not read to their ends."""
    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.read += len(range(*key.indices(len(self))))
            return super().__getitem__(key)

    n = 1 << 16
    lists = [(np.arange(n), (np.arange(n, 0, -1) * (i + 1)).view(Counted)) for i in range(3)]
    texts, _ = lexical.first_texts(lists, np.arange(n), 10)
    assert texts.tolist() == list(range(10)) and Counted.read < n


def test_products_past_64_bits():
    lengths, counts = np.array([10 ** 12, 3], np.int64), np.array([5, 1], np.int64)
    got = lexical.impacts(np.array([9, 9]), counts, lengths, 10 ** 9, 10 ** 14)
    expected = [9 * (10 ** 9 * t // (1000 * t + 8 * (10 + 90 * n * 10 ** 9 // 10 ** 14))) for n, t in ((10 ** 12, 5), (3, 1))]
    assert got.tolist() == expected


def test_languages_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    apart = [r for r in got if r.held_out and r.lang is not None]
    assert len(got) == docs.count() and len(apart) > 150
    assert sum(r.lang == r.lang_pred for r in apart) >= 0.95 * len(apart)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_defined_results(spark):
    rows = [(i, *(("der die und das", "de"), ("the and of it", "en"))[i % 2], "a") for i in range(60)]
    rows += [(100, None, "en", "a"), (101, "12 -- 34", "de", "a"), (None, "the of and", None, None), (102, "", None, "a"),
             (103, "the of " * 20000, None, "a"), (103, "the of " * 20000, None, "a")]
    got = {(r.doc_id, r.lang_pred) for r in language.identify(edge_docs(spark, rows)).collect()}
    assert {(100, "und"), (101, "und"), (None, "en"), (102, "und"), (103, "en"), (0, "de"), (1, "en")} <= got
    again = language.identify(edge_docs(spark, rows[::-1])).collect()
    same_rows([(r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in again],
              [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in language.identify(edge_docs(spark, rows)).collect()])
    unknown = language.identify(edge_docs(spark, [(i, "the of", None, "a") for i in range(4)])).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in unknown) and len(unknown) == 4
    assert language.identify(empty_docs(spark)).collect() == []


def test_penalties_leave_weights_at_zero():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        y = i % 2
        buckets = np.unique(np.concatenate(([y], rng.integers(2, 2000, 20))))
        rows.append((buckets, np.ones(len(buckets)), y))
    idf = np.ones(language.BUCKETS)
    sparse = language.Softmax(["a", "b"], idf, l1=0.3).fit(rows)
    loose = language.Softmax(["a", "b"], idf, l1=0.0).fit(rows)
    assert (sparse.w[2:2000] == 0).mean() > (loose.w[2:2000] == 0).mean() + 0.1
    assert all(sparse.predict(b, c)[0] == "ab"[y] for b, c, y in rows)
    assert sum(len(list(language.gram_counts(pa.array([t, None, ""])))) for t in ("ab", "")) == 1
