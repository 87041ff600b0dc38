"""Exact, near and passage deduplication against brute force."""

import hashlib
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from ember.llm import exact_dedup, line_dedup, near_dup, repeats

from .llm_data import edge_docs, edge_rows, empty_docs, prose, same_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_dedup(spark, digest_bytes):
    rows = edge_rows()
    got = exact_dedup.dedup(edge_docs(spark), digest_bytes=digest_bytes, triggers=3).collect()
    best, size = {}, Counter(norm(t) for _, t, *_ in rows)
    for i, t, *_ in rows:
        if i is not None:
            best[norm(t)] = max(i, best.get(norm(t), i))
    same_rows([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got],
              [(i, best.get(norm(t)), size[norm(t)], hashlib.sha256(norm(t)).hexdigest()) for i, t, *_ in rows])
    kept = [r for r in got if r.kept]
    assert Counter(r.text_sha256 for r in kept) == {hashlib.sha256(k).hexdigest(): 1 for k in size}
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_a_second_batch_finds_copies_of_the_first(spark, tmp, digest_bytes):
    """State, texts and manifest stay in a folder; each call's rows meet all earlier ones."""
    rows = [(i if i != 3 else None, t) for i, t, *_ in edge_rows()]
    batches = [[], rows[:9], rows[9:16], [], rows[16:] + rows[:3] + [(900, rows[4][1]), (-5, rows[4][1])]]
    seen = []
    for batch in batches:
        got = exact_dedup.dedup(edge_docs(spark, [(*r, "en", "a") for r in batch]), digest_bytes=digest_bytes,
                                state=f"{tmp}/state").collect()
        seen += batch
        groups = {}
        for i, t in seen:
            groups.setdefault((t or "").encode().lower(), []).append(i)
        expected = []
        for i, t in batch:
            ids = groups[(t or "").encode().lower()]
            expected.append((i, max((x for x in ids if x is not None), default=None), len(ids)))
        same_rows([(r.doc_id, r.keep_id, r.group_size) for r in got], expected)
        for key in {(t or "").encode().lower() for _, t in batch}:
            sha = hashlib.sha256(key).hexdigest()
            kept = [r for r in got if r.text_sha256 == sha and r.kept]
            assert len(kept) <= 1 and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_keeps_rows_and_columns(spark):
    docs = edge_docs(spark)
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({norm(t) for _, t, *_ in edge_rows()})
    assert exact_dedup.dedup(empty_docs(spark)).collect() == []


def shingle_set(text, k):
    words = WORD.findall(norm(text).decode())
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def brute_components(rows, k):
    rows = [(i, shingle_set(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(rows):
        for j, y in rows[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return {i: find(i) for i, _ in rows}


def test_near_duplicates_on_edge_cases(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    expected = brute_components(rows, 4)
    got = near_dup.near_duplicates(edge_docs(spark), k=4).collect()
    same_rows([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got],
              [(i, len(shingle_set(t, 4)), expected.get(i), i is None or expected[i] == i) for i, t in rows])
    assert near_dup.near_duplicates(empty_docs(spark), k=4).collect() == []


def test_near_duplicates_in_large_mixed_buckets(spark):
    """Families that share much but not enough, so buckets hold many components."""
    shared = prose(5, 60, 5000)
    rows = []
    for f in range(12):
        own = prose(100 + f, 25, 5000)
        for v in range(6):
            rows.append((len(rows), f"{shared} {own} v{v} {f}", "en", "a"))
    expected = brute_components([(r[0], r[1]) for r in rows], 4)
    for options in ({}, {"small_bucket": 2, "block": 16}, {"small_bucket": 2, "broadcast_ids": 0, "broadcast_bytes": 0}):
        got = near_dup.near_duplicates(edge_docs(spark, rows), k=4, **options).collect()
        assert {r.doc_id: r.component_id for r in got} == expected
    assert len(set(expected.values())) > 1


def test_posterior_stop():
    # P(Binomial(n + 1, t) <= m) is the posterior with a uniform prior
    assert near_dup.least_matches(32, 0.8, 0.0) == 0
    assert near_dup.least_matches(32, 0.8, 1e-6) < near_dup.least_matches(32, 0.8, 0.05) < 32


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"most_segments": 1, "shard_bytes": 1}, {"broadcast_bytes": 0, "shard_bytes": 1}])
def test_repeats(spark, options):
    rows = edge_rows()[:12] + edge_rows()[13:]
    passage = prose(9, 50)
    rows += [(900 + i, f"{prose(50 + i, 10)} {passage} {prose(80 + i, 10)} {passage[:250]}", "en", "a") for i in range(4)]
    got = repeats.remove_repeats(edge_docs(spark, rows), length=200, **options).collect()
    expected = brute_repeats([r[1] for r in rows], 200)
    same_rows([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got],
              [(r[0], *e) for r, e in zip(rows, expected)])
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(empty_docs(spark)).collect() == []


def test_lines(spark):
    near = prose(21, 40)
    words = near.split(" ")
    changed = " ".join([*words[:20], "other", *words[21:]])
    rows = [(0, f"{near}\nkeep me\n\nSame  line here", "en", "a"), (1, f"same line here\n{changed}\n\nfresh", "en", "a"),
            (2, None, "en", "a"), (3, "", "en", "a"), (4, f"{prose(22, 40)}\nunlike", "en", None),
            (4, f"{prose(22, 40)}\nunlike", "en", None)]
    got = line_dedup.dedup_lines(edge_docs(spark, rows)).collect()
    same_rows([(r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in got],
              [(0, 4, 0, rows[0][1]), (1, 4, 2, "\nfresh"), (2, 0, 0, None), (3, 1, 0, ""),
               (4, 2, 0, rows[4][1]), (4, 2, 2, "")])
    assert line_dedup.dedup_lines(empty_docs(spark)).collect() == []


def test_line_dedup_is_native(spark):
    plan = line_dedup.dedup_lines(edge_docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def similar(a, b):
    return edit_distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 2 and len(chars) > 2:
            del chars[at]
        else:
            chars[at:at + (kind == 0)] = rng.choice("abcdefgh")
    return " ".join("".join(chars).split())


def line_labels(spark, lines, **options):
    """Number of the first line of each line's group, from single-line documents that stay or go."""
    rows = [(i, line, "en", "a") for i, line in enumerate(lines)]
    return {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(edge_docs(spark, rows), **options).collect()}


def test_a_crowded_key_drops_no_partner(spark):
    """Every line shares its first half with all others; a line's partner is far
    from it by place and by SimHash. Blocks of a hot key meet each other too."""
    rng = random.Random(5)
    start = prose(31, 14)

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))

    ends = [[word() for _ in range(10)] for _ in range(60)]
    lines = [f"{start} {' '.join(words)}" for words in ends]
    # two letters of every word of the second half, so that no eight signs of it stay
    lines += [f"{start} {' '.join(w[0] + '9' + w[2:5] + '9' + w[6:] for w in words)}" for words in ends]
    assert all(similar(lines[i], lines[i + 60]) for i in range(60)) and not similar(lines[0], lines[61])
    wanted = {i: int(i >= 60) for i in range(120)}
    assert line_labels(spark, lines) == wanted
    rows = spark.createDataFrame([(1, i, i) for i in range(500)] + [(2, i, i) for i in range(3)] + [(3, 1, 1), (3, 2, 1)],
                                 "key long, id long, grp long")
    pairs = line_dedup._met(rows, line_dedup.F.lit(True), 64, 100, rate=1).collect()
    same_rows([(r.a, r.b) for r in pairs], [(i, j) for j in range(500) for i in range(j)] + [(0, 1), (0, 2), (1, 2)])


def test_exchanges_of_lines_go_when_a_table_is_written(spark):
    """Every exchange stayed on disk to the end of the session; keys may meet in passes."""
    rng = random.Random(6)
    lines = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(rng.randint(4, 30))) for _ in range(60)]
    lines += [edited(rng, x, 2) for x in lines]
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec")

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    before, set_before = shuffles(), [spark.conf.get(n) for n in names]
    docs = edge_docs(spark, [(i, x, "en", "a") for i, x in enumerate(lines)])
    left = line_dedup.dedup_lines(docs, pass_rows=1)
    end = time.time() + 20
    while len(shuffles() - before) and time.time() < end:
        time.sleep(0.2)
    assert not shuffles() - before and [spark.conf.get(n) for n in names] == set_before
    assert {r.doc_id: r.n_removed for r in left.collect()} == {i: int(i >= 60) for i in range(120)} == line_labels(spark, lines)


def test_common_parts_are_keys_of_lines_with_few_others_only(spark):
    """A head of 20 words was among the keys of all its lines, whose pairs grow with their square."""
    rng = random.Random(7)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n))

    head = words(20)
    lines = [f"{head} {words(40)}" for _ in range(150)] + [f"{head} {words(1)}" for _ in range(5)]
    once = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "node long, norm string, size int")
    common = line_dedup._common(once, 20, 100, rate=1)
    assert line_dedup._common(once, 20, 200, rate=1) is None
    keys = {r.node: {k >> 10 & (1 << 40) - 1 for k in r["keys"]} for r in
            line_dedup._sketches(once, 0.8, 20, 16, 24, 20, common).collect()}
    assert all(len(k) == 20 for k in keys.values())
    lines_of = Counter(k for i in range(150) for k in keys[i])
    assert max(lines_of.values()) == 1
    assert len(set.intersection(*(keys[i] for i in range(150, 155)))) >= 18
    plain = {r.node: {k >> 10 for k in r["keys"]} for r in line_dedup._sketches(once, 0.8, 20, 16, 24, 20, None).collect()}
    assert max(Counter(k for i in range(150) for k in plain[i]).values()) == 150


def test_lines_of_one_to_fifty_words_with_a_change_are_met(spark):
    rng = random.Random(11)
    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))

    lines = []
    for n in (1, 2, 3, 5, 8, 10, 12, 16, 20, 30, 50):
        for kind in ("letter", "word") * 8:
            x = y = ""
            while x == y or not similar(x, y):
                words = [word() for _ in range(n)]
                x, at = " ".join(words), rng.randrange(n)
                y = edited(rng, x, 1) if kind == "letter" else " ".join([*words[:at], word(), *words[at + 1:]])
                if kind == "word" and n < 5:
                    y = edited(rng, x, 1)
            lines += [x, y]
    gone = line_labels(spark, lines)
    assert [lines[i:i + 2] for i in range(0, len(lines), 2) if not gone[i + 1] and not gone[i]] == []


@pytest.mark.parametrize("block", [2048, 3])
def test_short_lines_equal_brute_force(spark, block):
    """All edits that the similarity allows, few letters, so that keys are shared by unlike lines."""
    rng, lines = random.Random(12), []
    for size in range(1, 21):
        for _ in range(4):
            x = " ".join("".join(rng.choice("abcdefgh ") for _ in range(size)).split()) or "a"
            lines += [x, edited(rng, x, 1 + rng.randrange(max(1, size // 5))), edited(rng, x, max(1, size // 5))]
    lines = [x for x in lines if x and len(x) <= 25]
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(lines):
        for b in range(a):
            if (len(x) <= 20 or len(lines[b]) <= 20) and similar(x, lines[b]):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    assert line_labels(spark, lines, block=block) == {i: int(find(i) != i) for i in range(len(lines))}


@pytest.mark.parametrize("options", [{}, {"broadcast_ids": 0, "broadcast_bytes": 0, "small_bucket": 1, "block": 2}])
def test_near_duplicates_with_null_and_shared_ids(spark, options):
    base, other, clean = prose(31), prose(32), prose(33)
    rows = [(None, base), (None, base + " tail"), (None, base), (5, other), (5, clean), (3, other + " tail"),
            (7, prose(34)), (7, prose(34) + " tail"), (None, ""), (None, None)]
    docs = edge_docs(spark, [(*r, "en", "a") for r in rows])
    got = near_dup.near_duplicates(docs, k=4, **options).collect()
    by_size = sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None)
    assert by_size[:3] == [(3, 3, True), (5, 3, False), (5, 5, True)]
    assert sorted(r[2] for r in by_size[3:]) == [False, True] and {r[:2] for r in by_size[3:]} == {(7, 7)}
    left = [(r.doc_id, r.text) for r in near_dup.kept_rows(docs, k=4, **options).collect()]
    assert sum(i is None and bool(t) for i, t in left) == 1 and sum(i == 7 for i, _ in left) == 1
    assert (5, clean) in left and (3, other + " tail") in left and (5, other) not in left and len(left) == 6


def test_line_repeated_to_over_four_million_words(spark):
    """1,600 times 3,000 words in one document, over 2 ** 21 for half of them; its near-copy is met."""
    line = prose(41, 3000)
    words = line.split(" ")
    near = " ".join([*words[:1500], "other", *words[1501:]])
    rows = [(0, "\n".join([line] * 1600), "en", "a"), (1, near + "\nfresh", "en", "a")]
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(edge_docs(spark, rows)).collect()}
    assert got == {0: (1600, 1599), 1: (2, 1)}


def test_a_hot_key_writes_no_pairs_of_unlike_lines(spark, monkeypatch):
    """1,600 lines that share a word, and 400 that share most of a long beginning, are not paired with each other."""
    rng, written = random.Random(15), []
    usual = line_dedup.materialize

    def counted(frame, name):
        out = usual(frame, name)
        if name in ("line-pairs", "line-links", "line-all-links"):
            written.append(out.count())
        return out

    def letters(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    monkeypatch.setattr(line_dedup, "materialize", counted)
    lines = ["subscribe " + letters(26) for _ in range(1600)]
    assert not any(line_labels(spark, lines).values()) and sum(written) < 5000
    written.clear()
    head = " ".join(letters(6) for _ in range(20))
    lines = [head + " " + " ".join(letters(6) for _ in range(20)) for _ in range(400)]
    assert not any(line_labels(spark, lines).values()) and sum(written) < 8 * 400 * 2


def test_recall_of_planted_pairs(spark):
    """Pairs at 0.8 or more by brute force: every kind of change is met in nine of ten or more."""
    rng, lines, kinds = random.Random(16), [], []

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))

    for n in (1, 2, 3, 5, 8, 10, 15, 20, 30, 50):
        for share in (0, 0.05, 0.1, 0.2):
            for _ in range(8):
                x = " ".join(word() for _ in range(n))
                y = edited(rng, x, max(1, int(len(x) * share)))
                if x and y and x != y and similar(x, y):
                    lines += [x, y]
                    kinds.append(share)
    gone = line_labels(spark, lines)
    for share in (0, 0.05, 0.1, 0.2):
        found = [gone[2 * i] or gone[2 * i + 1] for i, k in enumerate(kinds) if k == share]
        assert len(found) > 60 and sum(found) >= (0.9 if share == 0.2 else 0.97) * len(found), share


def test_lines_without_spaces_and_in_other_scripts(spark):
    rng = random.Random(17)
    x = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300))
    y = x[:100] + "漢" + x[101:220] + x[221:]
    z = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(60))
    gone = line_labels(spark, [x, y, z, z[:30] + "!" + z[30:], "".join(reversed(x))])
    assert gone == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0}


def test_state_is_closed_after_the_stream(spark):
    """Every store of a stream's state would keep its memory until some maintenance."""
    rows = [(i, f"text {i % 7}", "en", "a") for i in range(40)]
    manager = spark._jvm.org.apache.spark.sql.execution.streaming.state.RocksDBMemoryManager
    assert exact_dedup.kept_rows(edge_docs(spark, rows)).count() == 7
    assert manager.getNumRocksDBInstances(False) == 0 and manager.getNumRocksDBInstances(True) == 0


def test_pairs_of_a_block_are_held_a_few_rows_at_a_time():
    """900 rows that all pass: 810,000 pairs, of which every hash was compared at once before."""
    sig = np.zeros((900, 160), np.uint8)
    stops = [(n, near_dup.least_matches(n, 0.8, 1e-6)) for n in range(32, 161, 32)]
    tracemalloc.start()
    try:
        parts = [len(part[0]) for part in near_dup._passes(sig, sig, stops, 32)]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(parts) == 900 * 900 and most < 48 << 20
