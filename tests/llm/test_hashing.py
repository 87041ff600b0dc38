import random
import re

import numpy as np
import pyarrow as pa

from ember.llm.words import shingle_sets, slabs, utf8, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_words_and_shingles_equal_brute_force():
    rng = random.Random(0)
    signs = ["a", "B", "é", " ", "\t", "\n", " ", "\x1c", "漢", ".", "\r", "x"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(300)] + [None, "", " "]
    names = {}
    for size in (1, 64, 1 << 20):  # slab sizes do not matter
        seen = 0
        for lo, hi, h, at in shingle_sets(pa.array(texts), 3, size):
            for i in range(lo, hi):
                words = WORD.findall(lower(texts[i]))
                expected = {tuple(words[j:j + 3]) for j in range(len(words) - 2)} or ({tuple(words)} if words else set())
                got = h[at[i - lo]:at[i - lo + 1]].tolist()
                assert len(got) == len(expected) and got == sorted(got)
                key = tuple(sorted(expected))
                assert names.setdefault(key, got) == got
                seen += 1
        assert seen == len(texts)
    assert len({tuple(v) for v in names.values()}) == len(names)


def test_sliced_and_chunked_columns():
    column = pa.chunked_array([["ab", None], ["c d", "ef"]])
    raw, offsets = utf8(column)
    assert offsets.tolist() == [0, 2, 2, 5, 7] and raw.tobytes() == b"abc def"
    raw, offsets = utf8(pa.array(["zz", "ab", "c"]).slice(1, 2))
    assert raw.tobytes() == b"abc" and offsets.tolist() == [0, 2, 3]
    assert [r for r in slabs(np.array([0, 5, 5, 9, 20]), 6)] == [(0, 2), (2, 3), (3, 4)]
    hashes, owner = word_hashes(raw, offsets)
    assert owner.tolist() == [0, 1] and hashes[0] != hashes[1]
