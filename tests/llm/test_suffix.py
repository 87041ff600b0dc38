import random

import numpy as np
import pytest

from ember.llm import suffix


@pytest.mark.parametrize("alphabet", [0, 1, 2, 5, 40])
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(alphabet)
    for _ in range(200):
        text = [rng.randint(0, alphabet) for _ in range(rng.randrange(50))]
        text = text + text[:rng.randrange(len(text) + 1)]
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        sa = suffix.suffix_array(np.array(text, np.int64))
        assert sa.tolist() == expected
        by_entry = suffix.suffix_array(np.array(text, np.int64), 600)  # a large alphabet takes the other induction
        assert by_entry.tolist() == expected
        lcp = suffix.permuted_lcp(np.array(text, np.int64), sa, len(text))
        for a, b in zip(expected, expected[1:]):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert lcp[b] == n


def test_prefixes_end_at_the_stop_sign():
    text = np.array([2, 3, 0, 2, 3, 0, 2, 3, 0])
    lcp = suffix.permuted_lcp(text, suffix.suffix_array(text), 3, stop=0)
    assert lcp.max() == 2
