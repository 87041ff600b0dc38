"""Property tests: jobs vs brute force in plain Python on random inputs."""

import collections
import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ember.operators.topk import top_per_group
from ember.operators.weather import daily_max_range
from ember.operators.wordcount import word_count
from words import expected_words

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

obs_rows = st.lists(
    st.tuples(st.sampled_from(["S1", "S2", "S3"]), st.sampled_from([1, 2]),
              st.sampled_from(["TMAX", "TMIN", "PRCP"]), st.integers(-5, 5),
              st.sampled_from([None, None, None, "X"])),
    min_size=1, max_size=40)


def brute_force_range(rows):
    """The reference's formulation: self-join TMAX x TMIN, join back to max."""
    good = [r for r in rows if r[4] is None]
    ranges = [(a[1], a[0], a[3] - b[3]) for a in good for b in good
              if a[0] == b[0] and a[1] == b[1] and a[2] == "TMAX" and b[2] == "TMIN"]
    best = {}
    for d, _, rg in ranges:
        best[d] = max(best.get(d, rg), rg)
    return sorted(r for r in ranges if r[2] == best[r[0]])


@settings(**SETTINGS)
@given(obs_rows)
def test_daily_max_range_equals_self_join(spark, rows):
    df = spark.createDataFrame(
        [(s, d, o, v, None, q) for s, d, o, v, q in rows],
        "station string, date long, observation string, value long, mflag string, qflag string")
    got = sorted((r.date, r.station, r.range) for r in daily_max_range(df).collect() for _ in range(r.pairs))
    assert got == brute_force_range(rows)


groups = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30), st.integers(0, 3)),
                  min_size=1, max_size=40)


@settings(**SETTINGS)
@given(groups)
def test_top_per_group_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, id long, v long")
    best = {}
    for g, _, v in rows:
        best[g] = max(best.get(g, v), v)
    expected = sorted((g, i, v) for g, i, v in rows if v == best[g])
    got = sorted((r.g, r.id, r.v) for r in top_per_group(df, "g", "v", keep=["id"]).collect())
    assert got == expected


texts = st.text(alphabet=string.ascii_letters + string.punctuation + " \t\n\x0b\x0c\r\x1c"
                "\x85\xa0 　éÉßñ0123456789", max_size=60)


@settings(max_examples=30, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=5))
def test_words_equal_python(spark, lines):
    expected = collections.Counter(w for t in lines for w in expected_words(t))
    df = spark.createDataFrame([(t,) for t in lines], "text string")
    assert {r.word: r["count"] for r in word_count(df, normalise=False).collect()} == dict(expected)
