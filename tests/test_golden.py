"""Hand-made micro-fixtures for behaviour the DuckDB oracle cannot see."""

import collections
import os
import unicodedata

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ember.operators import aggregate as agg
from ember.operators import orders as ops
from ember.operators.graph import adjacency_edges, adjacency_lines, shortest_path, shortest_path_known
from ember.operators.topk import top_per_group
from ember.operators.weather import daily_max_range, daily_max_range_sql
from ember.operators.wordcount import by_frequency, token_count, word_count
from ember.sources.delimited import popular_pages, read_pageviews
from ember.sources.json import read_json_lines, read_json_objects, read_multiline_json
from ember.functions.fmt import json_pair
from ember.functions.logs import parse_access_log
from words import expected_words


def _write(path, text, name="part-0.txt"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)
    return path


# --- sources ---------------------------------------------------------------

MULTI = """{
  "subreddit": "a",
  "score": 2,
  "meta": {"x": 1,
           "y": 2}
}
{"subreddit": "b", "score": 5}
{
  "subreddit": "a",
  "text": "has } { inside",
  "score": 4
}
   {"subreddit": "b", "score": 7}
"""


def test_multiline_json_reads_every_object(spark, tmp):
    path = _write(os.path.join(tmp, "mj"), MULTI)
    df = read_multiline_json(spark, path, "subreddit string, score long")
    got = sorted((r.subreddit, r.score) for r in df.collect())
    assert got == [("a", 2), ("a", 4), ("b", 5), ("b", 7)]
    avg = {r.subreddit: r.average for r in agg.group_average(df, "subreddit", "score").collect()}
    assert avg == {"a": 3.0, "b": 6.0}


def test_json_objects_drop_and_count_bad_records(spark, tmp):
    lines = ['{"subreddit": "a", "score": 1} {"subreddit": "b} {", "score": 2}', "not json", "",
             '{"subreddit": "a", "score": {"x": 1}, "more": [{"y": 2}, {"z": 3}]}', '{"subreddit": "c", "score": 4']
    path = _write(os.path.join(tmp, "jo"), "\n".join(lines))
    bad = Observation("bad")
    df = read_json_objects(spark, path, "subreddit string, score long", bad_records=bad)
    assert sorted((r.subreddit, r.score) for r in df.collect()) == [("a", 1), ("b} {", 2)]
    assert bad.get == {"bad": 3}
    assert read_json_objects(spark, path, "subreddit string, score long", keep_invalid=True).count() == 5
    whole = read_multiline_json(spark, path, "subreddit string, score long")
    assert sorted(r.score for r in whole.collect()) == [1, 2]


def test_json_pair_prints_plain_numbers(spark):
    values = [12345678.0, 0.0001, 3.0, -2.5, 1e16, 1.25e-7, 123456789012345.6, 0.1, -1e22, 0.0]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "k string, v double")
    got = [r[0] for r in df.select(json_pair("k", "v")).collect()]
    assert got == [f'["{i}", {v!r}]' for i, v in enumerate(values)]


def test_orders_by_a_long_list_of_any_type(spark):
    keys = [f"k{i}" for i in range(1001)]
    orders = spark.createDataFrame([(k, 1.0) for k in keys[:5]] + [("other", 2.0)], "o_orderkey string, o_totalprice double")
    assert sorted(r[0] for r in ops.lookup_denormalized(
        orders.withColumn("part_names", F.array()).withColumn("o_orderkey", F.col("o_orderkey")), keys)
        .select("o_orderkey").collect()) == keys[:5]


def test_json_lines_bad_record_kept_aside(spark, tmp):
    path = _write(os.path.join(tmp, "jl"),
                  '{"subreddit": "a", "score": 1}\nnot json\n{"subreddit": "a", "score": 3}\n')
    df = read_json_lines(spark, path, "subreddit string, score long", bad_records_column="_bad")
    rows = df.select("subreddit", "score", "_bad").collect()
    assert sorted(r.score for r in rows if r._bad is None) == [1, 3]
    assert [r._bad for r in rows if r._bad is not None] == ["not json"]


def test_group_average_json_line(spark):
    df = spark.createDataFrame([("q\"x", 1), ("q\"x", 2)], "k string, v long")
    row = agg.group_average(df, "k", "v").first()
    assert row.json == '["q\\"x", 1.5]'


def test_pageviews_quotes_and_hour(spark, tmp):
    d = os.path.join(tmp, "pv")
    _write(d, 'en Quo"te 9 100\nen Main_Page 50 1\nen Special:X 60 1\nfr Autre 99 1\n'
              'en Tied 9 3\n', name="pagecounts-20160801-120000.gz.txt")
    _write(d, "en Other 4 1\nen bad x 1\n", name="pagecounts-20160801-130000")
    pv = popular_pages(read_pageviews(spark, d))
    top = top_per_group(pv, "hour", "views", keep=["title"])
    got = sorted((r.hour, r.title, r.views) for r in top.collect())
    assert got == [("20160801-12", 'Quo"te', 9), ("20160801-12", "Tied", 9),
                   ("20160801-13", "Other", 4)]


LOGS = """host1 - - [01/Aug/1995:00:00:01 -0400] "GET /a.html HTTP/1.0" 200 100
host1 - - [01/Aug/1995:00:00:07 -0400] "GET /b.html HTTP/1.0" 200 300
host2 - - [01/Aug/1995:00:00:08 -0400] "GET /c.html HTTP/1.0" 304 -
host2 - - [01/Aug/1995:00:00:09 -0400] "get /c.html HTTP/1.0" 200 5
host2 - - [01/Aug/1995:00:00:09 -0400] "GET /c.html HTTP/1.0 200 5
host3 - - [01/Aug/1995:00:01:00 +0000] "POST /d HTTP/1.1" 200 7
"""


def test_access_log_parse_drops_bad_lines(spark, tmp):
    path = _write(os.path.join(tmp, "logs"), LOGS)
    rows = parse_access_log(spark.read.text(path)).orderBy("datetime").collect()
    assert [(r.host, r.path, r.bytes) for r in rows] == [
        ("host1", "/a.html", 100.0), ("host1", "/b.html", 300.0), ("host3", "/d", 7.0)]
    assert str(rows[0].datetime) == "1995-08-01 00:00:01"


def test_correlation_null_on_constant(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 7.0), (1, 9.0)], "requests long, bytes double")
    assert agg.correlation(df, "requests", "bytes").first().r is None
    assert agg.correlation_two_pass(df, "requests", "bytes").first().r is None


def test_correlation_one_and_two_pass_agree(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 25.0), (3, 29.0), (4, 41.0)], "x long, y double")
    a = agg.correlation(df, "x", "y", digits=None).first()
    b = agg.correlation_two_pass(df, "x", "y", digits=None).first()
    assert a.r == pytest.approx(b.r, rel=1e-12)
    s = agg.six_sums(df, "x", "y").first()
    n = s.n
    r = (n * s.sum_xy - s.sum_x * s.sum_y) / (
        ((n * s.sum_x2 - s.sum_x ** 2) ** 0.5) * ((n * s.sum_y2 - s.sum_y ** 2) ** 0.5))
    assert a.r == pytest.approx(r, rel=1e-9)


# --- relative score --------------------------------------------------------

def test_relative_score_drops_nonpositive_groups(spark):
    df = spark.createDataFrame(
        [("g", 2.0, "a"), ("g", 4.0, "b"), ("neg", -1.0, "c"), ("neg", -3.0, "d")],
        "subreddit string, score double, author string")
    for bc in (False, True):
        out = agg.relative_score(df, "subreddit", "score", "author", broadcast=bc).collect()
        assert [(r.relative_score, r.author) for r in out] == [(4 / 3, "b"), (2 / 3, "a")]


# --- top per group / weather ----------------------------------------------

def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("h1", "a", 5), ("h1", "b", 5), ("h1", "c", 1), ("h2", "d", 2)],
                               "hour string, title string, views long")
    got = [(r.hour, r.title) for r in top_per_group(df, "hour", "views", keep=["title"])
           .orderBy("hour", "title").collect()]
    assert got == [("h1", "a"), ("h1", "b"), ("h2", "d")]


def test_daily_range_quality_flag_and_pairs(spark):
    rows = [
        ("S1", 20200101, "TMAX", 30, None, None), ("S1", 20200101, "TMIN", 10, None, None),
        ("S1", 20200101, "TMIN", 10, None, None),            # duplicate min: 2 pairs
        ("S2", 20200101, "TMAX", 25, None, None), ("S2", 20200101, "TMIN", 5, None, None),
        ("S3", 20200101, "TMAX", 99, None, "X"), ("S3", 20200101, "TMIN", 0, None, None),
        ("S4", 20200102, "TMAX", 10, None, None), ("S4", 20200102, "TMIN", 3, None, None),
        ("S5", 20200102, "TMAX", 8, None, None), ("S5", 20200102, "TMIN", 1, None, None),
    ]
    df = spark.createDataFrame(rows, "station string, date long, observation string, "
                                     "value long, mflag string, qflag string")
    expected = [(20200101, "S1", 20, 2), (20200101, "S2", 20, 1),
                (20200102, "S4", 7, 1), (20200102, "S5", 7, 1)]
    for out in (daily_max_range(df), daily_max_range_sql(spark, df)):
        assert [(r.date, r.station, r.range, r.pairs) for r in out.collect()] == expected


def test_daily_range_counts_many_pairs(spark):
    n = 50_000
    df = spark.range(2 * n).select(
        F.lit("S").alias("station"), F.lit(20200101).cast("long").alias("date"),
        F.when(F.col("id") < n, "TMAX").otherwise("TMIN").alias("observation"),
        F.when(F.col("id") < n, 9).otherwise(2).alias("value"), F.lit(None).cast("string").alias("qflag"))
    for out in (daily_max_range(df), daily_max_range_sql(spark, df)):
        assert [tuple(r) for r in out.collect()] == [(20200101, "S", 7, n * n)]


# --- words -----------------------------------------------------------------

def test_words_match_python(spark):
    text = "Hello, World!! it's  3.5\tdogs—éte café x_y"
    df = spark.createDataFrame([(text,)], "text string")
    got = {r.word: r["count"] for r in word_count(df, normalise=False).collect()}
    assert got == dict(collections.Counter(expected_words(text)))


def test_word_count_nfd_merges_forms(spark):
    df = spark.createDataFrame([("café café CAFÉ cafe",)], "text string")
    got = {r.word: r["count"] for r in word_count(df).collect()}
    assert got == {unicodedata.normalize("NFD", "café"): 3, "cafe": 1}


@pytest.mark.parametrize("form", ["NFD", "NFC", "NFKD"])
def test_word_count_forms_equal_python_on_documents(spark, form):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    expected = collections.Counter()
    for r in docs.select("text").toLocalIterator():
        expected.update(expected_words(r.text, form))
    got = {r.word: r["count"] for r in word_count(docs, normalise=form).collect()}
    assert got == dict(expected)


def test_by_frequency_order(spark):
    df = spark.createDataFrame([("b a b c a b",)], "text string")
    out = by_frequency(word_count(df, normalise=False)).collect()
    assert [r.line for r in out] == ["b 3", "a 2", "c 1"]


def test_token_count_equals_jvm_break_iterator(spark):
    """Brute force: the JDK's word BreakIterator per line, segments trimmed,
    non-empty ones counted in NFD - driven through the session's JVM."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    jvm = spark._jvm
    locale = jvm.java.util.Locale("en", "ca")
    expected = collections.Counter()
    for r in docs.select("text").collect():
        for line in r.text.split("\n"):
            it = jvm.java.text.BreakIterator.getWordInstance(locale)
            it.setText(line)
            start, end = it.first(), it.next()
            while end != -1:
                w = line[start:end].strip()
                if w:
                    expected[unicodedata.normalize("NFD", w)] += 1
                start, end = end, it.next()
    got = {r.word: r["count"] for r in token_count(docs).collect()}
    assert got == dict(expected)


def test_token_count_keeps_case_and_punctuation(spark):
    df = spark.createDataFrame([("Hi there, it's 3.5 dogs. BY-NC 555-1234 a.09@b $12,5%",)],
                               "text string")
    got = {r.word: r["count"] for r in token_count(df, normalise=False).collect()}
    assert got["Hi"] == 1 and got["it's"] == 1 and got["3.5"] == 1 and got["BY-NC"] == 1
    assert got[","] == 1 and got["."] == 1 and got["-"] == 1 and got["@"] == 1
    assert got[".09"] == 1 and got["$12,5%"] == 1


# --- graph -------------------------------------------------------------------

def _chain(spark, n):
    lines = [f"{i}: {i + 1}" for i in range(n)]
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_adjacency_edges(spark):
    lines = spark.createDataFrame([("1: 2 3",), ("2:",), ("3:  4  ",), ("junk",)], "value string")
    got = sorted((r.source, r.destination) for r in adjacency_edges(lines).collect())
    assert got == [("1", "2"), ("1", "3"), ("3", "4")]


def test_adjacency_lines_split_a_large_node(spark):
    rows = [("hub", f"d{i}") for i in range(200)] + [("hub", "d1"), ("a", "hub"), ("b", "a")]
    lines = adjacency_lines(spark.createDataFrame(rows, "source string, destination string"), per_line=20)
    sizes = [len(r.value.split(" ")) - 1 for r in lines.collect()]
    assert len(sizes) == 13 and max(sizes) <= 40
    assert sorted(map(tuple, adjacency_edges(lines).collect())) == sorted(set(rows))


def test_bfs_hop_limit(spark):
    edges = adjacency_edges(_chain(spark, 8))
    path6 = [r.node for r in shortest_path(edges, "0", "6").orderBy("pos").collect()]
    assert path6 == [str(i) for i in range(7)]
    assert shortest_path(edges, "0", "7").count() == 0
    assert shortest_path(edges, "0", "missing").count() == 0


def test_bfs_min_parent_cycle_and_same_node(spark):
    lines = spark.createDataFrame(
        [("1: 3 2",), ("2: 4 1",), ("3: 4",), ("4: 1 5",), ("5:",)], "value string")
    edges = adjacency_edges(lines)
    known = {r.node: (r.source, r.distance)
             for r in shortest_path_known(edges, "1", "5").collect()}
    assert known == {"1": (None, 0), "2": ("1", 1), "3": ("1", 1), "4": ("2", 2), "5": ("4", 3)}
    same = shortest_path(edges, "2", "2").collect()
    assert [(r.pos, r.node) for r in same] == [(0, "2")]


# --- orders ------------------------------------------------------------------

def _order_tables(spark):
    orders = spark.createDataFrame([(1, 2.675), (2, 20.0), (3, 30.5)],
                                   "o_orderkey long, o_totalprice double")
    lineitem = spark.createDataFrame([(1, 100, 2), (1, 101, 1), (1, 100, 1), (3, 101, 1)],
                                     "l_orderkey long, l_partkey long, l_linenumber int")
    part = spark.createDataFrame([(100, "red bolt"), (101, "blue gear")],
                                 "p_partkey long, p_name string")
    return orders, lineitem, part


def test_order_lookups_inner_outer_denorm(spark, tmp):
    o, li, p = _order_tables(spark)
    inner = {r.o_orderkey: r.part_names for r in ops.order_part_names(o, li, p, [1, 2, 3]).collect()}
    assert inner == {1: "blue gear, red bolt, red bolt", 3: "blue gear"}
    outer = {r.o_orderkey: r.line for r in ops.order_part_names_outer(o, li, p, [1, 2]).collect()}
    assert outer[2] == "Order #2 $20.00: "
    assert outer[1].startswith("Order #1 $2.67: blue gear")
    assert ops.order_part_names(o, li, p, []).count() == 0
    path = os.path.join(tmp, "denorm")
    ops.write_denormalized(ops.denormalize_orders(o, li, p), path, files=2)
    look = ops.lookup_denormalized(spark.read.parquet(path), [1, 2, 3]).collect()
    assert sorted(r.o_orderkey for r in look) == [1, 3]
    keys = spark.createDataFrame([(3,)], "k long")
    assert [r.part_names for r in ops.order_part_names(o, li, p, keys).collect()] == ["blue gear"]


def test_bfs_same_node_needs_the_node(spark, tmp):
    from conftest import SF_SMALL
    from ember.plans.graph import bfs_same_node
    for name in ("nation", "customer", "orders", "lineitem"):
        rows = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        rows.where("n_nationkey <> 3" if name == "nation" else "true").write.parquet(f"{tmp}/{name}.parquet")
    assert bfs_same_node(spark, tmp).collect() == []
    assert [tuple(r) for r in bfs_same_node(spark, SF_SMALL).collect()] == [(0, "n3")]
