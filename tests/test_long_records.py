"""Records and words of any length, cut-off objects, scratch copies."""

import collections
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ember.functions.text import LOCALE_TOKEN_RE2, locale_tokens, normal_form
from ember.operators.wordcount import token_count
from ember.session import checkpoint_dir, materialize, release_scratch, scratch_path, scratch_scope
from ember.sources.json import read_json_lines, read_json_objects, read_multiline_json, read_pretty_json
from ember.sources.store import KeyedStore, split_size

SCHEMA = "subreddit string, score long, body string"


def _file(path, text):
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write(text)
    return path


def _bodies():
    return ["x" * 500_000, '"' * 100_000, "\\" * 100_000, "} {" * 50_000, "é\n" * 1000, ""]


@pytest.mark.parametrize("reader", [read_json_objects, read_multiline_json, read_pretty_json, read_json_lines])
def test_bodies_of_any_length(spark, tmp, reader):
    records = [{"subreddit": f"s{i}", "score": i, "more": {"a": [{"b": 1}]}, "body": b} for i, b in enumerate(_bodies())]
    indent = None if reader in (read_json_objects, read_json_lines) else 2
    path = _file(os.path.join(tmp, "j"), "\n".join(json.dumps(r, indent=indent) for r in records))
    got = {r.subreddit: (r.score, r.body) for r in reader(spark, path, SCHEMA).collect()}
    assert got == {r["subreddit"]: (r["score"], r["body"]) for r in records}


def test_a_string_without_an_end_takes_linear_time(spark, tmp):
    """Each escaped quote of a cut-off body would otherwise start a search to the text's end."""
    text = json.dumps({"subreddit": "a", "score": 1, "body": ""}) + '{"body": "' + '\\"' * 200_000
    path = _file(os.path.join(tmp, "cut"), text)
    assert [r.score for r in read_json_objects(spark, path, SCHEMA).collect()] == [1]


def test_pretty_objects_are_split_and_cut_ones_left_out(spark, tmp):
    records = [{"subreddit": f"s{i % 3}", "score": i, "body": "} {" if i % 2 else "\n}\n", "in": {"k": [{}, {"z": "}"}]}}
               for i in range(3000)]
    texts = [json.dumps(r, indent=2) for r in records]
    for i in range(0, 3000, 40):
        texts[i] += "\n" + texts[i][:30]  # followed by one that was cut off
    path = _file(os.path.join(tmp, "p"), "\n".join(texts))
    with split_size(spark, 32 << 10):
        rows = read_pretty_json(spark, path, SCHEMA)
        assert rows.rdd.getNumPartitions() > 4
        assert sorted(r.score for r in rows.collect()) == list(range(3000))
    assert read_pretty_json(spark, path, SCHEMA, keep_invalid=True).count() == 3075
    spark.range(0).select(F.lit("").alias("v")).write.text(os.path.join(tmp, "none"))
    assert read_pretty_json(spark, os.path.join(tmp, "none"), SCHEMA).count() == 0


def test_json_lines_cut_off_are_left_out(spark, tmp):
    path = _file(os.path.join(tmp, "l"), '{"subreddit": "a", "score": 1}\n{"subreddit": "b"\n{"subreddit": "c"}\nx\n')
    assert {r.subreddit for r in read_json_lines(spark, path, SCHEMA, keep_invalid=False).collect()} == {"a", "c"}
    assert read_json_lines(spark, path, SCHEMA).count() == 4


def test_words_of_any_length(spark):
    words = ["a" * 500_000, "a." * 100_000 + "a", "1" * 200_000, "1,2" * 60_000, "é́" * 100_000, "a1" * 100_000, "#" * 3]
    rows = spark.createDataFrame([(w,) for w in words], "text string")
    got = {r.word: r["count"] for r in token_count(rows, normalise=False).collect()}
    assert got == collections.Counter([*words[:6], "#", "#", "#"])


def test_both_forms_of_the_token_pattern_agree(spark, duck):
    rng = random.Random(7)
    signs = list("ab1.,'\"-_%#$¢€ \t") + ["é", "é", "­", "·", "‧", "漢", "٫", "²", "​", "🙂", "ा"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(1500)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r.id: r.t for r in rows.select("id", locale_tokens("text").alias("t")).collect()}
    pattern = LOCALE_TOKEN_RE2.replace("'", "''")
    for i, t in enumerate(texts):
        assert got[i] == duck.execute(f"SELECT regexp_extract_all(?, '{pattern}')", [t]).fetchone()[0], t


def test_normal_forms(spark):
    import unicodedata
    words = ["é", "é", "ﬁ", "Å", "한글", "abc", "", "ộ", "̈́"]
    rows = spark.createDataFrame([(w,) for w in [*words, None]], "w string")
    for form in ("NFC", "NFD", "NFKC", "NFKD"):
        got = [r.n for r in rows.select(normal_form(F.col("w"), form).alias("n")).collect()]
        assert got == [*(unicodedata.normalize(form, w) for w in words), None]
    with pytest.raises(ValueError):
        normal_form(F.col("w"), "NFX")


def test_scratch_goes_with_its_scope(spark, tmp):
    base = checkpoint_dir(spark).removeprefix("file:")
    kept = materialize(spark.range(5), "outside")
    before = set(os.listdir(base))
    with scratch_scope():
        inner = materialize(spark.range(10), "inside")
        new = set(os.listdir(base)) - before
        assert len(new) == 1 and inner.count() == 10  # still there for a lost executor
        inner.write.parquet(os.path.join(tmp, "result"))
        scratch_path(spark, "never-written")
    assert set(os.listdir(base)) == before
    assert spark.read.parquet(os.path.join(tmp, "result")).count() == 10 and kept.count() == 5
    with pytest.raises(RuntimeError), scratch_scope():
        materialize(spark.range(3), "failed")
        raise RuntimeError
    assert set(os.listdir(base)) == before
    gone = release_scratch()
    assert any("outside-" in g for g in gone) and not set(os.listdir(base)) & {os.path.basename(g) for g in gone}


def test_bucketed_table_is_found_by_another_session(spark, tmp):
    KeyedStore(spark, root=tmp).append(spark.range(100).withColumnRenamed("id", "k"), "ks", "t", key="k", buckets=4)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("ember_")]:
        spark.sql(f"DROP TABLE {name}")  # what a new session's catalog looks like
    store = KeyedStore(spark, root=tmp)
    assert store.read("ks", "t").count() == 100
    store.append(spark.range(5).withColumnRenamed("id", "k"), "ks", "t", key="k", buckets=4)
    assert store.read("ks", "t").count() == 105
    with pytest.raises(ValueError):
        store.append(spark.range(5).withColumnRenamed("id", "k"), "ks", "t", key="k", buckets=8)
