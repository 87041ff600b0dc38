"""Sources and sinks: round trips in temporary folders."""

import os
import re

from pyspark.sql import functions as F

from ember import sinks
from ember.operators.ingest import ingest_access_log
from ember.sources.frames import empty, rows, view
from ember.sources.store import KeyedStore
from ember.sources.text import read_lines, read_whole_files


def test_text_sinks_round_trip(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v long")
    sinks.write_key_value(df, os.path.join(tmp, "kv"), "k", "v")
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp, "kv")).collect()) == \
        ["a\t1", "b\t2", "c\t3"]
    sinks.write_text(df, os.path.join(tmp, "t3"), F.concat_ws(" ", "k", "v"), partitions=3)
    files = [f for f in os.listdir(os.path.join(tmp, "t3")) if f.startswith("part-")]
    assert len(files) == 3
    sinks.write_single_file(df, os.path.join(tmp, "one"), F.col("k"))
    files = [f for f in os.listdir(os.path.join(tmp, "one")) if f.startswith("part-")]
    assert len(files) == 1
    sinks.write_json(df, os.path.join(tmp, "js"))
    sinks.write_json(df, os.path.join(tmp, "js"))       # overwrite mode
    assert spark.read.json(os.path.join(tmp, "js")).count() == 3
    sinks.write_csv(df, os.path.join(tmp, "csv"))
    assert spark.read.schema("k string, v long").csv(os.path.join(tmp, "csv")).count() == 3
    p = sinks.write_snapshot(df, os.path.join(tmp, "snap"), 2)
    assert p.endswith("iter2") and spark.read.json(p).count() == 3


def test_null_sink_counters(spark):
    df = spark.range(10)
    got = sinks.count_only(df, {"rows": F.count(F.lit(1)), "total": F.sum("id")})
    assert got == {"rows": 10, "total": 45}


def test_read_lines_delimiter_partitions_and_whole_files(spark, tmp):
    d = os.path.join(tmp, "txt")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("x;y;z")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("1\n2\n")
    lines = read_lines(spark, os.path.join(d, "a.txt"), line_sep=";", min_partitions=4)
    assert sorted(r.value for r in lines.collect()) == ["x", "y", "z"]
    assert lines.rdd.getNumPartitions() >= 4
    whole = read_whole_files(spark, d).collect()
    assert sorted(r.file_name for r in whole) == ["a.txt", "b.txt"]


def test_keyed_store_append_read_and_pushdown(spark, tmp):
    store = KeyedStore(spark, root=tmp)
    orders = spark.createDataFrame([(i, float(i) * 1.5) for i in range(100)],
                                   "orderkey long, totalprice double")
    store.append(orders, "ks", "orders", key="orderkey", batch_rows=30, parallelism=2)
    df = store.read("ks", "orders")
    got = df.where(F.col("orderkey").isin([3, 7])).select("orderkey", "totalprice")
    assert sorted(r.orderkey for r in got.collect()) == [3, 7]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "In(orderkey, [3,7])" in text
    assert spark.sql("SELECT count(*) AS n FROM orders").first().n == 100


def test_ingest_access_log_with_uid(spark, tmp):
    lines = spark.createDataFrame(
        [('h - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 10',), ("junk",)], "value string")
    out = os.path.join(tmp, "logs")
    ingest_access_log(lines, out, with_uid=True)
    got = spark.read.parquet(out).collect()
    assert len(got) == 1 and got[0].host == "h" and got[0].bytes == 10.0
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", got[0].uid)
    store = KeyedStore(spark, root=tmp)
    ingest_access_log(lines, store=store, keyspace="ks", table="nasalogs", batch_rows=300,
                      parallelism=4)
    assert store.read("ks", "nasalogs", view=False).count() == 1


def test_frames(spark):
    e = empty(spark, "node string, distance int")
    assert e.count() == 0 and e.columns == ["node", "distance"]
    r = view(rows(spark, [("a", 0)], "node string, distance int"), "known_t")
    assert spark.sql("SELECT node FROM known_t").first().node == "a"
    assert r.count() == 1
