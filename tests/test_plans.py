"""Plan checks: pushdown, pruning, join strategy, no Python in hot paths."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ember.operators import orders as ops
from ember.operators.aggregate import relative_score
from ember.operators.graph import edge_table
from ember.operators.joins import row_filter
from ember.operators.topk import top_per_group
from ember.operators.weather import daily_max_range
from ember.operators.wordcount import word_count
from ember.sources import standins
from ember.sources.store import KeyedStore
from ember.sources.testdata import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_list_pushed_into_scans(spark):
    o, li, p = (table(spark, SF_SMALL, n) for n in ("orders", "lineitem", "part"))
    text = plan(ops.order_part_names(o, li, p, [1, 2, 3]))
    assert "PushedFilters: [In(o_orderkey, [1,2,3])" in text
    assert "In(l_orderkey, [1,2,3])" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_raw_word_count_has_no_python(spark):
    text = plan(word_count(table(spark, SF_SMALL, "documents"), normalise=False))
    assert "EvalPython" not in text
    assert "partial_count" in text


def test_nfd_runs_in_the_jvm_after_first_count(spark):
    text = plan(word_count(table(spark, SF_SMALL, "documents"), normalise=True))
    assert "Python" not in text
    # words are counted before their forms are made, and summed after
    assert text.index("partial_sum(count") < text.index("partial_count")


def test_broadcast_relative_score_uses_broadcast_join(spark):
    c = standins.comments(table(spark, SF_SMALL, "events"))
    text = plan(relative_score(c, "subreddit", "score", "author", broadcast=True))
    assert "BroadcastHashJoin" in text


def test_measured_side_too_big_falls_back_to_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = standins.comments(table(spark, SF_SMALL, "events"))
        text = plan(relative_score(c, "subreddit", "score", "author", broadcast=True,
                                   max_broadcast_bytes=1))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_per_group_uses_no_window(spark):
    ev = table(spark, SF_SMALL, "events").select(
        F.date_format("ts", "yyyyMMdd-HH").alias("hour"), "event_id", "value")
    text = plan(top_per_group(ev, "hour", "value", keep=["event_id"]))
    assert "Window" not in text and "LeftSemi" in text


def test_temperature_range_has_no_self_join(spark):
    obs = standins.observations(table(spark, SF_SMALL, "events"))
    text = plan(daily_max_range(obs))
    assert "SortMergeJoin" not in text and "SortAggregate" not in text
    assert text.count("FileScan parquet") == 2   # written ranges and measured maxima


def test_bucketed_store_opens_only_the_keys_buckets(spark, tmp):
    store = KeyedStore(spark, root=tmp)
    orders = table(spark, SF_SMALL, "orders")
    store.append(orders, "tpch", "orders", key="o_orderkey", buckets=16)
    store.append(orders, "tpch", "orders", key="o_orderkey", buckets=16)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan does not say
    try:
        got = store.read("tpch", "orders", view=False).where(F.col("o_orderkey").isin(1, 7))
        assert "SelectedBucketsCount: 2 out of 16" in plan(got) and got.count() == 4
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_bucketed_tables_join_without_a_shuffle_of_the_order_key(spark, tmp):
    o, li, p = (table(spark, SF_SMALL, n) for n in ("orders", "lineitem", "part"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bo, bl = ops.bucket_orders(o, li, f"{tmp}/o", f"{tmp}/l", buckets=8)
        joined = bo.join(bl, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").count()
        assert "Exchange" not in plan(joined) and plan(joined).count("SelectedBucketsCount: 8 out of 8") == 2
        got = ops.order_part_names(bo, bl, p.hint("broadcast"))
        assert "hashpartitioning" not in plan(got)
        assert sorted(got.collect()) == sorted(ops.order_part_names(o, li, p).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_frontier_does_not_shuffle_the_edges(spark):
    edges = spark.range(4000).select(F.concat(F.lit("n"), F.col("id") % 50).alias("source"),
                                     F.concat(F.lit("m"), "id").alias("destination"))
    hub = spark.range(3000).select(F.lit("hub").alias("source"), F.concat(F.lit("h"), "id").alias("destination"))
    edges = edges.unionByName(hub)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = edge_table(edges, per_part=500, buckets=8)
        frontier = spark.createDataFrame([("n1",), ("n2",), ("hub",)], "source string")
        hop = stored.next_nodes(frontier, broadcast=False)
        text = plan(hop)
        scan = next(line for line in text.splitlines() if "Bucketed: true" in line)
        above = text[:text.index(scan)].splitlines()
        depth = len(scan) - len(scan.lstrip(" :+-"))
        # the operators that the scan's rows pass: lines less and less indented
        path = []
        for line in reversed(above):
            at = len(line) - len(line.lstrip(" :+-"))
            if at < depth:
                path.append(line)
                depth = at
        first = next(i for i, line in enumerate(path) if "Exchange" in line)
        assert any("SortMergeJoin" in line for line in path[:first])  # joined where they lie
        assert any("partial_min" in line for line in path[:first])  # and reduced, before the nodes are shuffled
        near = {tuple(r) for r in stored.next_nodes(frontier, broadcast=True).collect()}
        assert near == {tuple(r) for r in hop.collect()} and len(near) == 3160
        assert stored.edges.where("source = 'hub'").select("part").distinct().count() == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_key_frames_filter_line_items_before_their_shuffle(spark):
    o, li, p = (table(spark, SF_SMALL, n) for n in ("orders", "lineitem", "part"))
    keys = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ops.order_part_names(o, li, p, keys, outer=True, max_broadcast_bytes=1)
        text = plan(got)
        assert "bit_or" in text and "BroadcastHashJoin" in text and "LeftSemi" in text
        assert sorted(got.collect()) == sorted(ops.order_part_names(o, li, p, keys, outer=True).collect())
        small = plan(ops.order_part_names(o, li, p, keys))
        assert "BroadcastHashJoin [l_orderkey" in small and "bit_or" not in small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_filter_loses_no_key_and_drops_most_others(spark):
    rows = spark.range(20000).select("id", F.col("id").alias("_extra")).unionByName(
        spark.createDataFrame([(None, 0)], "id long, _extra long"))
    keys = spark.createDataFrame([(i * 7,) for i in range(500)] + [(None,)], "k int")
    kept = {r.id for r in row_filter(rows, "id", keys, bits=1 << 16).collect()}
    assert {i * 7 for i in range(500)} <= kept and None not in kept and len(kept) < 800
    assert row_filter(rows, "id", keys.limit(0)).count() == 0


def test_salted_join_shuffles_both_sides(spark):
    c = standins.comments(table(spark, SF_SMALL, "events"))
    text = plan(relative_score(c, "subreddit", "score", "author", salt_buckets=4))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text and "_salt" in text
