"""Paired implementations that must agree."""

import os

from conftest import SF_SMALL
from helpers import rows_of
from ember.operators import aggregate as agg
from ember.operators import orders as ops
from ember.operators.topk import argmax_per_group, top_per_group
from ember.operators.weather import daily_max_range, daily_max_range_sql
from ember.sources import standins
from ember.sources.testdata import table


def test_temperature_dataframe_equals_sql(spark):
    obs = standins.observations(table(spark, SF_SMALL, "events"))
    assert rows_of(daily_max_range(obs)) == rows_of(daily_max_range_sql(spark, obs))


def test_relative_score_broadcast_equals_shuffle(spark):
    c = standins.comments(table(spark, SF_SMALL, "events"))
    a = agg.relative_score(c, "subreddit", "score", "author", broadcast=False)
    b = agg.relative_score(c, "subreddit", "score", "author", broadcast=True)
    assert rows_of(a) == rows_of(b)


def test_group_average_dataframe_equals_sql(spark):
    ev = table(spark, SF_SMALL, "events")
    a = agg.group_average(ev, "event_type", "value", digits=6).drop("json")
    b = agg.group_average_sql(spark, ev, "event_type", "value")
    assert rows_of(a) == rows_of(b)


def test_denormalised_lookup_equals_direct_join(spark, tmp):
    o, li, p = (table(spark, SF_SMALL, n) for n in ("orders", "lineitem", "part"))
    keys = [0, 1, 2, 5, 8, 13, 21, 34, 55, 89]
    path = os.path.join(tmp, "denorm")
    ops.write_denormalized(ops.denormalize_orders(o, li, p), path, files=3)
    a = ops.lookup_denormalized(spark.read.parquet(path), keys)
    b = ops.order_part_names(o, li, p, keys)
    assert rows_of(a) == rows_of(b)


def test_argmax_equals_top_when_no_ties(spark):
    ev = table(spark, SF_SMALL, "events").selectExpr(
        "date_format(ts, 'yyyyMMdd-HH') AS hour", "event_id", "value")
    a = argmax_per_group(ev, "hour", "value", keep=["event_id"])
    b = top_per_group(ev, "hour", "value", keep=["event_id"])
    assert rows_of(a) == rows_of(b)


def test_salted_relative_score_equals_plain_under_skew(spark):
    # one subreddit holds most rows
    rows = [("hot", float(i % 7 + 1), f"a{i}") for i in range(300)] + \
           [("cold", float(i + 1), f"b{i}") for i in range(20)]
    c = spark.createDataFrame(rows, "subreddit string, score double, author string")
    plain = agg.relative_score(c, "subreddit", "score", "author")
    salted = agg.relative_score(c, "subreddit", "score", "author", salt_buckets=8)
    assert rows_of(plain) == rows_of(salted)
    forced = agg.relative_score(c, "subreddit", "score", "author", broadcast=True,
                                max_broadcast_bytes=1, salt_buckets=8)
    assert rows_of(plain) == rows_of(forced)
