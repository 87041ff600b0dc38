"""Stream = batch: a file stream replayed in several micro-batches ends on
the batch regression."""

import os

import pytest
from pyspark.sql import functions as F

from ember.streaming.regression import file_messages, parse_points, regression_stats, run_available


def test_stream_equals_batch(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    pts = [(float(i), 2.0 * i + 1.0 + (0.5 if i % 3 else -0.25)) for i in range(40)]
    for k in range(4):
        with open(os.path.join(src, f"part-{k}.txt"), "w") as f:
            for x, y in pts[k * 10:(k + 1) * 10]:
                f.write(f"{x} {y}\n")
            if k == 2:
                f.write("bad\n")
    final = run_available(file_messages(spark, src, files_per_trigger=1),
                          checkpoint=os.path.join(tmp, "ckpt"),
                          results=os.path.join(tmp, "out"), digits=None).first()
    batches = spark.read.parquet(os.path.join(tmp, "out")).select("batch_id").distinct().count()
    assert batches == 4
    batch = regression_stats(parse_points(spark.read.text(src))).first()
    assert final.n == 40 == batch.n
    assert final.slope == pytest.approx(batch.slope, rel=1e-12)
    assert final.intercept == pytest.approx(batch.intercept, rel=1e-12)
    import numpy as np
    xs, ys = np.array(pts).T
    slope, icpt = np.polyfit(xs, ys, 1)
    assert final.slope == pytest.approx(slope, rel=1e-9)
    assert final.intercept == pytest.approx(icpt, rel=1e-9)


def test_parse_points_ignores_bad(spark):
    df = spark.createDataFrame([("1 2",), ("bad",), ("3 x",), (None,)], "value string")
    rows = parse_points(df).collect()
    assert [(r.x, r.y) for r in rows] == [(1.0, 2.0), (None, None), (3.0, None), (None, None)]
    assert regression_stats(parse_points(df)).first().n == 1
    assert regression_stats(parse_points(df)).select(F.col("slope")).first().slope is None


def test_a_repeated_batch_leaves_one_row(spark, tmp):
    """A batch that ran again after a failure writes over its own row; the next
    call with the same checkpoint goes on with the state."""
    src, out, ckpt = (os.path.join(tmp, n) for n in ("in", "out", "ckpt"))
    os.makedirs(src)

    def add(name, points):
        with open(os.path.join(src, name), "w") as f:
            f.writelines(f"{x} {y}\n" for x, y in points)

    add("a.txt", [(1, 2), (2, 4)])
    add("b.txt", [(3, 7)])
    first = run_available(file_messages(spark, src, files_per_trigger=1), ckpt, out).first()
    assert first.n == 3
    os.remove(os.path.join(ckpt, "commits", "1"))  # the last batch's result was written, its commit was not
    for name in os.listdir(os.path.join(ckpt, "commits")):
        if name.startswith(".1."):
            os.remove(os.path.join(ckpt, "commits", name))
    add("c.txt", [(4, 8)])
    last = run_available(file_messages(spark, src, files_per_trigger=1), ckpt, out).first()
    rows = {r.batch_id: r.n for r in spark.read.parquet(out).collect()}
    assert last.n == 4 and rows == {0: 2, 1: 3, 2: 4} and spark.read.parquet(out).count() == 3
    assert last.slope == pytest.approx(regression_stats(parse_points(spark.read.text(src)), 6).first().slope)
