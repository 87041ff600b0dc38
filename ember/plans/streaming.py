"""Running regression over a file stream of ``"x y"`` messages rendered from
``events`` (x = user_id, y = value)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import standins
from ..sources.testdata import table
from ..streaming.regression import file_messages, run_available
from .registry import register


@register("streaming_regression", oracle="""
SELECT round(regr_slope(value, user_id), 6) AS slope,
       round(regr_intercept(value, user_id), 6) AS intercept,
       regr_count(value, user_id) AS n,
       CAST(sum(user_id) AS DOUBLE) AS sum_x, round(sum(value), 4) AS sum_y,
       round(sum(user_id * value), 4) AS sum_xy, CAST(sum(user_id * user_id) AS DOUBLE) AS sum_x2
FROM events
""")
def streaming_regression(spark, sf_dir, bytes_per_trigger: int = 1 << 30):
    base = scratch_path(spark, "points_stream")
    src = os.path.join(base, "in")
    # as many files as the scan has splits; micro-batches are cut by bytes
    standins.point_messages(table(spark, sf_dir, "events")).write.text(src)
    final = run_available(file_messages(spark, src, bytes_per_trigger=bytes_per_trigger),
                          checkpoint=os.path.join(base, "checkpoint"),
                          results=os.path.join(base, "out"))
    return final.select("slope", "intercept", "n", "sum_x", F.round("sum_y", 4).alias("sum_y"),
                        F.round("sum_xy", 4).alias("sum_xy"), "sum_x2")
