"""Grouped statistics: averages, relative scores, correlation, 2-D histogram.

Every aggregate here is a built-in Spark aggregate, so it runs as partial
(map-side) + final ``HashAggregate``: a hot key is pre-aggregated in every map
task before the shuffle, the role the reference's combiners played.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fmt import json_pair
from .joins import DEFAULT_BROADCAST_BYTES, measure, salted_join


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def group_average(df: DataFrame, key: str, value: str, name: str = "average",
                  digits: int | None = None) -> DataFrame:
    """Mean of ``value`` per ``key`` (as double), plus the reference's JSON
    output line ``["key", mean]``."""
    avg = F.avg(F.col(value).cast("double"))
    if digits is not None:
        avg = F.round(avg, digits)
    out = df.groupBy(key).agg(avg.alias(name))
    return out.withColumn("json", json_pair(F.col(key), F.col(name)))


def group_average_sql(spark: SparkSession, df: DataFrame, key: str, value: str,
                      name: str = "average", digits: int = 6) -> DataFrame:
    """SQL form of ``group_average`` (the DataFrame is bound as a view)."""
    return spark.sql(
        f"SELECT {key}, round(avg(CAST({value} AS DOUBLE)), {digits}) AS {name} "
        f"FROM {{comments}} GROUP BY {key}", comments=df)


def positive_averages(df: DataFrame, key: str, score: str) -> DataFrame:
    """Per-key mean score, keeping only keys whose mean is > 0."""
    return (df.groupBy(key).agg(F.avg(F.col(score).cast("double")).alias("avg_score"))
            .where(F.col("avg_score") > 0))


def relative_score(df: DataFrame, key: str, score: str, author: str,
                   broadcast: bool = False, digits: int | None = None,
                   sort: bool = True,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                   salt_buckets: int | None = None) -> DataFrame:
    """Each row's score divided by its key's mean score; keys with a mean
    <= 0 are dropped (in both join modes). Returns ``relative_score, author``
    sorted by relative score, descending.

    ``broadcast=False`` leaves the join to the planner (shuffle join, or a
    runtime broadcast chosen by AQE from measured sizes). ``broadcast=True``
    materialises the per-key means, measures them and broadcasts them when
    within ``max_broadcast_bytes``; otherwise it falls back to a shuffle join
    (AQE splits skewed keys). ``salt_buckets`` salts a shuffle join
    explicitly instead (a hot key spread over that many tasks)."""
    avgs = positive_averages(df, key, score)
    facts = df.select(key, score, author)
    small = False
    if broadcast:
        m = measure(avgs, max_broadcast_bytes)
        avgs, small = m.side(), m.small
    if salt_buckets and not small:
        joined = salted_join(facts, avgs, [key], salt_buckets)
    else:
        joined = facts.join(avgs, key)
    rel = F.col(score) / F.col("avg_score")
    if digits is not None:
        rel = F.round(rel, digits)
    out = joined.select(rel.alias("relative_score"), F.col(author).alias("author"))
    # the author breaks ties, so equal scores do not share one sort partition
    return out.orderBy(F.desc("relative_score"), "author") if sort else out


def host_totals(logs: DataFrame, host: str = "host", nbytes: str = "bytes") -> DataFrame:
    """Requests and bytes per host."""
    return logs.groupBy(host).agg(F.count(F.lit(1)).alias("requests"),
                                  F.sum(F.col(nbytes)).alias("bytes"))


def pearson(x, y) -> F.Column:
    """Pearson r; NULL (not an error) when either side has no variance."""
    return F.try_divide(F.covar_pop(_c(x), _c(y)),
                        F.stddev_pop(_c(x)) * F.stddev_pop(_c(y)))


def correlation(df: DataFrame, x: str, y: str, digits: int | None = 6) -> DataFrame:
    """One-pass correlation of two columns: one row ``n, r, r2``."""
    r = pearson(x, y)
    r_out = F.round(r, digits) if digits is not None else r
    r2_out = F.round(r * r, digits) if digits is not None else r * r
    return df.agg(F.count(F.lit(1)).alias("n"), r_out.alias("r"), r2_out.alias("r2"))


def six_sums(df: DataFrame, x: str, y: str) -> DataFrame:
    """The reference's moment tuple in one global pass: n, sum x, sum y,
    sum x^2, sum y^2, sum xy."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(fx).alias("sum_x"),
                  F.sum(fy).alias("sum_y"), F.sum(fx * fx).alias("sum_x2"),
                  F.sum(fy * fy).alias("sum_y2"), F.sum(fx * fy).alias("sum_xy"))


def correlation_two_pass(df: DataFrame, x: str, y: str, digits: int | None = 6) -> DataFrame:
    """Centred (two-pass) correlation: the means are one global aggregate
    (two scalars), then sums of centred products in a second pass."""
    means = df.agg(F.avg(F.col(x).cast("double")).alias("mx"),
                   F.avg(F.col(y).cast("double")).alias("my")).first()
    mx = F.lit(means["mx"]).cast("double")
    my = F.lit(means["my"]).cast("double")
    dx, dy = F.col(x) - mx, F.col(y) - my
    r = F.try_divide(F.sum(dx * dy), F.sqrt(F.sum(dx * dx)) * F.sqrt(F.sum(dy * dy)))
    r_out = F.round(r, digits) if digits is not None else r
    r2_out = F.round(r * r, digits) if digits is not None else r * r
    return df.agg(F.count(F.lit(1)).alias("n"), r_out.alias("r"), r2_out.alias("r2"))


def histogram_2d(df: DataFrame, x: str, y: str, bins: int = 20,
                 fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Counts on a ``bins`` x ``bins`` grid spanning the data's range.

    ``fraction`` samples first (the reference plotted a sample); ``None``
    uses every row. Returns ``bx, by, x_lo, y_lo, n``."""
    src = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    src = src.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    if fraction is not None and fraction < 1.0:
        src = src.sample(fraction=fraction, seed=seed)
    s = src.agg(F.min("x").alias("x0"), F.max("x").alias("x1"),
                F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    if s["x0"] is None:
        return src.sparkSession.createDataFrame(
            [], "bx int, by int, x_lo double, y_lo double, n bigint")

    def bucket(c, lo, hi):
        if hi == lo:
            return F.lit(0)
        raw = F.floor((F.col(c) - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins)))
        return F.least(raw, F.lit(bins - 1)).cast("int")

    wx = (s["x1"] - s["x0"]) / bins
    wy = (s["y1"] - s["y0"]) / bins
    return (src.select(bucket("x", s["x0"], s["x1"]).alias("bx"),
                       bucket("y", s["y0"], s["y1"]).alias("by"))
            .groupBy("bx", "by").agg(F.count(F.lit(1)).alias("n"))
            .select("bx", "by",
                    (F.lit(s["x0"]) + F.col("bx") * F.lit(wx)).alias("x_lo"),
                    (F.lit(s["y0"]) + F.col("by") * F.lit(wy)).alias("y_lo"), "n"))
