"""Daily maximum temperature range: the station(s) with the largest
TMAX - TMIN on each date.

The reference self-joins TMAX and TMIN rows on (station, date) and joins the
result back to the per-date maximum. A self-join emits every TMAX x TMIN pair
of a (station, date) group, so here the same answer comes from aggregates:

1. count rows per (station, date, observation, value)   - partial aggregate
2. per (station, date): the largest TMAX and smallest TMIN with their counts
3. per date: the largest range (tiny), joined back on (date, range)
4. a winner carries ``pairs`` = ``n_tmax * n_tmin``, the number of times the
   self-join would have repeated its row, so no row is ever multiplied

Only rows whose quality flag is NULL are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .joins import DEFAULT_BROADCAST_BYTES, measure


def station_ranges(obs: DataFrame, station="station", date="date",
                   observation="observation", value="value", qflag="qflag") -> DataFrame:
    """``date, station, range, pairs`` for every (station, date) with both a
    TMAX and a TMIN; ``pairs`` = how many (TMAX, TMIN) rows give that range."""
    o = obs
    if qflag in obs.columns:
        o = o.where(F.col(qflag).isNull())
    o = o.where(F.col(observation).isin("TMAX", "TMIN")).select(
        F.col(station).alias("station"), F.col(date).alias("date"),
        F.col(observation).alias("obs"), F.col(value).alias("value"))
    level1 = o.groupBy("station", "date", "obs", "value").agg(F.count(F.lit(1)).alias("n"))
    is_max, is_min = F.col("obs") == "TMAX", F.col("obs") == "TMIN"
    hi, lo = F.when(is_max, F.col("value")), F.when(is_min, F.col("value"))
    # max_by/min_by keep fixed-width buffers, so this stays a HashAggregate
    level2 = level1.groupBy("station", "date").agg(
        F.max(hi).alias("hi"), F.max_by(F.when(is_max, F.col("n")), hi).alias("hi_n"),
        F.min(lo).alias("lo"), F.min_by(F.when(is_min, F.col("n")), lo).alias("lo_n"))
    return (level2.where(F.col("hi").isNotNull() & F.col("lo").isNotNull())
            .select("date", "station", (F.col("hi") - F.col("lo")).alias("range"),
                    (F.col("hi_n") * F.col("lo_n")).alias("pairs")))


def daily_max_range(obs: DataFrame, sort: bool = True,
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, **cols) -> DataFrame:
    """``date, station, range, pairs`` of the largest range per date (ties
    kept); ``pairs`` counts the observation pairs that give the range."""
    # one row per station and date, written once: both steps below read it
    ranges = materialize(station_ranges(obs, **cols), "ranges")
    best = ranges.groupBy("date").agg(F.max("range").alias("range"))
    win = ranges.join(measure(best, max_broadcast_bytes).side(), ["date", "range"], "left_semi") \
        .select("date", "station", "range", "pairs")
    return win.orderBy("date", "station") if sort else win


def daily_max_range_sql(spark: SparkSession, obs: DataFrame, sort: bool = True) -> DataFrame:
    """The same job written as SQL text over bound views. The ranges are
    written once, as two steps read them."""
    ranges = materialize(spark.sql("""
        WITH level1 AS (
          SELECT station, date, observation AS obs, value, count(*) AS n
          FROM {recordings}
          WHERE qflag IS NULL AND observation IN ('TMAX', 'TMIN')
          GROUP BY station, date, observation, value),
        level2 AS (
          SELECT station, date,
                 max(CASE WHEN obs = 'TMAX' THEN value END) AS hi,
                 max_by(CASE WHEN obs = 'TMAX' THEN n END, CASE WHEN obs = 'TMAX' THEN value END) AS hi_n,
                 min(CASE WHEN obs = 'TMIN' THEN value END) AS lo,
                 min_by(CASE WHEN obs = 'TMIN' THEN n END, CASE WHEN obs = 'TMIN' THEN value END) AS lo_n
          FROM level1 GROUP BY station, date)
        SELECT date, station, hi - lo AS range, hi_n * lo_n AS pairs
        FROM level2 WHERE hi IS NOT NULL AND lo IS NOT NULL""", recordings=obs), "ranges")
    best = measure(spark.sql("SELECT date, max(range) AS range FROM {ranges} GROUP BY date", ranges=ranges))
    order = "ORDER BY date, station" if sort else ""
    return spark.sql(f"""
        SELECT r.date, r.station, r.range, r.pairs
        FROM {{ranges}} r LEFT SEMI JOIN {{best}} b ON r.date = b.date AND r.range = b.range
        {order}""", ranges=ranges, best=best.side())
