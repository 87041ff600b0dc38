"""Daily maximum temperature range (observations stand-in: ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fmt import range_line
from ..operators.weather import daily_max_range, daily_max_range_sql
from ..sinks import written_lines
from ..session import scratch_path
from ..sources import standins
from ..sources.delimited import read_csv
from ..sources.testdata import table
from .registry import register

OBSERVATION_SCHEMA = "station string, date bigint, observation string, value double, mflag string, qflag string"

# The reference's own formulation: self-join TMAX x TMIN, join back to the max.
_ORACLE = """
WITH obs AS (
  SELECT CAST(user_id AS VARCHAR) AS station, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date,
         CASE event_type WHEN 'purchase' THEN 'TMAX' ELSE 'TMIN' END AS observation, value
  FROM events WHERE event_type IN ('purchase', 'view') AND event_id % 11 <> 0),
r AS (
  SELECT a.date, a.station, a.value - b.value AS range
  FROM obs a JOIN obs b ON a.station = b.station AND a.date = b.date
  WHERE a.observation = 'TMAX' AND b.observation = 'TMIN'),
m AS (SELECT date, max(range) AS max_range FROM r GROUP BY date)
SELECT r.date, r.station, m.max_range AS range, count(*) AS pairs
FROM r JOIN m ON r.date = m.date AND r.range = m.max_range
GROUP BY r.date, r.station, m.max_range
"""


@register("daily_max_range", oracle=_ORACLE)
def daily_max_range_q(spark, sf_dir):
    return daily_max_range(standins.observations(table(spark, sf_dir, "events")))


@register("daily_max_range_sql", oracle=_ORACLE)
def daily_max_range_sql_q(spark, sf_dir):
    return daily_max_range_sql(spark, standins.observations(table(spark, sf_dir, "events")))


@register("daily_max_range_csv", oracle=_ORACLE)
def daily_max_range_csv(spark, sf_dir):
    """Observations written as CSV files without a header and read with a
    declared schema; flagged readings are left out."""
    path = scratch_path(spark, "observations")
    standins.observations(table(spark, sf_dir, "events")).write.csv(path)
    return daily_max_range(read_csv(spark, path, OBSERVATION_SCHEMA))


@register("daily_max_range_lines", oracle=f"""
SELECT CAST(row_number() OVER (ORDER BY date, station) - 1 AS BIGINT) AS pos,
       date || ' ' || station || ' ' || CAST(range AS VARCHAR) AS line
FROM (SELECT * FROM ({_ORACLE}))
""")
def daily_max_range_lines(spark, sf_dir):
    """The sorted ``DATE ID RANGE`` lines as written to text files and read
    back in file order."""
    days = daily_max_range(standins.observations(table(spark, sf_dir, "events")))
    return written_lines(days, range_line("date", "station", F.col("range")), scratch_path(spark, "range-lines"))
