"""Colour features, model comparisons and a 2-D histogram on ``part``.

Colours: R = partkey % 256, G = partkey * 7 % 256, B = size * 5 % 256,
label = dominant channel. Regression: retail price from part key and size.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.colour import lab_sql
from ..ml.colour import compare_classifiers, label_indexer, with_lab
from ..ml.regression import (best_regressor, best_weather_model, elastic_net_line, linear_fit, predictions,
                             with_day_of_year)
from ..ml.split import train_test_split
from ..operators.aggregate import histogram_2d
from ..session import scratch_path
from ..sinks import write_csv
from ..sources import standins
from ..sources.delimited import read_csv
from ..sources.testdata import table
from .registry import register

_COLOURS = """
c AS (SELECT CAST(p_partkey % 256 AS INTEGER) AS R, CAST(p_partkey * 7 % 256 AS INTEGER) AS G,
             CAST(p_size * 5 % 256 AS INTEGER) AS B FROM part)"""


def _lab_oracle() -> str:
    inner = lab_sql("R", "G", "B", table="c")
    return (f"WITH {_COLOURS}, lab AS ({inner}) "
            "SELECT R, G, B, round(lL, 6) AS lL, round(lA, 6) AS lA, round(lB, 6) AS lB FROM lab")


@register("rgb_to_lab", oracle=_lab_oracle())
def rgb_to_lab_q(spark, sf_dir):
    c = standins.colours(table(spark, sf_dir, "part")).select("R", "G", "B")
    lab = with_lab(c)
    return lab.select("R", "G", "B", *[F.round(x, 6).alias(x) for x in ("lL", "lA", "lB")])


@register("part_histogram_2d", oracle="""
WITH s AS (SELECT min(p_size) AS x0, max(p_size) AS x1,
                  min(p_retailprice) AS y0, max(p_retailprice) AS y1 FROM part)
SELECT CAST(least(floor((p_size - x0) / (x1 - x0) * 10.0), 9) AS INTEGER) AS bx,
       CAST(least(floor((p_retailprice - y0) / (y1 - y0) * 10.0), 9) AS INTEGER) AS by,
       count(*) AS n
FROM part, s GROUP BY ALL
""")
def part_histogram_2d(spark, sf_dir):
    return histogram_2d(table(spark, sf_dir, "part"), "p_size", "p_retailprice", bins=10) \
        .select("bx", "by", "n")


@register("colour_classifier_scores")
def colour_classifier_scores(spark, sf_dir):
    """F1 of {RGB, LAB} x {forest, MLP} on a hash split of the parts.

    The MLP stacks 128 rows per block (the reference used 1): block size only
    changes how rows are batched into matrices, not the fitted model."""
    return compare_classifiers(standins.colours(table(spark, sf_dir, "part")),
                               split_key="p_partkey", mlp_block_size=128)


_STATEMENT = "SELECT p_partkey, p_size, p_retailprice FROM __THIS__"


@register("price_regressor_scores")
def price_regressor_scores(spark, sf_dir):
    """r2 of the four tuned regressors for retail price; best flagged."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    _, scores = best_regressor(part, ["p_partkey", "p_size"], "p_retailprice", _STATEMENT,
                               split_key="p_partkey")
    return scores


@register("price_prediction_histogram")
def price_prediction_histogram(spark, sf_dir):
    """Label vs prediction of the best regressor, binned on a 20 x 20 grid."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    model, _ = best_regressor(part, ["p_partkey", "p_size"], "p_retailprice", _STATEMENT,
                              split_key="p_partkey")
    return histogram_2d(predictions(model, part, "p_retailprice"), "p_retailprice",
                        "prediction", bins=20)


@register("colour_split_counts", oracle=f"""
WITH {_COLOURS.replace("FROM part", ", p_partkey FROM part")},
s AS (SELECT CASE WHEN R >= G AND R >= B THEN 'red' WHEN G >= B THEN 'green' ELSE 'blue' END AS labelword,
             CAST(('0x' || substr(md5(p_partkey || '/42'), 1, 8)) AS BIGINT) % 10000 < 7500 AS train FROM c)
SELECT labelword, train, count(*) AS n FROM s GROUP BY ALL
""")
def colour_split_counts(spark, sf_dir):
    """Rows of each label on both sides of the repeatable split."""
    train, test = train_test_split(standins.colours(table(spark, sf_dir, "part")), 0.75, key="p_partkey",
                                   cache=False)
    return (train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))
            .groupBy("labelword", "train").agg(F.count("*").alias("n")))


@register("colour_label_index", oracle=f"""
WITH {_COLOURS},
s AS (SELECT CASE WHEN R >= G AND R >= B THEN 'red' WHEN G >= B THEN 'green' ELSE 'blue' END AS labelword FROM c),
n AS (SELECT labelword, count(*) AS n FROM s GROUP BY labelword)
SELECT labelword, CAST(row_number() OVER (ORDER BY n DESC, labelword) - 1 AS DOUBLE) AS index, n FROM n
""")
def colour_label_index(spark, sf_dir):
    """The label index the classifiers are trained on, with its rows; the
    colours come from a CSV file with a header."""
    path = scratch_path(spark, "colours")
    write_csv(standins.colours(table(spark, sf_dir, "part")), path, header=True)
    colours = read_csv(spark, path, "R int, G int, B int, p_partkey long, labelword string", header=True)
    indexed = label_indexer("labelword").fit(colours).transform(colours)
    return indexed.groupBy("labelword", "index").agg(F.count("*").alias("n"))


@register("price_linear_fit", oracle="""
SELECT round(regr_slope(p_retailprice, p_partkey), 6) AS slope,
       round(regr_intercept(p_retailprice, p_partkey), 6) AS intercept,
       round(regr_r2(p_retailprice, p_partkey), 6) AS r2 FROM part
""")
def price_linear_fit(spark, sf_dir):
    """Unregularised fit of retail price on part key."""
    fit = linear_fit(table(spark, sf_dir, "part"), "p_partkey", "p_retailprice")
    return fit.select(*(F.round(c, 6).alias(c) for c in fit.columns))


@register("price_elastic_net", oracle="""
WITH m AS (
  SELECT avg(p_partkey) AS mx, avg(p_retailprice) AS my, stddev_pop(p_partkey) AS sx, stddev_pop(p_retailprice) AS sy,
         corr(p_retailprice, p_partkey) AS r FROM part),
w AS (SELECT *, sign(r) * greatest(abs(r) - 0.1 * 0.5 / sy, 0) / (1 + 0.9 * 0.5 / sy) * sy / sx AS slope FROM m)
SELECT round(slope, 3) AS slope, round(my - slope * mx, 1) AS intercept FROM w
""")
def price_elastic_net(spark, sf_dir):
    """Retail price on part key with the elastic net of the regressor search; the
    SQL is its closed form for one feature (the fit is iterative, so rounded)."""
    line = elastic_net_line(table(spark, sf_dir, "part"), "p_partkey", "p_retailprice")
    return line.select(F.round("slope", 3).alias("slope"), F.round("intercept", 1).alias("intercept"))


@register("station_day_of_year", oracle="""
SELECT CAST(user_id AS VARCHAR) AS station, dayofyear(ts) AS doy, count(*) AS n
FROM events GROUP BY ALL
""")
def station_day_of_year(spark, sf_dir):
    """Readings per station and day of year, the regression's time feature."""
    rows = with_day_of_year(standins.station_temperatures(table(spark, sf_dir, "events")))
    return rows.groupBy("station", F.col("doy").cast("long").alias("doy")).agg(F.count("*").alias("n"))


@register("station_temperature_scores")
def station_temperature_scores(spark, sf_dir):
    """r2 of the four tuned regressors for station temperatures."""
    _, scores = best_weather_model(standins.station_temperatures(table(spark, sf_dir, "events")),
                                   split_key="event_id")
    return scores
