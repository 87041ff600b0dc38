"""ML: score floors on learnable stand-ins, LAB reference values, SQL stage."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from ember.functions.colour import lab_sql
from ember.ml.colour import compare_classifiers, with_lab
from ember.ml.colour import colour_pipelines
from ember.ml.regression import (best_regressor, best_weather_model, elastic_net_closed, elastic_net_line,
                                 with_day_of_year)
from ember.ml.scores import label_scores, r2, weighted_f1
from ember.ml import colour, regression
from ember.ml.split import spread, train_test_split
from ember.sources import standins
from ember.sources.testdata import table
from pyspark.ml.feature import SQLTransformer


def test_lab_reference_colours(spark):
    df = spark.createDataFrame([(255, 255, 255), (255, 0, 0), (0, 0, 0)], "R int, G int, B int")
    rows = {(r.R, r.G, r.B): (r.lL, r.lA, r.lB) for r in with_lab(df).collect()}
    assert rows[(255, 255, 255)] == pytest.approx((100.0, 0.0, 0.0), abs=1e-3)
    assert rows[(255, 0, 0)] == pytest.approx((53.2408, 80.0925, 67.2032), abs=1e-3)
    assert rows[(0, 0, 0)] == pytest.approx((0.0, 0.0, 0.0), abs=1e-9)


def test_lab_sql_stage_equals_expressions(spark):
    c = standins.colours(table(spark, SF_SMALL, "part"))
    a = with_lab(c).select("R", "G", "B", "lL", "lA", "lB").orderBy("R", "G", "B").collect()
    b = SQLTransformer(statement=lab_sql(passthrough=("labelword",))).transform(c) \
        .select("R", "G", "B", "lL", "lA", "lB").orderBy("R", "G", "B").collect()
    for x, y in zip(a, b):
        assert tuple(x) == pytest.approx(tuple(y), abs=1e-9)


def test_day_of_year(spark):
    df = spark.createDataFrame([("S", "2024-02-01", 1.0, 2.0, 3.0, 4.0)],
                               "station string, date string, latitude double, longitude double, "
                               "elevation double, tmax double").withColumn("date", F.to_date("date"))
    assert with_day_of_year(df).first().doy == 32


def test_station_temperatures_are_learnt(spark):
    rows = standins.station_temperatures(table(spark, SF_SMALL, "events"))
    _, scores = best_weather_model(rows, split_key="event_id")
    assert max(r.score for r in scores.collect()) > 0.8
    assert sum(r.best for r in scores.collect()) == 1


def test_colour_classifiers_learn(spark):
    scores = {r.model: r.score for r in compare_classifiers(
        standins.colours(table(spark, SF_MID, "part")), split_key="p_partkey",
        mlp_block_size=128).collect()}
    assert set(scores) == {"RGB-forest", "LAB-forest", "RGB-MLP", "LAB-MLP"}
    assert scores["RGB-forest"] > 0.85
    assert scores["LAB-forest"] > 0.6


def test_best_regressor_is_a_tree(spark):
    part = table(spark, SF_MID, "part").select("p_partkey", "p_size", "p_retailprice")
    model, scores = best_regressor(part, ["p_partkey", "p_size"], "p_retailprice",
                                   "SELECT p_partkey, p_size, p_retailprice FROM __THIS__",
                                   split_key="p_partkey")
    rows = {r.model: (r.score, r.best) for r in scores.collect()}
    best = [m for m, (_, b) in rows.items() if b]
    assert len(best) == 1 and best[0] != "LinearRegression"
    assert rows[best[0]][0] > 0.8
    assert model.transform(part).count() == part.count()


def test_scores_equal_the_library(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    colours = standins.colours(table(spark, SF_SMALL, "part"))
    train, test = train_test_split(colours, 0.75, key="p_partkey")
    for name in ("RGB-forest", "LAB-forest"):
        told = colour_pipelines(3)[name].fit(train).transform(test)
        wanted = MulticlassClassificationEvaluator(labelCol="index", metricName="f1").evaluate(told)
        assert weighted_f1(told).first().score == pytest.approx(wanted, rel=1e-12)
    never = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 2.0), (0.0, 1.0)], "index double, prediction double")
    wanted = MulticlassClassificationEvaluator(labelCol="index", metricName="f1").evaluate(never)
    assert weighted_f1(never).first().score == pytest.approx(wanted)
    assert [r.label for r in label_scores(never).orderBy("label").collect()] == [0.0, 1.0]
    part = table(spark, SF_SMALL, "part").select("p_partkey", "p_size", "p_retailprice")
    model, scores = best_regressor(part, ["p_partkey", "p_size"], "p_retailprice", split_key="p_partkey")
    told = model.transform(part)
    wanted = RegressionEvaluator(labelCol="p_retailprice", metricName="r2").evaluate(told)
    assert r2(told, "p_retailprice").first().score == pytest.approx(wanted, rel=1e-9)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, prediction double")
    assert r2(flat, "y").first().score is None


@pytest.mark.parametrize("x,reg,mix", [("p_partkey", 0.5, 0.1), ("p_partkey", 20.0, 0.9), ("p_size", 0.5, 0.1), ("p_partkey", 1e4, 1.0)])
def test_elastic_net_equals_its_closed_form(spark, x, reg, mix):
    part = table(spark, SF_MID, "part").select(x, "p_retailprice").unionByName(
        spark.createDataFrame([(None, 5.0)], f"{x} int, p_retailprice double"))
    got = elastic_net_line(part, x, "p_retailprice", reg, mix, tol=1e-12).first()
    closed = elastic_net_closed(part, x, "p_retailprice", reg, mix).first()
    assert got.slope == pytest.approx(closed.slope, rel=1e-6, abs=1e-9)
    assert got.intercept == pytest.approx(closed.intercept, rel=1e-6)


def test_fits_read_a_large_file_in_many_tasks(spark, monkeypatch):
    class Seen(Exception):
        pass

    def split(df, *args, **options):
        raise Seen(df.rdd.getNumPartitions())

    one = spark.range(140000).coalesce(1).selectExpr(
        "id AS p_partkey", "cast(id % 7 AS int) AS p_size", "cast(id % 11 AS double) AS p_retailprice")
    fits = [(colour, lambda: compare_classifiers(standins.colours(one), split_key="p_partkey")),
            (regression, lambda: best_regressor(one, ["p_partkey", "p_size"], "p_retailprice", split_key="p_partkey"))]
    for module, fit in fits:
        monkeypatch.setattr(module, "train_test_split", split)
        with pytest.raises(Seen) as seen:
            fit()
        assert seen.value.args[0] == 2


def test_spread_keeps_the_rows(spark):
    rows = [(i, None if i % 5 == 0 else i % 3) for i in range(40)] * 2
    df = spark.createDataFrame(rows, "a int, b int").coalesce(1)
    wide = spread(df, few_rows=50, task_rows=20)
    assert wide.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(rows, key=str)
    assert [r.a for r in wide.collect()] == [r.a for r in spread(df.repartition(3), few_rows=50, task_rows=20).collect()]
    assert spread(df, few_rows=80).rdd.getNumPartitions() == 1
