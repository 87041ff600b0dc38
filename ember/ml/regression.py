"""Choice of a regressor: every candidate's grid is searched by a
train-validation split of the training rows, the tuned models are scored on
the test rows, and the scores come back as a frame with the best one marked.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import regression as R
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .split import spread, train_test_split


@dataclass(frozen=True)
class Candidate:
    """A regressor class and the values to try for some of its parameters."""
    kind: type
    grid: dict[str, list] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.kind.__name__

    def tuner(self, prepare: list, evaluator: Evaluator, train_ratio: float, seed: int) -> TrainValidationSplit:
        model = self.kind(featuresCol="features", labelCol=evaluator.getLabelCol())
        if model.hasParam("seed"):
            model.setSeed(seed)
        search = ParamGridBuilder()
        for param, values in self.grid.items():
            search.addGrid(model.getParam(param), values)
        return TrainValidationSplit(estimator=Pipeline(stages=[*prepare, model]), evaluator=evaluator,
                                    estimatorParamMaps=search.build(), trainRatio=train_ratio, seed=seed)


# Fixed values (must equal the reference's model settings).
CANDIDATES = [
    Candidate(R.DecisionTreeRegressor, {"maxDepth": [10], "minInstancesPerNode": [2], "minInfoGain": [0.5]}),
    Candidate(R.LinearRegression, {"regParam": [0.5], "elasticNetParam": [0.1], "aggregationDepth": [10],
                                   "tol": [0.000008], "maxIter": [100]}),
    Candidate(R.RandomForestRegressor, {"featureSubsetStrategy": ["onethird"], "minInfoGain": [0.1]}),
    Candidate(R.GBTRegressor, {"maxIter": [30], "maxDepth": [10]}),
]
TRAIN_RATIO = 0.2  # share of the training rows used to fit inside each split

# Station-temperature rows: position, elevation and day of year.
WEATHER_FEATURES = ["latitude", "longitude", "elevation", "doy"]


def best_regressor(df: DataFrame, feature_cols, label_col: str, statement: str | None = None,
                   split_key: str | None = None, seed: int = 42, candidates=CANDIDATES,
                   metric: str = "r2", parallelism: int = 2,
                   train_ratio: float = TRAIN_RATIO) -> tuple[PipelineModel, DataFrame]:
    """Returns ``(best_model, scores)``; ``scores`` is ``model, score, best``.

    ``statement`` is an optional SQL stage ahead of the features. Up to
    ``parallelism`` tuners run concurrently; all are seeded."""
    evaluator = RegressionEvaluator(labelCol=label_col, metricName=metric)
    prepare = [VectorAssembler(inputCols=list(feature_cols), outputCol="features")]
    if statement:
        prepare.insert(0, SQLTransformer(statement=statement))
    train, test = train_test_split(spread(df), 0.75, key=split_key, seed=seed)

    def tuned(candidate: Candidate) -> PipelineModel:
        return candidate.tuner(prepare, evaluator, train_ratio, seed).fit(train).bestModel

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = dict(zip((c.name for c in candidates), pool.map(tuned, candidates)))
    scored = {name: float(evaluator.evaluate(model.transform(test))) for name, model in models.items()}
    for part in (train, test):
        part.unpersist()
    scores = df.sparkSession.createDataFrame(list(scored.items()), "model string, score double")
    direction = F.desc if evaluator.isLargerBetter() else F.asc
    best = scores.orderBy(direction("score"), "model").first().model
    return models[best], scores.withColumn("best", F.col("model") == best)


def predictions(model: PipelineModel, df: DataFrame, label_col: str) -> DataFrame:
    """Full-data predictions of a fitted model, without the feature vector."""
    return model.transform(df).drop("features").withColumn(
        "residual", F.col(label_col) - F.col("prediction"))


def with_day_of_year(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumn("doy", F.dayofyear(date))


def best_weather_model(df: DataFrame, split_key: str | None = None, seed: int = 42):
    """The station-temperature form: predict ``tmax`` from position,
    elevation and day of year."""
    return best_regressor(with_day_of_year(df), WEATHER_FEATURES, "tmax", split_key=split_key, seed=seed)


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Ordinary least squares of y on x by MLlib: ``slope, intercept, r2``."""
    rows = VectorAssembler(inputCols=[x], outputCol="features").transform(df.select(x, y).dropna())
    model = R.LinearRegression(featuresCol="features", labelCol=y, regParam=0.0, solver="normal").fit(rows)
    return df.sparkSession.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))],
        "slope double, intercept double, r2 double")


def elastic_net_line(df: DataFrame, x: str, y: str, reg: float = 0.5, mix: float = 0.1, **settings) -> DataFrame:
    """Elastic net of y on one feature by MLlib, with the settings of the
    candidate above unless told otherwise: ``slope, intercept``."""
    rows = VectorAssembler(inputCols=[x], outputCol="features").transform(df.select(x, y).dropna())
    model = R.LinearRegression(featuresCol="features", labelCol=y, regParam=reg, elasticNetParam=mix,
                               **{"tol": 0.000008, "maxIter": 100, **settings}).fit(rows)
    return df.sparkSession.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                           "slope double, intercept double")


def elastic_net_closed(df: DataFrame, x: str, y: str, reg: float = 0.5, mix: float = 0.1) -> DataFrame:
    """The same line from sums alone. With both columns scaled to unit variance
    the slope is the correlation, pulled towards 0 by the L1 share of the
    penalty and divided by 1 plus its L2 share. Null without variance."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    moments = df.select(a.alias("x"), b.alias("y")).dropna().agg(
        F.avg("x").alias("mx"), F.avg("y").alias("my"), F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"),
        F.covar_pop("x", "y").alias("c"))
    r, pull = F.try_divide("c", F.col("sx") * F.col("sy")), F.try_divide(F.lit(reg), "sy")
    beta = F.signum(r) * F.greatest(F.abs(r) - mix * pull, F.lit(0.0)) / (1 + (1 - mix) * pull)
    line = moments.select("mx", "my", (beta * F.try_divide("sy", "sx")).alias("slope"))
    return line.select("slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"))
