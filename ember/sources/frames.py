"""Frames from driver values and temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def rows(spark: SparkSession, data, schema: T.StructType | str) -> DataFrame:
    """A small frame from driver-side rows (parameters, seeds)."""
    return spark.createDataFrame(list(data), schema)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def view(df: DataFrame, name: str) -> DataFrame:
    """Register (or replace) a temp view and return the frame."""
    df.createOrReplaceTempView(name)
    return df
