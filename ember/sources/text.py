"""Plain text sources: lines, whole files, custom record delimiters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioning import spread

def read_lines(spark: SparkSession, path: str | list[str], min_partitions: int | None = None,
               line_sep: str | None = None, with_file_name: bool = False) -> DataFrame:
    """One row per line (``value``). ``min_partitions`` re-spreads the lines
    over at least that many tasks (the reference's ``textFile(path, n)``);
    ``line_sep`` sets a custom record delimiter."""
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    df = reader.text(path)
    if with_file_name:
        df = df.select("value", F.col("_metadata.file_name").alias("file_name"))
    return spread(df, min_partitions) if min_partitions else df


def read_whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file (``value``, ``file_name``): a file is never split."""
    return spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_name").alias("file_name"))
