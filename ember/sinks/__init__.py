"""Writers. Each takes a DataFrame and writes it distributed (one file per
task) unless a single file is asked for explicitly after an aggregation."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.fmt import key_value_line


def _line(df: DataFrame, line: Column | str | None) -> DataFrame:
    if line is None:
        if len(df.columns) != 1:
            raise ValueError("give the line column/expression for a multi-column frame")
        return df.select(F.col(df.columns[0]).cast("string").alias("value"))
    return df.select((F.col(line) if isinstance(line, str) else line).alias("value"))


def write_text(df: DataFrame, path: str, line: Column | str | None = None,
               mode: str = "errorifexists", partitions: int | None = None) -> None:
    """Text files, one line per row. ``partitions`` fixes the number of
    output files (a shuffle); ``0`` keeps the input partitioning (map-only)."""
    out = _line(df, line)
    if partitions:
        out = out.repartition(partitions)
    out.write.mode(mode).text(path)


def write_key_value(df: DataFrame, path: str, key: str, value: str, sep: str = "\t",
                    mode: str = "errorifexists") -> None:
    """Hadoop text output: ``key<TAB>value`` lines (no CSV quoting)."""
    df.select(key_value_line(key, value, sep).alias("value")).write.mode(mode).text(path)


def write_single_file(df: DataFrame, path: str, line: Column | str | None = None,
                      mode: str = "errorifexists") -> None:
    """One output file: for small, already aggregated results only."""
    _line(df, line).coalesce(1).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_snapshot(df: DataFrame, base: str, step: int, fmt: str = "json") -> str:
    """``<base>/iter<step>`` snapshot of an iterative job's state."""
    path = os.path.join(base, f"iter{step}")
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def count_only(df: DataFrame, counters: dict[str, Column], name: str = "counters") -> dict:
    """Run the job for its side totals only (null sink): ``counters`` maps a
    name to an aggregate expression; returns the totals."""
    obs = Observation(name)
    df.observe(obs, *[expr.alias(k) for k, expr in counters.items()]) \
        .write.format("noop").mode("overwrite").save()
    return obs.get


def written_lines(df: DataFrame, line: Column | str | None, path: str) -> DataFrame:
    """Write ``df`` as text in its order and read the lines back with their
    place in the whole output: ``pos, line``. Files count in name order; a
    window per file numbers its lines, one small row per file the files."""
    write_text(df, path, line)
    spark = df.sparkSession
    rows = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("block", "id")) - 1
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = rows.groupBy("file").agg(F.count("*").alias("n")).select("file", before.alias("before"))
    return rows.withColumn("at", within).join(files, "file").select(
        (F.col("at") + F.col("before")).cast("long").alias("pos"), "line")
