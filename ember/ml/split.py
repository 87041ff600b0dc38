"""Repeatable train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 10000

#: Rows up to which a table stays as its files are cut, and a task's rows beyond.
FEW_ROWS = 1 << 17
TASK_ROWS = 100000


def split_slot(key: str, seed: int = 42) -> Column:
    """0 .. SLOTS - 1 from the md5 of key and seed: the same in every engine."""
    digest = F.md5(F.concat_ws("/", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % SLOTS


def train_test_split(df: DataFrame, train_fraction: float = 0.75, key: str | None = None,
                     seed: int = 42, cache: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of ``key`` (stable across runs and partitionings) or,
    without a key, by a seeded ``randomSplit``."""
    if key:
        in_train = F.coalesce(split_slot(key, seed) < round(train_fraction * SLOTS), F.lit(True))
        parts = [df.where(in_train), df.where(~in_train)]
    else:
        parts = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    train, test = (p.cache() for p in parts) if cache else parts
    return train, test


def spread(df: DataFrame, few_rows: int = FEW_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """The same rows in tasks of about ``task_rows``, for fits that read them
    hundreds of times: a small file is one task, whatever rows it holds. Rows go
    by their hash and are sorted in a task, so that seeded samples are the same
    again. Up to ``few_rows`` rows stay where they are."""
    rows = df.count()
    if rows <= few_rows:
        return df
    return df.repartition(-(-rows // task_rows), *df.columns).sortWithinPartitions(*df.columns)
