"""Keyed-store tables (keyspace.table) behind Spark's data source API.

The reference read and wrote a Cassandra cluster. Here the store is any
Spark data source: ``format="parquet"`` (a folder per ``keyspace/table``,
the default and what tests use) or a connector format such as
``org.apache.spark.sql.cassandra`` when its jar is on the class path.
Key filters and column lists are ordinary ``where`` / ``select`` calls: the
source receives them as pushed filters and a pruned read schema.

Parquet tables can be *bucketed* by a key: rows are stored by a hash of it, so a
look-up opens only its keys' buckets and joins of tables with equal buckets on
their keys shuffle neither. The layout is noted beside the table, so any later
session finds it.
"""

from __future__ import annotations

import hashlib
import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


def _layout(spark: SparkSession, path: str) -> tuple[list[str], int] | None:
    note = path.rstrip("/") + ".buckets"
    if not path_exists(spark, note):
        return None
    row = spark.read.schema("keys array<string>, buckets int").json(note).first()
    return row["keys"], row["buckets"]


def _catalog_name(path: str) -> str:
    return "ember_" + hashlib.md5(path.encode()).hexdigest()


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_bucketed`` wrote, in this session or another. The
    catalog's entry is only a description: dropping it leaves the files."""
    known = _layout(spark, path)
    if known is None:
        raise ValueError(f"{path} is not bucketed")
    name = _catalog_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(f"`{k}`" for k in known[0])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                  f"INTO {known[1]} BUCKETS LOCATION \"{path}\"")
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, keys, buckets: int) -> None:
    """Append ``df`` to the bucketed table at ``path``. Rows are dealt by the
    buckets' own hash, so a bucket is about one file a call; a bucket much
    larger than the others is split over several writers and files by AQE."""
    spark, keys = df.sparkSession, [keys] if isinstance(keys, str) else list(keys)
    known = _layout(spark, path)
    if known is None:
        spark.createDataFrame([(keys, buckets)], "keys array<string>, buckets int").coalesce(1).write.json(
            path.rstrip("/") + ".buckets")
    elif known != (keys, buckets):
        raise ValueError(f"{path} has {known[1]} buckets of {known[0]}")
    if path_exists(spark, path):
        read_bucketed(spark, path)  # the catalog must know what is appended to
    (df.hint("rebalance", buckets, *(F.col(k) for k in keys)).write.mode("append").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(_catalog_name(path)))


@contextmanager
def split_size(spark: SparkSession, split_bytes: int):
    """Scans started inside are cut into splits of ``split_bytes``. Parquet
    readers take no split option, only the session has one; it is put back."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(split_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class KeyedStore:
    def __init__(self, spark: SparkSession, root: str | None = None,
                 fmt: str = "parquet", options: dict | None = None):
        self.spark = spark
        self.root = root
        self.fmt = fmt
        self.options = dict(options or {})

    def _path(self, keyspace: str, table: str) -> str:
        return os.path.join(self.root or "", keyspace, table)

    def read(self, keyspace: str, table: str, split_bytes: int | None = None,
             view: bool = True) -> DataFrame:
        """Full-table scan as a DataFrame, registered as a temp view named
        after the table. ``split_bytes`` is the connector's split size; for
        Parquet, where it is a setting of the session, see ``split_size``."""
        if self.fmt == "parquet":
            if split_bytes:
                raise ValueError("Parquet readers take no split size: run the scan inside split_size(...)")
            path = self._path(keyspace, table)
            bucketed = _layout(self.spark, path) is not None
            df = read_bucketed(self.spark, path) if bucketed else self.spark.read.options(**self.options).parquet(path)
        else:
            reader = self.spark.read.format(self.fmt).options(**self.options)
            if split_bytes:
                reader = reader.option("split_size_in_mb", str(max(1, split_bytes >> 20)))
            df = reader.options(keyspace=keyspace, table=table).load()
        if view:
            df.createOrReplaceTempView(table)
        return df

    def append(self, df: DataFrame, keyspace: str, table: str, key: str | None = None,
               batch_rows: int | None = None, parallelism: int | None = None,
               buckets: int | None = None) -> None:
        """Append rows. With Parquet the rows are clustered by ``key`` so a
        key look-up reads few row groups; ``batch_rows`` caps rows per file
        (the store's write batch); ``parallelism`` sets concurrent writers.

        Writers get ranges of (key, row hash): each file covers a narrow key
        range, yet a hot key is split over several writers instead of one.
        With ``buckets`` the table is bucketed by ``key`` instead."""
        if buckets:
            if self.fmt != "parquet" or not key:
                raise ValueError("buckets need the Parquet store and a key")
            write_bucketed(df, self._path(keyspace, table), key, buckets)
            return
        out = df
        if parallelism:
            if key:
                out = out.repartitionByRange(parallelism, F.col(key),
                                             F.xxhash64(*[F.col(c) for c in df.columns]))
            else:
                out = out.repartition(parallelism)
        if key:
            out = out.sortWithinPartitions(key)
        writer = out.write.mode("append").format(self.fmt).options(**self.options)
        if self.fmt == "parquet":
            if batch_rows:
                writer = writer.option("maxRecordsPerFile", str(batch_rows))
            writer.save(self._path(keyspace, table))
        else:
            if batch_rows:
                writer = writer.option("spark.cassandra.output.batch.size.rows", str(batch_rows))
            writer.options(keyspace=keyspace, table=table).save()
