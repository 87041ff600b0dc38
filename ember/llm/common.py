"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path  # noqa: F401  (re-exported)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def binary_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose row i is the bytes of values[offsets[i]:offsets[i + 1]]."""
    width = values.dtype.itemsize
    at = np.asarray(offsets, np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                 [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))]
                                 ).cast(pa.binary())


def fixed_binary(matrix: np.ndarray) -> pa.Array:
    """A binary column of equally long rows."""
    n, width = matrix.shape
    at = np.arange(n + 1, dtype=np.int64) * width
    return binary_column(np.ascontiguousarray(matrix).reshape(-1), at)


def packed(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def small_batches(it, rows: int = 256):
    """The record batches of ``it`` in slices of at most ``rows`` rows, for
    steps that turn long values into Python objects."""
    for batch in it:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, rows_per_task: int = 1 << 19) -> DataFrame:
    """Smallest node reachable from every node of ``edges`` (a, b): (node, label).

    ``edges`` should be a written table: every round reads it.
    Minimum-label propagation with pointer jumping: every round each node takes
    the least label among its neighbours, then the label of its label, so a
    chain of n links needs about log n rounds. A hub's neighbours only meet in
    a ``min`` with map-side combine. Each round is written to the shared
    checkpoint folder, so a lost executor re-reads one round, and only counts
    reach the driver. Up to ``rows_per_task`` links are one task's work and
    are not shuffled; more are dealt out as the session has it. No edges give
    no rows."""
    small = edges.count() <= rows_per_task

    def held(frame: DataFrame) -> DataFrame:
        return frame.coalesce(1) if small else frame

    both = held(edges.select(F.col("a").alias("s"), F.col("b").alias("d")).unionAll(
        edges.select(F.col("b").alias("s"), F.col("a").alias("d"))))
    labels = held(materialize(both.groupBy(F.col("s").alias("node")).agg(
        F.least(F.col("s"), F.min("d")).alias("label")), "cc-start"))
    while True:
        spread = (both.join(labels.select(F.col("node").alias("s"), "label"), "s")
                  .groupBy(F.col("d").alias("node")).agg(F.min("label").alias("near")))
        met = (labels.join(spread, "node")
               .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = held(materialize(met.join(jump, "label").select(
            "node", "old", F.least("label", "far").alias("label")), "cc-round"))
        labels = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return labels
