"""Input parallelism.

A scan yields one task per file split; a few large unsplittable files (or a
table written as one row group) leave most cores idle during CPU-heavy steps
such as tokenising. ``spread`` re-distributes rows round-robin when the files
under the frame give fewer splits than the cluster can run at once - on a
large input, already split into many tasks, it adds no shuffle. The splits
are estimated from file names and sizes in the plan, so no job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_UNITS = {"b": 0, "": 0, "k": 10, "m": 20, "g": 30, "t": 40}


def byte_size(text: str) -> int:
    """Bytes of a Spark size setting (``134217728``, ``128m``, ``16MB``)."""
    text = text.strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits):]
    return int(digits) << _UNITS[unit[:1]]


def scan_splits(df: DataFrame) -> int | None:
    """About how many tasks scan the files under ``df``; None without files."""
    files = len(df.inputFiles())
    if not files:
        return None
    per_task = byte_size(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(files, -(-input_bytes(df) // per_task))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files under ``df``, from the plan (no job)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def output_parts(df: DataFrame, part_bytes: int = 256 << 20, least_bytes: int = 4 << 20) -> int:
    """Number of parts to write ``df`` in: about ``part_bytes`` of input each;
    of a small input as many as there are cores, if each gets ``least_bytes``."""
    size = input_bytes(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // part_bytes), min(cores, -(-size // least_bytes)))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    splits = scan_splits(df)
    return df.repartition(target) if splits is not None and splits < target else df
