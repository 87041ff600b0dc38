"""Session defaults and shared-storage helpers.

Jobs never build their own session: they take the caller's ``SparkSession``.
``build_session`` is for tests, benchmarks and command-line use only.

Lineage is cut with reliable checkpoints in the folder the cluster names in
``spark.checkpoint.dir``. That setting is read from the session; a private
folder is created only when nothing is configured (local tests).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Builder defaults. ANSI stays on (Spark 4 default) so bad casts surface as
# errors in jobs; parsers use try_* functions where a bad record must be dropped.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def recommended_conf(input_bytes: int, total_cores: int,
                     shuffle_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the input so every task fits in executor memory.

    Shuffle partitions start at about one per ``shuffle_partition_bytes`` of
    input (at least two waves of the cluster's cores) and AQE coalesces the
    small ones at run time; scans are split at 256 MB; a shuffle partition
    five times the median and over 512 MB counts as skewed and is split.
    At 100 TB on 8,000 cores this gives ~400,000 initial partitions."""
    shuffle = max(2 * total_cores, -(-input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ember", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            # executors on other machines cannot see a driver-local folder
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local runs and tests only
        configured = tempfile.mkdtemp(prefix="ember-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Scratch folders of this process that are still there: (folder, how to remove it).
_scratch: list[tuple[str, object]] = []


def _hadoop_path(spark: SparkSession, path: str):
    """Hadoop's path and file system of ``path``, whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    at, files = _hadoop_path(spark, path)
    return files.exists(at)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for data a job writes and reads back (rendered stream input,
    materialised intermediate tables). The folder goes when the
    ``scratch_scope`` it was made in ends, else when the driver's process
    does; until then a lost executor's work can be redone from it."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    at, files = _hadoop_path(spark, path)
    _scratch.append((path, lambda: files.delete(at, True)))
    return path


def release_scratch(since: int = 0) -> list[str]:
    """Remove the scratch folders made after the first ``since``; returns those
    removed. A folder that cannot be removed now is kept on the list."""
    gone = []
    for entry in reversed(_scratch[since:]):
        try:
            entry[1]()
        except Exception:  # noqa: BLE001 - the store or the JVM may be gone: leave the folder
            continue
        _scratch.remove(entry)
        gone.append(entry[0])
    return gone


@contextmanager
def scratch_scope():
    """Copies made inside are removed at its end, when their results must have
    been read or written elsewhere::

        with scratch_scope():
            daily_max_range(observations).write.parquet(target)
    """
    since = len(_scratch)
    try:
        yield
    finally:
        release_scratch(since)


atexit.register(release_scratch)


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    folder and return a frame reading it back.

    This cuts lineage like ``checkpoint()`` (a lost executor re-reads the
    files), but the copy is columnar: scans are vectorised, prune columns,
    and the planner sees its real size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
