"""Access-log ingestion: parse lines and store the rows (Parquet folder or a
keyed store), optionally with a per-row UUID key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logs import parse_access_log
from ..sources.store import KeyedStore


def access_log_rows(lines: DataFrame, with_uid: bool = False, col: str = "value") -> DataFrame:
    rows = parse_access_log(lines, col)
    return rows.withColumn("uid", F.expr("uuid()")) if with_uid else rows


def ingest_access_log(lines: DataFrame, path: str | None = None, store: KeyedStore | None = None,
                      keyspace: str | None = None, table: str | None = None,
                      with_uid: bool = False, batch_rows: int | None = None,
                      parallelism: int | None = None) -> None:
    """Parse ``lines`` and write them: to Parquet at ``path``, or appended to
    ``store`` as ``keyspace.table``."""
    rows = access_log_rows(lines, with_uid)
    if store is not None:
        store.append(rows, keyspace, table, key="host", batch_rows=batch_rows,
                     parallelism=parallelism)
    else:
        w = rows.write.mode("errorifexists")
        if batch_rows:
            w = w.option("maxRecordsPerFile", str(batch_rows))
        w.parquet(path)
