"""Running least-squares line over an unbounded stream of ``"x y"`` messages.

The state is one global aggregate row (no key), so it stays bounded without
a watermark; Spark merges each micro-batch's partial aggregates into it.
Output mode is *update*: every trigger emits the current slope/intercept.
Messages that do not parse to two numbers are ignored by the regression
(``regr_*`` skip NULL pairs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def parse_points(messages: DataFrame, col: str = "value") -> DataFrame:
    """``x double, y double`` from space-separated text (binary is decoded)."""
    parts = F.split(F.col(col).cast("string"), " ")
    return messages.select(F.get(parts, 0).try_cast("double").alias("x"),
                           F.get(parts, 1).try_cast("double").alias("y"))


def regression_stats(points: DataFrame, digits: int | None = None) -> DataFrame:
    """One row: ``slope, intercept, n`` plus the least-squares sums."""
    slope = F.regr_slope("y", "x")
    icpt = F.regr_intercept("y", "x")
    if digits is not None:
        slope, icpt = F.round(slope, digits), F.round(icpt, digits)
    ok = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y = F.when(ok, F.col("x")), F.when(ok, F.col("y"))
    return points.agg(slope.alias("slope"), icpt.alias("intercept"),
                      F.regr_count("y", "x").alias("n"),
                      F.sum(x).alias("sum_x"), F.sum(y).alias("sum_y"),
                      F.sum(x * y).alias("sum_xy"), F.sum(x * x).alias("sum_x2"))


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Streaming ``value`` column from a Kafka topic (needs the Kafka
    connector on the class path)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                  bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` column from text files appearing in ``path``; a
    micro-batch takes so many files, or about so many bytes."""
    reader = spark.readStream.schema("value string")
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def start_regression(messages: DataFrame, checkpoint: str, sink: str = "console",
                     trigger: dict | None = None, foreach_batch=None,
                     query_name: str | None = None, digits: int | None = None) -> StreamingQuery:
    """Start the running regression. ``sink`` is any streaming format
    (console, memory, ...) or pass ``foreach_batch``; ``trigger`` is passed
    to ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}``)."""
    stats = regression_stats(parse_points(messages), digits)
    w = stats.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    return w.format(sink).start()


def run_available(messages: DataFrame, checkpoint: str, results: str,
                  digits: int | None = 6, timeout: float | None = None) -> DataFrame:
    """Process everything available now, in as many micro-batches as the
    source yields. Each batch's update row is the partition ``batch_id`` of the
    Parquet table ``results``, written over if the batch is run again after a
    failure, so no batch counts twice; a later call with the same checkpoint
    goes on where this one ended. Returns the final state row."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{results.rstrip('/')}/batch_id={batch_id}")

    q = start_regression(messages, checkpoint, trigger={"availableNow": True},
                         foreach_batch=save, digits=digits)
    if not (q.awaitTermination(timeout) if timeout is not None else q.awaitTermination() or True):
        q.stop()
        raise TimeoutError(f"the stream was not read to its end within {timeout} s; "
                           "run again with the same checkpoint to go on")
    if q.exception() is not None:
        raise q.exception()
    spark = messages.sparkSession
    out = spark.read.parquet(results)
    return out.orderBy(F.desc("batch_id")).limit(1).drop("batch_id")


def run_for(messages: DataFrame, checkpoint: str, seconds: float = 120.0,
            sink: str = "console", digits: int | None = None) -> StreamingQuery:
    """Run the regression for a bounded time (the reference waited 120 s),
    then stop it; the checkpoint lets a later run resume the state."""
    q = start_regression(messages, checkpoint, sink=sink, digits=digits)
    q.awaitTermination(seconds)
    if q.isActive:
        q.stop()
    return q
