"""Exact deduplication as a stateful stream over disk-backed keyed state.

A manifest holds one row per text: its digest, id and content locator (file
and row of the scan). A Structured Streaming query reads the manifest file by
file; per digest a RocksDB state row, which never expires, retains the
digest, the stable identifier of the row that stays, its locator and the
number of texts seen. Every task first combines the rows of a batch by digest,
so a hot text reaches its state as a few rows. The groups are read from the
state itself. With a ``state`` folder of one's own the texts, manifest and state
stay there, and the next call goes on from them: its rows meet the copies that
came with earlier batches, whose locators still find their bytes.

Wherever the state was hit, the full bytes of the texts are compared. Digests
whose texts differ are split by their bytes, so the result does not rest on
the digest being collision-free.

Texts are equal when identical after lower-casing A-Z only. Defined results: a
null text is empty; of equal texts the row with the largest id stays, of
repeated rows with that id the first one scanned; a null id is smaller than
every id. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from .common import materialize, scratch_path

NO_ID = -(1 << 63)  # stands for a null id inside the state
#: Disk-backed state; many small stores, so none reserves disk ahead, all of an
#: executor share one bounded memory, and each is closed once its batch is written.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
MANIFEST = "doc_id long, file long, at long, sha binary"
FEED = MANIFEST + ", batch int"


def stored(docs: DataFrame) -> DataFrame:
    """``docs`` as a plain file scan, whose rows have stable locators; any
    other frame is written once."""
    plan = docs._jdf.queryExecution().analyzed()
    return docs if plan.getClass().getSimpleName() == "LogicalRelation" and docs.inputFiles() else materialize(
        docs, "stored")


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with a stable content locator (__file, __at) for every row. To
    join two results by locator give both the same ``stored`` frame."""
    docs = stored(docs)
    meta = docs.metadataColumn("_metadata")
    return docs.select(F.xxhash64(meta["file_path"]).alias("__file"), meta["row_index"].alias("__at"),
                       *(docs[f"`{c}`"] for c in docs.columns))


def _bodies(column) -> list[bytes]:
    """Normalised texts as bytes: bytes.lower() changes A-Z only."""
    return [(v or b"").lower() for v in column.cast(pa.binary()).to_pylist()]


def manifest(rows: DataFrame) -> DataFrame:
    """(file, at, doc_id, text) -> MANIFEST."""
    def batches(it):
        for batch in it:
            sha = [hashlib.sha256(b).digest() for b in _bodies(batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), batch.column(1), pa.array(sha, pa.binary())],
                names=["doc_id", "file", "at", "sha"])

    return rows.mapInArrow(batches, MANIFEST)


def stream_groups(spark: SparkSession, manifest_path: str, checkpoint: str, digest_bytes: int, triggers: int) -> DataFrame:
    """Run the stream to the end of the manifest, then read its state:
    (key, group_size, keep_id, keep_file, keep_at) of every digest."""
    files = len(spark.read.schema(FEED).parquet(manifest_path).inputFiles())
    kept = F.max(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.bitwise_not("file").alias("f"),
                          F.bitwise_not("at").alias("a")))
    groups = (spark.readStream.schema(FEED).option("maxFilesPerTrigger", max(1, -(-files // triggers)))
              .parquet(manifest_path).groupBy(F.substring("sha", 1, digest_bytes).alias("key"))
              .agg(kept.alias("best"), F.count("*").alias("group_size")))
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        run = (groups.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
               .option("checkpointLocation", checkpoint).start())
        run.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        best, size = state.schema["value"].dataType.names
        best = F.col("value")[best]
        digest = state.schema["key"].dataType.names[0]
        groups = state.select(F.col("key")[digest].alias("key"), F.col("value")[size].alias("group_size"),
                              best["id"].alias("keep_id"), F.bitwise_not(best["f"]).alias("keep_file"),
                              F.bitwise_not(best["a"]).alias("keep_at"))
        return materialize(groups, "dedup-groups")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32,
          triggers: int = 2, broadcast_rows: int = 1 << 20, state: str | None = None) -> DataFrame:
    """file, at, doc_id, keep_id, group_size, kept, text_sha256 for every row.

    ``digest_bytes`` shortens the state's key (tests use it to force
    collisions); ``triggers`` is the least number of micro-batches; at most
    ``broadcast_rows`` locators (16 bytes each) are broadcast to fetch texts.
    ``state`` is a shared folder that later calls go on from: ``docs`` are then
    the next batch, and groups hold the rows of all batches so far. A batch is
    known by its number; one that failed half-way needs a copy of the folder
    from before it."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    batch = 0
    if state:
        while path_exists(spark, f"{state}/texts/batch={batch}"):
            batch += 1
        texts.write.parquet(f"{state}/texts/batch={batch}")
        parts = [f"{state}/texts/batch={b}" for b in range(batch + 1)]
        texts, new = located(spark.read.parquet(*parts)), located(spark.read.parquet(parts[-1]))
    else:
        texts = new = located(docs).select("__file", "__at", F.col(id_col).cast("long").alias("doc_id"),
                                           F.col(text_col).alias("text"))
    texts, new = (t.select(F.col("__file").alias("file"), F.col("__at").alias("at"), "doc_id", "text") for t in (texts, new))
    path = f"{state}/manifest" if state else scratch_path(spark, "dedup-manifest")
    manifest(new).write.parquet(f"{path}/batch={batch}")
    everything = spark.read.schema(FEED).parquet(path).withColumn("key", F.substring("sha", 1, digest_bytes))
    rows = everything.filter(F.col("batch") == batch).drop("batch")
    groups = stream_groups(spark, path, f"{state}/stream" if state else scratch_path(spark, "dedup-stream"),
                           digest_bytes, triggers)
    everything = everything.drop("batch")
    if batch:  # groups that this batch's rows belong to
        groups = groups.join(rows.select("key").distinct(), "key", "left_semi")

    # the full bytes of every text whose digest was hit
    hits = materialize(everything.join(groups.filter("group_size > 1").select("key"), "key").select("file", "at", "key"),
                       "dedup-hits")
    found = F.broadcast(hits) if hits.count() <= broadcast_rows else hits

    def bodies(it):
        for batch in it:
            seen = dict.fromkeys(zip(batch.column(0).to_pylist(), _bodies(batch.column(1))))
            yield pa.RecordBatch.from_pylist([{"key": k, "body": b} for k, b in seen],
                                             pa.schema([("key", pa.binary()), ("body", pa.binary())]))

    located_hits = texts.join(found, ["file", "at"])
    distinct = located_hits.select("key", "text").mapInArrow(bodies, "key binary, body binary").distinct()
    clashes = materialize(distinct.groupBy("key").count().filter("count > 1").select("key"), "dedup-clashes")
    best = F.max(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.bitwise_not("file").alias("f"),
                          F.bitwise_not("at").alias("a"))).alias("best")
    if not clashes.isEmpty():
        # groups of one digest split by their bytes
        def whole(it):
            for batch in it:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], pa.array(_bodies(batch.column(4)), pa.binary())],
                    names=["file", "at", "doc_id", "key", "body"])

        split = located_hits.join(clashes, "key").select("file", "at", "doc_id", "key", "text").mapInArrow(
            whole, "file long, at long, doc_id long, key binary, body binary")
        parts = split.groupBy("key", "body").agg(best, F.count("*").alias("group_size")).select(
            "key", "body", "group_size", F.col("best.id").alias("keep_id"), F.bitwise_not("best.f").alias("keep_file"),
            F.bitwise_not("best.a").alias("keep_at"))
        fixed = split.join(parts, ["key", "body"]).select("file", "at", "group_size", "keep_id", "keep_file",
                                                          "keep_at")
        clear = rows.join(clashes, "key", "left_anti").join(groups, "key")
        fixed = rows.join(fixed, ["file", "at"])
        joined = clear.select(*fixed.columns).unionByName(fixed)
    else:
        joined = rows.join(groups, "key")
    return joined.select(
        "file", "at", "doc_id", F.nullif("keep_id", F.lit(NO_ID)).alias("keep_id"), "group_size",
        ((F.col("file") == F.col("keep_file")) & (F.col("at") == F.col("keep_at"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = stored(docs)
    dropped = dedup(docs, **options).filter("NOT kept").select(
        F.col("file").alias("__file"), F.col("at").alias("__at"))
    return located(docs).join(dropped, ["__file", "__at"], "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns))
