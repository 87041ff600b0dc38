"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words: its weight's share of
``ratio`` times all words, at most ``cap`` times its own words, the excess
reshared by weight among the others. Each of its texts then has the same
expected number of copies, a whole part and a fraction. Fractions are rounded
dependently: two texts of a source meet, word mass is moved at random from one
to the other (keeping the sum of words and every text's expectation) until one
becomes integral, and the other goes on to the next meeting. This runs in
buckets of about ``bucket_rows`` texts, long texts first so that the mass left
over is a short text's, each leaving at most one residual;
residuals meet again, ``fan`` buckets at a time, up a tree until one per
source is left, which is drawn. So a source misses its target by less than
one text, and no task ever holds more than a bucket.

Buckets, order and draws depend on ids and sizes only, so reruns agree.
Defined results: a null text is empty; a text without words is never taken;
null sources are one source, ordered last; repeated rows are drawn one by
one; a source without words has target 0. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, union_all
from .exact_dedup import NO_ID, located, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
ROW = "file long, at long, id long, source string, size long, bucket long, part double, extra int"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """file, at, id, source, size: the words of every row."""
    rows = located(docs)
    return rows.select(F.col("__file").alias("file"), F.col("__at").alias("at"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, n_rows, target: one row per source.

    Sources in ascending order of cap per weight: while the next one's cap is
    below its share of what is left, it is capped; the first that is not fixes
    the share per weight of all that follow. The windows run over one row per
    source."""
    sums = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                   F.count("*").alias("n_rows")), "mix-sources")
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ahead = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    steps = (sums.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
             .withColumn("left", F.lit(float(ratio)) * F.sum("source_size").over(Window.partitionBy())
                         - F.sum("limit").over(ahead.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("left", F.coalesce("left", F.lit(float(ratio)) * F.sum("source_size").over(
                 Window.partitionBy())))
             .withColumn("share", F.col("left") / F.sum("weight").over(
                 ahead.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("capped", F.col("limit") <= F.col("weight") * F.col("share")))
    level = F.max(F.when(~F.col("capped"), F.col("share"))).over(Window.partitionBy())
    return steps.withColumn("level", level).select(
        "source", "source_size", "n_rows",
        F.when(F.col("capped"), F.col("limit")).otherwise(F.least("limit", F.col("weight") * F.col("level")))
        .alias("target"))


def round_pairs(part: np.ndarray, size: np.ndarray, rng: np.random.Generator):
    """Pivotal rounding in order: (0 or 1 per row, -1 for the one left over; its fraction)."""
    extra = np.full(len(part), -1, np.int64)
    draws = rng.random(len(part)).tolist()
    held, p, w = -1, 0.0, 0.0
    for i, (q, v) in enumerate(zip(part.tolist(), size.tolist())):
        if q <= 0.0 or q >= 1.0:
            extra[i] = int(q >= 1.0)
            continue
        if held < 0:
            held, p, w = i, q, float(v)
            continue
        up, down = min((1 - p) * w, q * v), min(p * w, (1 - q) * v)
        if draws[i] * (up + down) < down:  # mass moves to the held row
            full, empty = (1 - p) * w <= q * v, q * v <= (1 - p) * w
            first, second = (1 if full else None), (0 if empty else None)
            p, q = p + up / w, q - up / v
        else:
            empty, full = p * w <= (1 - q) * v, (1 - q) * v <= p * w
            first, second = (0 if empty else None), (1 if full else None)
            p, q = p - down / w, q + down / v
        if first is not None:
            extra[held] = first
            held = -1
        if second is not None:
            extra[i] = second
        elif held < 0:
            held, p, w = i, q, float(v)
    return extra, held, p


def meeting(seed: int, level: int, last: bool):
    """Rounds one bucket; only the last level draws its residual."""
    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "id"], ascending=[False, True], kind="stable")
        where = (seed, level, frame["source"].iloc[0], int(frame["bucket"].iloc[0]))
        rng = np.random.default_rng(zlib.crc32(repr(where).encode()))
        part = frame["part"].to_numpy().copy()
        extra, held, p = round_pairs(part, frame["size"].to_numpy(), rng)
        if held >= 0:
            part[held] = p
            if last:
                extra[held] = int(rng.random() < p)
        return frame.assign(part=part, extra=pd.array(extra, "Int32")).assign(
            extra=lambda f: f["extra"].mask(f["extra"] < 0))

    return meet


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, ratio: float = 1.5, cap: float = 2.0, seed: int = 0, bucket_rows: int = 8192,
        fan: int = 64, broadcast_sources: int = 1 << 16) -> DataFrame:
    """file, at, doc_id, size, source_size, target, copies, taken for every row.

    The target table is broadcast while it has at most ``broadcast_sources``
    rows, else joined by shuffle."""
    sizes = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    goal = materialize(targets(sizes, weights, ratio, cap), "mix-targets")
    n_sources, most = goal.agg(F.count("*"), F.max("n_rows")).first()
    goal = (F.broadcast(goal) if n_sources <= broadcast_sources else goal).withColumnRenamed("source", "of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (sizes.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
            .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0.0)))
            .withColumn("whole", F.floor(F.col("copies") + F.lit(1e-9)).cast("int"))
            .withColumn("part", F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0))))
    n_buckets = F.ceil(F.col("n_rows") / F.lit(bucket_rows)).cast("long")
    open_rows = rows.filter("part > 0").withColumn(
        "bucket", F.pmod(F.xxhash64("id", "size", F.lit(seed)), n_buckets)).select(
        "file", "at", "id", "source", "size", "bucket", "part", F.lit(None).cast("int").alias("extra"))
    decided, buckets, level = [], -(-(most or 0) // bucket_rows), 0
    while True:
        last = buckets <= 1
        met = materialize(open_rows.groupBy("source", "bucket").applyInPandas(
            meeting(seed, level, last), ROW), f"mix-level{level}")
        decided.append(met.filter("extra IS NOT NULL").select("file", "at", "extra"))
        if last:
            break
        open_rows = met.filter("extra IS NULL").withColumn("bucket", F.floor(F.col("bucket") / fan))
        buckets, level = -(-buckets // fan), level + 1
    extra = union_all(decided)
    taken = F.col("whole") + F.coalesce("extra", F.lit(0))
    return rows.join(extra, ["file", "at"], "left").select(
        "file", "at", F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "size", "source_size", "target",
        taken.alias("copies"), (taken * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each repeated as often as the mix takes it."""
    docs = stored(docs)
    taken = mix(docs, **options).filter("copies > 0").select(
        F.col("file").alias("__file"), F.col("at").alias("__at"), F.col("copies").alias("__copies"))
    return (located(docs).join(taken, ["__file", "__at"])
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
