"""Rows holding the maximum of a value within each group, ties kept.

Plan: the per-group maximum is a partial + final aggregate (tiny shuffle, hot
groups pre-aggregated map-side); it is materialised, measured, and joined back
on ``(group, value = max)`` - as a broadcast when proven small, so the fact
table is scanned twice but never shuffled. Beyond the bound it is a shuffle
join keyed by group *and* value, which spreads a hot group over many tasks.
No window over a whole group is used: a group may hold a third of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_BYTES, measure


def top_per_group(df: DataFrame, group: str | Sequence[str], value: str,
                  keep: Sequence[str] = (), max_alias: str | None = None,
                  sort: bool = True,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """All rows of ``df`` whose ``value`` equals its group's maximum.

    Returns ``group..., keep..., value`` (``value`` renamed to ``max_alias``
    when given), sorted by group."""
    groups = [group] if isinstance(group, str) else list(group)
    cols = groups + [c for c in keep if c not in groups] + [value]
    base = df.select(*cols).where(F.col(value).isNotNull())
    maxima = base.groupBy(*groups).agg(F.max(value).alias(value))
    side = measure(maxima, max_broadcast_bytes).side()
    out = base.join(side, groups + [value], "left_semi")
    if max_alias:
        out = out.withColumnRenamed(value, max_alias)
    return out.orderBy(*groups) if sort else out


def max_per_group(df: DataFrame, group: str | Sequence[str], value: str,
                  alias: str = "max_value") -> DataFrame:
    """Only the maximum per group (the MapReduce job's output)."""
    groups = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*groups).agg(F.max(value).alias(alias))


def argmax_per_group(df: DataFrame, group: str | Sequence[str], value: str,
                     keep: Sequence[str] = (),
                     max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Exactly one row per group: the maximum ``value`` and the ``keep``
    columns of a row holding it (on ties, the largest ``keep`` tuple, so the
    answer is deterministic).

    The full data only goes through the hash-aggregated maximum and a
    broadcast semi join (``top_per_group``); the tie-break aggregate, whose
    struct buffer needs a sort-based aggregate, sees only the winning rows."""
    groups = [group] if isinstance(group, str) else list(group)
    winners = top_per_group(df, groups, value, keep=keep, sort=False,
                            max_broadcast_bytes=max_broadcast_bytes)
    best = F.max(F.struct(*[F.col(c) for c in keep])) if keep else None
    aggs = [F.max(value).alias(value)] + ([best.alias("_b")] if keep else [])
    return (winners.groupBy(*groups).agg(*aggs)
            .select(*groups, *[F.col(f"_b.{c}").alias(c) for c in keep], value))
