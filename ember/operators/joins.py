"""Join helpers: a size-checked broadcast with a shuffle-join fallback.

A side is broadcast only after it has been materialised and measured. The
measured side is written as Parquet under the shared checkpoint folder, so
the expensive input that produced it is scanned once, and a lost executor
re-reads that copy instead of recomputing it. Beyond the bound the join is
left to the planner: a shuffle join, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Bytes of a value whose type has a fixed width; others are measured.
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row: texts and binaries by their length, nested values by
    the length of their JSON, plus 16 for the row itself."""
    total = F.lit(16).cast("long")
    for field in schema.fields:
        col = F.col(f"`{field.name}`")
        if type(field.dataType) in _WIDTHS:
            total = total + F.lit(_WIDTHS[type(field.dataType)])
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        else:
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return total


@dataclass
class Measured:
    df: DataFrame
    rows: int
    bytes: int
    small: bool

    def side(self) -> DataFrame:
        """The frame to join with: broadcast-hinted only when proven small."""
        return F.broadcast(self.df) if self.small else self.df


def measure(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> Measured:
    """Materialise a derived (normally aggregated) frame and measure it."""
    materialised = materialize(df, "measured")
    rows, size = materialised.agg(F.count(F.lit(1)), F.sum(row_bytes(materialised.schema))).first()
    return Measured(materialised, rows, size or 0, (size or 0) <= max_bytes)


#: Bits of a row filter; its broadcast has a row for 64 bits at most (about 48 MB).
FILTER_BITS = 1 << 27


def row_filter(big: DataFrame, key: str, keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``big`` whose key may be among ``keys`` (one column), found
    before ``big`` is shuffled.

    A bitmap of ``bits`` bits has the hashes of the keys, 64 to a row; its rows
    are broadcast, a bound that does not grow with the keys. No row whose key is
    among them is lost; of the others about (keys / bits) stay, so an exact join
    follows. Null keys go. Meant for key sets too large to broadcast themselves."""
    def word(place: Column) -> Column:
        return F.shiftright(place, 6)

    def place(col: Column) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(bits).cast("long"))

    col = F.col(keys.columns[0]).cast(big.schema[key].dataType)
    bit = F.expr("shiftleft(1L, CAST(_at & 63 AS INT))")
    bitmap = (keys.where(col.isNotNull()).select(place(col).alias("_at")).groupBy(word(F.col("_at")).alias("_word"))
              .agg(F.bit_or(bit).alias("_bits")))
    marked = big.where(F.col(key).isNotNull()).withColumn("_at", place(F.col(key))).withColumn("_word", word(F.col("_at")))
    hit = marked.join(F.broadcast(bitmap), "_word").where(F.getbit("_bits", (F.col("_at").bitwiseAND(F.lit(63))).cast("int")) == 1)
    return hit.select(*(F.col(f"`{c}`") for c in big.columns))


def semi_join(big: DataFrame, key: str, keys: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The rows of ``big`` whose ``key`` is among ``keys`` (one column of a
    written table). Keys within ``max_bytes`` are broadcast; beyond that the
    rows that cannot match go by ``row_filter`` and only the rest is shuffled."""
    k = keys.select(F.col(keys.columns[0]).alias(key))
    rows, size = k.agg(F.count(F.lit(1)), F.sum(row_bytes(k.schema))).first()
    if (size or 0) <= max_bytes:
        return big.join(F.broadcast(k), key, "left_semi")
    # a bitmap that is mostly full would keep nearly every row
    rest = row_filter(big, key, k) if rows <= FILTER_BITS // 2 else big
    return rest.join(k, key, "left_semi")


def salted_join(big: DataFrame, small: DataFrame, on: list[str], buckets: int,
                how: str = "inner") -> DataFrame:
    """Shuffle join that spreads a hot key of ``big`` over ``buckets`` tasks.

    Each ``big`` row gets a salt from a hash of its own values (deterministic,
    so a retried task makes the same choice); every ``small`` row is repeated
    once per salt. A ``big`` row meets exactly the ``small`` rows it would
    have met without salting, so inner and left joins give the same result.
    For clusters where AQE's skew-join splitting is off or does not apply;
    both sides are shuffled, as ``small`` is one that must not be broadcast."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salting keeps {how} join results only for big-side-preserving joins")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets)).cast("int")
    b = big.withColumn("_salt", salt)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s.hint("merge"), list(on) + ["_salt"], how).drop("_salt")
