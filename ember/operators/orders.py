"""Order look-ups with the names of their parts.

Three designs of one query, as in the reference:

* ``order_part_names``      - join orders, line items and parts, concatenate
                               part names per order (inner: orders without
                               items vanish).
* ``order_part_names_outer``- every requested order comes back; ``part_names``
                               is empty when it has no items.
* ``denormalize_orders`` + ``lookup_denormalized`` - build the nested table
                               once (orders + ``part_names`` array), then
                               answer look-ups from it with no join.

Part names inside an order are ordered by line number, then name, so the
output is deterministic (the reference's order was whatever the reduce saw).

Keys may be ``None`` (all orders), a Python list of any type and length
(``isin``, pushed into the Parquet scan), or a one-column DataFrame of keys
(broadcast within a bound; beyond it a bitmap of the keys drops most other line
items before any is shuffled). A key set too long for the driver belongs in a
frame; the caller chooses.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.store import read_bucketed, write_bucketed
from .joins import DEFAULT_BROADCAST_BYTES, semi_join
from .partitioning import output_parts


def _restrict(df: DataFrame, key_col: str, keys, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        return semi_join(df, key_col, keys, max_broadcast_bytes)
    return df.where(F.col(key_col).isin(list(keys)))


def _ordered_names(lineitem: DataFrame, part: DataFrame, keys,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """(l_orderkey, names array<string>) ordered by line number, then name."""
    li = _restrict(lineitem.select("l_orderkey", "l_partkey", "l_linenumber"),
                   "l_orderkey", keys, max_broadcast_bytes)
    items = li.join(part.select("p_partkey", "p_name"),
                    F.col("l_partkey") == F.col("p_partkey"))
    return (items.groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "p_name")))
                 .alias("_items"))
            .select("l_orderkey",
                    F.transform("_items", lambda x: x["p_name"]).alias("names")))


def money(price) -> F.Column:
    """Two-decimal price rounded on the exact binary value, as Python's
    ``%.2f`` does (``format_string`` rounds the shortest decimal form half-up,
    so 2.675 would print 2.68 instead of 2.67)."""
    return F.regexp_replace(F.format_number(price, 2), ",", "")


def format_order_line(key, price, names) -> F.Column:
    """``Order #<key> $<price .2f>: <names>``."""
    return F.format_string("Order #%d $%s: %s", key, money(price), names)


def order_part_names(orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                     keys: Iterable | DataFrame | None = None,
                     outer: bool = False,
                     max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Part names per order.

    Returns ``o_orderkey, o_totalprice, part_names, line``. With
    ``outer=True`` orders that have no line items are kept with an empty
    ``part_names``."""
    o = orders.select("o_orderkey", "o_totalprice")
    if isinstance(keys, DataFrame):
        # the chosen orders are written once; both sides below read that copy
        keys = keys.select(F.col(keys.columns[0]).alias("o_orderkey"))
        o = materialize(o.join(keys, "o_orderkey", "left_semi"), "orders")
        keys = o.select("o_orderkey")
    else:
        o = _restrict(o, "o_orderkey", keys)
    names = _ordered_names(lineitem, part, keys, max_broadcast_bytes)
    joined = o.join(names, F.col("o_orderkey") == F.col("l_orderkey"),
                    "left" if outer else "inner")
    part_names = F.coalesce(F.array_join("names", ", "), F.lit(""))
    return joined.select(
        "o_orderkey", "o_totalprice",
        part_names.alias("part_names"),
        format_order_line(F.col("o_orderkey"), F.col("o_totalprice"), part_names).alias("line"),
    )


def order_part_names_outer(orders, lineitem, part, keys=None) -> DataFrame:
    return order_part_names(orders, lineitem, part, keys, outer=True)


def denormalize_orders(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """All order columns plus ``part_names array<string>``; orders with items only."""
    names = _ordered_names(lineitem, part, None)
    return (orders.join(names, F.col("o_orderkey") == F.col("l_orderkey"))
            .drop("l_orderkey")
            .withColumnRenamed("names", "part_names"))


def write_denormalized(df: DataFrame, path: str, files: int | None = None) -> None:
    """Store the nested table range-partitioned and sorted by order key, so a
    key look-up reads only the row groups whose min/max cover its keys."""
    n = files or output_parts(df)
    (df.repartitionByRange(n, "o_orderkey")
       .sortWithinPartitions("o_orderkey")
       .write.mode("overwrite").parquet(path))


def lookup_denormalized(denorm: DataFrame, keys=None) -> DataFrame:
    """Answer look-ups from the nested table: no join at read time."""
    d = _restrict(denorm.select("o_orderkey", "o_totalprice", "part_names"),
                  "o_orderkey", keys)
    names = F.array_join("part_names", ", ")
    return d.select("o_orderkey", "o_totalprice", names.alias("part_names"),
                    format_order_line(F.col("o_orderkey"), F.col("o_totalprice"), names)
                    .alias("line"))


def bucket_orders(orders: DataFrame, lineitem: DataFrame, orders_path: str, lineitem_path: str,
                  buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Orders and line items stored in the same buckets of the order key, so
    that later joins and look-ups by it shuffle neither. As many buckets as the
    larger table has parts by its bytes, unless given."""
    n = buckets or max(output_parts(orders), output_parts(lineitem))
    write_bucketed(orders, orders_path, "o_orderkey", n)
    write_bucketed(lineitem, lineitem_path, "l_orderkey", n)
    spark = orders.sparkSession
    return read_bucketed(spark, orders_path), read_bucketed(spark, lineitem_path)
