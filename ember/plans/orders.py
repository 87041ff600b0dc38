"""Order look-up queries on ``orders``, ``lineitem`` and ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import orders as ops
from ..operators.partitioning import output_parts
from ..session import scratch_path
from ..sources.store import KeyedStore
from ..sources.testdata import table
from .registry import register

_NAMES = "string_agg(p.p_name, ', ' ORDER BY l.l_linenumber, p.p_name)"
_PRICE = "CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"


def _tables(spark, sf_dir):
    return (table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
            table(spark, sf_dir, "part"))


@register("orders_part_names", oracle=f"""
SELECT o.o_orderkey, o.o_totalprice, {_NAMES} AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || {_NAMES} AS line
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY o.o_orderkey, o.o_totalprice
""")
def orders_part_names(spark, sf_dir):
    return ops.order_part_names(*_tables(spark, sf_dir))


@register("orders_bucketed_part_names", oracle=f"""
SELECT o.o_orderkey, o.o_totalprice, {_NAMES} AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || {_NAMES} AS line
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY o.o_orderkey, o.o_totalprice
""")
def orders_bucketed_part_names(spark, sf_dir):
    """The same from orders and line items stored in the same buckets of the
    order key: grouping and join by it shuffle neither."""
    orders, lineitem, part = _tables(spark, sf_dir)
    root = scratch_path(spark, "buckets")
    return ops.order_part_names(*ops.bucket_orders(orders, lineitem, f"{root}/orders", f"{root}/lineitem"), part)


@register("orders_part_names_outer", oracle=f"""
WITH n AS (
  SELECT l.l_orderkey, {_NAMES} AS names
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey)
SELECT o.o_orderkey, o.o_totalprice, coalesce(n.names, '') AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || coalesce(n.names, '') AS line
FROM orders o LEFT JOIN n ON o.o_orderkey = n.l_orderkey
""")
def orders_part_names_outer(spark, sf_dir):
    return ops.order_part_names_outer(*_tables(spark, sf_dir))


@register("orders_part_names_by_segment", oracle=f"""
WITH k AS (
  SELECT o.o_orderkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment = 'BUILDING'),
n AS (
  SELECT l.l_orderkey, {_NAMES} AS names
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_orderkey IN (SELECT o_orderkey FROM k) GROUP BY l.l_orderkey)
SELECT o.o_orderkey, o.o_totalprice, coalesce(n.names, '') AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || coalesce(n.names, '') AS line
FROM orders o LEFT JOIN n ON o.o_orderkey = n.l_orderkey
WHERE o.o_orderkey IN (SELECT o_orderkey FROM k)
""")
def orders_part_names_by_segment(spark, sf_dir):
    """Key set given as a frame (semi-join), derived from ``customer``."""
    orders, lineitem, part = _tables(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    keys = (orders.select("o_orderkey", "o_custkey")
            .join(customer.where(F.col("c_mktsegment") == "BUILDING")
                  .select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
            .select("o_orderkey"))
    return ops.order_part_names_outer(orders, lineitem, part, keys)


# Keys a caller asks for: present ones, one that no table has, one negative.
KEYS = [1, 2, 3, 7, 32, 33, 64, 100, 128, 255, 256, 511, 777, 999, 1000, 1234, -5, 10 ** 12]
_KEYS = ", ".join(map(str, KEYS))


@register("orders_by_keys", oracle=f"""
SELECT o.o_orderkey, o.o_totalprice, {_NAMES} AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || {_NAMES} AS line
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN part p ON l.l_partkey = p.p_partkey WHERE o.o_orderkey IN ({_KEYS})
GROUP BY o.o_orderkey, o.o_totalprice
""")
def orders_by_keys(spark, sf_dir):
    """Look-up of a list of keys: pushed into both scans."""
    return ops.order_part_names(*_tables(spark, sf_dir), keys=KEYS)


@register("orders_by_keys_outer", oracle=f"""
WITH n AS (
  SELECT l.l_orderkey, {_NAMES} AS names
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey)
SELECT o.o_orderkey, o.o_totalprice, coalesce(n.names, '') AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || coalesce(n.names, '') AS line
FROM orders o LEFT JOIN n ON o.o_orderkey = n.l_orderkey WHERE o.o_orderkey IN ({_KEYS})
""")
def orders_by_keys_outer(spark, sf_dir):
    return ops.order_part_names_outer(*_tables(spark, sf_dir), keys=KEYS)


@register("orders_denormalized_by_keys", oracle=f"""
SELECT o.o_orderkey, o.o_totalprice, {_NAMES} AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || {_NAMES} AS line
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN part p ON l.l_partkey = p.p_partkey WHERE o.o_orderkey IN ({_KEYS})
GROUP BY o.o_orderkey, o.o_totalprice
""")
def orders_denormalized_by_keys(spark, sf_dir):
    """The same look-up from the nested table, bucketed by order key: only the
    keys' buckets are opened."""
    store = KeyedStore(spark, root=scratch_path(spark, "store"))
    nested = ops.denormalize_orders(*_tables(spark, sf_dir))
    store.append(nested, "tpch", "orders_parts", key="o_orderkey", buckets=output_parts(nested))
    return ops.lookup_denormalized(store.read("tpch", "orders_parts", view=False), KEYS)


@register("orders_denormalized_lookup", oracle=f"""
SELECT o.o_orderkey, o.o_totalprice, {_NAMES} AS part_names,
       'Order #' || o.o_orderkey || ' $' || {_PRICE} || ': ' || {_NAMES} AS line
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY o.o_orderkey, o.o_totalprice
""")
def orders_denormalized_lookup(spark, sf_dir):
    """Build the nested table once into a keyed store (range-clustered by
    order key), then answer look-ups from the store's copy with no join."""
    nested = ops.denormalize_orders(*_tables(spark, sf_dir))
    store = KeyedStore(spark, root=scratch_path(spark, "store"))
    store.append(nested, "tpch", "orders_parts", key="o_orderkey", parallelism=output_parts(nested))
    return ops.lookup_denormalized(store.read("tpch", "orders_parts", view=False))
