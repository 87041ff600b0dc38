"""Bounded BFS over the link graph region -> nation -> customer -> order -> part."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.graph import adjacency_edges, adjacency_lines, shortest_path, shortest_path_known
from ..session import scratch_path
from ..sources import standins
from ..sources.testdata import table
from ..sources.text import read_lines
from .registry import register

SRC, DST, MAX_HOPS = "r0", "p7", 6

# Links back from every nation and to itself close cycles, so nodes are met
# again at later hops.
_CYCLES = """
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'n' || n_nationkey, 'n' || n_nationkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer"""

_EDGES = """
e AS (
  SELECT 'r' || n_regionkey AS source, 'n' || n_nationkey AS destination FROM nation
  UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
  UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders
  UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem)"""

def _known(edges: str, src: str, dst: str) -> str:
    return f"""
WITH RECURSIVE {edges},
reach(node, distance) AS (
  SELECT '{src}', 0
  UNION
  SELECT e.destination, reach.distance + 1 FROM reach JOIN e ON e.source = reach.node
  WHERE reach.distance < {MAX_HOPS}),
d AS MATERIALIZED (SELECT node, min(distance) AS distance FROM reach GROUP BY node),
k AS MATERIALIZED (SELECT * FROM d WHERE distance <= (SELECT distance FROM d WHERE node = '{dst}')),
par AS MATERIALIZED (
  SELECT k.node, min(e.source) AS source FROM k
  JOIN e ON e.destination = k.node
  JOIN k p ON p.node = e.source AND p.distance = k.distance - 1
  GROUP BY k.node)"""


def _edges(spark, sf_dir):
    t = {n: table(spark, sf_dir, n) for n in ("nation", "customer", "orders", "lineitem")}
    return standins.link_edges(t["nation"], t["customer"], t["orders"], t["lineitem"])


_KNOWN = _known(_EDGES, SRC, DST)


@register("bfs_known_paths", oracle=_KNOWN + """
SELECT k.node, par.source, CAST(k.distance AS INTEGER) AS distance
FROM k LEFT JOIN par ON par.node = k.node
""")
def bfs_known_paths(spark, sf_dir):
    known = shortest_path_known(_edges(spark, sf_dir), SRC, DST, MAX_HOPS)
    return known.select("node", "source", "distance")


@register("bfs_path", oracle=_KNOWN + f""",
walk(back, node) AS (
  SELECT 0, '{DST}' WHERE EXISTS (SELECT 1 FROM k WHERE node = '{DST}')
  UNION ALL
  SELECT walk.back + 1, par.source FROM walk JOIN par ON par.node = walk.node)
SELECT CAST((SELECT max(back) FROM walk) - back AS INTEGER) AS pos, node FROM walk
""")
def bfs_path(spark, sf_dir):
    return shortest_path(_edges(spark, sf_dir), SRC, DST, MAX_HOPS).select(
        F.col("pos").cast("int").alias("pos"), "node")


def _adjacency(spark, sf_dir):
    """The cyclic graph as adjacency text, ``node: a b c`` lines of bounded
    length, written and scanned again."""
    t = {n: table(spark, sf_dir, n) for n in ("nation", "customer", "orders", "lineitem")}
    edges = standins.link_edges(t["nation"], t["customer"], t["orders"], t["lineitem"]).unionByName(
        standins.back_links(t["nation"], t["customer"]))
    path = scratch_path(spark, "adjacency")
    adjacency_lines(edges).write.text(path)
    return adjacency_edges(read_lines(spark, path))


_CYCLIC = _EDGES.rstrip(")") + _CYCLES + ")"


@register("bfs_adjacency_cycles", oracle=_known(_CYCLIC, "n3", DST) + """
SELECT k.node, par.source, CAST(k.distance AS INTEGER) AS distance
FROM k LEFT JOIN par ON par.node = k.node
""")
def bfs_adjacency_cycles(spark, sf_dir):
    return shortest_path_known(_adjacency(spark, sf_dir), "n3", DST, MAX_HOPS).select("node", "source", "distance")


@register("bfs_same_node", oracle="SELECT CAST(0 AS INTEGER) AS pos, 'n3' AS node FROM nation WHERE n_nationkey = 3")
def bfs_same_node(spark, sf_dir):
    """Source and target are one node: a path of that node alone, if the node is
    there. Its link to itself says so, which only its nation row gives."""
    edges = _adjacency(spark, sf_dir)
    there = edges.where((F.col("source") == "n3") & (F.col("destination") == "n3")).select(F.col("source").alias("node"))
    return shortest_path(edges, "n3", "n3", MAX_HOPS).join(there, "node", "left_semi").select(
        F.col("pos").cast("int").alias("pos"), "node")
