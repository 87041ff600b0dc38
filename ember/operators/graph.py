"""Bounded breadth-first shortest path over an edge table.

``shortest_path_known`` expands a frontier hop by hop (a join of the frontier
with the edges), keeps the smallest parent id for a node reached from several
parents in one hop, removes already known nodes (left anti join), and adds the
new level to the known-paths table ``node, source, distance``. It stops when
the target is in the frontier, when the frontier is empty, or after
``max_hops`` hops - then the result is empty, as in the reference.

Scale notes:
* The edges are written once under the shared checkpoint folder, bucketed by
  hash of the source, so no hop ever shuffles them: a small frontier is
  broadcast, a large one is shuffled to the edges' buckets. A source with very
  many edges (a hub may have a third of all) is cut into parts by a hash of the
  destination, so its edges lie in many buckets; the frontier's row of a hub is
  repeated for its parts.
* Each new level is written once as Parquet; the known table is the union
  of the written levels, so lineage stays one hop long and a lost executor
  re-reads a level instead of replaying every hop.
* The frontier is broadcast only when its counted size is within the bound. An
  ``Observation`` on the level's write gives both that count and the
  target test, with no extra job.
* Levels hold parent pointers only (no path arrays), so storage stays one row
  of three columns per node; ``shortest_path`` rebuilds the path with one
  chained join over the levels (one row per level), in a single job.
The driver loop runs at most ``max_hops + 1`` times and reads only counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path
from ..sinks import write_snapshot
from ..sources.store import read_bucketed, write_bucketed
from .joins import DEFAULT_BROADCAST_BYTES, Measured, measure, row_bytes
from .partitioning import output_parts, spread

KNOWN_SCHEMA = T.StructType([
    T.StructField("node", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("distance", T.IntegerType(), False),
])


def adjacency_edges(lines: DataFrame, col: str = "value") -> DataFrame:
    """``"s: d1 d2 ..."`` lines to ``source, destination`` rows; lines with
    no targets (or no colon) produce nothing, blank tokens are dropped."""
    v = F.col(col)
    src = F.trim(F.substring_index(v, ":", 1))
    rest = F.when(F.instr(v, ":") > 0, F.expr(f"substr({col}, instr({col}, ':') + 1)"))
    dests = F.filter(F.split(F.coalesce(rest, F.lit("")), " "), lambda d: d != "")
    return lines.select(src.alias("source"), F.explode(dests).alias("destination"))


def _parts(edges: DataFrame, most: int) -> Measured:
    """``source, parts`` of the nodes with more than ``most`` edges: at most one
    row for ``most`` edges, measured before it is broadcast."""
    counts = edges.groupBy("source").agg(F.count("*").alias("c")).where(F.col("c") > most)
    return measure(counts.select("source", F.ceil(F.col("c") / most).alias("parts")))


def _dealt(edges: DataFrame, parts: Measured) -> DataFrame:
    """``edges`` with the ``part`` of its source that each belongs to."""
    return edges.join(parts.side(), "source", "left").withColumn(
        "part", F.pmod(F.xxhash64("destination"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")


def adjacency_lines(edges: DataFrame, per_line: int = 4096) -> DataFrame:
    """The ``"s: d1 d2 ..."`` lines (``value``) that ``adjacency_edges`` reads. A
    node of more than ``per_line`` edges gets several lines, by a hash of the
    destination, so no group grows with the data; equal edges are written once."""
    edges = materialize(edges, "edges")
    return (_dealt(edges, _parts(edges, per_line)).groupBy("source", "part")
            .agg(F.collect_set("destination").alias("to"))
            .select(F.concat_ws(" ", F.concat("source", F.lit(":")), F.concat_ws(" ", "to")).alias("value")))


@dataclass
class EdgeTable:
    """Edges stored in buckets of (source, part)."""
    edges: DataFrame
    parts: Measured

    def next_nodes(self, frontier: DataFrame, broadcast: bool) -> DataFrame:
        """``node, source``: the nodes one hop from ``frontier`` (column
        ``source``), each with its least parent. The edges are not shuffled."""
        if broadcast:
            met = self.edges.join(F.broadcast(frontier), "source")
        else:
            last = F.coalesce("parts", F.lit(1)).cast("int") - 1
            wide = frontier.join(self.parts.side(), "source", "left").select(
                "source", F.explode(F.sequence(F.lit(0), last)).alias("part"))
            met = self.edges.join(wide, ["source", "part"])
        return met.groupBy(F.col("destination").alias("node")).agg(F.min("source").alias("source"))


def edge_table(edges: DataFrame, per_part: int = 1 << 20, buckets: int | None = None) -> EdgeTable:
    """``edges`` (``source, destination``) written once by hash of the source;
    links without an end are left out. ``per_part`` is the number of edges of
    one source that lie together."""
    e = (edges.select(F.col("source").cast("string"), F.col("destination").cast("string"))
         .where(F.col("source").isNotNull() & F.col("destination").isNotNull()))
    e = materialize(spread(e), "bfs_edges")
    parts = _parts(e, per_part)
    path = scratch_path(edges.sparkSession, "bfs_buckets")
    write_bucketed(_dealt(e, parts), path, ["source", "part"], buckets or output_parts(e))
    return EdgeTable(read_bucketed(edges.sparkSession, path), parts)


def _empty(spark) -> DataFrame:
    return spark.createDataFrame([], KNOWN_SCHEMA)


def shortest_path_known(edges: DataFrame | EdgeTable, src: str, dst: str, max_hops: int = 6,
                        max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                        snapshot_dir: str | None = None) -> DataFrame:
    """Known-paths table ``node, source, distance`` at the hop the target was
    found; empty when it is not reachable within ``max_hops``. ``edges`` is a
    frame, or an ``edge_table`` that several searches share.

    ``snapshot_dir`` also writes the known table after every hop as JSON
    (``<dir>/iter<i>``), as the reference did."""
    levels = _search(edges, src, dst, max_hops, max_broadcast_bytes, snapshot_dir)
    return _union(levels) if levels else _empty(_session(edges))


def _session(edges: DataFrame | EdgeTable):
    return (edges.edges if isinstance(edges, EdgeTable) else edges).sparkSession


def _search(edges, src, dst, max_hops, max_broadcast_bytes, snapshot_dir):
    """The written levels 0..d (d = distance of ``dst``), or None."""
    spark = _session(edges)
    frontier = spark.createDataFrame([(src, None, 0)], KNOWN_SCHEMA)
    if src == dst:
        return [frontier]
    table = edges if isinstance(edges, EdgeTable) else edge_table(edges)
    levels = [frontier]
    size, found = 0, False
    for hop in range(max_hops + 1):
        if snapshot_dir:
            write_snapshot(_union(levels), snapshot_dir, hop)
        if found:
            return levels
        if hop == max_hops:
            return None
        # bytes, counted as the level was written
        best = table.next_nodes(frontier.select(F.col("node").alias("source")), size <= max_broadcast_bytes)
        fresh = (best.join(_union(levels).select("node"), "node", "left_anti")
                 .select("node", "source", F.lit(hop + 1).alias("distance")))
        # the level's size and the target test come from the write itself
        obs = Observation(f"bfs_level{hop + 1}")
        frontier = materialize(
            fresh.observe(obs, F.count(F.lit(1)).alias("n"),
                          F.sum(row_bytes(frontier.select("node").schema)).alias("bytes"),
                          F.max((F.col("node") == dst).cast("int")).alias("hit")),
            f"bfs_level{hop + 1}")
        stats = obs.get
        size, found = stats["bytes"] or 0, bool(stats["hit"])
        if stats["n"] == 0:
            return None
        levels.append(frontier)
    return None


def _union(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for lvl in levels[1:]:
        out = out.unionByName(lvl)
    return out


def shortest_path(edges: DataFrame | EdgeTable, src: str, dst: str, max_hops: int = 6,
                  **kw) -> DataFrame:
    """The path from ``src`` to ``dst`` as ``pos, node`` rows (empty when none).

    Following parent pointers back from the target is one chained join over
    the levels (each side one row), evaluated as a single job."""
    spark = _session(edges)
    levels = _search(edges, src, dst, max_hops,
                     kw.get("max_broadcast_bytes", DEFAULT_BROADCAST_BYTES), kw.get("snapshot_dir"))
    if not levels:
        return spark.createDataFrame([], "pos int, node string")
    d = len(levels) - 1
    chain = levels[d].where(F.col("node") == dst).select(
        F.col("node").alias(f"n{d}"), F.col("source").alias(f"n{d - 1}") if d else F.lit(None))
    for k in range(d - 1, 0, -1):
        step = levels[k].select(F.col("node").alias(f"n{k}"), F.col("source").alias(f"n{k - 1}"))
        chain = chain.join(step, f"n{k}")
    nodes = F.array(*[F.col(f"n{k}") for k in range(d + 1)])
    return chain.select(F.posexplode(nodes).alias("pos", "node")).select(
        F.col("pos").cast("int"), "node")
