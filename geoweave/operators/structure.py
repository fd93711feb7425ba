"""Structural operators: summary (A1), degrees (A2–A4), undirected collapse (A5), self-loops, induced subgraph (J5), dense id remap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.model import Graph
from geoweave.operators.ranking import global_rank


def graph_summary(g: Graph) -> DataFrame:
    """A1: ``(n_nodes, n_edges, directed, node_attrs, edge_attrs)`` in one aggregate."""
    counts = g.nodes.select(F.lit(1).alias("_n"), F.lit(0).alias("_m")).unionByName(
        g.edges.select(F.lit(0).alias("_n"), F.lit(1).alias("_m"))
    )
    return counts.agg(
        F.sum("_n").cast("long").alias("n_nodes"),
        F.sum("_m").cast("long").alias("n_edges"),
    ).select(
        "n_nodes",
        "n_edges",
        F.lit(g.directed).alias("directed"),
        F.lit(",".join(g.node_attrs)).alias("node_attrs"),
        F.lit(",".join(g.edge_attrs)).alias("edge_attrs"),
    )


def out_degree(g: Graph) -> DataFrame:
    """A2: successors per node, 0 for nodes without out-edges. Partial aggregation before the
    join makes hub nodes cheap."""
    deg = g.edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    return g.nodes.select("id").join(deg, F.col("id") == F.col("src"), "left").select(
        "id", F.coalesce("out_degree", F.lit(0)).cast("long").alias("out_degree")
    )


def _endpoints(edges: DataFrame, value=None) -> DataFrame:
    v = [value.alias("_v")] if value is not None else []
    return edges.select(F.col("src").alias("id"), *v).unionByName(
        edges.select(F.col("dst").alias("id"), *v)
    )


def total_degree(g: Graph) -> DataFrame:
    """A3: in + out degree; a self-loop counts twice."""
    deg = _endpoints(g.edges).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return g.nodes.select("id").join(deg, "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree")
    )


def strength(g: Graph) -> DataFrame:
    """A4: weighted degree (sum of incident weights, self-loops twice); 1 per edge if unweighted."""
    w = F.col("weight") if g.has_weight else F.lit(1.0)
    st = _endpoints(g.edges, w).groupBy("id").agg(F.sum("_v").alias("strength"))
    return g.nodes.select("id").join(st, "id", "left").select(
        "id", F.coalesce("strength", F.lit(0.0)).alias("strength")
    )


_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


def undirected(g: Graph, combine: str = "sum") -> Graph:
    """A5 (D4): collapse to canonical pairs ``(least, greatest)``; parallel and mutual edges
    are combined by ``sum``/``min``/``max`` of ``weight`` (unweighted: weight 1.0 per pair)."""
    canon = g.edges.select(
        F.least("src", "dst").alias("src"),
        F.greatest("src", "dst").alias("dst"),
        (F.col("weight") if g.has_weight else F.lit(1.0)).alias("weight"),
    )
    if g.has_weight:
        edges = canon.groupBy("src", "dst").agg(_COMBINE[combine]("weight").alias("weight"))
    else:
        edges = canon.select("src", "dst").distinct().withColumn("weight", F.lit(1.0))
    return Graph(g.nodes, edges, directed=False)


def self_loops(g: Graph) -> DataFrame:
    return g.edges.filter(F.col("src") == F.col("dst"))


def induced_subgraph(g: Graph, ids: DataFrame, id_col: str = "id") -> Graph:
    """Nodes in ``ids`` and the edges with both ends in it; original ids are kept."""
    keep = ids.select(F.col(id_col).alias("id")).distinct()
    nodes = g.nodes.join(keep, "id", "left_semi")
    edges = g.edges.join(keep.withColumnRenamed("id", "src"), "src", "left_semi").join(
        keep.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )
    return Graph(nodes, edges.select(*g.edges.columns), g.directed)


def dense_ids(nodes: DataFrame, start: int = 0) -> DataFrame:
    """``(id, new_id)`` with ``new_id`` dense in id order (distributed rank)."""
    return global_rank(nodes.select("id"), ["id"], rank_col="new_id", start=start)


def remap_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace ``src``/``dst`` by their ``new_id`` from a ``(id, new_id)`` mapping."""
    ms = mapping.select(F.col("id").alias("src"), F.col("new_id").alias("_ns"))
    md = mapping.select(F.col("id").alias("dst"), F.col("new_id").alias("_nd"))
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.join(ms, "src").join(md, "dst").select(
        F.col("_ns").alias("src"), F.col("_nd").alias("dst"), *rest
    )
