"""End-to-end workflows of the reference, each a chain of DataFrame operators.

* ``build_graph`` (G23): text files → parsed nodes/edges → Parquet store.
* ``route_report`` (§3.2): weights → far pair → route → random routes → features.
* ``skeleton_export`` (§3.3/G22): sample → induced subgraph → weights → undirected(min) →
  communities → forest per community → dense-id node/edge export.
* ``bfs_report`` (G21): budgeted BFS → longest path → features.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.model import Graph
from geoweave.operators import community, features, forest, geo, paths, sampling, structure, traverse
from geoweave.sources import store, text

log = logging.getLogger(__name__)


def build_graph(
    spark: SparkSession,
    location_path: str,
    user_path: str,
    out_path: str | None = None,
    max_nodes: int | None = None,
    skip_first: bool = False,
    reports: dict[str, DataFrame] | None = None,
) -> tuple[Graph, DataFrame]:
    """Parse both text inputs into a graph; returns the graph and the rejected lines.

    The node count used to validate destinations is the number of *valid* location lines (as in
    the reference); with ``max_nodes`` a short file is logged and its report row (S6) put under
    ``reports["locations"]``.
    """
    loc_lines = text.read_numbered_lines(spark, location_path)
    nodes = text.parse_locations(loc_lines, max_nodes)
    rejects = text.location_rejects(loc_lines, max_nodes)
    from geoweave.plans.iterate import checkpoint

    nodes = checkpoint(nodes)
    n = nodes.count()
    if max_nodes is not None and reports is not None:
        reports["locations"] = text.location_report(loc_lines, max_nodes)
    if max_nodes is not None and (report := text.short_file_report(n, max_nodes))["short"]:
        log.warning("location input has %(actual)d nodes, fewer than the expected %(expected)d", report)
    edges = text.parse_adjacency(text.read_numbered_lines(spark, user_path), n, skip_first)
    g = Graph(nodes, edges, directed=True)
    if out_path:
        store.save_graph(g, out_path)
        g = store.load_graph(spark, out_path)
    return g, rejects


def route_report(g: Graph, n_random: int = 100, max_attempts: int = 50, seed: int = 7) -> dict[str, DataFrame]:
    """§3.2: far pair route and random context routes as DataFrames and features."""
    g = geo.edge_weights(g)
    fp = geo.farthest_pair(g.nodes).select(F.lit(-1).alias("qid"), F.col("u").alias("source"), F.col("v").alias("sink"))
    state = paths.shortest_paths(g, fp.select("qid", "source"), fp.select("qid", "sink"))
    route = paths.route_paths(state, fp)
    summary = paths.route_summary(state, fp, fp, route)
    rnd, rstate = paths.random_routes(g, n_random, max_attempts, seed, with_state=True)
    rq = rnd.select(F.col("slot").alias("qid"), F.col("u").alias("source"), F.col("v").alias("sink"), "cost")
    rnodes = paths.route_paths(rstate, rq)
    feats = features.route_features(g.nodes, rq.select("qid", "cost"), rnodes, summary, route)
    return {"route": summary, "route_nodes": route, "random_routes": rnd, "stats": paths.route_stats(rnd), "features": feats}


def skeleton_export(
    g: Graph, max_nodes: int | None = None, max_edges: int | None = None, seed: int = 42, similarity: str = "distance"
) -> dict[str, DataFrame]:
    """§3.3/G22: forest per community of the graph, exported with dense ids and the nodes' degree in
    the full graph. ``max_nodes`` analyses the induced subgraph of a sample, ``max_edges`` exports a
    sample of the forest's edges; both are off unless asked for."""
    part = structure.induced_subgraph(g, sampling.sample_nodes(g.nodes, max_nodes, seed)) if max_nodes is not None else g
    sub = geo.edge_weights(part, force_recalc=True)
    und = structure.undirected(sub, "min")
    sim = {"distance": F.col("weight"), "unit": F.lit(1.0), "inverse": F.lit(1.0) / F.nullif(F.col("weight"), F.lit(0.0))}[similarity]
    memb, _ = community.louvain(und.nodes, und.edges.withColumn("sim", sim), "sim")
    fst = forest.community_forest(und, memb)
    fe = sampling.sample_rows(fst, max_edges, seed, ("u", "v")) if max_edges is not None else fst
    ends = fe.select(F.col("u").alias("id")).unionByName(fe.select(F.col("v").alias("id"))).distinct()
    deg = structure.total_degree(g).join(ends, "id", "left_semi")
    mapping = structure.dense_ids(ends, start=0)
    nodes = mapping.join(g.nodes, "id").join(deg, "id").select(
        F.col("new_id").alias("node_id"), "lat", "lon", F.col("degree").alias("degree_original")
    )
    edges = structure.remap_edges(fe.select(F.col("u").alias("src"), F.col("v").alias("dst")), mapping).select(
        F.col("src").alias("source"), F.col("dst").alias("destination")
    )
    return {"membership": memb, "forest": fst, "export_nodes": nodes, "export_edges": edges}


def bfs_report(g: Graph, start: int, max_nodes: int = 5000) -> dict[str, DataFrame]:
    """Budgeted BFS tree, its longest path and map features."""
    tree = traverse.bfs_tree(g, start, max_nodes)
    lp = traverse.bfs_longest_path(tree)
    return {"tree": tree, "longest_path": lp, "features": features.bfs_features(g.nodes, tree, lp)}


def sampled_subgraph_tables(g: Graph, n: int, seed: int = 42, one_based: bool = False) -> dict[str, DataFrame]:
    """Sample ``n`` nodes (L5), take the induced edges (J5) and return viewer tables
    ``nodes(node_id, lat, lon)`` and ``edges(source, destination)``; ``one_based`` shifts ids by
    one as one of the reference's exports does (P4). Original ids are kept (Q29)."""
    sample = sampling.sample_nodes(g.nodes, n, seed)
    sub = structure.induced_subgraph(g, sample)
    shift = 1 if one_based else 0
    nodes = sub.nodes.select((F.col("id") + shift).alias("node_id"), "lat", "lon")
    edges = sub.edges.select((F.col("src") + shift).alias("source"), (F.col("dst") + shift).alias("destination"))
    return {"nodes": nodes, "edges": edges}
