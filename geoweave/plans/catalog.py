"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the fixture graphs of ``sources.fixtures``) and
runs over the whole tables. Column names match the SQL oracles in ``plans.oracles``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.operators import geo, quality, sampling, structure
from geoweave.plans.iterate import checkpoint, release
from geoweave.session import ensure_checkpoint_dir
from geoweave.sources import fixtures, text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _f1(spark, sf):
    return fixtures.part_graph(spark, sf)


def _f1w(spark, sf):
    return geo.edge_weights(_f1(spark, sf))


@register("graph_summary")
def q_graph_summary(spark, sf):
    return structure.graph_summary(_f1w(spark, sf))


@register("out_degree")
def q_out_degree(spark, sf):
    return structure.out_degree(_f1(spark, sf))


@register("total_degree")
def q_total_degree(spark, sf):
    return structure.total_degree(_f1(spark, sf))


@register("strength")
def q_strength(spark, sf):
    st = structure.strength(fixtures.order_multigraph(spark, sf))
    return st.select("id", F.round("strength", 4).alias("strength"))


@register("edge_weights")
def q_edge_weights(spark, sf):
    e = _f1w(spark, sf).edges
    return e.select("src", "dst", F.round("weight", 6).alias("weight"))


@register("undirected_sum")
def q_undirected_sum(spark, sf):
    e = structure.undirected(fixtures.order_multigraph(spark, sf), "sum").edges
    return e.select("src", "dst", F.round("weight", 4).alias("weight"))


@register("undirected_min")
def q_undirected_min(spark, sf):
    return structure.undirected(fixtures.order_multigraph(spark, sf), "min").edges


@register("self_loops")
def q_self_loops(spark, sf):
    return structure.self_loops(_f1(spark, sf)).select(F.col("src").alias("id"))


@register("inspection_table")
def q_inspection_table(spark, sf):
    return quality.inspection_table(_f1(spark, sf), 50)


@register("quality_checks")
def q_quality_checks(spark, sf):
    g = _f1(spark, sf)
    # the line items are more than the distinct links between parts, so this check reports a difference
    n_items = fixtures.table(spark, sf, "lineitem").count()
    return quality.quality_checks(g, expected_nodes=_n_parts(spark, sf), expected_edges=n_items)


@register("bbox_extremes")
def q_bbox_extremes(spark, sf):
    return geo.bbox_extremes(_f1(spark, sf).nodes)


@register("farthest_pair")
def q_farthest_pair(spark, sf):
    fp = geo.farthest_pair(_f1(spark, sf).nodes)
    return fp.select("u", "v", F.round("distance_km", 6).alias("distance_km"))


@register("centroid")
def q_centroid(spark, sf):
    c = geo.centroid(_f1(spark, sf).nodes)
    return c.select(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "n_nodes")


def _n_parts(spark, sf) -> int:
    return fixtures.table(spark, sf, "part").count()


@register("parse_adjacency")
def q_parse_adjacency(spark, sf):
    return text.parse_adjacency(fixtures.adjacency_lines(spark, sf), _n_parts(spark, sf))


@register("parse_locations")
def q_parse_locations(spark, sf):
    return text.parse_locations(fixtures.location_lines(spark, sf))


@register("line_rejects")
def q_line_rejects(spark, sf):
    return text.location_rejects(fixtures.location_lines(spark, sf))


@register("location_report")
def q_location_report(spark, sf):
    return text.location_report(fixtures.location_lines(spark, sf), _n_parts(spark, sf) + 10)


@register("numbered_lines")
def q_numbered_lines(spark, sf):
    """F5 adjacency lines written as text files and numbered from the files alone."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    lines = fixtures.adjacency_lines(spark, sf).repartitionByRange("line_no").sortWithinPartitions("line_no")
    lines.select("value").write.text(folder)
    return text.read_numbered_lines(spark, folder)


@register("sample_nodes")
def q_sample_nodes(spark, sf):
    return sampling.sample_nodes(_f1(spark, sf).nodes, 500, seed=42)


@register("induced_subgraph")
def q_induced_subgraph(spark, sf):
    g = _f1(spark, sf)
    s = sampling.sample_nodes(g.nodes, 500, seed=42)
    return structure.induced_subgraph(g, s).edges


@register("sample_edges")
def q_sample_edges(spark, sf):
    return sampling.sample_edges(_f1(spark, sf).edges, 1000, seed=42)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoke query: great-circle shortest distances from node 0 over the haversine-weighted part
    graph (frontier relaxation), with each node's out-degree: ``(id, dist, out_degree)``."""
    g = _f1w(spark, sf_dir)
    src = g.nodes.filter(F.col("id") == 0).select(F.lit(0).alias("qid"), F.col("id").alias("source"))
    from geoweave.operators import paths as _paths

    st = _paths.shortest_paths(g, src).select("id", F.round("dist", 6).alias("dist"))
    return structure.out_degree(_f1(spark, sf_dir)).join(st, "id", "left").select("id", "dist", "out_degree")


# ---- traversal -----------------------------------------------------------------------------

from geoweave.operators import paths, traverse  # noqa: E402


@register("bfs_levels")
def q_bfs_levels(spark, sf):
    return traverse.bfs_tree(_f1(spark, sf), 0)


def _levels(spark, sf):
    g = _f1(spark, sf)
    return traverse.reachable(g, traverse.resolve_start(g, 0).select(F.col("id").alias("source"), "id"))


@register("bfs_level_histogram")
def q_bfs_level_histogram(spark, sf):
    # levels need no visit order
    t = _levels(spark, sf)
    return t.groupBy("level").agg(F.count(F.lit(1)).alias("n_nodes"))


@register("reachable_count")
def q_reachable_count(spark, sf):
    g = _f1(spark, sf)
    src = traverse.resolve_start(g, 0).select(F.col("id").alias("source"), "id")
    r = traverse.reachable(g, src)
    return r.groupBy("source").agg(F.count(F.lit(1)).alias("n_reached"))


@register("farthest_node")
def q_farthest_node(spark, sf):
    return traverse.farthest_node(_levels(spark, sf))


@register("bfs_longest_path")
def q_bfs_longest_path(spark, sf):
    return traverse.bfs_longest_path(traverse.bfs_tree(_f1(spark, sf), 0))


@register("bfs_budget")
def q_bfs_budget(spark, sf):
    return traverse.bfs_tree(_f1(spark, sf), 0, max_nodes=500)


@register("sssp_distances")
def q_sssp_distances(spark, sf):
    g = _f1w(spark, sf)
    src = g.nodes.filter(F.col("id") == 0).select(F.lit(0).alias("qid"), F.col("id").alias("source"))
    st = paths.shortest_paths(g, src)
    return st.select("id", F.round("dist", 6).alias("dist"))


def _far_route(g, sides=(None, None)):
    fp = geo.farthest_pair(g.nodes).select(F.lit(0).alias("qid"), F.col("u").alias("source"), F.col("v").alias("sink"))
    state = paths.shortest_paths(g, fp.select("qid", "source"), fp.select("qid", "sink"), edges=sides[0], back=sides[1])
    route = paths.route_paths(state, fp)
    return fp, state, route


@register("route_cost")
def q_route_cost(spark, sf):
    fp, state, route = _far_route(_f1w(spark, sf))
    s = paths.route_summary(state, fp, fp, route)
    return s.select("source", "sink", F.round("cost", 6).alias("cost"), "hops")


@register("route_nodes")
def q_route_nodes(spark, sf):
    _, _, route = _far_route(_f1w(spark, sf))
    return route.select("pos", "id")


def _f4_tree(spark, sf):
    g = fixtures.hierarchy_tree(spark, sf)
    roots = g.nodes.filter(F.col("id") == 0).select("id")
    return traverse.tree_depths(g.edges, roots)


@register("tree_preorder")
def q_tree_preorder(spark, sf):
    return traverse.tree_preorder(_f4_tree(spark, sf))


@register("dfs_deepest")
def q_dfs_deepest(spark, sf):
    return traverse.deepest_in_preorder(traverse.tree_preorder(_f4_tree(spark, sf)))


# ---- components, forests, communities ------------------------------------------------------

from geoweave.operators import community, components, forest  # noqa: E402


def _f3(spark, sf):
    return fixtures.pair_graph(spark, sf)


def _f3_once(spark, sf):
    """The same graph for queries that read its edges several times: they are built and written once."""
    g = _f3(spark, sf)
    return g.with_edges(checkpoint(g.edges))


@register("components")
def q_components(spark, sf):
    g = fixtures.order_graph(spark, sf)
    return components.connected_components(g.nodes, g.edges)


@register("component_sizes")
def q_component_sizes(spark, sf):
    g = fixtures.order_graph(spark, sf)
    return components.component_sizes(components.connected_components(g.nodes, g.edges))


@register("spanning_forest_edges")
def q_spanning_forest_edges(spark, sf):
    g = _f3(spark, sf)
    return forest.spanning_forest(g.nodes, g.edges)


@register("spanning_forest_total")
def q_spanning_forest_total(spark, sf):
    g = _f3(spark, sf)
    t = forest.forest_total(forest.spanning_forest(g.nodes, g.edges))
    return t.select("n_edges", F.round("total_weight", 3).alias("total_weight"))


def _lpa3(spark, sf):
    g = _f3_once(spark, sf)
    labels, _ = community.label_propagation(g.nodes, g.edges, max_iter=3)
    return g, labels


@register("label_propagation_3")
def q_label_propagation_3(spark, sf):
    return _lpa3(spark, sf)[1]


@register("lpa_changes")
def q_lpa_changes(spark, sf):
    g = _f3_once(spark, sf)
    _, changes = community.label_propagation(g.nodes, g.edges, max_iter=10)
    # the per-iteration counters are driver-side scalars: one row per iteration
    rows = [(i + 1, int(c)) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, "iteration int, changes long")


def _membership(labels):
    return labels.select("id", F.col("label").alias("community"))


@register("community_selection")
def q_community_selection(spark, sf):
    _, labels = _lpa3(spark, sf)
    return community.select_communities(_membership(labels), num_random=20, seed=42)


@register("community_internal_edges")
def q_community_internal_edges(spark, sf):
    g, labels = _lpa3(spark, sf)
    return community.internal_edges(_membership(labels), g.edges)


@register("contract_communities")
def q_contract_communities(spark, sf):
    g, labels = _lpa3(spark, sf)
    cw = community.canonical_weighted(g.edges, "weight")
    c = community.contract(_membership(labels), cw)
    # sums of 6-decimal weights are exact on the 6-decimal grid; coarser rounding can sit on a
    # rounding boundary where summation order decides
    return c.select("u", "v", F.round("w", 6).alias("w"))


@register("lpa_modularity")
def q_lpa_modularity(spark, sf):
    g, labels = _lpa3(spark, sf)
    cw = checkpoint(community.canonical_weighted(g.edges, "weight"))
    q = community.modularity(_membership(labels), cw)
    return q.select(F.round("modularity", 6).alias("modularity"), F.round("m", 4).alias("m"))


@register("community_forest")
def q_community_forest(spark, sf):
    g, labels = _lpa3(spark, sf)
    return forest.community_forest(g, _membership(labels))


@register("community_forest_starts")
def q_community_forest_starts(spark, sf):
    """As ``community_forest`` where a third of the communities have no member with coordinates: they are skipped."""
    g, labels = _lpa3(spark, sf)
    gone = F.col("label") % 3 == 0
    nodes = g.nodes.join(labels, "id").select("id", *(F.when(~gone, F.col(c)).alias(c) for c in ("lat", "lon")))
    return forest.community_forest(g.with_nodes(nodes), _membership(labels))


@register("sample_per_group")
def q_sample_per_group(spark, sf):
    _, labels = _lpa3(spark, sf)
    s = sampling.sample_per_group(_membership(labels), "community", cap=5, seed=42)
    return s.select("community", "id")


@register("louvain_step")
def q_louvain_step(spark, sf):
    """One step from the communities of three label propagations: who gains how much by moving, by both rules."""
    g, labels = _lpa3(spark, sf)
    cw = checkpoint(community.canonical_weighted(g.edges, "weight"))
    sym, k = community.level_tables(g.nodes, cw)
    memb = checkpoint(_membership(labels).join(k, "id"))
    m = float(cw.agg(F.sum("w")).first()[0])

    def gains(rule):
        found = community.louvain_candidates(memb, sym, m, rule).filter("delta > 1e-7")
        return found.select(F.lit(rule).alias("rule"), "id", F.col("ci").alias("community"), F.round("delta", 8).alias("delta"))

    return gains("standard").unionByName(gains("simple"))


@register("louvain_optimum")
def q_louvain_optimum(spark, sf):
    """What must hold of Louvain: every node assigned once, nobody left who gains by a move at the end of any
    pass, modularity never falling and equal to its definition."""
    g = _f3(spark, sf)
    gaining = []

    def look(_, memb, sym, m):
        gaining.append(community.louvain_candidates(memb, sym, m).filter("delta > 1e-9").count())

    memb, hist = community.louvain(g.nodes, g.edges, "weight", on_pass=look)
    found = [h["modularity"] for h in hist]
    falls = sum(b < a - 1e-9 for a, b in zip(found, found[1:], strict=False))
    q = community.modularity(memb, community.canonical_weighted(g.edges, "weight")).select(
        (F.abs(F.col("modularity") - F.lit(found[-1])) > 1e-9).cast("long").alias("differs")
    )
    counts = memb.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("nodes"))
    # the counters of the passes are driver-side scalars
    return counts.join(q).select("rows", "nodes", F.lit(sum(gaining)).cast("long").alias("gaining"), F.lit(falls).cast("long").alias("falls"), "differs")


@register("louvain_membership")
def q_louvain_membership(spark, sf):
    g = _f3(spark, sf)
    memb, _ = community.louvain(g.nodes, g.edges, "weight")
    return memb


@register("louvain_modularity")
def q_louvain_modularity(spark, sf):
    g = _f3(spark, sf)
    _, hist = community.louvain(g.nodes, g.edges, "weight")
    return community.history_df(spark, hist)


# ---- DFS path layers, colours, exports, feature tables -------------------------------------

from geoweave.operators import features  # noqa: E402


def _dfs_path(spark, sf):
    order = traverse.tree_preorder(_f4_tree(spark, sf))
    return order, order.select(F.col("visit_order").alias("pos"), "id")


@register("path_downsample")
def q_path_downsample(spark, sf):
    _, path = _dfs_path(spark, sf)
    return sampling.stride_downsample(path, 50)


@register("segment_colors")
def q_segment_colors(spark, sf):
    _, path = _dfs_path(spark, sf)
    seg = features.path_segments(sampling.stride_downsample(path, 50))
    return seg.select("seg", "from_id", "to_id", "color")


@register("path_layers")
def q_path_layers(spark, sf):
    _, path = _dfs_path(spark, sf)
    return features.path_layers(features.path_segments(sampling.stride_downsample(path, 50)), 10)


@register("dense_ids")
def q_dense_ids(spark, sf):
    return structure.dense_ids(_f1(spark, sf).nodes.select("id"))


def _export(spark, sf):
    g1 = _f1(spark, sf)
    g3 = _f3(spark, sf)
    fst = forest.spanning_forest(g3.nodes, g3.edges)
    fe = fst.select("u", "v")
    ends = fe.select(F.col("u").alias("id")).unionByName(fe.select(F.col("v").alias("id"))).distinct()
    mapping = structure.dense_ids(ends, start=0)
    deg = structure.total_degree(g1)
    return g1, fe, mapping, deg


@register("export_nodes")
def q_export_nodes(spark, sf):
    g1, _, mapping, deg = _export(spark, sf)
    return mapping.join(g1.nodes, "id").join(deg, "id", "left").select(
        F.col("new_id").alias("node_id"), "lat", "lon", F.coalesce("degree", F.lit(0)).cast("long").alias("degree_original")
    )


@register("export_edges")
def q_export_edges(spark, sf):
    _, fe, mapping, _ = _export(spark, sf)
    e = structure.remap_edges(fe.select(F.col("u").alias("src"), F.col("v").alias("dst")), mapping)
    return e.select(F.col("src").alias("source"), F.col("dst").alias("destination"))


def _flat(feats):
    """Feature rows with their coordinates as text, ``lon lat`` with 4 digits each."""
    point = lambda p: F.format_string("%.4f %.4f", p["lon"], p["lat"])
    return feats.select("layer", "kind", "color", "label", F.array_join(F.transform("coords", point), ", ").alias("points"))


@register("bfs_features")
def q_bfs_features(spark, sf):
    g = _f1(spark, sf)
    tree = traverse.bfs_tree(g, 0)
    return _flat(features.bfs_features(g.nodes, tree, traverse.bfs_longest_path(tree)))


@register("dfs_features")
def q_dfs_features(spark, sf):
    g = fixtures.hierarchy_tree(spark, sf)
    order, path = _dfs_path(spark, sf)
    deep = traverse.deepest_in_preorder(order).first()["id"]
    last = order.agg(F.max_by("id", "visit_order")).first()[0]
    return _flat(features.dfs_features(g.nodes, sampling.stride_downsample(path, 50), deep, last))


@register("community_features")
def q_community_features(spark, sf):
    g, labels = _lpa3(spark, sf)
    memb = _membership(labels)
    sel = community.select_communities(memb, num_random=20, seed=42)
    return _flat(features.community_features(g.nodes, g.edges, memb, sel))


# ---- random route batch ----------------------------------------------------------------------


def _route_graph(spark, sf):
    """F1 with its links written before their weights are computed: the shuffles that link the line items are over."""
    g = _f1(spark, sf)
    return geo.edge_weights(g.with_edges(checkpoint(g.edges)))


def _random_routes(spark, sf):
    g = _route_graph(spark, sf)
    return g, paths.random_routes(g, n_pairs=100, max_attempts=50, seed=7)


@register("route_batch")
def q_route_batch(spark, sf):
    _, rnd = _random_routes(spark, sf)
    return rnd.select("slot", "attempt", "u", "v", F.round("cost", 6).alias("cost"))


@register("route_batch_stats")
def q_route_batch_stats(spark, sf):
    _, rnd = _random_routes(spark, sf)
    s = paths.route_stats(rnd)
    return s.select(
        "n_routes", F.round("min_km", 6).alias("min_km"), F.round("max_km", 6).alias("max_km"), F.round("avg_km", 4).alias("avg_km")
    )


def _random_route_paths(spark, sf):
    g = _route_graph(spark, sf)
    sides = paths.prepared_sides(g)  # of the random routes and the main one
    rnd, state = paths.random_routes(g, n_pairs=100, max_attempts=50, seed=7, with_state=True, sides=sides)
    rq = rnd.select(F.col("slot").alias("qid"), F.col("u").alias("source"), F.col("v").alias("sink"), "cost")
    return g, rq, paths.route_paths(state, rq), sides


def _main_route(g, sides):
    fp, state, route = _far_route(g, sides)
    release(*sides)
    return paths.route_summary(state, fp, fp, route).select("source", "sink", "cost"), route.select("pos", "id")


@register("route_nodes_union")
def q_route_nodes_union(spark, sf):
    g, _, rn, sides = _random_route_paths(spark, sf)
    _, main = _main_route(g, sides)
    return rn.select("id").unionByName(main.select("id")).distinct()  # A21 / U2


@register("route_features")
def q_route_features(spark, sf):
    g, rq, rn, sides = _random_route_paths(spark, sf)
    return _flat(features.route_features(g.nodes, rq.select("qid", "cost"), rn, *_main_route(g, sides)))


# ---- routes over other weights ---------------------------------------------------------------


def _from_zero(spark, g):
    src = g.nodes.filter(F.col("id") == 0).select(F.lit(0).alias("qid"), F.col("id").alias("source"))
    return paths.shortest_paths(g, src)


@register("route_custom_weight")
def q_route_custom_weight(spark, sf):
    """The cheapest route from node 0 to the last part by order quantities."""
    g = fixtures.priced_graph(spark, sf)
    sinks = g.nodes.agg(F.max("id").alias("sink")).withColumn("qid", F.lit(0))
    src = sinks.select("qid", F.lit(0).cast("long").alias("source"))
    st = paths.shortest_paths(g, src, sinks.select("qid", "sink"))
    route = paths.route_summary(st, src, sinks, paths.route_paths(st, sinks))
    return route.select("source", "sink", F.round("cost", 6).alias("cost"))


@register("sssp_custom_weight")
def q_sssp_custom_weight(spark, sf):
    return _from_zero(spark, fixtures.priced_graph(spark, sf)).select("id", F.round("dist", 6).alias("dist"))


@register("route_zero_weight")
def q_route_zero_weight(spark, sf):
    """Distances over a graph in which many nodes coincide; ``chains_home`` is 1 when the predecessors of
    the last node lead back to the source (they would never end in a cycle)."""
    st = _from_zero(spark, geo.edge_weights(fixtures.coarse_graph(spark, sf)))
    chains = traverse.walk_up(
        st.select(F.lit(0).alias("key"), "id", F.col("pred").alias("parent")),
        st.agg(F.max("id").alias("id")).withColumn("key", F.lit(0)),
    )
    home = chains.filter("id = 0").count()
    return st.select("id", F.round("dist", 6).alias("dist"), F.lit(home).cast("long").alias("chains_home"))


# ---- tables for a viewer, members, starts ------------------------------------------------------

from geoweave.plans import workflows  # noqa: E402


@register("sampled_table_nodes")
def q_sampled_table_nodes(spark, sf):
    return workflows.sampled_subgraph_tables(_f1(spark, sf), 500, seed=42)["nodes"]


@register("sampled_table_edges")
def q_sampled_table_edges(spark, sf):
    return workflows.sampled_subgraph_tables(_f1(spark, sf), 500, seed=42, one_based=True)["edges"]


@register("community_members")
def q_community_members(spark, sf):
    _, labels = _lpa3(spark, sf)
    memb = _membership(labels)
    return community.members_of(memb, community.select_communities(memb, num_random=20, seed=42))


@register("community_starts")
def q_community_starts(spark, sf):
    g, labels = _lpa3(spark, sf)
    return community.valid_start_nodes(_membership(labels), g.nodes, structure.total_degree(g))


@register("fallback_start")
def q_fallback_start(spark, sf):
    return traverse.resolve_start(_f1(spark, sf), -1)
