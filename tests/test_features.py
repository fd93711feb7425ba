"""Feature tables: DFS path layers (G19), route styles (G20), community layers."""

from pyspark.sql import functions as F

from geoweave.functions.colors import ROUTE_COLORS
from geoweave.operators import features, sampling, traverse
from tests.helpers import graph


def test_dfs_layers_and_markers(spark):
    # a path 0 → 1 → … → 29 as a tree
    g = graph(spark, [(i, i + 1) for i in range(29)])
    tree = traverse.tree_depths(g.edges, g.nodes.filter("id = 0").select("id"))
    order = traverse.tree_preorder(tree)
    path = order.select(F.col("visit_order").alias("pos"), "id")
    ds = sampling.stride_downsample(path, 10)  # step 3 plus the last node
    assert sorted(r.pos for r in ds.collect()) == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27, 29]
    layers = features.path_layers(features.path_segments(ds), layers=5)
    rows = sorted(tuple(r) for r in layers.select("layer", "start_step", "end_step", "start_id", "end_id").collect())
    assert rows[0] == (0, 1, 2, 0, 6) and rows[-1] == (4, 9, 10, 24, 29)
    f = features.dfs_features(g.nodes, ds, deepest_id=29, last_id=29, layers=5)
    marks = {r.label for r in f.filter(F.col("layer") == "markers").collect()}
    assert marks == {"start: node 0", "last visited: node 29", "deepest: node 29"}
    colors = [r.color for r in features.path_segments(ds).orderBy("seg").collect()]
    assert colors[0] == "#1919e5" and colors[-1] != colors[0]


def test_route_styles(spark):
    g = graph(spark, [(0, 1), (1, 2), (2, 3)])
    routes = spark.createDataFrame([(1, 10.0), (2, 30.0), (3, 20.0)], "qid long, cost double")
    rn = spark.createDataFrame([(q, p, q + p - 1) for q in (1, 2, 3) for p in (0, 1)], "qid long, pos long, id long")
    f = features.route_features(g.nodes, routes, rn)
    lines = {r.label: r.color for r in f.filter(F.col("kind") == "line").collect()}
    assert lines["shortest of the sample (10.00 km)"] == ROUTE_COLORS["shortest"]
    assert lines["longest of the sample (30.00 km)"] == ROUTE_COLORS["longest"]
    assert lines["route of 20.00 km"] == ROUTE_COLORS["other"]
    assert f.filter(F.col("kind") == "point").count() == 4


def test_community_layers(spark):
    a = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    edges = a + [(i + 4, j + 4) for i, j in a]
    g = graph(spark, edges, directed=False)
    memb = spark.createDataFrame([(i, 0 if i < 4 else 4) for i in range(8)], "id long, community long")
    sel = spark.createDataFrame([(0, "largest"), (4, "smallest")], "community long, role string")
    f = features.community_features(g.nodes, g.edges, memb, sel, max_members=3, max_edge_size=10)
    pts = f.filter(F.col("kind") == "point").groupBy("layer").count().collect()
    assert sorted(r["count"] for r in pts) == [3, 3]  # capped members per community
    assert f.filter(F.col("kind") == "line").count() == 6  # 3 internal edges among 3 shown members, ×2
