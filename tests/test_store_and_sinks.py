"""Graph store round trip, sinks, exports and workflows on a small text input."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from geoweave.model import Graph
from geoweave.operators import community, features, traverse
from geoweave.plans import workflows
from geoweave.sources import store, text
from tests.helpers import graph


def test_save_load_roundtrip(spark):
    g = graph(spark, [(0, 1), (1, 2), (2, 0)], weights=[1.5, 2.5, 3.5])
    d = tempfile.mkdtemp(prefix="geoweave-store-")
    store.save_graph(g, d, num_partitions=2)
    h = store.load_graph(spark, d)
    assert h.directed and h.has_weight
    assert sorted(map(tuple, h.edges.collect())) == sorted(map(tuple, g.edges.collect()))
    assert sorted(map(tuple, h.nodes.collect())) == sorted(map(tuple, g.nodes.collect()))


def test_build_graph_from_text_files(spark):
    d = tempfile.mkdtemp(prefix="geoweave-build-")
    with open(os.path.join(d, "loc.txt"), "w") as fh:
        fh.write("10.0,20.0\nbad\n-5.5,100.25\n1.0,1.0\n")
    with open(os.path.join(d, "usr.txt"), "w") as fh:
        fh.write("0,2,3\n1,1\n2,x,3,9\n")
    g, rejects = workflows.build_graph(
        spark, os.path.join(d, "loc.txt"), os.path.join(d, "usr.txt"), out_path=os.path.join(d, "graph")
    )
    assert g.nodes.count() == 3 and [r.line_no for r in rejects.collect()] == [1]
    assert sorted((r.src, r.dst) for r in g.edges.collect()) == [(0, 1), (0, 2), (1, 0), (2, 1), (2, 2)]


def test_geojson_and_exports(spark):
    g = graph(spark, [(0, 1), (1, 2), (0, 3)])
    tree = traverse.bfs_tree(g, 0)
    feats = features.bfs_features(g.nodes, tree, traverse.bfs_longest_path(tree))
    lines = [json.loads(r.value) for r in store.geojson_lines(feats).collect()]
    kinds = {x["geometry"]["type"] for x in lines}
    assert kinds == {"Point", "LineString"} and all(x["type"] == "Feature" for x in lines)
    t = workflows.sampled_subgraph_tables(g, 3, seed=1, one_based=True)
    assert t["nodes"].count() == 3 and t["nodes"].agg(F.min("node_id")).first()[0] >= 1
    d = tempfile.mkdtemp(prefix="geoweave-export-")
    store.export_tables(t["nodes"], t["edges"], d, fmt="csv")
    assert spark.read.option("header", True).csv(os.path.join(d, "nodes")).count() == 3


def test_members_and_start_nodes(spark):
    memb = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2)], "id long, community long")
    sel = spark.createDataFrame([(2, "largest")], "community long, role string")
    assert sorted(r.id for r in community.members_of(memb, sel).collect()) == [2, 3]
    nodes = spark.createDataFrame([(0, None, 1.0), (1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0)], "id long, lat double, lon double")
    deg = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 0)], "id long, degree long")
    got = {r.community: r.id for r in community.valid_start_nodes(memb, nodes, deg).collect()}
    assert got == {0: 1}


def test_attributes_survive_the_store_and_a_hub_is_spread(spark):
    nodes = spark.range(3001).select("id", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.concat(F.lit("n"), "id").alias("name"))
    edges = spark.range(1, 3001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"), F.lit("visit").alias("kind"))
    d = tempfile.mkdtemp(prefix="geoweave-attrs-")
    g = Graph(nodes, edges, directed=False)
    store.save_graph(g, d, num_partitions=3)
    h = store.load_graph(spark, d)
    assert not h.directed and h.nodes.columns == nodes.columns and h.edges.columns == edges.columns
    assert sorted(map(tuple, h.nodes.collect())) == sorted(map(tuple, nodes.collect()))
    assert h.summary().first() == g.summary().first()
    assert len([f for f in os.listdir(os.path.join(d, "edges")) if f.endswith(".parquet")]) == 3


def test_text_and_csv_sinks(spark):
    d = tempfile.mkdtemp(prefix="geoweave-sinks-")
    g = graph(spark, [(0, 1), (1, 2)])
    store.write_location_lines(g.nodes, os.path.join(d, "loc"))
    rows = [r.value for r in text.read_numbered_lines(spark, os.path.join(d, "loc")).orderBy("line_no").collect()]
    want = [f"{r.lat},{r.lon}" for r in g.nodes.orderBy("id").collect()]
    assert rows == want
    store.write_csv(g.edges, os.path.join(d, "edges"))
    back = spark.read.option("header", True).csv(os.path.join(d, "edges"))
    assert sorted((int(r.src), int(r.dst)) for r in back.collect()) == [(0, 1), (1, 2)]


def test_reports(spark):
    g = graph(spark, [(i, (i + 1) % 8) for i in range(8)] + [(i, (i + 3) % 8) for i in range(8)])
    r = workflows.route_report(g, n_random=3, max_attempts=5)
    layers = {x.layer for x in r["features"].collect()}
    assert layers == {"random routes", "main route", "markers", "nodes on routes"}
    on_route = {x.label for x in r["features"].filter("layer = 'nodes on routes'").collect()}
    assert {f"node {x.id}" for x in r["route_nodes"].collect()} <= on_route
    b = workflows.bfs_report(g, 0, max_nodes=4)
    assert b["tree"].count() == 4 and b["features"].filter("layer = 'centre'").count() == 1
    s = workflows.skeleton_export(g)
    n = s["export_nodes"].count()
    assert n == s["forest"].select(F.explode(F.array("u", "v")).alias("id")).distinct().count()
    ids = {x.node_id for x in s["export_nodes"].collect()}
    assert ids == set(range(n)) and all(x.source in ids and x.destination in ids for x in s["export_edges"].collect())
