"""Fixture graphs built from the driver's tables and the driver contract."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from geoweave.operators import components
from geoweave.sources import fixtures
from tests.conftest import SF_SMALL


def test_part_graph_counts(spark):
    g = fixtures.part_graph(spark, SF_SMALL)
    assert g.nodes.count() == 200 and g.edges.count() == 2752
    assert g.edges.filter(F.col("src") == F.col("dst")).count() == 16


def test_pair_graph_holds_every_link(spark):
    g = fixtures.pair_graph(spark, SF_SMALL)
    assert g.edges.count() == 2636
    assert {r.component for r in components.connected_components(g.nodes, g.edges).collect()} == {0}


def test_order_graph_components(spark):
    g = fixtures.order_graph(spark, SF_SMALL)
    assert g.nodes.count() == 1650 and g.edges.count() == 1500
    sizes = [r["count"] for r in components.connected_components(g.nodes, g.edges).groupBy("component").count().collect()]
    assert len(sizes) == 150 and sum(sizes) == 1650


def test_hierarchy_nodes(spark):
    g = fixtures.hierarchy_tree(spark, SF_SMALL)
    assert g.nodes.count() == 191


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "dist", "out_degree"]
    assert df.count() == 200


def test_every_query_has_callable_and_most_have_oracles():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= len(qs) - 10
