"""Graph data model: two DataFrames and a direction flag."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lon", T.DoubleType(), True),
    ]
)
EDGE_SCHEMA = T.StructType(
    [T.StructField("src", T.LongType(), False), T.StructField("dst", T.LongType(), False)]
)
WEIGHTED_EDGE_SCHEMA = T.StructType(
    EDGE_SCHEMA.fields + [T.StructField("weight", T.DoubleType(), True)]
)


@dataclass(frozen=True)
class Graph:
    """A directed (or undirected) graph held as two DataFrames.

    ``nodes``: ``id BIGINT, lat DOUBLE, lon DOUBLE`` (coordinates nullable).
    ``edges``: ``src BIGINT, dst BIGINT`` and optionally ``weight DOUBLE``.
    ``km_weights`` is true only when the weights are the great-circle distances of the edges'
    endpoints (set by ``geo.edge_weights``); searches may then bound the remaining way by distance.
    Nothing is computed until an operator runs an action.
    """

    nodes: DataFrame
    edges: DataFrame
    directed: bool = True
    km_weights: bool = False

    @property
    def has_weight(self) -> bool:
        return "weight" in self.edges.columns

    @property
    def node_attrs(self) -> list[str]:
        return [c for c in self.nodes.columns if c != "id"]

    @property
    def edge_attrs(self) -> list[str]:
        return [c for c in self.edges.columns if c not in ("src", "dst")]

    def with_edges(self, edges: DataFrame, directed: bool | None = None, km_weights: bool = False) -> "Graph":
        """Same nodes, other edges; weights count as custom ones unless ``km_weights`` says otherwise."""
        return Graph(self.nodes, edges, self.directed if directed is None else directed, km_weights)

    def with_nodes(self, nodes: DataFrame) -> "Graph":
        return Graph(nodes, self.edges, self.directed)

    def summary(self) -> DataFrame:
        """A1: one row ``(n_nodes, n_edges, directed, node_attrs, edge_attrs)``."""
        from geoweave.operators.structure import graph_summary

        return graph_summary(self)
