"""geoweave — geographic graph analytics expressed as Spark DataFrame jobs.

A graph is a pair of DataFrames (``nodes(id, lat, lon)``, ``edges(src, dst[, weight])``).
Every operator is a join / aggregate / window over those frames; iterative algorithms are
driver loops that only ever receive a counter per round and cut lineage with reliable
checkpoints.
"""

from geoweave.model import Graph, NODE_SCHEMA, EDGE_SCHEMA, WEIGHTED_EDGE_SCHEMA
from geoweave.session import build_session, ensure_checkpoint_dir

__all__ = [
    "Graph",
    "NODE_SCHEMA",
    "EDGE_SCHEMA",
    "WEIGHTED_EDGE_SCHEMA",
    "build_session",
    "ensure_checkpoint_dir",
]
