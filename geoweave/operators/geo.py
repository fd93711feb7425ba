"""Geographic operators: edge weights (J1), bounding-box extremes (A11), approximate farthest
pair (G15) and centroid (A16)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.functions.geo import coord_present, haversine_km
from geoweave.model import Graph


def edge_weights(g: Graph, force_recalc: bool = False) -> Graph:
    """``weight`` = haversine km between the endpoints' coordinates.

    An existing ``weight`` is kept unless ``force_recalc``. Endpoints missing from the node table
    or without coordinates give ``+inf``. Two equi-joins against the node table; Spark/AQE
    chooses broadcast when the node table is small and a skew-aware sort-merge join otherwise.
    """
    if g.has_weight and not force_recalc:
        return g
    nodes = g.nodes.select("id", "lat", "lon")
    s = nodes.select(F.col("id").alias("src"), F.col("lat").alias("_lat1"), F.col("lon").alias("_lon1"))
    d = nodes.select(F.col("id").alias("dst"), F.col("lat").alias("_lat2"), F.col("lon").alias("_lon2"))
    extra = [c for c in g.edge_attrs if c != "weight"]
    weighted = (
        g.edges.join(s, "src", "left")
        .join(d, "dst", "left")
        .select(
            "src",
            "dst",
            haversine_km("_lat1", "_lon1", "_lat2", "_lon2").alias("weight"),
            *extra,
        )
    )
    return g.with_edges(weighted, km_weights=True)


def bbox_extremes(nodes: DataFrame) -> DataFrame:
    """Ids of the min-lat, max-lat, min-lon and max-lon nodes (ties → smallest id).

    One aggregate pass; nodes without coordinates are skipped.
    """
    valid = nodes.filter(coord_present("lat", "lon"))
    return valid.agg(
        F.min(F.struct(F.col("lat"), F.col("id"))).getField("id").alias("min_lat_id"),
        F.min(F.struct(-F.col("lat"), F.col("id"))).getField("id").alias("max_lat_id"),
        F.min(F.struct(F.col("lon"), F.col("id"))).getField("id").alias("min_lon_id"),
        F.min(F.struct(-F.col("lon"), F.col("id"))).getField("id").alias("max_lon_id"),
    )


def _extreme_points(nodes: DataFrame) -> DataFrame:
    """One row holding the (≤4) distinct extreme points as ``array<struct<id,lat,lon>>``."""
    valid = nodes.filter(coord_present("lat", "lon"))

    def pick(key):
        m = F.min(F.struct(key.alias("k"), F.col("id").alias("id"), F.col("lat").alias("lat"), F.col("lon").alias("lon")))
        return F.struct(m.getField("id").alias("id"), m.getField("lat").alias("lat"), m.getField("lon").alias("lon"))

    return valid.agg(
        F.array_distinct(
            F.array(pick(F.col("lat")), pick(-F.col("lat")), pick(F.col("lon")), pick(-F.col("lon")))
        ).alias("pts")
    )


def farthest_pair(nodes: DataFrame) -> DataFrame:
    """Approximate farthest pair = farthest of the pairs of bounding-box extremes.

    The ≤6 pairs are formed inside one row (array of ≤4 points), so no join is needed. The pair
    is oriented ``u < v``; ties in distance go to the smallest ``(u, v)``.
    """
    pts = _extreme_points(nodes)
    n = F.size("pts")
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.transform(
                F.filter(F.sequence(F.lit(0), n - 1), lambda j: j > i),
                lambda j: F.struct(F.col("pts")[i].alias("a"), F.col("pts")[j].alias("b")),
            ),
        )
    )
    p = pts.filter(n >= 2).select(F.explode(pairs).alias("p"))
    a, b = F.col("p.a"), F.col("p.b")
    cand = p.select(
        F.least(a.getField("id"), b.getField("id")).alias("u"),
        F.greatest(a.getField("id"), b.getField("id")).alias("v"),
        haversine_km(a.getField("lat"), a.getField("lon"), b.getField("lat"), b.getField("lon")).alias("d"),
    )
    best = cand.agg(F.min(F.struct((-F.col("d")).alias("nd"), "u", "v")).alias("b"))
    return best.filter(F.col("b").isNotNull()).select(
        F.col("b.u").alias("u"), F.col("b.v").alias("v"), (-F.col("b.nd")).alias("distance_km")
    )


def centroid(nodes: DataFrame, exclude_ids: Iterable[int] | None = None) -> DataFrame:
    """Mean latitude and longitude of nodes with coordinates (optional exclusions)."""
    valid = nodes.filter(coord_present("lat", "lon"))
    ex = list(exclude_ids or [])
    if ex:
        valid = valid.filter(~F.col("id").isin(ex))
    return valid.agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count(F.lit(1)).alias("n_nodes")
    )
