"""Graph store and sinks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geoweave.model import Graph


def save_graph(g: Graph, path: str, num_partitions: int | None = None, mode: str = "overwrite") -> None:
    """``path/nodes`` and ``path/edges`` as Parquet plus ``path/meta`` (JSON), with all attributes.

    Edges are range-clustered on ``(src, dst)`` and sorted, so Parquet row-group statistics let a later
    ``src = x`` / ``src IN (…)`` filter skip most of the data and a hub's edges spread over several
    files. Without ``num_partitions`` the number of files follows the data (AQE).
    """
    spark = g.nodes.sparkSession

    def ranged(df: DataFrame, *keys: str) -> DataFrame:
        parts = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
        return parts.sortWithinPartitions(*keys)

    ranged(g.nodes, "id").write.mode(mode).parquet(f"{path}/nodes")
    ranged(g.edges, "src", "dst").write.mode(mode).parquet(f"{path}/edges")
    meta = {
        "directed": g.directed,
        "km_weights": g.km_weights,
        "nodes": g.nodes.schema.jsonValue(),
        "edges": g.edges.schema.jsonValue(),
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/meta")


def load_graph(spark: SparkSession, path: str) -> Graph:
    """Read a saved graph with the schemas it was saved with (no inference)."""
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    nodes, edges = (
        spark.read.schema(StructType.fromJson(meta[name])).parquet(f"{path}/{name}") for name in ("nodes", "edges")
    )
    return Graph(nodes, edges, meta["directed"], meta["km_weights"])


def write_location_lines(nodes: DataFrame, path: str) -> None:
    """``lat,lon`` text lines ordered by node id."""
    nodes.orderBy("id").select(F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ``(line_no, value)`` as text in line order."""
    lines.orderBy("line_no").select("value").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_tables(nodes: DataFrame, edges: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Node table and edge table for an external viewer (Parquet, CSV or JSON)."""
    for name, df in (("nodes", nodes), ("edges", edges)):
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(f"{path}/{name}")
        elif fmt == "json":
            w.json(f"{path}/{name}")
        else:
            w.parquet(f"{path}/{name}")


def geojson_lines(features: DataFrame) -> DataFrame:
    """One GeoJSON ``Feature`` per row as a JSON string column ``value``."""
    coords = F.transform("coords", lambda p: F.array(p["lon"], p["lat"]))
    geom = F.when(
        F.col("kind") == "point",
        F.to_json(F.struct(F.lit("Point").alias("type"), F.element_at(coords, 1).alias("coordinates"))),
    ).otherwise(F.to_json(F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates"))))
    props = F.to_json(F.struct("layer", "kind", "color", "label"))
    return features.select(
        F.concat(F.lit('{"type":"Feature","geometry":'), geom, F.lit(',"properties":'), props, F.lit("}")).alias("value")
    )


def write_geojson_lines(features: DataFrame, path: str) -> None:
    geojson_lines(features).write.mode("overwrite").text(path)
