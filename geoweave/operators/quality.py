"""Data-quality checks (C1–C6) and the inspection table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave.model import Graph


def _rows(frame: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Turn a one-row aggregate into long ``(check_name, actual, expected)`` rows via ``stack``."""
    parts = ", ".join(f"'{name}', CAST({a} AS BIGINT), CAST({e} AS BIGINT)" for name, a, e in specs)
    return frame.selectExpr(f"stack({len(specs)}, {parts}) AS (check_name, actual, expected)")


def quality_checks(
    g: Graph,
    expected_nodes: int | None = None,
    expected_edges: int | None = None,
    probe_node: int = 0,
) -> DataFrame:
    """C1–C5 over the whole tables: ``checks(check_name, actual, expected, ok)``.

    * ``n_nodes`` / ``n_edges`` compared with the expected counts when given (C1);
    * ids dense: ``min_id = 0``, ``max_id = n − 1``, ``distinct_ids = n`` (C2);
    * ``lat_missing`` / ``lon_missing`` = 0 (C3);
    * ``probe_out_degree`` of one node (C4, informational);
    * ``dangling_src`` / ``dangling_dst`` = 0: edge endpoints that are not nodes (C5).
    """
    en = "NULL" if expected_nodes is None else str(int(expected_nodes))
    ee = "NULL" if expected_edges is None else str(int(expected_edges))
    node_stats = g.nodes.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("mn"),
        F.max("id").alias("mx"),
        F.count_distinct("id").alias("nd"),
        F.count_if(F.col("lat").isNull() | F.isnan("lat")).alias("lat_miss"),
        F.count_if(F.col("lon").isNull() | F.isnan("lon")).alias("lon_miss"),
    )
    edge_stats = g.edges.agg(
        F.count(F.lit(1)).alias("m"),
        F.count_if(F.col("src") == F.lit(probe_node)).alias("probe"),
    )
    ids = g.nodes.select("id")
    dangling_src = g.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_anti").agg(
        F.count(F.lit(1)).alias("c")
    )
    dangling_dst = g.edges.join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti").agg(
        F.count(F.lit(1)).alias("c")
    )
    rows = (
        _rows(
            node_stats,
            [
                ("n_nodes", "n", en),
                ("min_id", "mn", "0"),
                ("max_id", "mx", "n - 1"),
                ("distinct_ids", "nd", "n"),
                ("lat_missing", "lat_miss", "0"),
                ("lon_missing", "lon_miss", "0"),
            ],
        )
        .unionByName(_rows(edge_stats, [("n_edges", "m", ee), ("probe_out_degree", "probe", "NULL")]))
        .unionByName(_rows(dangling_src, [("dangling_src", "c", "0")]))
        .unionByName(_rows(dangling_dst, [("dangling_dst", "c", "0")]))
    )
    return rows.withColumn(
        "ok", F.col("expected").isNull() | (F.col("actual") == F.col("expected"))
    )


def head_tail_ids(nodes: DataFrame, k: int) -> DataFrame:
    """L1/U4: the first ``k`` and last ``k`` ids (two TakeOrderedAndProject, ≤ 2k rows)."""
    head = nodes.select("id").orderBy(F.col("id").asc()).limit(k)
    tail = nodes.select("id").orderBy(F.col("id").desc()).limit(k)
    return head.unionByName(tail).distinct()


def inspection_table(g: Graph, k: int = 50) -> DataFrame:
    """``(idx, id, lat, lon, out_degree)`` for the first and last ``k`` nodes.

    The ≤ 2k sampled ids are a proven-small side: edges are semi-joined against them before
    counting, so only their out-edges are aggregated.
    """
    ids = head_tail_ids(g.nodes, k)
    small = F.broadcast(ids)  # at most 2k rows
    sample = g.nodes.join(small, "id", "left_semi").select("id", "lat", "lon")
    deg = (
        g.edges.join(small.withColumnRenamed("id", "src"), "src", "left_semi")
        .groupBy("src")
        .agg(F.count(F.lit(1)).alias("out_degree"))
    )
    out = sample.join(deg, F.col("id") == F.col("src"), "left").select(
        "id", "lat", "lon", F.coalesce("out_degree", F.lit(0)).cast("long").alias("out_degree")
    )
    # ≤ 2k rows: a single ordered window partition is fine here
    return out.select(
        F.row_number().over(Window.orderBy("id")).cast("long").alias("idx"), "id", "lat", "lon", "out_degree"
    )


def probe_out_degree(g: Graph, node: int) -> DataFrame:
    """C4: out-degree of one node."""
    return g.edges.filter(F.col("src") == F.lit(node)).agg(F.count(F.lit(1)).alias("out_degree"))
