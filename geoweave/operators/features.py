"""Map-ready feature tables (S15, G17, G19–G22; P7–P11, L4, W2, W3, J6).

A feature row is ``(layer, kind, color, label, coords)`` with ``coords`` an
``array<struct<lon, lat>>`` (one point for markers, two or more for lines). Rendering is left to
any map tool; ``sources.store.write_geojson_lines`` writes GeoJSON features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave.functions.colors import (
    ROUTE_COLORS,
    TREE_EDGE_COLOR,
    gradient_color,
    level_color,
    log_scale,
    route_style,
    two_end_color,
)
from geoweave.functions.geo import coord_present

FEATURE_COLS = ["layer", "kind", "color", "label", "coords"]

# Marker colours for start / end / deepest node and for path vertices.
START_COLOR = "#2ca02c"
END_COLOR = "#d62728"
DEEPEST_COLOR = "#800080"
VERTEX_COLOR = "#3186cc"
MAIN_ROUTE_COLOR = "#1f77b4"
SOURCE_COLOR = "#2ca02c"
SINK_COLOR = "#d62728"
ROUTE_NODE_COLOR = "#800080"
LAYER_START_COLOR = "green"
LAYER_END_COLOR = "red"


def _pt(lon="lon", lat="lat"):
    return F.struct(F.col(lon).alias("lon"), F.col(lat).alias("lat"))


def _feature(df: DataFrame, layer, kind: str, color, label, coords) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(
        lit(layer).alias("layer"), F.lit(kind).alias("kind"), lit(color).alias("color"), lit(label).alias("label"), coords.alias("coords")
    )


def with_coords(df: DataFrame, nodes: DataFrame, id_col: str = "id", prefix: str = "") -> DataFrame:
    """Attach ``lat``/``lon`` of ``id_col`` (rows without coordinates are dropped)."""
    n = nodes.filter(coord_present("lat", "lon")).select(
        F.col("id").alias(id_col), F.col("lat").alias(prefix + "lat"), F.col("lon").alias(prefix + "lon")
    )
    return df.join(n, id_col)


def polyline(points: DataFrame, key_cols, pos_col: str = "pos") -> DataFrame:
    """Ordered coordinates per key: ``(…key_cols, coords)``; one group per path, whose size is the
    path length (bounded by the number of hops)."""
    agg = points.groupBy(*key_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"), F.col("lon"), F.col("lat")))).alias("_pts")
    )
    return agg.select(*key_cols, F.transform("_pts", lambda s: F.struct(s["lon"].alias("lon"), s["lat"].alias("lat"))).alias("coords"))


# ---- BFS (G21) ---------------------------------------------------------------------------------


def bfs_features(nodes: DataFrame, tree: DataFrame, longest_path: DataFrame) -> DataFrame:
    """Visited nodes coloured by level, tree edges, the longest path, start/end markers, centre."""
    pts = with_coords(tree, nodes)
    visited = _feature(
        pts, "visited nodes", "point", level_color("level"),
        F.format_string("node %d level %d", F.col("id"), F.col("level")), F.array(_pt()),
    )
    child = with_coords(tree.filter(F.col("parent").isNotNull()), nodes)
    both = with_coords(child.select("id", "parent", F.col("lat").alias("clat"), F.col("lon").alias("clon")), nodes, "parent", "p")
    edges = _feature(
        both, "bfs tree", "line", TREE_EDGE_COLOR,
        F.format_string("%d -> %d", F.col("parent"), F.col("id")),
        F.array(_pt("plon", "plat"), _pt("clon", "clat")),
    )
    lp = polyline(with_coords(longest_path, nodes).withColumn("_k", F.lit(0)), ["_k"])
    path = _feature(lp, "longest path", "line", END_COLOR, F.lit("longest path"), F.col("coords"))
    ends = longest_path.agg(F.min_by("id", "pos").alias("s"), F.max_by("id", "pos").alias("e"))
    marks = ends.select(F.explode(F.array(
        F.struct(F.lit("start").alias("role"), F.col("s").alias("id")),
        F.struct(F.lit("end").alias("role"), F.col("e").alias("id")),
    )).alias("m")).select("m.role", "m.id")
    mk = with_coords(marks, nodes)
    markers = _feature(
        mk, "markers", "point", F.when(F.col("role") == "start", F.lit(START_COLOR)).otherwise(F.lit(END_COLOR)),
        F.format_string("%s node %d", F.col("role"), F.col("id")), F.array(_pt()),
    )
    centre = pts.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    c = _feature(centre, "centre", "point", "#000000", F.lit("centre"), F.array(_pt()))
    return visited.unionByName(edges).unionByName(path).unionByName(markers).unionByName(c)


# ---- routes (G20) ----------------------------------------------------------------------------


def route_features(
    nodes: DataFrame, routes: DataFrame, route_nodes: DataFrame, main: DataFrame | None = None, main_nodes: DataFrame | None = None
) -> DataFrame:
    """Random routes styled shortest / longest / other (P10), the main route with the markers of its
    ends, and the nodes on any route, the main one included (A21, U2).

    ``routes``: ``(qid, cost)``; ``route_nodes``: ``(qid, pos, id)``; ``main``: ``(source, sink, cost)``;
    ``main_nodes``: ``(pos, id)``.
    """
    lines = polyline(with_coords(route_nodes, nodes), ["qid"])
    # a global aggregate of one row, read as two scalars
    bounds = routes.agg(F.min("cost").alias("lo"), F.max("cost").alias("hi")).first()
    styled = lines.join(routes.select("qid", "cost"), "qid")
    style = route_style("cost", F.lit(bounds["lo"]), F.lit(bounds["hi"]))
    colour = F.when(style == "shortest", F.lit(ROUTE_COLORS["shortest"])).when(style == "longest", F.lit(ROUTE_COLORS["longest"])).otherwise(F.lit(ROUTE_COLORS["other"]))
    label = F.when(style == "shortest", F.format_string("shortest of the sample (%.2f km)", F.col("cost"))).when(
        style == "longest", F.format_string("longest of the sample (%.2f km)", F.col("cost"))
    ).otherwise(F.format_string("route of %.2f km", F.col("cost")))
    out = _feature(styled, "random routes", "line", colour, label, F.col("coords"))
    ids = route_nodes.select("id")
    if main is not None and main_nodes is not None:
        ids = ids.unionByName(main_nodes.select("id"))
        line = polyline(with_coords(main_nodes, nodes).withColumn("_k", F.lit(0)), ["_k"])
        cost = main.filter("cost is not null").select(F.lit(0).alias("_k"), "cost")
        main_line = line.join(cost, "_k")
        out = out.unionByName(
            _feature(main_line, "main route", "line", MAIN_ROUTE_COLOR, F.format_string("route of %.2f km", F.col("cost")), F.col("coords"))
        )
        ends = main.select(F.explode(F.array(
            F.struct(F.lit("source").alias("role"), F.col("source").alias("id")),
            F.struct(F.lit("sink").alias("role"), F.col("sink").alias("id")),
        )).alias("m")).select("m.role", "m.id")
        end_colour = F.when(F.col("role") == "source", F.lit(SOURCE_COLOR)).otherwise(F.lit(SINK_COLOR))
        out = out.unionByName(
            _feature(with_coords(ends, nodes), "markers", "point", end_colour, F.format_string("%s node %d", F.col("role"), F.col("id")), F.array(_pt()))
        )
    on_route = with_coords(ids.distinct(), nodes)
    return out.unionByName(
        _feature(on_route, "nodes on routes", "point", ROUTE_NODE_COLOR, F.format_string("node %d", F.col("id")), F.array(_pt()))
    )


# ---- DFS path layers (G19) -------------------------------------------------------------------


def path_segments(path: DataFrame, pos_col: str = "pos") -> DataFrame:
    """W2/W3/P7 over a (down-sampled) visit path ``(pos, id)``: one row per consecutive pair.

    Visual steps are renumbered 0..k−1; segment ``j`` joins step j → j+1, its layer is
    ``j // max(1, (k−1) // layers)`` and its colour runs blue → red over the k steps.
    The path is already reduced to a bounded number of points, so one window is fine.
    """
    w = Window.orderBy(pos_col)
    steps = path.select(F.col("id"), (F.row_number().over(w) - 1).alias("step"), F.count(F.lit(1)).over(Window.partitionBy()).alias("k"))
    seg = steps.select(
        "step", "k", F.col("id").alias("from_id"), F.lead("id").over(Window.orderBy("step")).alias("to_id")
    ).filter(F.col("to_id").isNotNull())
    return seg.select(
        F.col("step").alias("seg"), "from_id", "to_id", "k",
        gradient_color(F.col("step"), F.col("k")).alias("color"),
    )


def path_layers(segments: DataFrame, layers: int = 10) -> DataFrame:
    """``(layer, start_step, end_step, start_id, end_id, n_segments)`` per layer."""
    per = F.greatest(F.lit(1), F.floor((F.col("k") - 1) / layers)).cast("long")
    tagged = segments.withColumn("layer", F.floor(F.col("seg") / per).cast("long"))
    return tagged.groupBy("layer").agg(
        (F.min("seg") + 1).alias("start_step"),
        (F.max("seg") + 1).alias("end_step"),
        F.min_by("from_id", "seg").alias("start_id"),
        F.max_by("to_id", "seg").alias("end_id"),
        F.count(F.lit(1)).alias("n_segments"),
    )


def dfs_features(nodes: DataFrame, path: DataFrame, deepest_id, last_id, layers: int = 10) -> DataFrame:
    """Vertices layer, per-layer coloured segments with start/end markers, and the start /
    last-visited / deepest markers of the full traversal."""
    segs = path_segments(path)
    per = F.greatest(F.lit(1), F.floor((F.col("k") - 1) / layers)).cast("long")
    segs = segs.withColumn("layer", F.floor(F.col("seg") / per).cast("long"))
    a = with_coords(segs, nodes, "from_id", "a_")
    ab = with_coords(a, nodes, "to_id", "b_")
    lay = path_layers(segs.drop("layer"), layers)
    layer_name = F.format_string("path (steps %d-%d)", F.col("start_step"), F.col("end_step"))
    lines = ab.join(lay.select("layer", "start_step", "end_step"), "layer")
    seg_f = _feature(lines, layer_name, "line", F.col("color"), F.format_string("segment %d", F.col("seg")),
                     F.array(_pt("a_lon", "a_lat"), _pt("b_lon", "b_lat")))
    ls = with_coords(lay, nodes, "start_id")
    le = with_coords(lay, nodes, "end_id")
    start_f = _feature(ls, layer_name, "point", LAYER_START_COLOR, F.format_string("layer start: step %d", F.col("start_step")), F.array(_pt()))
    end_f = _feature(le, layer_name, "point", LAYER_END_COLOR, F.format_string("layer end: step %d", F.col("end_step")), F.array(_pt()))
    verts = _feature(with_coords(path, nodes), "path vertices", "point", VERTEX_COLOR, F.format_string("node %d", F.col("id")), F.array(_pt()))
    first = path.agg(F.min_by("id", "pos").alias("id"))
    marks = first.select(F.lit("start").alias("role"), "id").unionByName(
        nodes.filter(F.col("id") == F.lit(last_id)).select(F.lit("last visited").alias("role"), "id")
    ).unionByName(nodes.filter(F.col("id") == F.lit(deepest_id)).select(F.lit("deepest").alias("role"), "id"))
    mk = with_coords(marks, nodes)
    colour = F.when(F.col("role") == "start", F.lit(START_COLOR)).when(F.col("role") == "deepest", F.lit(DEEPEST_COLOR)).otherwise(F.lit(END_COLOR))
    mk_f = _feature(mk, "markers", "point", colour, F.format_string("%s: node %d", F.col("role"), F.col("id")), F.array(_pt()))
    return verts.unionByName(seg_f).unionByName(start_f).unionByName(end_f).unionByName(mk_f)


# ---- communities (G17) -----------------------------------------------------------------------


def community_features(
    nodes: DataFrame,
    edges: DataFrame,
    membership: DataFrame,
    selection: DataFrame,
    max_members: int | None = None,
    max_edge_size: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Selected communities coloured by the log-normalised community size (P9): their members and
    internal edges. On request only ``max_members`` sampled members each (L7), and edges only for
    communities of at most ``max_edge_size`` members."""
    from geoweave.operators.sampling import sample_per_group

    sizes = membership.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    bounds = sizes.agg(F.min("size").alias("_lo"), F.max("size").alias("_hi"))
    sel = selection.select("community", "role").join(sizes, "community")
    # smallest and largest community size: a one-row aggregate read as two scalars
    lo_hi = bounds.first()
    lo, hi = int(lo_hi["_lo"] or 1), int(lo_hi["_hi"] or 1)
    sel = sel.withColumn("color", two_end_color(log_scale(F.col("size"), F.lit(max(1, lo)), F.lit(hi))))
    layer = F.when(F.col("role") == "largest", F.format_string("largest community (%d)", F.col("size"))).when(
        F.col("role") == "smallest", F.format_string("smallest community (%d)", F.col("size"))
    ).otherwise(F.format_string("community %d (%d members)", F.col("community"), F.col("size")))
    sel = sel.withColumn("layer", layer)
    members = membership.join(sel.select("community"), "community", "left_semi")
    shown = sample_per_group(members, "community", max_members, seed) if max_members is not None else members
    pts = with_coords(shown, nodes).join(sel, "community")
    pts_f = _feature(pts, F.col("layer"), "point", F.col("color"), F.format_string("node %d (community %d)", F.col("id"), F.col("community")), F.array(_pt()))
    small = sel.filter(F.col("size") <= max_edge_size) if max_edge_size is not None else sel
    sm = shown.join(small.select("community"), "community", "left_semi")
    mu = sm.select(F.col("id").alias("src"), F.col("community").alias("cs"))
    mv = sm.select(F.col("id").alias("dst"), F.col("community").alias("cd"))
    inner = edges.select("src", "dst").join(mu, "src").join(mv, "dst").filter(F.col("cs") == F.col("cd"))
    a = with_coords(inner, nodes, "src", "a_")
    ab = with_coords(a, nodes, "dst", "b_").join(sel.withColumnRenamed("community", "cs"), "cs")
    e_f = _feature(ab, F.col("layer"), "line", F.col("color"), F.format_string("%d - %d", F.col("src"), F.col("dst")),
                   F.array(_pt("a_lon", "a_lat"), _pt("b_lon", "b_lat")))
    return pts_f.unionByName(e_f)
