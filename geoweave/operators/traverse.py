"""Traversals: budgeted BFS tree (G1), reachability (G3), farthest node (A20), parent-chain
walks (G2/G6) and depth-first pre-order numbering of trees (G4).

Searches advance one level per round, walks and deep trees double their reach per round; every
round's output is checkpointed and the driver only reads counters.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.model import Graph
from geoweave.operators.ranking import global_rank, global_rank_counted, grouped_exclusive_sum
from geoweave.plans.iterate import Found, RoundLog, checkpoint, keyed, release

log = logging.getLogger(__name__)

TREE_COLS = ["id", "level", "parent", "visit_order"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def resolve_start(g: Graph, start: int, seed: int = 42) -> DataFrame:
    """The start node as a one-row frame; an id that is not a node is replaced by a
    deterministic pseudo-random node (Q16) with a warning."""
    hit = g.nodes.filter(F.col("id") == F.lit(start)).select("id")
    if hit.limit(1).count() == 1:
        return hit
    log.warning("start node %s is not in the graph; using a seeded random node", start)
    from geoweave.operators.sampling import sample_nodes

    return sample_nodes(g.nodes.select("id"), 1, seed)


def bfs_tree(
    g: Graph, start: int, max_nodes: int | None = None, rounds: RoundLog | None = None
) -> DataFrame:
    """G1: breadth-first tree ``(id, level, parent, visit_order)`` from ``start``.

    Exact FIFO semantics of a queue-based BFS with ascending neighbour lists: a node's parent is
    the earliest-visited node of the previous level that points to it, and the visit order of a
    level is ``(parent.visit_order, id)``. With ``max_nodes`` the search stops once that many
    nodes are visited, even in the middle of a level (L2). Per round: frontier ⋈ edges, partial
    aggregate per destination, anti-join with the visited set, distributed rank.
    """
    edges = keyed(g.edges.select("src", "dst"), "src")
    seed = resolve_start(g, start).select(
        F.col("id").cast("long").alias("id"),
        F.lit(0).alias("level"),
        F.lit(None).cast("long").alias("parent"),
        F.lit(0).cast("long").alias("visit_order"),
    )
    frontier = checkpoint(seed)
    frames = [frontier]
    seen = Found(["id"], edges)
    if seen.buckets is not None:
        seen.add(frontier.select("id", "level"), 0)
    total = frontier.count()
    level = 0
    while total > 0 and (max_nodes is None or total < max_nodes):
        cand = (
            frontier.join(edges, frontier.id == edges.src)
            .groupBy(edges.dst.alias("id"))
            .agg(F.min(F.struct(frontier.visit_order.alias("o"), edges.src.alias("p"))).alias("b"))
        )
        visited = _union([f.select("id") for f in frames]) if seen.buckets is None else seen.all().select("id")
        new = seen.placed(cand).join(visited.withColumn("_seen", F.lit(True)), "id", "left").filter("_seen is null").select(
            "id", F.col("b.p").alias("parent"), F.col("b.o").alias("_po")
        )
        if max_nodes is not None:  # only the rows that still fit are ranked (a bounded top-k)
            new = new.orderBy("_po", "id").limit(max_nodes - total)
        ranked, n_new = global_rank_counted(new, ["_po", "id"], rank_col="visit_order", start=total)
        # the ranked rows are already on reliable storage; this frame only adds columns
        nxt = ranked.select("id", F.lit(level + 1).alias("level"), "parent", "visit_order")
        if rounds is not None:
            rounds.record(level=level + 1, new_nodes=n_new)
        if n_new == 0:
            break
        frames.append(nxt)
        if seen.buckets is not None:
            seen.add(nxt.select("id", "level"), level + 1)
        total += n_new
        frontier = nxt
        level += 1
    release(edges)
    seen.release()
    return _union(frames)


def reachable(g: Graph, sources: DataFrame, rounds: RoundLog | None = None) -> DataFrame:
    """``(source, id, level)`` for every node reachable from each source (multi-source).

    Order-free closure: frontier ⋈ edges → distinct → anti-join visited, until no new pair.
    ``sources`` has columns ``source`` and ``id`` (the start node of that source key).
    """
    edges = keyed(g.edges.select("src", "dst"), "src")
    found = Found(["source", "id"], edges)
    frontier = found.add(sources.select("source", "id", F.lit(0).alias("level")).distinct(), 0)
    level = 0
    while True:
        level += 1
        cand = frontier.join(edges, frontier.id == edges.src).select("source", edges.dst.alias("id")).distinct()
        seen = found.all().select("source", "id", F.lit(True).alias("_seen"))
        new = found.placed(cand).join(seen, ["source", "id"], "left").filter("_seen is null").drop("_seen")
        frontier = found.add(new.withColumn("level", F.lit(level)), level)
        n_new = frontier.count()
        if rounds is not None:
            rounds.record(level=level, new_nodes=n_new)
        if n_new == 0:
            found.drop_last()
            break
    release(edges)
    return found.all()


def farthest_node(tree: DataFrame, key_cols=()) -> DataFrame:
    """Deepest node of a tree (largest level; ties → smallest id)."""
    best = F.min(F.struct((-F.col("level")).alias("nl"), F.col("id").alias("id")))
    agg = tree.groupBy(*key_cols).agg(best.alias("b")) if key_cols else tree.agg(best.alias("b"))
    return agg.select(*key_cols, F.col("b.id").alias("id"), (-F.col("b.nl")).alias("level"))


def walk_up(parents: DataFrame, targets: DataFrame, key_cols=("key",)) -> DataFrame:
    """Follow ``parent`` pointers from each target to its root.

    ``parents``: ``(…key_cols, id, parent)``; ``targets``: ``(…key_cols, id)``. Returns
    ``(…key_cols, id, step)`` with step 0 at the target.

    Pointer doubling: round ``k`` has a table of jumps over ``2 ** k`` hops, by which the part of a walk already
    known gives as much again, and jumps joined with themselves give the next table. A walk of ``h`` hops takes
    ``log2(h)`` rounds, all targets together; a round writes one table.
    """
    keys = list(key_cols)
    jump = parents.filter(F.col("parent").isNotNull()).select(
        *keys, "id", F.col("parent").alias("to"), F.lit(None).cast("long").alias("step")
    )
    walk = targets.select(*keys, "id", F.lit(None).cast("long").alias("to"), F.lit(0).cast("long").alias("step"))
    table = checkpoint(jump.unionByName(walk))
    hops = 1
    while True:
        jump = table.filter("step is null").drop("step")
        walk = table.filter("step is not null").select(*keys, "id", "step")
        # tables as large as the state are joined by shuffles: none of them passes the driver
        ahead = walk.join(jump.hint("merge"), keys + ["id"]).select(
            *keys, F.col("to").alias("id"), F.lit(None).cast("long").alias("to"), (F.col("step") + hops).alias("step")
        )
        further = jump.select(*keys, F.col("id").alias("to"), F.col("to").alias("_to"))
        longer = jump.join(further.hint("merge"), keys + ["to"]).select(*keys, "id", F.col("_to").alias("to"), F.lit(None).cast("long").alias("step"))
        known = walk.select(*keys, "id", F.lit(None).cast("long").alias("to"), "step")
        prev, table = table, checkpoint(known.unionByName(ahead).unionByName(longer))
        release(prev)
        hops *= 2
        if table.filter(F.col("step") >= hops // 2).isEmpty():
            return table.filter("step is not null").select(*keys, "id", F.col("step").cast("int").alias("step"))


def bfs_longest_path(tree: DataFrame) -> DataFrame:
    """The tree path from the root to the farthest node as ``(pos, id)``; in a BFS tree the
    position of a node on its root path is its level."""
    far = farthest_node(tree).select(F.lit(0).alias("key"), "id")
    chain = walk_up(tree.select(F.lit(0).alias("key"), "id", "parent"), far)
    return chain.join(tree.select("id", "level"), "id").select(
        F.col("level").cast("long").alias("pos"), "id"
    )


def tree_depths(tree_edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Top-down depth of every node of a rooted forest given parent → child edges
    ``(src, dst)``: ``(id, parent, depth)``."""
    edges = checkpoint(tree_edges.select("src", "dst"))
    cur = checkpoint(
        roots.select(F.col("id"), F.lit(None).cast("long").alias("parent"), F.lit(0).alias("depth"))
    )
    frames = [cur]
    d = 0
    while True:
        nxt = checkpoint(
            cur.join(edges, cur.id == edges.src).select(
                edges.dst.alias("id"), edges.src.alias("parent"), F.lit(d + 1).alias("depth")
            )
        )
        if nxt.count() == 0:
            break
        frames.append(nxt)
        cur = nxt
        d += 1
    release(edges, nxt)
    return _union(frames)


def tree_preorder(tree: DataFrame) -> DataFrame:
    """Depth-first pre-order of a rooted forest ``(id, parent, depth)`` with children in
    ascending id order: ``(id, depth, visit_order, subtree_size)``.

    Equals the visit order of a stack DFS that pushes neighbours in reverse order when the
    reachable part is a tree. Shallow trees go level by level, two joins a level; a tree deeper than
    an Euler tour takes rounds (the logarithm of its nodes) is ranked as such a tour.
    """
    t = checkpoint(tree.select("id", "parent", "depth"))
    shape = t.agg(F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n")).first()
    if shape["depth"] is None:
        return t.select("id", "depth", F.lit(0).cast("long").alias("visit_order"), F.lit(1).cast("long").alias("subtree_size"))
    tour_rounds = (2 * shape["n"]).bit_length()
    return _preorder_by_levels(t, shape["depth"]) if 2 * shape["depth"] <= tour_rounds else _preorder_by_tour(t, shape["n"])


def _preorder_by_tour(t: DataFrame, n: int) -> DataFrame:
    """Pre-order by ranking the Euler tour.

    Every node has an arc down into it and one up out of it. The arc after a node's down arc is that into its
    first child, or its own up arc; the one after its up arc is that into its next sibling, or its parent's up
    arc; roots are siblings. List ranking by pointer doubling counts the down arcs from each arc to the
    end: from a node's down arc it gives the order, the difference to its up arc the size."""
    grouped = t.withColumn("_grp", F.coalesce(F.col("parent"), F.lit(-1).cast("long")))
    # the next sibling is the next row of the order (parent, id): no window over a hub's children
    ranked = checkpoint(global_rank(grouped, ["_grp", "id"], rank_col="_r").select("id", "parent", "_grp", "_r"))
    following = ranked.select((F.col("_r") - 1).alias("_r"), F.col("_grp").alias("_ng"), F.col("id").alias("_sibling"))
    first = t.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.min("id").alias("_child"))
    nodes = ranked.join(following, "_r", "left").join(first, "id", "left")
    sibling = F.when(F.col("_ng") == F.col("_grp"), F.col("_sibling"))
    down_next = F.struct(F.coalesce("_child", "id").alias("id"), F.col("_child").isNull().alias("up"))
    up_next = F.when(sibling.isNotNull(), F.struct(sibling.alias("id"), F.lit(False).alias("up"))).when(
        F.col("parent").isNotNull(), F.struct(F.col("parent").alias("id"), F.lit(True).alias("up"))
    )
    arc = F.array(
        F.struct(F.lit(False).alias("up"), down_next.alias("nxt"), F.lit(1).cast("long").alias("downs")),
        F.struct(F.lit(True).alias("up"), up_next.alias("nxt"), F.lit(0).cast("long").alias("downs")),
    )
    arcs = checkpoint(nodes.select("id", F.inline(arc).alias("up", "nxt", "downs")).select("id", "up", F.col("nxt.id").alias("nid"), F.col("nxt.up").alias("nup"), "downs"))
    release(ranked)
    for _ in range((2 * n - 1).bit_length()):  # jumps of 1, 2, 4, ... arcs reach the end of the tour
        ahead = arcs.select(
            F.col("id").alias("nid"), F.col("up").alias("nup"), F.col("nid").alias("_id"), F.col("nup").alias("_up"), F.col("downs").alias("_d")
        )
        prev = arcs
        arcs = checkpoint(
            arcs.join(ahead, ["nid", "nup"], "left").select(
                "id", "up", F.col("_id").alias("nid"), F.col("_up").alias("nup"), (F.col("downs") + F.coalesce("_d", F.lit(0))).alias("downs")
            )
        )
        release(prev)
    ends = arcs.groupBy("id").agg(
        F.max(F.when(~F.col("up"), F.col("downs"))).alias("_down"), F.max(F.when(F.col("up"), F.col("downs"))).alias("_up")
    )
    return t.select("id", "depth").join(ends, "id").select(
        "id", "depth", (F.lit(n) - F.col("_down")).alias("visit_order"), (F.col("_down") - F.col("_up")).alias("subtree_size")
    )


def _preorder_by_levels(t: DataFrame, max_depth: int) -> DataFrame:
    """Bottom-up subtree sizes (one grouped sum per level), one skew-safe grouped prefix sum over
    siblings, then top-down offsets (one join per level)."""
    # bottom-up subtree sizes
    sizes_by_level: dict[int, DataFrame] = {}
    below = None
    for d in range(max_depth, -1, -1):
        lvl = t.filter(F.col("depth") == d)
        if below is None:
            sized = lvl.withColumn("subtree_size", F.lit(1).cast("long"))
        else:
            child = below.groupBy(F.col("parent").alias("id")).agg(F.sum("subtree_size").alias("_cs"))
            sized = lvl.join(child, "id", "left").withColumn(
                "subtree_size", (F.lit(1) + F.coalesce("_cs", F.lit(0))).cast("long")
            ).drop("_cs")
        below = checkpoint(sized)
        sizes_by_level[d] = below
    sized_all = _union([sizes_by_level[d] for d in range(max_depth + 1)])
    # sum of the sizes of earlier siblings (roots form one sibling group)
    grouped = sized_all.withColumn("_grp", F.coalesce(F.col("parent"), F.lit(-1).cast("long")))
    sib = checkpoint(
        grouped_exclusive_sum(grouped, "_grp", ["id"], "subtree_size", "_before").drop("_grp")
    )
    # top-down: order(v) = order(parent) + 1 + before(v); a root starts at before(root)
    cur = checkpoint(
        sib.filter(F.col("depth") == 0).select(
            "id", "depth", F.col("_before").cast("long").alias("visit_order"), "subtree_size"
        )
    )
    frames = [cur]
    for d in range(1, max_depth + 1):
        lvl = sib.filter(F.col("depth") == d)
        nxt = checkpoint(
            lvl.join(cur.select(F.col("id").alias("parent"), F.col("visit_order").alias("_po")), "parent").select(
                "id",
                "depth",
                (F.col("_po") + 1 + F.col("_before")).cast("long").alias("visit_order"),
                "subtree_size",
            )
        )
        frames.append(nxt)
        cur = nxt
    return _union(frames)


def deepest_in_preorder(order: DataFrame) -> DataFrame:
    """Q13: deepest node = first in visit order among those of maximal depth."""
    b = order.agg(F.min(F.struct((-F.col("depth")).alias("nd"), F.col("visit_order").alias("o"), F.col("id").alias("id"))).alias("b"))
    return b.select(F.col("b.id").alias("id"), (-F.col("b.nd")).alias("depth"), F.col("b.o").alias("visit_order"))
