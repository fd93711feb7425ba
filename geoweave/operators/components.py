"""Connected components (G12) with the alternating large-star / small-star algorithm
(Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii 2014).

The edge set is rewritten until every component is a star around its smallest node id:

* large-star: every node ``u`` links each larger neighbour to ``m(u)``, the smallest id in
  ``{u} ∪ Γ(u)``;
* small-star: every node ``u`` links itself and each smaller neighbour to the smallest id among
  them.

Both steps are one partial aggregate (``min`` per node — hubs are pre-combined map-side) and one
join; the number of rounds is O(log² n) in the worst case and close to log n in practice, in
contrast to O(diameter) for plain min-label propagation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.plans.iterate import RoundLog, checkpoint, drop_dead_shuffles, fingerprint, release


def _canon(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def _sym(e: DataFrame) -> DataFrame:
    return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _large_star(e: DataFrame) -> DataFrame:
    s = _sym(e)
    m = s.groupBy("u").agg(F.min("v").alias("_mv"))
    return _canon(
        s.join(m, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("a"), F.least(F.col("u"), F.col("_mv")).alias("b"))
    )


def _small_star(e: DataFrame) -> DataFrame:
    s = _sym(e).filter(F.col("v") < F.col("u"))
    m = s.groupBy("u").agg(F.min("v").alias("_m"))
    linked = s.join(m, "u").select(F.col("v").alias("a"), F.col("_m").alias("b"))
    centre = m.select(F.col("u").alias("a"), F.col("_m").alias("b"))
    return _canon(linked.unionByName(centre))


def stars(edges: DataFrame, rounds: RoundLog | None = None) -> DataFrame:
    """``(a, b)``: every node ``b`` of a component but its smallest one, linked to that one, ``a``.

    ``edges (src, dst)`` may be directed or undirected; both orientations are used. Rounds go on until
    the edge set no longer changes (its row count and hash are compared, one small job per round).
    """
    cur = checkpoint(_canon(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))))
    seen = fingerprint(cur)
    while True:
        nxt = checkpoint(_small_star(_large_star(cur)))
        now = fingerprint(nxt)
        if rounds is not None:
            rounds.record(edges=now[0])
        release(cur)
        cur = nxt
        drop_dead_shuffles(edges)
        if now == seen:
            return cur
        seen = now


def edge_components(edges: DataFrame, rounds: RoundLog | None = None) -> DataFrame:
    """``(id, component)`` of the nodes that have an edge to another node."""
    found = stars(edges, rounds)
    members = found.select(F.col("b").alias("id"), F.col("a").alias("component"))
    centres = found.groupBy("a").agg(F.lit(1).alias("_one")).select(F.col("a").alias("id"), F.col("a").alias("component"))
    return members.unionByName(centres)


def connected_components(nodes: DataFrame, edges: DataFrame, rounds: RoundLog | None = None) -> DataFrame:
    """``(id, component)`` where ``component`` is the smallest node id of the weak component.

    Nodes without edges are their own component.
    """
    # a centre has no row as a member and keeps its own id
    lab = stars(edges, rounds).select(F.col("b").alias("id"), F.col("a").alias("_c"))
    return nodes.select("id").join(lab, "id", "left").select(
        "id", F.coalesce(F.col("_c"), F.col("id")).alias("component")
    )


def component_sizes(membership: DataFrame, col: str = "component") -> DataFrame:
    """``(component, size)``."""
    return membership.groupBy(col).agg(F.count(F.lit(1)).alias("size"))


def pointer_jump(ptr: DataFrame, rounds: RoundLog | None = None) -> DataFrame:
    """Resolve a forest of parent pointers ``(c, p)`` (roots point to themselves) to
    ``(c, root)`` by repeated ``p ← p(p)``; O(log depth) rounds."""
    cur = ptr.select("c", "p")  # short lineage: the first jump reads it directly
    cur_src = None
    while True:
        q = cur.select(F.col("c").alias("_qc"), F.col("p").alias("_qp"))
        nxt = checkpoint(
            cur.join(q, cur.p == q["_qc"], "left").select(
                "c",
                F.coalesce(F.col("_qp"), F.col("p")).alias("p"),
                (F.coalesce(F.col("_qp"), F.col("p")) != F.col("p")).alias("_changed"),
            )
        )
        changed = nxt.filter("_changed").count()
        if rounds is not None:
            rounds.record(jump_changed=changed)
        release(cur_src)
        cur_src = nxt
        cur = nxt.drop("_changed")
        if changed == 0:
            break
    return cur.select("c", F.col("p").alias("root"))
