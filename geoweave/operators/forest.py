"""Minimum spanning forests (G13 per community, G14 per component) by Borůvka rounds.

Each round every fragment picks its lightest outgoing edge (``min(struct(weight, u, v))`` — a
partial aggregate, so a giant fragment costs no more than a small one), the picked edges join
the forest, and fragments merge by pointer jumping along the picked edges (with a strict total
order on edges the only cycles are mutual picks, broken toward the smaller label). The number of
fragments at least halves per round, so there are O(log n) rounds.

Before the first shuffle every partition drops the edges that are the heaviest of a cycle among its own
edges: no forest holds them. Once no more than ``FINISH_EDGES`` edges between fragments are left, one task
finishes them instead of further rounds; both work on arrays of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.model import Graph
from geoweave.operators.community import valid_start_nodes
from geoweave.operators.components import pointer_jump
from geoweave.operators.structure import total_degree
from geoweave.plans.iterate import RoundLog, checkpoint, release

INF = float("inf")
#: edges that a task looks at together when it drops heavy ones
PRUNE_EDGES = 1 << 17
#: edges between fragments that one task may finish
FINISH_EDGES = 1 << 19


def _finite(w):
    return w.isNotNull() & ~F.isnan(w) & (w < F.lit(INF))


def light_edges(a: np.ndarray, b: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forest of the edges ``(a, b)``, ``order`` naming them from light to heavy: the places of
    its edges, the distinct nodes, and the place of each node's root among them."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    place = order[a[order] != b[order]]
    a, b = ends[: len(a)][place], ends[len(a) :][place]
    root = np.arange(len(names))
    kept = [place[:0]]
    while len(place):
        turn = np.arange(len(place))
        best = np.full(len(names), len(place))
        np.minimum.at(best, a, turn)
        np.minimum.at(best, b, turn)
        picks = np.flatnonzero(best < len(place))
        pointer = np.arange(len(names))
        pointer[picks] = a[best[picks]] + b[best[picks]] - picks
        mutual = (pointer[pointer] == np.arange(len(names))) & (np.arange(len(names)) < pointer)
        pointer[mutual] = np.flatnonzero(mutual)
        while (pointer[pointer] != pointer).any():
            pointer = pointer[pointer]
        kept.append(place[np.unique(best[picks])])
        root, a, b = pointer[root], pointer[a], pointer[b]
        place, a, b = place[a != b], a[a != b], b[a != b]
    return np.concatenate(kept), names, root


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def without_heavy_edges(edges: DataFrame, at_once: int | None = None) -> DataFrame:
    """``(u, v, weight)`` without edges that close a cycle of lighter ones inside their partition.

    A task holds at most ``2 * at_once`` edges and an Arrow batch. Where hardly any edge goes, as in a partition
    with few cycles, the rest passes as it is. Weights must be finite.
    """
    limit = at_once or PRUNE_EDGES
    cols = ("u", "v", "weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passing = [], False

        def light() -> list[np.ndarray]:
            u, v, w = (np.concatenate(c) for c in zip(*held, strict=True))
            keep = np.sort(light_edges(u, v, np.lexsort((v, u, w)))[0])
            return [u[keep], v[keep], w[keep]]

        for batch in batches:
            if passing:
                yield batch.select(list(cols))
                continue
            held.append(_columns(batch, cols))
            size = sum(len(h[0]) for h in held)
            if size > 2 * limit:
                held = [light()]
                passing = len(held[0][0]) > 0.9 * size
                if passing or len(held[0][0]) > limit:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], list(cols))
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in light()], list(cols))

    return edges.select(*cols).mapInArrow(run, "u long, v long, weight double")


def _finished(live: DataFrame) -> DataFrame:
    """``(c, root, u, v, weight)``: the last merges, a row per fragment, and beside them the last forest edges, one
    fewer than fragments in each tree (null in the rows left over). ``live`` has at most ``FINISH_EDGES`` rows."""
    cols = ("fu", "fv", "weight", "u", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [_columns(b, cols) for b in batches if b.num_rows]
        if not rows:
            return
        fu, fv, w, u, v = (np.concatenate(c) for c in zip(*rows, strict=True))
        keep, names, root = light_edges(fu, fv, np.lexsort((v, u, w)))
        spare = pa.nulls(len(names) - len(keep))
        ends = [pa.concat_arrays([pa.array(c[keep]), spare.cast(pa.array(c).type)]) for c in (u, v, w)]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[root]), *ends], ["c", "root", "u", "v", "weight"])

    flat = live.select("fu", "fv", "k.weight", "k.u", "k.v").coalesce(1)
    return flat.mapInArrow(run, "c long, root long, u long, v long, weight double")


def spanning_forest(
    nodes: DataFrame,
    edges: DataFrame,
    membership: DataFrame | None = None,
    rounds: RoundLog | None = None,
    finish_edges: int | None = None,
) -> DataFrame:
    """Forest edges ``(u, v, weight, grp)``.

    ``edges``: ``(src, dst, weight)``, treated as undirected; parallel edges keep their minimum.
    With ``membership(id, community)`` only edges inside one community are used and ``grp`` is
    the community (G13); otherwise ``grp`` is the smallest node id of the tree (G14).
    """
    finish = FINISH_EDGES if finish_edges is None else finish_edges
    canon = edges.filter((F.col("src") != F.col("dst")) & _finite(F.col("weight"))).select(
        F.least("src", "dst").cast("long").alias("u"), F.greatest("src", "dst").cast("long").alias("v"), F.col("weight").cast("double")
    )
    if membership is not None:
        mu = membership.select(F.col("id").alias("u"), F.col("community").alias("_cu"))
        mv = membership.select(F.col("id").alias("v"), F.col("community").alias("_cv"))
        canon = canon.join(mu, "u").join(mv, "v").filter(F.col("_cu") == F.col("_cv")).select("u", "v", "weight")
    canon = without_heavy_edges(canon).groupBy("u", "v").agg(F.min("weight").alias("weight"))
    # an edge carries the fragments of its ends; parallel edges between fragments keep their lightest,
    # so the table shrinks with the fragments and the nodes themselves are never rewritten
    live = checkpoint(canon.select(F.col("u").alias("fu"), F.col("v").alias("fv"), F.struct("weight", "u", "v").alias("k")))
    picked: list[DataFrame] = []
    merges: list[DataFrame] = []
    while (left := live.count()) > 0:
        if left <= finish:
            last = checkpoint(_finished(live))
            if rounds is not None:
                rounds.record(fragments=last.count())
            picked.append(last.filter("u is not null").select("u", "v", "weight"))
            merges.append(last.select("c", "root"))
            break
        inc = live.select(F.col("fu").alias("f"), "k", F.col("fv").alias("other")).unionByName(
            live.select(F.col("fv").alias("f"), "k", F.col("fu").alias("other"))
        )
        best = checkpoint(
            inc.groupBy("f").agg(F.min(F.struct("k", "other")).alias("b")).select(
                "f", F.col("b.k.u").alias("u"), F.col("b.k.v").alias("v"), F.col("b.k.weight").alias("weight"), F.col("b.other").alias("p")
            )
        )
        if rounds is not None:
            rounds.record(fragments=best.count())
        # the round's best-edge table is kept (one row per fragment); forest edges are read from it
        picked.append(best.select("u", "v", "weight").distinct())
        # mutual picks form the only cycles: the smaller fragment label becomes the root
        back = best.select(F.col("f").alias("_bf"), F.col("p").alias("_bp"))
        ptr = best.join(back, best.p == back["_bf"]).select(
            F.col("f").alias("c"),
            F.when((F.col("_bp") == F.col("f")) & (F.col("f") < F.col("p")), F.col("f")).otherwise(F.col("p")).alias("p"),
        )
        roots = checkpoint(pointer_jump(ptr))
        merges.append(roots)
        ru = roots.select(F.col("c").alias("fu"), F.col("root").alias("_ru"))
        rv = roots.select(F.col("c").alias("fv"), F.col("root").alias("_rv"))
        prev = live
        live = checkpoint(
            live.join(ru, "fu")
            .join(rv, "fv")
            .filter(F.col("_ru") != F.col("_rv"))
            .groupBy(F.least("_ru", "_rv").alias("fu"), F.greatest("_ru", "_rv").alias("fv"))
            .agg(F.min("k").alias("k"))
        )
        release(prev)
    release(live)
    if not picked:
        spark = nodes.sparkSession
        return spark.createDataFrame([], "u bigint, v bigint, weight double, grp bigint")
    forest = reduce(lambda a, b: a.unionByName(b), picked)
    if membership is not None:
        grp = membership.select(F.col("id").alias("u"), F.col("community").alias("grp"))
    else:
        # final root of every node: the merges composed from the last (smallest) to the first
        final = merges[-1]
        for roots in reversed(merges[:-1]):
            later = final.select(F.col("c").alias("root"), F.col("root").alias("_end"))
            final = roots.join(later, "root", "left").select("c", F.coalesce("_end", "root").alias("root"))
        final = checkpoint(final)
        smallest = final.groupBy("root").agg(F.min("c").alias("grp"))
        grp = final.join(smallest, "root").select(F.col("c").alias("u"), "grp")
    return forest.join(grp, "u").select("u", "v", "weight", "grp")


def community_forest(g: Graph, membership: DataFrame, rounds: RoundLog | None = None) -> DataFrame:
    """The forest of every community that has a valid start (L11): a member with coordinates and
    a link. Other communities are skipped whole, whatever their weights."""
    starts = valid_start_nodes(membership, g.nodes, total_degree(g)).select("community")
    return spanning_forest(g.nodes, g.edges, membership.join(starts, "community", "left_semi"), rounds)


def forest_total(forest: DataFrame) -> DataFrame:
    """``(n_edges, total_weight)``."""
    return forest.agg(F.count(F.lit(1)).alias("n_edges"), F.sum("weight").alias("total_weight"))
