"""Weighted shortest paths (G5–G7, A17, A21, L9) by set-wise frontier relaxation.

State ``(qid, id, dist, pdist, pred)`` holds, per query and node, the best known distance and
the predecessor that reached it. Each round relaxes the out-edges of nodes whose distance
dropped since they were last relaxed (the nearest of them first where many wait), keeps per
destination the minimum of ``struct(dist, pdist, pred)`` (a partial aggregate: hubs are
pre-combined map-side) and logs only improvements. Equal-cost predecessors resolve to the smallest
``(dist(pred), pred)`` — the one a binary-heap Dijkstra pops first. With a sink, a search from both
ends first finds the links that can lie on a shortest route, and only those are relaxed.
All queries of a batch advance in the same jobs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.functions.geo import haversine_km
from geoweave.functions.keys import md5_int
from geoweave.model import Graph
from geoweave.operators.components import stars
from geoweave.operators.traverse import walk_up
from geoweave.plans.iterate import Found, RoundLog, checkpoint, drop_dead_shuffles, keyed, release

BEST = ["dist", "pdist", "pred"]


def usable_edges(g: Graph) -> DataFrame:
    """Edges with a finite weight (``inf`` edges — missing coordinates — are never usable)."""
    if not g.has_weight:
        raise ValueError("shortest paths need a 'weight' column; run geo.edge_weights first")
    w = F.col("weight")
    return g.edges.filter(w.isNotNull() & ~F.isnan(w) & (w < F.lit(float("inf")))).select(
        "src", "dst", "weight"
    )


def prepared_edges(g: Graph, heads: bool = True) -> DataFrame:
    """Usable edges written once for a whole search or batch; with km weights and ``heads`` each edge also carries its
    head's coordinates, so rounds bounded by distance need no join with the nodes."""
    edges = usable_edges(g)
    if g.km_weights and heads:
        ends = g.nodes.select(F.col("id").alias("dst"), F.col("lat").alias("_dlat"), F.col("lon").alias("_dlon"))
        edges = edges.join(ends, "dst", "left")
    return keyed(edges, "src")


def prepared_sides(g: Graph) -> tuple[DataFrame, DataFrame]:
    """Usable edges written twice, keyed by their tails and by their heads, for searches with sinks."""
    edges = prepared_edges(g, heads=False)
    drop_dead_shuffles(edges)
    return edges, keyed(edges, "dst")


def shortest_paths(
    g: Graph,
    sources: DataFrame,
    sinks: DataFrame | None = None,
    rounds: RoundLog | None = None,
    geo_bound: bool = True,
    edges: DataFrame | None = None,
    back: DataFrame | None = None,
) -> DataFrame:
    """``(qid, id, dist, pred)`` for the nodes reached from each query's source.

    ``sources``: ``(qid, source)``. ``sinks``: optional ``(qid, sink)``, one a query: then rows are those of nodes that
    can lie on a shortest route to the sink, none but the source's where no route leads there. Without sinks distances
    to all reachable nodes are exact. Weights must not be negative; zero is allowed.

    With sinks, a search from both ends (``links_between``) first leaves each query the few links that matter; the
    search from the source then runs on those and gives distances, ties and predecessors as on all edges. With
    ``geo_bound``, and only where the graph's weights are known to be great-circle distances (``Graph.km_weights``),
    the great-circle distance still to go bounds that search too.

    Queries, bounds and state are tables: nothing but a few numbers per round reaches the driver. The state is a log
    (``Found``) to which a round adds the rows that improved; a node's row is the smallest of its rows. A predecessor
    of equal cost replaces another only if it is itself nearer to the source, so predecessors never form a cycle over
    zero-weight edges. ``edges`` and ``back`` may be given as made by ``prepared_sides`` to share them between searches.

    A search from one source relaxes the nearest ``NEAREST`` of the waiting nodes in a round while many wait: a node
    far from the source would mostly be relaxed again when its distance drops. The order changes no distance.
    """
    own = edges is None
    if sinks is not None:
        goal = sinks.filter("sink is not null").select("qid", F.col("sink").cast("long").alias("sink"))
        ends = checkpoint(sources.select("qid", F.col("source").cast("long").alias("source")).join(goal, "qid"))
        free = sources.join(goal, "qid", "left_anti")  # no sink: searched without a bound
        if own:
            edges, back = prepared_sides(g)
        made = back is None
        back = keyed(edges, "dst") if made else back
        links = links_between(g, ends, edges, back, geo_bound and g.km_weights, rounds)
        state = _search(ends.select("qid", "source"), links, rounds)
        release(links, ends, *((back,) if made or own else ()))
        if not free.isEmpty():
            state = state.unionByName(_search(free, edges, rounds))
        release(edges if own else None)
        return state
    edges = prepared_edges(g, False) if own else edges
    state = _search(sources, edges, rounds)
    release(edges if own else None)
    return state


def _search(sources: DataFrame, edges: DataFrame, rounds: RoundLog | None) -> DataFrame:
    """``(qid, id, dist, pred)`` of all nodes reached over ``edges``; edges with a ``qid`` serve that query alone."""
    start = checkpoint(
        sources.select(
            "qid",
            F.col("source").cast("long").alias("id"),
            F.lit(0.0).alias("dist"),
            F.lit(-1.0).alias("pdist"),
            F.lit(None).cast("long").alias("pred"),
            F.lit(0).alias("level"),
            F.lit(True).alias("near"),
        )
    )
    one = start.limit(2).count() < 2
    # the links of one query are few and nearly each leads to a least distance: no round of theirs is limited
    few = edges.count() // EDGES_PER_WAITING if one and "qid" not in edges.columns else float("inf")
    found = Found(["qid", "id"], edges)
    found.add(start, 0)
    release(start)
    r, limits, reach = 0, {}, float("inf")
    while True:
        r += 1
        frontier = _waiting(found.all(), r, limits).filter(F.col("dist") <= reach)
        if limits:  # rows of earlier rounds may have been improved since
            other = found.all().select(F.col("qid").alias("_q"), F.col("id").alias("_i"), F.col("dist").alias("_less"))
            same = (F.col("qid") == F.col("_q")) & (F.col("id") == F.col("_i"))
            frontier = frontier.join(other.hint("merge"), same & (F.col("_less") < F.col("dist")), "left_anti")
        limits = {} if reach == float("inf") else {**limits, r: reach}
        frontier = frontier.select("qid", "id", "dist")
        if one and found.buckets is not None:  # at most one row a node: a bucket of edges streams past its nodes
            frontier = frontier.hint("shuffle_hash")
        fits = frontier.id == edges.src
        if "qid" in edges.columns:
            fits &= frontier.qid == edges.qid
        cand = frontier.join(edges, fits).select(
            frontier.qid,
            F.col("dst").alias("id"),
            (F.col("dist") + F.col("weight")).alias("dist"),
            F.col("dist").alias("pdist"),
            F.col("id").alias("pred"),
        )
        best = found.placed(cand.groupBy("qid", "id").agg(F.min(F.struct(*BEST)).alias("c")))
        old = found.all().groupBy("qid", "id").agg(F.min(F.struct(*BEST)).alias("o")).hint("merge")
        nearer = F.col("o").isNull() | (F.col("c.dist") < F.col("o.dist"))
        tie = (F.col("c.dist") == F.col("o.dist")) & (F.col("c") < F.col("o")) & (F.col("c.pdist") < F.col("c.dist"))
        found.add(
            best.join(old, ["qid", "id"], "left").filter(nearer | tie).select(
                "qid", "id", *(F.col(f"c.{x}").alias(x) for x in BEST), F.lit(r).alias("level"), nearer.alias("near")
            ),
            r,
        )
        left = _waiting(found.all(), r + 1, limits).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("level") == r, 1)).alias("new"),
            F.percentile_approx("dist", NEAREST, 100).alias("reach"),
        ).first()
        if rounds is not None:
            rounds.record(improved=left["new"])
        if left["n"] == 0:
            break
        reach = float("inf") if left["n"] <= few else left["reach"]
        if r % ROUNDS_PER_LOG == 0:
            found = _compacted(found, edges)
    state = checkpoint(_rows_now(found.all()))
    found.drop_all()
    out = state.select("qid", "id", "dist", "pred")
    out._round_path = state._round_path  # a caller that is done with the rows may release them
    return out


def links_between(
    g: Graph, ends: DataFrame, edges: DataFrame, back: DataFrame, geo_bound: bool = False, rounds: RoundLog | None = None
) -> DataFrame:
    """``(qid, src, dst, weight)``, written: all links that can lie on a shortest route of ``ends(qid, source, sink)``.

    Every query is searched from both ends at once, nearest nodes first. A row of the state holds a node's distance
    from the source ``f`` and to the sink ``b`` and at which of them it was last relaxed (``fr``, ``br``); where both
    are known their sum bounds the route. ``rf`` and ``rb`` are the least distances still to be relaxed. A node whose
    distance and the other end's ``r`` (or the great-circle distance to that end) exceed the bound need not
    be relaxed: a shortest route through it was met from the other end, or there is none. A query ends when ``rf + rb``
    exceeds its bound or one end has nothing left; each node of its shortest routes was then relaxed from an end.
    In a graph whose searches spread fast the two halves hold a small part of what one whole search would.
    """
    place = g.nodes.select("id", "lat", "lon") if geo_bound else None
    if geo_bound:
        for end, x in (("source", "s"), ("sink", "t")):
            ends = ends.join(place.select(F.col("id").alias(end), F.col("lat").alias(f"_{x}lat"), F.col("lon").alias(f"_{x}lon")), end, "left")
    ends = checkpoint(ends)
    few = max(WAITING_AT_ONCE, edges.count() // (2 * EDGES_PER_WAITING * max(1, ends.count())))
    none = F.lit(None).cast("double")
    zero, inf = F.lit(0.0), F.lit(float("inf"))
    first = ends.select("qid", F.col("source").alias("id"), zero.alias("f"), none.alias("b")).unionByName(
        ends.select("qid", F.col("sink").alias("id"), none.alias("f"), zero.alias("b"))
    )
    first = first.groupBy("qid", "id").agg(F.min("f").alias("f"), F.min("b").alias("b"))
    state = checkpoint(
        first.select(
            "qid", "id", "f", "b", none.alias("fr"), none.alias("br"), zero.alias("fh"), zero.alias("bh"),
            F.col("f").isNotNull().alias("fw"), F.col("b").isNotNull().alias("bw"),
        )
    )
    least = F.col("best") + F.col("best") * F.lit(1e-9) + F.lit(1e-9)  # never too small by rounding
    may = {"f": F.col("f") + F.greatest("rb", "fh") <= least, "b": F.col("b") + F.greatest("rf", "bh") <= least}
    while True:
        bounds = checkpoint(_bounds_of(state, few))
        now = bounds.agg(F.count(F.when(F.col("live"), 1)).alias("live"), F.sum("waiting").alias("waiting")).first()
        if rounds is not None:
            rounds.record(live=now["live"], waiting=now["waiting"])
        known = state.join(bounds, "qid")
        if not now["live"]:
            break
        go = {x: F.col("live") & F.col(f"{x}w") & (F.col(x) <= F.col(f"reach_{x}")) & may[x] for x in "fb"}
        ahead = known.filter(go["f"]).select("qid", "id", "f").join(edges, F.col("id") == edges.src)
        behind = known.filter(go["b"]).select("qid", "id", "b").join(back, F.col("id") == back.dst)
        cand = ahead.select("qid", F.col("dst").alias("id"), (F.col("f") + F.col("weight")).alias("f"), none.alias("b")).unionByName(
            behind.select("qid", F.col("src").alias("id"), none.alias("f"), (F.col("b") + F.col("weight")).alias("b"))
        )
        cand = cand.groupBy("qid", "id").agg(F.min("f").alias("f"), F.min("b").alias("b"))
        togo = {"f": zero, "b": zero}
        if geo_bound:
            cand = cand.join(place, "id", "left").join(ends, "qid")
            togo = {x: _still_to_go(y) for x, y in (("f", "t"), ("b", "s"))}
        cand = cand.select(
            "qid", "id", "f", "b", none.alias("fr"), none.alias("br"),
            *(F.when(F.col(x).isNotNull(), togo[x]).alias(f"{x}h") for x in "fb"),
        )
        done = known.select("qid", "id", "f", "b", *(F.when(go[x], F.col(x)).otherwise(F.col(f"{x}r")).alias(f"{x}r") for x in "fb"), "fh", "bh")
        values = ["f", "b", "fr", "br", "fh", "bh"]
        after = done.unionByName(cand).groupBy("qid", "id").agg(*(F.min(x).alias(x) for x in values))
        waits = {x: F.col(x).isNotNull() & F.coalesce(F.col(x) < F.col(f"{x}r"), F.lit(True)) & may[x] for x in "fb"}
        after = after.join(bounds, "qid").select("qid", "id", *values, *(F.coalesce(waits[x], F.lit(False)).alias(f"{x}w") for x in "fb"))
        met = F.col("f").isNotNull() & F.col("b").isNotNull()
        after = checkpoint(after.filter(met | F.col("fw") | F.col("bw") | F.col("fr").isNotNull() | F.col("br").isNotNull()))
        release(state, bounds)
        state = after
        drop_dead_shuffles(edges)
    on = {x: F.coalesce(F.col(f"{x}r") == F.col(x), F.lit(False)) for x in "fb"}
    kept = (on["f"] & (F.col("f") + F.col("fh") <= least)) | (on["b"] & (F.col("b") + F.col("bh") <= least))
    relaxed = [F.when(on[x], F.col(x)).alias(x) for x in "fb"]
    inside = known.filter((F.col("best") < inf) & kept).select("qid", "id", *relaxed, least.alias("least"), (least - F.col("best")).alias("slack"))
    inside = checkpoint(inside)
    release(state, bounds)
    tails = inside.withColumnsRenamed({"id": "src", "f": "f_src", "b": "b_src"})
    heads = inside.select("qid", F.col("id").alias("dst"), F.col("f").alias("f_dst"), F.col("b").alias("b_dst"))
    # a node may have been relaxed from one end at more than its least distance, if it was met from the other end at
    # that: the links of a shortest route up to some node are least ways from the source, then one joins the halves,
    # the others are least ways to the sink
    w = F.col("weight")
    before, after = F.col("f_src") + w <= F.col("f_dst") + F.col("slack"), F.col("b_dst") + w <= F.col("b_src") + F.col("slack")
    across = F.col("f_src") + w + F.col("b_dst") <= F.col("least")
    links = tails.join(edges, "src").join(heads, ["qid", "dst"]).filter(before | after | across)
    links = keyed(links.select("qid", "src", "dst", "weight"), "src")
    release(inside, ends)
    return links


#: so many waiting nodes of one end of a query are relaxed in a round without a look at their distances
WAITING_AT_ONCE = 256


def _bounds_of(state: DataFrame, few: int) -> DataFrame:
    """Of every query: the least known way ``best``, the least waiting distances ``rf`` and ``rb``, up to which distance
    a round relaxes, how many nodes wait, and whether the search goes on (``live``)."""
    inf = F.lit(float("inf"))
    wait = {x: F.when(F.col(f"{x}w"), F.col(x)) for x in "fb"}
    sums = [F.min(F.col("f") + F.col("b")).alias("_best")]
    for x in "fb":
        sums += [
            F.min(wait[x]).alias(f"_r{x}"), F.count(wait[x]).alias(f"_n{x}"), F.percentile_approx(wait[x], NEAREST, 100).alias(f"_p{x}")
        ]
    per = state.groupBy("qid").agg(*sums).select(
        "qid", F.coalesce("_best", inf).alias("best"), *(F.coalesce(f"_r{x}", inf).alias(f"r{x}") for x in "fb"),
        *(F.when(F.col(f"_n{x}") > few, F.col(f"_p{x}")).otherwise(inf).alias(f"reach_{x}") for x in "fb"),
        (F.col("_nf") + F.col("_nb")).alias("waiting"),
    )
    ahead = (F.col("rf") < inf) & (F.col("rb") < inf)
    return per.withColumn("live", ahead & (F.col("rf") + F.col("rb") <= F.col("best") + F.col("best") * F.lit(1e-9) + F.lit(1e-9)))


def _still_to_go(x: str):
    """Great-circle distance of a node to the end ``x`` of its query, less what rounding may add near the antipode."""
    h = haversine_km(F.col("lat"), F.col("lon"), F.col(f"_{x}lat"), F.col(f"_{x}lon")) - F.lit(1e-3)
    known = F.col("lat").isNotNull() & F.col(f"_{x}lat").isNotNull() & (h < F.lit(float("inf")))
    return F.when(known & (h > 0), h).otherwise(F.lit(0.0))


#: the part of the waiting nodes that a round relaxes, the nearest ones
NEAREST = 0.2
#: a round relaxes all waiting nodes once they are fewer than one to this many edges
EDGES_PER_WAITING = 256
#: after this many rounds the log of a search is written anew with one row a node
ROUNDS_PER_LOG = 6


def _waiting(log: DataFrame, r: int, limits: dict[int, float]) -> DataFrame:
    """The rows of a search's log that no round before ``r`` has relaxed.

    ``limits``: up to which distance each round since the last unlimited one relaxed. A row of round ``l`` waits if it
    lies beyond the limits of all rounds after ``l``."""
    first = min(limits, default=r) - 1
    beyond, most = [], float("-inf")
    for level in range(r - 1, first - 1, -1):
        beyond.append(most)
        most = max(most, limits.get(level, float("-inf")))
    least = F.get(F.lit(beyond), F.lit(r - 1) - F.col("level"))
    return log.filter(F.col("near") & (F.col("level") >= first)).filter(F.col("dist") > least)


def _rows_now(log: DataFrame) -> DataFrame:
    """``(qid, id, dist, pdist, pred, level)``: each node's best row and the round its distance last dropped."""
    now = log.groupBy("qid", "id").agg(
        F.min(F.struct(*BEST)).alias("o"), F.max(F.when(F.col("near"), F.col("level"))).alias("level")
    )
    return now.select("qid", "id", *(F.col(f"o.{x}").alias(x) for x in BEST), "level")


def _compacted(found: Found, like: DataFrame) -> Found:
    log = Found(found.keys, like)
    log.add(_rows_now(found.all()).withColumn("near", F.lit(True)), 0)
    found.drop_all()
    return log


def route_paths(state: DataFrame, sinks: DataFrame) -> DataFrame:
    """Node sequence of each query's route as long form ``(qid, pos, id)`` (pos 0 = source).

    Unreachable sinks give no rows."""
    reached = state.join(sinks.select("qid", F.col("sink").alias("id")), ["qid", "id"], "left_semi")
    chain = walk_up(state.select("qid", "id", F.col("pred").alias("parent")), reached.select("qid", "id"), ("qid",))
    hops = chain.groupBy("qid").agg(F.max("step").alias("_h"))
    return chain.join(hops, "qid").select("qid", (F.col("_h") - F.col("step")).alias("pos"), "id")


def route_summary(state: DataFrame, sources: DataFrame, sinks: DataFrame, paths: DataFrame) -> DataFrame:
    """``(qid, source, sink, cost, hops)``; NULL cost/hops when the sink is unreachable (Q17)."""
    cost = state.select("qid", F.col("id").alias("sink"), F.col("dist").alias("cost"))
    hops = paths.groupBy("qid").agg(F.max("pos").cast("int").alias("hops"))
    return (
        sources.select("qid", "source")
        .join(sinks.select("qid", "sink"), "qid")
        .join(cost, ["qid", "sink"], "left")
        .join(hops, "qid", "left")
        .select("qid", "source", "sink", "cost", "hops")
    )


def random_pair_attempts(nodes: DataFrame, n_pairs: int, max_attempts: int, seed: int = 7) -> DataFrame:
    """Candidate ``(slot, attempt, u, v)`` pairs drawn by hashing; ids are taken from the
    node table through a dense rank so any id set works. Pairs with ``u = v`` are dropped."""
    from geoweave.operators.structure import dense_ids

    n_nodes = nodes.count()
    mapping = dense_ids(nodes, start=0)
    spark = nodes.sparkSession
    # grid of slots × attempts built from one range (no join)
    grid = spark.range(n_pairs * max_attempts).select(
        (F.col("id") / max_attempts).cast("long").alias("slot"),
        (F.col("id") % max_attempts).alias("attempt"),
    )
    draws = grid.select(
        "slot",
        "attempt",
        (md5_int(seed, "slot", "attempt", F.lit("u")) % n_nodes).alias("_u"),
        (md5_int(seed, "slot", "attempt", F.lit("v")) % n_nodes).alias("_v"),
    )
    mu = mapping.select(F.col("new_id").alias("_u"), F.col("id").alias("u"))
    mv = mapping.select(F.col("new_id").alias("_v"), F.col("id").alias("v"))
    return draws.join(mu, "_u").join(mv, "_v").select("slot", "attempt", "u", "v").filter(
        F.col("u") != F.col("v")
    )


def random_routes(
    g: Graph,
    n_pairs: int = 100,
    max_attempts: int = 50,
    seed: int = 7,
    rounds: RoundLog | None = None,
    with_state: bool = False,
    sides: tuple[DataFrame, DataFrame] | None = None,
):
    """Up to ``n_pairs`` routes between random reachable pairs with positive cost.

    Each slot tries its attempts in order. No route leaves a weak component, so attempts between two components
    are known to fail and need no search; a wave solves the next other attempt of every open slot in one batched
    relaxation. Returns ``(slot, attempt, u, v, cost)``; with ``with_state`` also the relaxation
    state ``(qid = slot, id, dist, pred)`` of the solved slots, for path reconstruction. ``sides`` may be given as
    made by ``prepared_sides``.
    """
    attempts = checkpoint(random_pair_attempts(g.nodes, n_pairs, max_attempts, seed))
    edges = prepared_edges(g, heads=False) if sides is None else sides[0]
    drop_dead_shuffles(edges)
    star = stars(edges)
    centre = {x: star.select(F.col("b").alias(x), F.col("a").alias(f"_{x}")) for x in "uv"}
    near = attempts.join(centre["u"], "u", "left").join(centre["v"], "v", "left")
    near = near.filter(F.coalesce("_u", "u") == F.coalesce("_v", "v")).select("slot", "attempt", "u", "v")
    left = checkpoint(near)
    release(star)
    drop_dead_shuffles(edges)
    back = keyed(edges, "dst") if sides is None else sides[1]
    done: list[DataFrame] = []
    states: list[DataFrame] = []
    while True:
        first = left.groupBy("slot").agg(F.min(F.struct("attempt", "u", "v")).alias("a"))
        wave = checkpoint(first.select("slot", "a.attempt", "a.u", "a.v", F.col("slot").alias("qid")))
        if wave.isEmpty():
            release(wave, left)
            break
        state = shortest_paths(
            g,
            wave.select("qid", F.col("u").alias("source")),
            wave.select("qid", F.col("v").alias("sink")),
            rounds=rounds,
            edges=edges,
            back=back,
        )
        solved = checkpoint(
            wave.join(state.select("qid", F.col("id").alias("v"), F.col("dist").alias("cost")), ["qid", "v"])
            .filter(F.col("cost") > 0)
            .select("slot", "attempt", "u", "v", "cost")
        )
        done.append(solved)
        if with_state:
            states.append(checkpoint(state.join(solved.select(F.col("slot").alias("qid")), "qid", "left_semi")))
        release(state)
        prev, tried = left, wave.select("slot", "attempt")
        left = checkpoint(left.join(solved.select("slot"), "slot", "left_anti").join(tried, ["slot", "attempt"], "left_anti"))
        release(prev, wave)
    if sides is None:
        release(edges, back)
    if not done:
        empty = attempts.limit(0).select("slot", "attempt", "u", "v", F.lit(0.0).alias("cost"))
        if with_state:
            return empty, empty.select(F.col("slot").alias("qid"), F.col("u").alias("id"), F.col("cost").alias("dist"), F.col("v").alias("pred"))
        return empty
    routes = reduce(lambda x, y: x.unionByName(y), done)
    if with_state:
        return routes, reduce(lambda x, y: x.unionByName(y), states)
    return routes


def route_stats(routes: DataFrame) -> DataFrame:
    """``(n_routes, min_km, max_km, avg_km)`` of a set of routes."""
    return routes.agg(
        F.count(F.lit(1)).alias("n_routes"),
        F.min("cost").alias("min_km"),
        F.max("cost").alias("max_km"),
        F.avg("cost").alias("avg_km"),
    )
