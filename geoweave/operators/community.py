"""Community detection and analysis.

* Label propagation: synchronous, every node votes for itself plus each neighbour's label; the
  most frequent label wins, ties to the smallest label. The self-vote keeps synchronous updates
  from oscillating on sparse graphs.
* Louvain: sweeps of many moves at once. A move is accepted if its standard modularity gain
  (including the cost of leaving the current community) stays positive after everything that the
  other candidates of its sweep could take from it; so every sweep raises modularity, and a pass
  ends only when no node of its level gains by a move. Contraction keeps intra-community weight as
  self-loops and community labels are original node ids, so memberships compose across passes.
"""

from __future__ import annotations

import logging
from collections import deque
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoweave.plans.iterate import RoundLog, checkpoint, keyed, release

EPS = 1e-12
log = logging.getLogger(__name__)


# ---- label propagation -----------------------------------------------------------------------


def vote_edges(nodes: DataFrame, edges: DataFrame, self_vote: bool = True) -> DataFrame:
    """Symmetric ``(src, dst)`` voter pairs: ``src`` receives ``dst``'s label."""
    e = edges.filter(F.col("src") != F.col("dst")).select("src", "dst")
    sym = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    if self_vote:
        sym = sym.unionByName(nodes.select(F.col("id").alias("src"), F.col("id").alias("dst")))
    return sym


def _count_votes(voters: DataFrame, labels: DataFrame) -> DataFrame:
    """``(id, label, n)``: votes of every node for every label. Votes are dealt by node, so that counting them and
    choosing a node's label share one shuffle."""
    each = voters.join(labels, voters.dst == labels.id).select(voters.src.alias("id"), labels.label)
    return each.repartition("id").groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))


def _shifted_votes(voters: DataFrame, moved: DataFrame) -> DataFrame:
    """``(id, label, n)``: what the changed labels ``(dst, was, label)`` take from and add to the votes."""
    sides = F.array(F.struct(F.col("was").alias("label"), F.lit(-1).alias("n")), F.struct(F.col("label"), F.lit(1).alias("n")))
    each = voters.join(moved, "dst").select(F.col("src").alias("id"), F.inline(sides))
    return each.groupBy("id", "label").agg(F.sum("n").alias("n")).filter("n <> 0")


def label_propagation(
    nodes: DataFrame,
    edges: DataFrame,
    max_iter: int = 3,
    self_vote: bool = True,
    rounds: RoundLog | None = None,
    recount_share: float = 0.25,
) -> tuple[DataFrame, list[int]]:
    """``(id, label)`` after at most ``max_iter`` iterations (stops at 0 changes) and the
    number of label changes per iteration (A19).

    While more than ``recount_share`` of the nodes change, an iteration counts all votes. After that the votes are
    kept as a table, later iterations append only what the changed labels shift, and only nodes whose votes
    shifted choose anew; the appended parts are merged once they outgrow the table. The labels are the same.
    """
    voters = keyed(vote_edges(nodes, edges, self_vote), "dst")
    labels = checkpoint(nodes.select("id", F.col("id").alias("label"), F.col("id").alias("was")))
    few = recount_share * labels.count()
    votes: list[DataFrame] = []  # the table and the shifts since
    size, shifted = 0, 0
    changes: list[int] = []
    for _ in range(max_iter):
        recount = not votes
        if recount and changes and changes[-1] <= few:
            votes = [checkpoint(_count_votes(voters, labels))]
            size, shifted = votes[0].count(), 0
        elif not recount:
            moved = labels.filter("label <> was").select(F.col("id").alias("dst"), "was", "label")
            shift = checkpoint(_shifted_votes(voters, moved))
            votes.append(shift)
            shifted += shift.count()
            if shifted > size:
                merged = reduce(DataFrame.unionByName, votes).groupBy("id", "label").agg(F.sum("n").alias("n")).filter("n > 0")
                whole = checkpoint(merged)
                release(*votes[:-1])
                votes, size, shifted = [whole], whole.count(), 0
        if recount:
            now = votes[0] if votes else _count_votes(voters, labels)
        else:
            now = reduce(DataFrame.unionByName, votes).join(shift.select("id").distinct(), "id", "left_semi")
            now = now.groupBy("id", "label").agg(F.sum("n").alias("n")).filter("n > 0")
        win = now.groupBy("id").agg(F.max(F.struct("n", (-F.col("label")).alias("nl"))).alias("w"))
        new = checkpoint(
            labels.join(win, "id", "left").select("id", F.coalesce(-F.col("w.nl"), F.col("label")).alias("label"), F.col("label").alias("was"))
        )
        n = new.filter("label <> was").count()
        changes.append(n)
        if rounds is not None:
            rounds.record(changes=n, recounted=recount)
        release(labels)
        labels = new
        if n == 0:
            break
    else:
        if changes and changes[-1]:
            log.warning("label propagation stopped after %d iterations with %d changes in the last", max_iter, changes[-1])
    release(voters, *votes)
    return labels.select("id", "label"), changes


# ---- modularity and contraction ------------------------------------------------------------


def canonical_weighted(edges: DataFrame, weight_col: str | None = "weight") -> DataFrame:
    """Undirected ``(u, v, w)`` with ``u ≤ v``, parallel/mutual edges summed (A5, sum), self
    loops kept; unweighted graphs count 1 per distinct pair."""
    if weight_col and weight_col in edges.columns:
        c = edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"), F.col(weight_col).alias("w"))
        return c.groupBy("u", "v").agg(F.sum("w").alias("w"))
    c = edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()
    return c.withColumn("w", F.lit(1.0))


def node_strength(nodes: DataFrame, cw: DataFrame) -> DataFrame:
    """A4 on canonical edges: ``(id, k)``, a self-loop contributing twice its weight."""
    ends = cw.select(F.col("u").alias("id"), "w").unionByName(cw.select(F.col("v").alias("id"), "w"))
    k = ends.groupBy("id").agg(F.sum("w").alias("k"))
    return nodes.select("id").join(k, "id", "left").select("id", F.coalesce("k", F.lit(0.0)).alias("k"))


def modularity(membership: DataFrame, cw: DataFrame, moved_col: str | None = None) -> DataFrame:
    """One row ``(modularity, m)`` with ``Q = Σ_c in_c/m − (tot_c/2m)²``.

    ``membership(id, community)``, ``cw(u, v, w)`` canonical. ``m = 0`` gives ``Q = 0``.
    """
    mu = membership.select(F.col("id").alias("u"), F.col("community").alias("cu"))
    mv = membership.select(F.col("id").alias("v"), F.col("community").alias("cv"))
    e = cw.join(mu, "u").join(mv, "v")
    # per community: inside weight (edge once) and total degree (both ends)
    parts = (
        e.select(F.col("cu").alias("c"), F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(F.lit(0.0)).alias("inw"), F.col("w").alias("tw"))
        .unionByName(e.select(F.col("cv").alias("c"), F.lit(0.0).alias("inw"), F.col("w").alias("tw")))
    )
    per = parts.groupBy("c").agg(F.sum("inw").alias("in_c"), F.sum("tw").alias("tot_c"))
    # one aggregate over per-community terms and edge weights together (no join needed)
    z = F.lit(0.0)
    parts_sum = per.select(F.col("in_c").alias("a"), F.pow("tot_c", 2).alias("b"), z.alias("w"), z.alias("mv")).unionByName(
        cw.select(z.alias("a"), z.alias("b"), F.col("w"), z.alias("mv"))
    )
    if moved_col is not None:  # count moved nodes in the same job
        parts_sum = parts_sum.unionByName(
            membership.select(z.alias("a"), z.alias("b"), z.alias("w"), F.col(moved_col).cast("double").alias("mv"))
        )
    sums = parts_sum.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("w").alias("m"), F.sum("mv").alias("mv"))
    mm = F.nullif(F.col("m"), F.lit(0.0))
    q = sums.select(
        F.coalesce(F.col("a") / mm - F.col("b") / (4 * mm * mm), F.lit(0.0)).alias("modularity"),
        F.coalesce(F.col("m"), F.lit(0.0)).alias("m"),
        F.coalesce(F.col("mv"), F.lit(0.0)).cast("long").alias("moved"),
    )
    return q


def contract(membership: DataFrame, cw: DataFrame) -> DataFrame:
    """Community graph ``(u, v, w)`` (canonical), intra weight kept as self-loops."""
    mu = membership.select(F.col("id").alias("u"), F.col("community").alias("cu"))
    mv = membership.select(F.col("id").alias("v"), F.col("community").alias("cv"))
    e = cw.join(mu, "u").join(mv, "v")
    return e.groupBy(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).agg(F.sum("w").alias("w"))


def internal_edges(membership: DataFrame, edges: DataFrame) -> DataFrame:
    """``(community, n_edges)`` — edges with both ends in the same community."""
    mu = membership.select(F.col("id").alias("src"), F.col("community").alias("cs"))
    mv = membership.select(F.col("id").alias("dst"), F.col("community").alias("cd"))
    same = edges.join(mu, "src").join(mv, "dst").filter(F.col("cs") == F.col("cd"))
    return same.groupBy(F.col("cs").alias("community")).agg(F.count(F.lit(1)).alias("n_edges"))


# ---- selection -------------------------------------------------------------------------------


def select_communities(
    membership: DataFrame, num_random: int = 20, max_size: int | None = None, min_size: int = 5, seed: int = 42
) -> DataFrame:
    """``(community, role, size)`` — the largest, the smallest with more than one member
    (any size if none) and ``num_random`` seeded picks among ``min_size < size`` (``< max_size``, where given)
    excluding those two. Fewer than three communities → no rows (Q32)."""
    from geoweave.operators.sampling import sample_rows

    sizes = checkpoint(membership.groupBy("community").agg(F.count(F.lit(1)).alias("size")))
    n_comm = sizes.count()
    if n_comm < 3:
        return sizes.limit(0).select("community", F.lit("").alias("role"), "size")
    largest = sizes.agg(F.min(F.struct((-F.col("size")).alias("ns"), F.col("community").alias("c"))).alias("b")).select(
        F.col("b.c").alias("community"), F.lit("largest").alias("role"), (-F.col("b.ns")).alias("size")
    )
    multi = sizes.filter(F.col("size") > 1)
    pool = multi if multi.limit(1).count() == 1 else sizes
    smallest = pool.agg(F.min(F.struct(F.col("size").alias("s"), F.col("community").alias("c"))).alias("b")).select(
        F.col("b.c").alias("community"), F.lit("smallest").alias("role"), F.col("b.s").alias("size")
    )
    extremes = largest.select("community").unionByName(smallest.select("community"))
    wanted = F.col("size") > min_size
    if max_size is not None:
        wanted &= F.col("size") < max_size
    mid = sizes.filter(wanted).join(extremes, "community", "left_anti")
    rnd = sample_rows(mid, num_random, seed, ("community",)).select("community", F.lit("random").alias("role"), "size")
    return largest.unionByName(smallest).unionByName(rnd)


# ---- Louvain ---------------------------------------------------------------------------------


def louvain_candidates(memb: DataFrame, sym: DataFrame, m: float, rule: str = "standard") -> DataFrame:
    """``(id, ci, k, cb, delta)`` of the nodes that gain by moving to ``cb``, the best
    of their neighbours' communities (ties: the smallest label).

    ``memb(id, community, k)``; ``sym(i, j, w)`` holds every link in both directions, no loops. ``standard``
    asks that moving gains over staying; ``simple`` is the reference's rule, a positive gain of joining (Q21).
    """
    return _best_moves(memb, sym, m, rule).filter(F.col("delta") > EPS)


def _best_moves(memb: DataFrame, sym: DataFrame, m: float, rule: str = "standard") -> DataFrame:
    """As ``louvain_candidates``, also where the best move gains nothing (``delta`` is null where there is none)."""
    mj = memb.select(F.col("id").alias("j"), F.col("community").alias("cj"))
    links = sym.join(mj, "j").groupBy("i", "cj").agg(F.sum("w").alias("l"))  # A7
    tot = memb.groupBy("community").agg(F.sum("k").alias("tot"), F.count(F.lit(1)).alias("size"))  # A8
    node = memb.join(tot, "community").select(
        F.col("id").alias("i"), F.col("community").alias("ci"), "k", F.col("tot").alias("tot_own"), F.col("size").alias("size_own")
    )
    tc = tot.select(F.col("community").alias("cj"), F.col("tot").alias("tot_c"), F.col("size").alias("size_c"))
    ln = links.join(node, "i").join(tc, "cj")
    two_m2 = 2.0 * m * m
    gain = F.col("l") / F.lit(m) - F.col("tot_c") * F.col("k") / F.lit(two_m2)
    # two singletons merge only toward the smaller label: the other one has the same gain
    allowed = (F.col("cj") != F.col("ci")) & ~(
        (F.col("size_own") == 1) & (F.col("size_c") == 1) & (F.col("cj") > F.col("ci"))
    )
    best = ln.groupBy("i", "ci", "k", "tot_own").agg(
        F.max(F.when(allowed, F.struct(gain.alias("g"), (-F.col("cj")).alias("nc")))).alias("b"),  # A13
        F.sum(F.when(F.col("cj") == F.col("ci"), F.col("l")).otherwise(F.lit(0.0))).alias("l_own"),
    )
    stay = F.col("l_own") / F.lit(m) - (F.col("tot_own") - F.col("k")) * F.col("k") / F.lit(two_m2)
    delta = F.col("b.g") - (F.lit(0.0) if rule == "simple" else stay)
    return best.select(F.col("i").alias("id"), "ci", "k", (-F.col("b.nc")).alias("cb"), delta.alias("delta"))


def _accepted(cand: DataFrame, sym: DataFrame, m: float) -> DataFrame:
    """The moves ``(id, cb)`` among ``cand(id, ci, k, cb, delta, turn)`` that gain one after the other.

    Candidates are taken in falling order of ``turn``. What those of an earlier or equal turn can cost a
    move is charged to it, accepted or not: degree that joins its target or leaves its own community,
    and neighbours that leave the target or enter the own community. What is still above zero gains
    whatever becomes of the others. A community has at most ``TURNS`` sums, however many members it has."""
    flow = F.array(
        F.struct(F.col("cb").alias("c"), F.lit(True).alias("joins")), F.struct(F.col("ci").alias("c"), F.lit(False).alias("joins"))
    )
    sums = cand.select(F.inline(flow).alias("c", "joins"), "turn", "k").groupBy("c", "joins", "turn").agg(F.sum("k").alias("k"))
    upto = Window.partitionBy("c", "joins").orderBy(F.desc("turn"))
    sums = sums.select("c", "joins", "turn", F.sum("k").over(upto).alias("s"))
    joins = sums.filter("joins").select(F.col("c").alias("cb"), "turn", F.col("s").alias("joining"))
    leaves = sums.filter("not joins").select(F.col("c").alias("ci"), "turn", F.col("s").alias("leaving"))
    mine = cand.select(F.col("id").alias("i"), "ci", "cb", "turn")
    other = cand.select(F.col("id").alias("j"), F.col("ci").alias("_cj"), F.col("cb").alias("_bj"), F.col("turn").alias("_tj"))
    lost = (F.col("_cj") == F.col("cb")).cast("int") + (F.col("_bj") == F.col("ci")).cast("int")
    against = (
        sym.join(mine, "i")
        .join(other, "j")
        .filter((F.col("_tj") >= F.col("turn")) & (lost > 0))
        .groupBy(F.col("i").alias("id"))
        .agg(F.sum(F.col("w") * lost).alias("against"))
    )
    charge = F.col("k") * (F.col("joining") + F.col("leaving") - 2 * F.col("k")) / F.lit(2.0 * m * m)
    charge = charge + F.coalesce(F.col("against"), F.lit(0.0)) / F.lit(m)
    held = cand.join(joins, ["cb", "turn"]).join(leaves, ["ci", "turn"]).join(against, "id", "left")
    return held.filter(F.col("delta") - charge > EPS).select("id", "cb")


#: turns of a sweep: each takes about as many candidates as all earlier ones together
TURNS = 40


def _turn(seed: int, sweep: int):
    """Turn of a node in a sweep, drawn by hashing: ``t`` or higher with probability ``2 ** -t``."""
    h = F.xxhash64(F.lit(seed), F.lit(sweep), "id").bitwiseAND(F.lit((1 << TURNS) - 1))
    return (F.lit(TURNS) - F.length(F.regexp_replace(F.conv(h.cast("string"), 10, 2), "^0+", ""))).cast("int")


def _moved(memb: DataFrame, taken: DataFrame) -> tuple[DataFrame, int]:
    """The membership after the moves ``taken(id, cb)``, written, and the number of moves."""
    after = memb.join(taken, "id", "left").select(
        "id", F.coalesce("cb", "community").alias("community"), "k", "d", F.col("cb").isNotNull().alias("moved")
    )
    after = checkpoint(after)
    return after, after.filter("moved").count()


#: link rows of a block of communities, about
BLOCK_LINKS = 1 << 20


def _block_sweep(memb: DataFrame, sym: DataFrame, m: float, blocks: int, seed: int, sweep: int) -> DataFrame:
    """Moves ``(id, cb)`` of one sweep over blocks of whole communities.

    Communities are dealt to ``blocks`` blocks by a hash that changes with the sweep. A move between two
    communities of one block depends on nothing outside it (all links and degrees of both lie in the
    block), so every block runs its moves one after the other, each with its exact gain, to its own end. A community
    of more than ``BLOCK_LINKS`` link rows stays out: its moves are those of the other kind of sweep."""
    where = F.pmod(F.xxhash64(F.lit(seed), F.lit(sweep), "community"), F.lit(blocks))
    tot = memb.groupBy("community").agg(F.sum("k").alias("tot"), F.sum("d").alias("d")).filter(F.col("d") <= BLOCK_LINKS)
    node = memb.join(tot.drop("d"), "community").select("id", "community", "k", "tot", where.alias("block"))
    near = node.select(F.col("id").alias("j"), F.col("community").alias("cj"), F.col("tot").alias("tj"), F.col("block").alias("_b"))
    rows = sym.join(node.withColumnRenamed("id", "i"), "i").join(near, "j").filter("block = _b")
    rows = rows.select("block", "i", "j", "w", F.col("community").alias("ci"), "cj", "k", "tot", "tj")
    return rows.groupBy("block").applyInPandas(lambda block: _moves_in_turn(block, m), "id long, cb long")


#: steps of the share of its links by which a node may be away from moving and still be looked at beside candidates
NEAR_STEPS = 64


def _candidate_sweep(memb: DataFrame, sym: DataFrame, m: float, cand: DataFrame) -> DataFrame:
    """Moves ``(id, cb)`` of the nodes ``cand`` alone, of ``BLOCK_LINKS`` link rows together at most.

    Nothing else moves meanwhile, so one task that holds the links of the candidates and the degree of every
    community they touch runs their moves one after the other with exact gains, whatever the communities' size."""
    tot = memb.groupBy("community").agg(F.sum("k").alias("tot"))
    node = memb.join(tot, "community").select("id", "community", "k", "tot")
    mine = node.join(cand.select("id"), "id", "left_semi").withColumnRenamed("id", "i")
    near = node.select(F.col("id").alias("j"), F.col("community").alias("cj"), F.col("tot").alias("tj"))
    rows = sym.join(mine, "i").join(near, "j")
    rows = rows.select(F.lit(0).alias("block"), "i", "j", "w", F.col("community").alias("ci"), "cj", "k", "tot", "tj")
    return rows.groupBy("block").applyInPandas(lambda block: _moves_in_turn(block, m), "id long, cb long")


def _moves_in_turn(block: pd.DataFrame, m: float) -> pd.DataFrame:
    """Local moving of the nodes ``i`` of a block's link rows, node after node, until a round moves nothing. Their
    neighbours that are no ``i`` themselves stay where they are."""
    block = block.sort_values(["i", "j"])
    ids, start = np.unique(block["i"].to_numpy(), return_index=True)
    ends = [*start[1:].tolist(), len(block)]
    j = block["j"].to_numpy()
    fixed, place = np.unique(j[~np.isin(j, ids)], return_index=True)
    at = np.where(np.isin(j, ids), np.searchsorted(ids, j), len(ids) + np.searchsorted(fixed, j)).tolist()
    w = block["w"].tolist()
    first = block.iloc[start]
    here, k = first["ci"].tolist(), first["k"].tolist()
    here += block["cj"].to_numpy()[~np.isin(j, ids)][place].tolist()
    count = len(ids)
    tot = dict(zip(block["cj"].tolist(), block["tj"].tolist(), strict=True)) | dict(zip(here[:count], first["tot"].tolist(), strict=True))
    before, two_m = list(here), 2.0 * m
    waiting, queue = [True] * count, deque(range(count))
    while queue:
        i = queue.popleft()
        waiting[i] = False
        links: dict[int, float] = {}
        for e in range(start[i], ends[i]):
            c = here[at[e]]
            links[c] = links.get(c, 0.0) + w[e]
        own, ki = here[i], k[i]
        stay = links.get(own, 0.0) - (tot[own] - ki) * ki / two_m
        best = max(((x - tot[c] * ki / two_m, -c) for c, x in links.items() if c != own), default=None)
        if best is None or (best[0] - stay) / m <= EPS:
            continue
        here[i] = -best[1]
        tot[own] -= ki
        tot[here[i]] += ki
        for e in range(start[i], ends[i]):
            near = at[e]
            if near < count and not waiting[near] and here[near] != here[i]:
                waiting[near] = True
                queue.append(near)
    moved = [x for x in range(count) if here[x] != before[x]]
    return pd.DataFrame({"id": ids[moved], "cb": np.array([here[x] for x in moved], np.int64)})


def local_moving(memb: DataFrame, sym: DataFrame, m: float, seed: int = 42, rounds: RoundLog | None = None, level: int = 1):
    """``(membership, its round table, moves)`` after sweeps of moves until no node gains by a move of its own.

    ``memb(id, community, k, d)`` with ``d`` link rows of a node. Two kinds of sweep take turns: block sweeps
    move nodes one after the other inside blocks of communities, and sweeps over all candidates
    accept what gains whatever the others do (or, with nothing accepted, the best move alone). Once the candidates
    have no more than ``BLOCK_LINKS`` link rows together, sweeps of the candidates alone in one task follow
    instead, and take along the nodes nearest to a gain as far as these rows reach. All only raise modularity; the end is reached when no candidate is left, which is a local optimum."""
    moves, sweep, source, cand, few = 0, 0, None, None, False
    blocks = max(1, -(-sym.count() // BLOCK_LINKS))

    def settle(taken):
        nonlocal memb, source
        nxt, n = _moved(memb, taken)
        release(source)
        source, memb = nxt, nxt.drop("moved")
        return n

    while True:
        sweep += 1
        inside = settle(_candidate_sweep(memb, sym, m, cand) if few else _block_sweep(memb, sym, m, blocks, seed, sweep))
        if few and inside == 0:  # gains at the edge of rounding: the best candidate alone
            inside = settle(cand.orderBy(F.desc("delta"), "id").limit(1).select("id", "cb"))
        release(cand)
        best = _best_moves(memb, sym, m).filter("delta is not null").join(memb.select("id", "d"), "id")
        short = F.when(F.col("delta") > EPS, F.lit(0)).otherwise(F.ceil(-F.col("delta") * F.lit(m) / F.col("k") * NEAR_STEPS) + 1)
        cand = best.withColumn("short", short.cast("long")).filter(F.col("short") <= NEAR_STEPS)
        cand = checkpoint(cand.withColumn("turn", _turn(seed, sweep)))
        steps = {r["short"]: r for r in cand.groupBy("short").agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("d")).collect()}
        found, n, reach, rows = steps[0]["n"] if 0 in steps else 0, 0, -1, 0
        for step in sorted(steps):
            rows += steps[step]["d"]
            if rows > BLOCK_LINKS:
                break
            reach = step
        few = reach >= 0
        if found and not few:
            written, cand = cand, cand.filter("short = 0")
            cand._round_path = written._round_path
            n = settle(_accepted(cand, sym, m))
            if n == 0:  # all charged by one another: the best candidate alone
                n = settle(cand.orderBy(F.desc("delta"), "id").limit(1).select("id", "cb"))
        elif found:
            written, cand = cand, cand.filter(F.col("short") <= reach)
            cand._round_path = written._round_path
        moves += inside + n
        if rounds is not None:
            rounds.record(louvain_pass=level, sweep=sweep, in_blocks=inside, candidates=found, moved=n)
        if not found:
            release(cand)
            return memb, source, moves


def level_tables(nodes: DataFrame, cw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sym(i, j, w)``, the links in both directions without loops, and ``(id, k, d)`` of a level's nodes."""
    both = F.array(F.struct(F.col("u").alias("i"), F.col("v").alias("j")), F.struct(F.col("v").alias("i"), F.col("u").alias("j")))
    sym = checkpoint(cw.filter(F.col("u") != F.col("v")).select(F.inline(both).alias("i", "j"), "w"))
    degree = sym.groupBy(F.col("i").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    return sym, checkpoint(node_strength(nodes, cw).join(degree, "id", "left").na.fill(0, ["d"]))


def louvain(
    nodes: DataFrame,
    edges: DataFrame,
    weight_col: str | None = "weight",
    seed: int = 42,
    rounds: RoundLog | None = None,
    gain_rule: str = "standard",
    refine: bool = True,
    on_pass=None,
) -> tuple[DataFrame, list[dict]]:
    """``membership(id, community)`` and per-pass ``{pass, modularity, communities}``.

    Passes of local moving (G8) and contraction (G9), until a pass moves nothing. A pass ends when no node
    of its level gains by a single move. With ``refine`` the nodes themselves then move again from the
    communities found, and passes go on from there, until neither nodes nor communities gain by a move; every pass
    raises modularity. Community labels are original node ids. ``gain_rule="simple"`` chooses the same
    targets and takes the same moves: those that the reference's rule alone would add lower modularity
    (``louvain_candidates`` lists them). ``on_pass(pass, membership, links, m)``
    sees the level's membership and its links in both directions at the end of every pass.
    """
    if gain_rule not in ("standard", "simple"):
        raise ValueError(f"unknown gain rule {gain_rule!r}")
    base = cw = checkpoint(canonical_weighted(edges, weight_col))
    m = float(base.agg(F.sum("w")).first()[0] or 0.0)
    assign = checkpoint(nodes.select("id", F.col("id").alias("community")))  # node → community
    history: list[dict] = []
    if m <= 0.0:
        release(base)
        return assign, history
    base_sym, base_k = level_tables(nodes.select("id"), base)
    sym, k = base_sym, base_k
    start = k.select("id", F.col("id").alias("community"), "k", "d")
    on_nodes = True
    while True:
        memb, source, moves = local_moving(start, sym, m, seed, rounds, len(history) + 1)
        if on_pass is not None:
            on_pass(len(history) + 1, memb, sym, m)
        if moves or not history:
            after = memb.select("id", "community")
            if not on_nodes:
                step = after.select(F.col("id").alias("community"), F.col("community").alias("_nc"))
                after = assign.join(step, "community").select("id", F.col("_nc").alias("community"))
            prev, assign = assign, checkpoint(after)
            q = modularity(memb, cw).first()["modularity"]
            history.append({"pass": len(history) + 1, "modularity": q, "communities": assign.select("community").distinct().count()})
            release(prev)
        done = not moves and (on_nodes or not refine)
        if not done and moves:
            prev_cw = cw
            cw = checkpoint(contract(memb, cw))
            if not on_nodes:
                release(prev_cw)
        release(source, *(() if on_nodes else (sym, k)))
        if done:
            break
        if moves:  # up to the level of the communities
            on_nodes = False
            sym, k = level_tables(assign.select(F.col("community").alias("id")).distinct(), cw)
            start = k.select("id", F.col("id").alias("community"), "k", "d")
        else:  # back to the nodes
            release(cw)
            on_nodes, cw, sym, k = True, base, base_sym, base_k
            start = assign.join(k, "id").select("id", "community", "k", "d")
    release(*{id(x): x for x in (cw, base, base_sym, base_k)}.values())
    return assign, history


def history_df(spark: SparkSession, history: list[dict]) -> DataFrame:
    rows = [(h["pass"], float(h["modularity"]), int(h["communities"])) for h in history]
    return spark.createDataFrame(rows, "pass int, modularity double, communities long")


def members_of(membership: DataFrame, selection: DataFrame) -> DataFrame:
    """Members of the selected communities in long form ``(community, id)``.

    The reference keeps a Python list per community; one community can hold most of the graph,
    so the members stay as rows (a semi-join), never one array per community.
    """
    return membership.join(selection.select("community").distinct(), "community", "left_semi")


def valid_start_nodes(membership: DataFrame, nodes: DataFrame, degree: DataFrame) -> DataFrame:
    """Per community the smallest member with coordinates and degree > 0 ``(community, id)``;
    communities without such a member have no row (they are skipped)."""
    from geoweave.functions.geo import coord_present

    ok = nodes.filter(coord_present("lat", "lon")).select("id").join(
        degree.filter(F.col("degree") > 0).select("id"), "id", "left_semi"
    )
    return membership.join(ok, "id", "left_semi").groupBy("community").agg(F.min("id").alias("id"))
