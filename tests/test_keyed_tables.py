"""Bucketed round tables: same rows as plain ones, and no shuffle of the fixed side of a join."""

import random

import pytest
from pyspark.sql import functions as F

from geoweave.operators import community, paths, traverse
from geoweave.plans import iterate
from geoweave.plans.iterate import Found, keyed, release, shuffle_partitions
from tests.helpers import graph, q


@pytest.fixture(params=["plain", "bucketed"])
def layout(request, monkeypatch):
    monkeypatch.setattr(iterate, "ROWS_PER_BUCKET", 0 if request.param == "bucketed" else 10**9)
    return request.param


@pytest.fixture(scope="module")
def maze(spark):
    rng = random.Random(3)
    n = 120
    edges = sorted({(rng.randrange(n), rng.randrange(n)) for _ in range(260)} | {(i, i + 1) for i in range(60)})
    return n, edges, graph(spark, edges, n=n, weights=[rng.randint(0, 9) for _ in edges])


def levels_of(n, edges, start):
    out = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    level, todo = {start: 0}, [start]
    while todo:
        todo = [b for a in todo for b in out.get(a, ()) if level.setdefault(b, level[a] + 1) == level[a] + 1]
        todo = sorted(set(todo))
    return level


def tables(spark):
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("geoweave_round_")}


def test_searches_by_definition(spark, maze, layout):
    n, edges, g = maze
    want = levels_of(n, edges, 0)
    before = tables(spark)
    tree = traverse.bfs_tree(g, 0).collect()
    assert {r.id: r.level for r in tree} == want and len(tree) == len(want)
    assert sorted(r.visit_order for r in tree) == list(range(len(want)))
    assert tables(spark) == before  # nothing of a search whose result reads other tables stays
    sources = spark.createDataFrame([(7, 0), (8, 5), (9, 0)], "source long, id long")
    got = traverse.reachable(g, sources)
    found = {(r.source, r.id): r.level for r in got.collect()}
    assert found == {(s, v): l for s, at in ((7, 0), (8, 5), (9, 0)) for v, l in levels_of(n, edges, at).items()}
    assert got.count() == len(found)
    assert len(tables(spark) - before) == (1 if layout == "bucketed" else 0)  # the result itself


def test_paths_and_labels_do_not_depend_on_the_layout(spark, maze, monkeypatch):
    _, _, g = maze
    got = []
    for rows in (10**9, 0):
        monkeypatch.setattr(iterate, "ROWS_PER_BUCKET", rows)
        dist = {r.id: (r.dist, r.pred) for r in paths.shortest_paths(g, q(spark, 0, 0)).collect()}
        labels, changes = community.label_propagation(g.nodes, g.edges)
        got.append((dist, {r.id: r.label for r in labels.collect()}, changes))
    assert got[0] == got[1] and len(got[0][0]) > 60


def test_no_round_shuffles_a_bucketed_side(spark):
    edges = spark.range(4000).select((F.col("id") % 97).alias("src"), F.col("id").alias("dst"))
    table = keyed(edges, "src", rows_per_bucket=1)
    frontier = spark.range(50).select(F.col("id").alias("node"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = frontier.join(table, frontier.node == table.src)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        found = Found(["id"], table)
        found.add(spark.range(10).withColumn("level", F.lit(0)), 0)
        second = found.add(spark.range(10, 30).withColumn("level", F.lit(1)), 1)
        assert second.count() == 20 and found.all().count() == 30
        cand = spark.range(0, 60, 2).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        new = cand.join(found.all().select("id"), "id", "left_anti")
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Bucketed: true" in plan
        assert plan.count("Exchange") <= 1  # the candidates' own; the found side has none
        assert sorted(r.id for r in new.collect()) == list(range(30, 60, 2))
        assert found.buckets == shuffle_partitions(spark)
        found.release()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    name = table._round_table
    release(table)
    assert name not in tables(spark)


def labels_by_definition(n, edges, max_iter, self_vote):
    voters = [[] for _ in range(n)]
    for a, b in edges:
        if a != b:
            voters[a].append(b)
            voters[b].append(a)
    label, changes = list(range(n)), []
    for _ in range(max_iter):
        new = []
        for v in range(n):
            got = [label[u] for u in voters[v]] + ([label[v]] if self_vote else [])
            new.append(min(set(got), key=lambda x: (-got.count(x), x)) if got else label[v])
        changes.append(sum(a != b for a, b in zip(label, new, strict=True)))
        label = new
        if not changes[-1]:
            break
    return label, changes


@pytest.mark.parametrize("share,self_vote", [(0.0, True), (0.25, True), (1.0, True), (1.0, False)])
def test_kept_votes_give_the_labels_of_a_recount(spark, maze, share, self_vote):
    n, edges, g = maze
    log = iterate.RoundLog("labels")
    got, changes = community.label_propagation(g.nodes, g.edges, max_iter=6, self_vote=self_vote, rounds=log, recount_share=share)
    want, want_changes = labels_by_definition(n, edges, 6, self_vote)
    assert changes == want_changes
    assert {r.id: r.label for r in got.collect()} == dict(enumerate(want))
    recounted = [r["recounted"] for r in log.rounds]
    # an iteration recounts until one before it changed few labels, and that one is the last to recount
    few = [i for i, c in enumerate(changes) if c <= share * n]
    assert recounted == [not few or i <= few[0] + 1 for i in range(len(changes))]


def test_votes_are_counted_and_chosen_in_one_shuffle(spark, maze):
    g = maze[2]
    voters = community.checkpoint(community.vote_edges(g.nodes, g.edges))
    labels = community.checkpoint(g.nodes.select("id", F.col("id").alias("label")))
    win = community._count_votes(voters, labels).groupBy("id").agg(F.max(F.struct("n", (-F.col("label")).alias("nl"))).alias("w"))
    above_join = win._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert above_join.count("Exchange hashpartitioning") == 1


def test_queries_over_the_pair_graph_read_its_links_from_one_table(spark):
    from geoweave.plans import catalog

    g, _ = catalog._lpa3(spark, "/root/testdata/sf0.001")
    files = g.edges.inputFiles()
    assert files and not any("lineitem" in f for f in files)


def test_nearest_first_search_by_definition(spark, layout, monkeypatch):
    from tests.test_graph_ops import dijkstra

    rng = random.Random(5)
    pairs = sorted({(rng.randrange(150), rng.randrange(150)) for _ in range(900)})
    weight = {e: rng.choice([0, 1, 2, 40, 200]) + rng.random() * (rng.random() < 0.5) for e in pairs}
    g = graph(spark, pairs, n=150, weights=[weight[e] for e in pairs])
    want = dijkstra(weight, 0)
    log, before = iterate.RoundLog("near"), tables(spark)
    monkeypatch.setattr(paths, "EDGES_PER_WAITING", 100)
    monkeypatch.setattr(paths, "ROUNDS_PER_LOG", 3)
    got = {r.id: r for r in paths.shortest_paths(g, q(spark, 0, 0), rounds=log).collect()}
    assert {i: r.dist for i, r in got.items()} == want and tables(spark) == before
    for i, r in got.items():
        seen = set()
        while i != 0:  # every predecessor explains its distance and leads home
            assert i not in seen and got[i].pred is not None
            seen.add(i)
            assert got[got[i].pred].dist + weight[(got[i].pred, i)] == got[i].dist
            i = got[i].pred
    nearest = sum(r["improved"] for r in log.rounds)
    monkeypatch.setattr(paths, "EDGES_PER_WAITING", 1)  # no round is limited
    log = iterate.RoundLog("all")
    again = {r.id: r.dist for r in paths.shortest_paths(g, q(spark, 0, 0), rounds=log).collect()}
    assert again == want and nearest < sum(r["improved"] for r in log.rounds)


def test_waiting_rows_are_those_no_round_relaxed(spark):
    rng = random.Random(8)
    for _ in range(3):
        reach = {r: rng.choice([float("inf"), 1.0, 3.0, 5.0]) for r in range(1, 8)}
        rows = [(l, float(d), True) for l in range(8) for d in range(7)]
        log = spark.createDataFrame(rows, "level int, dist double, near boolean")
        limits = {}
        for r in range(1, 8):
            limits = {} if reach[r] == float("inf") else {**limits, r: reach[r]}
        got = sorted((x.level, x.dist) for x in paths._waiting(log, 8, limits).collect())
        assert got == [(l, d) for l, d, _ in rows if l <= 7 and all(d > reach[k] for k in range(l + 1, 8))]


def test_search_without_sinks_carries_no_coordinates(spark):
    from geoweave.operators import geo

    g = geo.edge_weights(graph(spark, [(0, 1), (1, 2)]))
    assert paths.prepared_edges(g, heads=False).columns == ["src", "dst", "weight"]
    assert "_dlat" in paths.prepared_edges(g).columns


def test_walks_to_the_root_broadcast_no_pointers(spark, monkeypatch):
    plans, write = [], traverse.checkpoint

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(traverse, "checkpoint", watched)
    parents = spark.createDataFrame([(0, i, i - 1 if i else None) for i in range(9)], "key int, id long, parent long")
    walk = traverse.walk_up(parents, spark.createDataFrame([(0, 8)], "key int, id long"))
    assert sorted((r.step, r.id) for r in walk.collect()) == [(k, 8 - k) for k in range(9)]
    assert any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_buckets_follow_the_rows_not_the_shuffle(spark):
    edges = spark.range(4000).select((F.col("id") % 97).alias("src"), F.col("id").alias("dst"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in names}
    cores = spark.sparkContext.defaultParallelism
    try:
        for k, v in zip(names, ("-1", "64"), strict=True):
            spark.conf.set(k, v)
        table = keyed(edges, "src", rows_per_bucket=1)
        found = Found(["id"], table)
        found.add(spark.range(10).withColumn("level", F.lit(0)), 0)
        assert found.buckets == cores < 64
        # candidates that an aggregate has shuffled are shuffled once more; the table stays where it is
        evens = spark.range(20).select((F.col("id") - F.col("id") % 2).alias("id"))
        cand = found.placed(evens.groupBy("id").agg(F.count(F.lit(1)).alias("n")))
        new = cand.join(found.all().select("id", F.lit(1).alias("seen")), "id", "left").filter("seen is null")
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2 and f", {cores}), REPARTITION" in plan
        assert sorted(r.id for r in new.collect()) == list(range(10, 20, 2))
        full = iterate.ROWS_IN_FULL_BUCKET
        assert [iterate.bucket_count(spark, n * full) for n in (1, cores, cores + 1, 1000)] == [cores, cores, 2 * cores, 64]
        spark.conf.set("spark.sql.shuffle.partitions", str(cores + 1))
        assert iterate.bucket_count(spark, full) == cores + 1
        found.release()
        release(table)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_search_from_both_ends_leaves_the_links_of_shortest_routes(spark, monkeypatch):
    from tests.test_graph_ops import dijkstra

    rng = random.Random(12)
    pairs = sorted({(rng.randrange(120), rng.randrange(120)) for _ in range(500)})
    weight = {e: rng.choice([0, 1, 2, 5]) for e in pairs}  # many ties
    g = graph(spark, pairs, n=121, weights=[weight[e] for e in pairs])
    asked = [(k, 7 * k, 110 - 11 * k) for k in range(3)] + [(4, 3, 120), (5, 9, 9)]  # node 120 has no links
    qs = spark.createDataFrame(asked, "qid long, source long, sink long")
    monkeypatch.setattr(paths, "WAITING_AT_ONCE", 24)
    monkeypatch.setattr(paths, "EDGES_PER_WAITING", 10**6)
    edges, back = paths.prepared_sides(g)
    links = {}
    for r in paths.links_between(g, qs, edges, back).collect():
        links.setdefault(r.qid, set()).add((r.src, r.dst))
    to = {(b, a): w for (a, b), w in weight.items()}
    for k, s, t in asked:
        f, b = dijkstra(weight, s), dijkstra(to, t)
        want = {(u, v) for (u, v), w in weight.items() if u in f and v in b and f[u] + w + b[v] == f.get(t)}
        assert want <= links.get(k, set()) and (t in f or k not in links)
    assert len(links[0]) < len(pairs) / 2
    one = paths.shortest_paths(g, qs.select("qid", "source"), edges=edges)
    two = paths.shortest_paths(g, qs.select("qid", "source"), qs.select("qid", "sink"), edges=edges, back=back)
    ways = [sorted(tuple(r) for r in paths.route_paths(st, qs).collect()) for st in (one, two)]
    assert ways[0] == ways[1] and two.count() < one.count() / 2
