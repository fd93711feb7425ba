"""SQL oracles (DuckDB dialect) for the registered queries.

Each oracle recomputes a query from the raw tables with plain SQL so that the Spark result can be
checked value by value. Shared pieces (fixture graphs, haversine) are SQL text fragments.
"""

from __future__ import annotations

# ---- fixture fragments --------------------------------------------------------------------

F1_NODES = (
    "SELECT p_partkey AS id, "
    "CAST((p_partkey * 7919) % 18000 - 9000 AS DOUBLE) / 100 AS lat, "
    "CAST((p_partkey * 104729) % 36000 - 18000 AS DOUBLE) / 100 AS lon FROM part"
)
F1_EDGES = (
    "SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b "
    "ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1"
)


def key_coords(col: str) -> str:
    return (
        f"CAST(({col} * 7919) % 18000 - 9000 AS DOUBLE) / 100 AS lat, "
        f"CAST(({col} * 104729) % 36000 - 18000 AS DOUBLE) / 100 AS lon"
    )


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    a = f"least({a}, 1.0)"
    return f"(6371.0 * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


F2_EDGES = (
    "SELECT o.o_custkey AS src, 1000000000 + l.l_suppkey AS dst, l.l_extendedprice AS weight "
    "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
)
F2_NODES = (
    f"SELECT c_custkey AS id, {key_coords('c_custkey')} FROM customer UNION ALL "
    f"SELECT 1000000000 + s_suppkey AS id, {key_coords('1000000000 + s_suppkey')} FROM supplier"
)

# F1 with haversine weights
F1_WEIGHTED = (
    f"SELECT e.src, e.dst, {hav('s.lat', 's.lon', 'd.lat', 'd.lon')} AS weight "
    "FROM f1e e JOIN f1n s ON s.id = e.src JOIN f1n d ON d.id = e.dst"
)

# F3 undirected graph of all F1 links (weights rounded to 6)
F3_EDGES = (
    "SELECT p.src, p.dst, round(" + hav("s.lat", "s.lon", "d.lat", "d.lon") + ", 6) AS weight "
    "FROM (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM f1e "
    "WHERE src <> dst) p "
    "JOIN f1n s ON s.id = p.src JOIN f1n d ON d.id = p.dst"
)

F5_ADJ = (
    "SELECT p.p_partkey AS line_no, CASE WHEN p.p_partkey % 50 = 0 "
    "THEN coalesce(a.adj, '') || ',x,-3,0,1.5,999999999, 7 ,99999999999999999999,' || chr(9) || '3' || chr(9) "
    "ELSE coalesce(a.adj, '') END AS value FROM part p LEFT JOIN "
    "(SELECT src, string_agg(CAST(dst + 1 AS VARCHAR), ',' ORDER BY dst + 1) AS adj FROM f1e GROUP BY src) a "
    "ON a.src = p.p_partkey"
)
F5_LOC = (
    "SELECT p_partkey AS line_no, CASE p_partkey % 97 WHEN 5 THEN 'bad' WHEN 6 THEN '1.0,abc' "
    "WHEN 7 THEN '1,2,3' WHEN 8 THEN '1.0d,2f' WHEN 9 THEN '0x1p3,1' "
    "WHEN 10 THEN chr(9) || '1.5,' || chr(9) || '2.5 ' ELSE printf('%.2f,%.2f', "
    "CAST((p_partkey * 7919) % 18000 - 9000 AS DOUBLE) / 100, "
    "CAST((p_partkey * 104729) % 36000 - 18000 AS DOUBLE) / 100) END AS value FROM part"
)


def with_graphs(body: str, *extra: str) -> str:
    """Prefix a query with the F1 node/edge CTEs (and any extra named CTEs)."""
    ctes = [f"f1n AS ({F1_NODES})", f"f1e AS ({F1_EDGES})"] + list(extra)
    return "WITH " + ", ".join(ctes) + " " + body


_BLANK = "' ' || chr(9)"
_NUMBER = "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def _field(k: int) -> str:
    t = f"trim(string_split(value, ',')[{k}], {_BLANK})"
    return f"CASE WHEN regexp_full_match({t}, {_NUMBER}) THEN try_cast({t} AS DOUBLE) END"


LOC_FIELDS = (
    f"SELECT line_no, value, len(string_split(value, ',')) AS k, {_field(1)} AS la, {_field(2)} AS lo FROM loc"
)

SQL: dict[str, str] = {}

SQL["graph_summary"] = with_graphs(
    "SELECT (SELECT count(*) FROM f1n) AS n_nodes, (SELECT count(*) FROM f1e) AS n_edges, "
    "true AS directed, 'lat,lon' AS node_attrs, 'weight' AS edge_attrs"
)
SQL["out_degree"] = with_graphs(
    "SELECT n.id, coalesce(d.c, 0) AS out_degree FROM f1n n LEFT JOIN "
    "(SELECT src, count(*) AS c FROM f1e GROUP BY src) d ON d.src = n.id"
)
SQL["total_degree"] = with_graphs(
    "SELECT n.id, coalesce(d.c, 0) AS degree FROM f1n n LEFT JOIN "
    "(SELECT id, count(*) AS c FROM (SELECT src AS id FROM f1e UNION ALL SELECT dst FROM f1e) GROUP BY id) d "
    "ON d.id = n.id"
)
SQL["strength"] = (
    f"WITH f2n AS ({F2_NODES}), f2e AS ({F2_EDGES}) "
    "SELECT n.id, round(coalesce(s.w, 0.0), 4) AS strength FROM f2n n LEFT JOIN "
    "(SELECT id, sum(w) AS w FROM (SELECT src AS id, weight AS w FROM f2e UNION ALL "
    "SELECT dst, weight FROM f2e) GROUP BY id) s ON s.id = n.id"
)
SQL["edge_weights"] = with_graphs(
    "SELECT src, dst, round(weight, 6) AS weight FROM f1w", f"f1w AS ({F1_WEIGHTED})"
)
SQL["undirected_sum"] = (
    f"WITH f2e AS ({F2_EDGES}) SELECT least(src, dst) AS src, greatest(src, dst) AS dst, "
    "round(sum(weight), 4) AS weight FROM f2e GROUP BY 1, 2"
)
SQL["undirected_min"] = (
    f"WITH f2e AS ({F2_EDGES}) SELECT least(src, dst) AS src, greatest(src, dst) AS dst, "
    "min(weight) AS weight FROM f2e GROUP BY 1, 2"
)
SQL["self_loops"] = with_graphs("SELECT src AS id FROM f1e WHERE src = dst")
SQL["inspection_table"] = with_graphs(
    "SELECT row_number() OVER (ORDER BY s.id) AS idx, s.id, s.lat, s.lon, coalesce(d.c, 0) AS out_degree "
    "FROM (SELECT * FROM f1n WHERE id IN (SELECT id FROM f1n ORDER BY id LIMIT 50) "
    "OR id IN (SELECT id FROM f1n ORDER BY id DESC LIMIT 50)) s "
    "LEFT JOIN (SELECT src, count(*) AS c FROM f1e GROUP BY src) d ON d.src = s.id"
)
SQL["quality_checks"] = with_graphs(
    "SELECT check_name, actual, expected, (expected IS NULL OR actual = expected) AS ok FROM ("
    "SELECT 'n_nodes' AS check_name, count(*) AS actual, (SELECT count(*) FROM part) AS expected FROM f1n "
    "UNION ALL SELECT 'min_id', min(id), 0 FROM f1n "
    "UNION ALL SELECT 'max_id', max(id), count(*) - 1 FROM f1n "
    "UNION ALL SELECT 'distinct_ids', count(DISTINCT id), count(*) FROM f1n "
    "UNION ALL SELECT 'lat_missing', count(*) FILTER (WHERE lat IS NULL OR isnan(lat)), 0 FROM f1n "
    "UNION ALL SELECT 'lon_missing', count(*) FILTER (WHERE lon IS NULL OR isnan(lon)), 0 FROM f1n "
    "UNION ALL SELECT 'n_edges', count(*), (SELECT count(*) FROM lineitem) FROM f1e "
    "UNION ALL SELECT 'probe_out_degree', count(*) FILTER (WHERE src = 0), NULL FROM f1e "
    "UNION ALL SELECT 'dangling_src', count(*), 0 FROM f1e WHERE src NOT IN (SELECT id FROM f1n) "
    "UNION ALL SELECT 'dangling_dst', count(*), 0 FROM f1e WHERE dst NOT IN (SELECT id FROM f1n))"
)
SQL["bbox_extremes"] = with_graphs(
    "SELECT first(id ORDER BY lat, id) AS min_lat_id, first(id ORDER BY lat DESC, id) AS max_lat_id, "
    "first(id ORDER BY lon, id) AS min_lon_id, first(id ORDER BY lon DESC, id) AS max_lon_id "
    "FROM f1n WHERE lat IS NOT NULL AND lon IS NOT NULL"
)
SQL["farthest_pair"] = with_graphs(
    "SELECT least(a.id, b.id) AS u, greatest(a.id, b.id) AS v, round("
    + hav("a.lat", "a.lon", "b.lat", "b.lon")
    + ", 6) AS distance_km FROM c a JOIN c b ON a.id < b.id ORDER BY distance_km DESC, u, v LIMIT 1",
    "x AS (SELECT first(id ORDER BY lat, id) AS i1, first(id ORDER BY lat DESC, id) AS i2, "
    "first(id ORDER BY lon, id) AS i3, first(id ORDER BY lon DESC, id) AS i4 FROM f1n)",
    "c AS (SELECT * FROM f1n WHERE id IN (SELECT i1 FROM x UNION SELECT i2 FROM x UNION "
    "SELECT i3 FROM x UNION SELECT i4 FROM x))",
)
SQL["centroid"] = with_graphs(
    "SELECT round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, count(*) AS n_nodes FROM f1n"
)
SQL["parse_adjacency"] = with_graphs(
    "SELECT DISTINCT src, try_cast(t AS BIGINT) - 1 AS dst FROM (SELECT src, "
    f"trim(t, {_BLANK}) AS t FROM "
    "(SELECT line_no AS src, unnest(string_split(value, ',')) AS t FROM adj "
    " WHERE line_no < (SELECT count(*) FROM part))) "
    "WHERE regexp_full_match(t, '[0-9]+') "
    "AND try_cast(t AS BIGINT) BETWEEN 1 AND (SELECT count(*) FROM part)",
    f"adj AS ({F5_ADJ})",
)
SQL["parse_locations"] = (
    f"WITH loc AS ({F5_LOC}), f AS ({LOC_FIELDS}) "
    "SELECT row_number() OVER (ORDER BY line_no) - 1 AS id, la AS lat, lo AS lon FROM f "
    "WHERE k = 2 AND la IS NOT NULL AND lo IS NOT NULL"
)
SQL["line_rejects"] = (
    f"WITH loc AS ({F5_LOC}), f AS ({LOC_FIELDS}) "
    "SELECT line_no, value AS raw FROM f WHERE NOT (k = 2 AND la IS NOT NULL AND lo IS NOT NULL)"
)
SQL["numbered_lines"] = with_graphs(
    "SELECT row_number() OVER (ORDER BY line_no) - 1 AS line_no, value FROM adj", f"adj AS ({F5_ADJ})"
)
SQL["location_report"] = (
    f"WITH loc AS ({F5_LOC}), f AS ({LOC_FIELDS}), c AS (SELECT count(*) AS lines, "
    "count(*) FILTER (k = 2 AND la IS NOT NULL AND lo IS NOT NULL) AS valid, count(*) + 10 AS expected FROM f) "
    "SELECT expected, lines, valid, lines - valid AS rejected, valid < expected AS short FROM c"
)
SQL["sample_nodes"] = with_graphs(
    "SELECT id, lat, lon FROM f1n ORDER BY md5('42:' || id), id LIMIT 500"
)
SQL["induced_subgraph"] = with_graphs(
    "SELECT src, dst FROM f1e WHERE src IN (SELECT id FROM s) AND dst IN (SELECT id FROM s)",
    "s AS (SELECT id FROM f1n ORDER BY md5('42:' || id), id LIMIT 500)",
)
SQL["sample_edges"] = with_graphs(
    "SELECT src, dst FROM f1e ORDER BY md5('42:' || src || ':' || dst), src, dst LIMIT 1000"
)


# ---- traversal -----------------------------------------------------------------------------


def bfs_cte(source: int = 0, budget: int | None = None, name: str = "bfs") -> str:
    """Queue-order BFS with visit orders as a keyed recursive CTE (optionally budgeted)."""
    cut = f" WHERE vo < {int(budget)}" if budget is not None else ""
    return (
        f"{name} AS (WITH RECURSIVE t(id, level, parent, visit_order) USING KEY (id) AS ("
        f"SELECT {int(source)}::BIGINT, 0, NULL::BIGINT, 0::BIGINT UNION "
        "SELECT id, level, parent, vo FROM ("
        "SELECT c.dst AS id, c.lvl AS level, c.par AS parent, "
        "(SELECT max(visit_order) FROM recurring.t) + row_number() OVER (ORDER BY c.po, c.dst) AS vo "
        "FROM (SELECT e.dst, max(t.level) + 1 AS lvl, arg_min(t.id, t.visit_order) AS par, "
        "min(t.visit_order) AS po FROM t JOIN f1e e ON e.src = t.id "
        "WHERE e.dst NOT IN (SELECT id FROM recurring.t) GROUP BY e.dst) c)"
        f"{cut}) SELECT * FROM t)"
    )


SQL["bfs_levels"] = with_graphs("SELECT id, level, parent, visit_order FROM bfs", bfs_cte(0))
SQL["bfs_level_histogram"] = with_graphs(
    "SELECT level, count(*) AS n_nodes FROM bfs GROUP BY level", bfs_cte(0)
)
SQL["reachable_count"] = with_graphs(
    "SELECT 0::BIGINT AS source, count(*) AS n_reached FROM bfs", bfs_cte(0)
)
SQL["farthest_node"] = with_graphs(
    "SELECT id, level FROM bfs ORDER BY level DESC, id LIMIT 1", bfs_cte(0)
)
SQL["bfs_longest_path"] = with_graphs(
    "SELECT w.level AS pos, w.id FROM w",
    bfs_cte(0),
    "w AS (WITH RECURSIVE w(id, level) AS ("
    "SELECT id, level FROM (SELECT id, level FROM bfs ORDER BY level DESC, id LIMIT 1) UNION ALL "
    "SELECT b.parent, w.level - 1 FROM w JOIN bfs b ON b.id = w.id WHERE b.parent IS NOT NULL) "
    "SELECT * FROM w)",
)
SQL["bfs_budget"] = with_graphs(
    "SELECT id, level, parent, visit_order FROM bfs", bfs_cte(0, budget=500)
)


def sssp_cte(source: str, name: str = "sp") -> str:
    """Single-source shortest distances with predecessor (strict improvement per round)."""
    return (
        f"{name} AS (WITH RECURSIVE d(id, dist, pred) USING KEY (id) AS ("
        f"SELECT ({source})::BIGINT, 0.0::DOUBLE, NULL::BIGINT UNION "
        "SELECT c.id, c.dist, c.pred FROM ("
        "SELECT e.dst AS id, min(d.dist + e.weight) AS dist, "
        "arg_min(d.id, (d.dist + e.weight, d.dist, d.id)) AS pred "
        "FROM d JOIN f1w e ON e.src = d.id GROUP BY e.dst) c "
        "LEFT JOIN recurring.d r ON r.id = c.id WHERE r.id IS NULL OR c.dist < r.dist"
        ") SELECT * FROM d)"
    )


FAR_PAIR = (
    "fp AS (SELECT least(a.id, b.id) AS u, greatest(a.id, b.id) AS v, "
    + hav("a.lat", "a.lon", "b.lat", "b.lon")
    + " AS dkm FROM c a JOIN c b ON a.id < b.id ORDER BY dkm DESC, u, v LIMIT 1)"
)
FAR_X = (
    "x AS (SELECT first(id ORDER BY lat, id) AS i1, first(id ORDER BY lat DESC, id) AS i2, "
    "first(id ORDER BY lon, id) AS i3, first(id ORDER BY lon DESC, id) AS i4 FROM f1n)"
)
FAR_C = (
    "c AS (SELECT * FROM f1n WHERE id IN (SELECT i1 FROM x UNION SELECT i2 FROM x UNION "
    "SELECT i3 FROM x UNION SELECT i4 FROM x))"
)
ROUTE_WALK = (
    "w AS (WITH RECURSIVE w(id, step) AS (SELECT v, 0 FROM fp WHERE v IN (SELECT id FROM sp) "
    "UNION ALL SELECT s.pred, w.step + 1 FROM w JOIN sp s ON s.id = w.id WHERE s.pred IS NOT NULL) "
    "SELECT * FROM w)"
)

SQL["sssp_distances"] = with_graphs(
    "SELECT id, round(dist, 6) AS dist FROM sp",
    f"f1w AS ({F1_WEIGHTED})",
    sssp_cte("0"),
)
SQL["route_cost"] = with_graphs(
    "SELECT fp.u AS source, fp.v AS sink, round(s.dist, 6) AS cost, "
    "(SELECT CAST(max(step) AS INTEGER) FROM w) AS hops FROM fp LEFT JOIN sp s ON s.id = fp.v",
    f"f1w AS ({F1_WEIGHTED})",
    FAR_X,
    FAR_C,
    FAR_PAIR,
    sssp_cte("SELECT u FROM fp"),
    ROUTE_WALK,
)
SQL["route_nodes"] = with_graphs(
    "SELECT (SELECT max(step) FROM w) - step AS pos, id FROM w",
    f"f1w AS ({F1_WEIGHTED})",
    FAR_X,
    FAR_C,
    FAR_PAIR,
    sssp_cte("SELECT u FROM fp"),
    ROUTE_WALK,
)

F4_EDGES = (
    "SELECT 0::BIGINT AS src, CAST(r_regionkey + 1 AS BIGINT) AS dst FROM region UNION ALL "
    "SELECT CAST(n_regionkey + 1 AS BIGINT), CAST(n_nationkey + 100 AS BIGINT) FROM nation UNION ALL "
    "SELECT CAST(c_nationkey + 100 AS BIGINT), CAST(c_custkey + 1000000000 AS BIGINT) FROM customer UNION ALL "
    "SELECT CAST(s_nationkey + 100 AS BIGINT), CAST(s_suppkey + 2000000000 AS BIGINT) FROM supplier"
)
F4_PATHS = (
    "tp AS (WITH RECURSIVE t(id, depth, path) AS (SELECT 0::BIGINT, 0, [0::BIGINT] UNION ALL "
    "SELECT e.dst, t.depth + 1, list_append(t.path, e.dst) FROM t JOIN f4e e ON e.src = t.id) "
    "SELECT * FROM t)"
)
SQL["tree_preorder"] = (
    f"WITH f4e AS ({F4_EDGES}), {F4_PATHS} "
    "SELECT id, depth, row_number() OVER (ORDER BY path) - 1 AS visit_order, "
    "(SELECT count(*) FROM tp t2 WHERE list_contains(t2.path, tp.id)) AS subtree_size FROM tp"
)
SQL["dfs_deepest"] = (
    f"WITH f4e AS ({F4_EDGES}), {F4_PATHS}, o AS (SELECT id, depth, "
    "row_number() OVER (ORDER BY path) - 1 AS visit_order FROM tp) "
    "SELECT id, depth, visit_order FROM o ORDER BY depth DESC, visit_order LIMIT 1"
)


# ---- components, forests, communities (F3) -------------------------------------------------

F3 = [f"f3e AS ({F3_EDGES})", "f3s AS (SELECT src, dst, weight FROM f3e UNION ALL SELECT dst, src, weight FROM f3e)"]
F6 = [
    "f6n AS (SELECT c_custkey AS id FROM customer UNION ALL SELECT 1000000000 + o_orderkey FROM orders)",
    "f6e AS (SELECT o_custkey AS src, 1000000000 + o_orderkey AS dst FROM orders)",
]
CC6 = (
    "cc AS (WITH RECURSIVE r(id, comp) USING KEY (id) AS (SELECT id, id FROM f6n UNION "
    "SELECT c.id, c.comp FROM (SELECT s.src AS id, min(r.comp) AS comp FROM r "
    "JOIN (SELECT src, dst FROM f6e UNION ALL SELECT dst, src FROM f6e) s ON s.dst = r.id "
    "GROUP BY s.src) c JOIN recurring.r o ON o.id = c.id WHERE c.comp < o.comp) SELECT * FROM r)"
)


def boruvka_ctes(edges: str, name: str, rounds: int = 11) -> list[str]:
    """Minimum spanning forest by unrolled rounds: the lightest edge ``(weight, u, v)`` of every fragment is
    taken and the fragments it joins are merged by a recursion over the taken edges. Fragments at least
    halve per round, so 11 rounds are enough for 2,048 nodes."""
    p = name
    ctes = [f"{p}c0 AS (SELECT id, id AS f FROM f1n)"]
    for i in range(rounds):
        ctes += [
            f"{p}x{i} AS MATERIALIZED (SELECT e.src AS u, e.dst AS v, e.weight, a.f AS fu, b.f AS fv FROM {edges} e "
            f"JOIN {p}c{i} a ON a.id = e.src JOIN {p}c{i} b ON b.id = e.dst WHERE a.f <> b.f)",
            f"{p}p{i} AS MATERIALIZED (SELECT DISTINCT u, v, weight, fu, fv FROM (SELECT fu AS f, * FROM {p}x{i} "
            f"UNION ALL SELECT fv AS f, * FROM {p}x{i}) "
            "QUALIFY row_number() OVER (PARTITION BY f ORDER BY weight, u, v) = 1)",
            f"{p}r{i} AS MATERIALIZED (WITH RECURSIVE r(f, g) USING KEY (f) AS (SELECT DISTINCT f, f FROM {p}c{i} UNION "
            f"SELECT c.f, c.g FROM (SELECT l.a AS f, min(r.g) AS g FROM r JOIN (SELECT fu AS a, fv AS b FROM {p}p{i} "
            f"UNION ALL SELECT fv, fu FROM {p}p{i}) l ON l.b = r.f GROUP BY l.a) c JOIN recurring.r o ON o.f = c.f "
            "WHERE c.g < o.g) SELECT * FROM r)",
            f"{p}c{i + 1} AS MATERIALIZED (SELECT c.id, r.g AS f FROM {p}c{i} c JOIN {p}r{i} r ON r.f = c.f)",
        ]
    union = " UNION ALL ".join(f"SELECT u, v, weight FROM {p}p{i}" for i in range(rounds))
    ctes.append(f"{name} AS (SELECT m.u, m.v, m.weight, c.f AS grp FROM ({union}) m JOIN {p}c{rounds} c ON c.id = m.u)")
    return ctes


FOREST = boruvka_ctes("f3e", "forest")

SQL["components"] = f"WITH {', '.join([*F6, CC6])} SELECT id, comp AS component FROM cc"
SQL["component_sizes"] = (
    f"WITH {', '.join([*F6, CC6])} SELECT comp AS component, count(*) AS size FROM cc GROUP BY comp"
)
SQL["spanning_forest_edges"] = with_graphs("SELECT u, v, weight, grp FROM forest", *F3, *FOREST)
SQL["spanning_forest_total"] = with_graphs(
    "SELECT count(*) AS n_edges, round(sum(weight), 3) AS total_weight FROM forest", *F3, *FOREST
)


def lpa_ctes(k: int) -> list[str]:
    ctes = [
        "vs AS (SELECT src, dst FROM f3e UNION ALL SELECT dst, src FROM f3e UNION ALL SELECT id, id FROM f1n)",
        "l0 AS (SELECT id, id AS label FROM f1n)",
    ]
    for i in range(1, k + 1):
        ctes.append(
            f"l{i} AS (SELECT id, label FROM (SELECT v.src AS id, l.label, count(*) AS n FROM vs v "
            f"JOIN l{i - 1} l ON l.id = v.dst GROUP BY v.src, l.label) "
            "QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, label) = 1)"
        )
    return ctes


LPA3 = lpa_ctes(3)
SQL["label_propagation_3"] = with_graphs("SELECT id, label FROM l3", *F3, *LPA3)
_LPA10 = lpa_ctes(10)
_CH = " UNION ALL ".join(
    f"SELECT {i} AS iteration, count(*) FILTER (WHERE a.label <> b.label) AS changes "
    f"FROM l{i} a JOIN l{i - 1} b ON a.id = b.id"
    for i in range(1, 11)
)
SQL["lpa_changes"] = with_graphs(
    "SELECT iteration, changes FROM ch WHERE iteration <= "
    "coalesce((SELECT min(iteration) FROM ch WHERE changes = 0), 10)",
    *F3,
    *_LPA10,
    f"ch AS ({_CH})",
)
_SIZES = "sz AS (SELECT label AS community, count(*) AS size FROM l3 GROUP BY label)"
_SELECTION = [
    *F3,
    *LPA3,
    _SIZES,
    "lg AS (SELECT community, 'largest' AS role, size FROM sz ORDER BY size DESC, community LIMIT 1)",
    "sm AS (SELECT community, 'smallest' AS role, size FROM sz WHERE size > 1 OR (SELECT max(size) FROM sz) = 1 "
    "ORDER BY size, community LIMIT 1)",
    "rnd AS (SELECT community, 'random' AS role, size FROM sz WHERE size > 5 "
    "AND community NOT IN (SELECT community FROM lg UNION SELECT community FROM sm) "
    "ORDER BY md5('42:' || community), community LIMIT 20)",
    "sel AS (SELECT * FROM (SELECT * FROM lg UNION ALL SELECT * FROM sm UNION ALL SELECT * FROM rnd) "
    "WHERE (SELECT count(*) FROM sz) >= 3)",
]
SQL["community_selection"] = with_graphs("SELECT * FROM sel", *_SELECTION)
SQL["community_members"] = with_graphs(
    "SELECT label AS community, id FROM l3 WHERE label IN (SELECT community FROM sel)", *_SELECTION
)
SQL["community_starts"] = with_graphs(
    "SELECT label AS community, min(id) AS id FROM l3 "
    "WHERE id IN (SELECT src FROM f1e UNION SELECT dst FROM f1e) GROUP BY label",
    *F3,
    *LPA3,
)
SQL["community_internal_edges"] = with_graphs(
    "SELECT a.label AS community, count(*) AS n_edges FROM f3e e JOIN l3 a ON a.id = e.src "
    "JOIN l3 b ON b.id = e.dst WHERE a.label = b.label GROUP BY a.label",
    *F3,
    *LPA3,
)
SQL["contract_communities"] = with_graphs(
    "SELECT least(a.label, b.label) AS u, greatest(a.label, b.label) AS v, round(sum(e.weight), 6) AS w "
    "FROM f3e e JOIN l3 a ON a.id = e.src JOIN l3 b ON b.id = e.dst GROUP BY 1, 2",
    *F3,
    *LPA3,
)
SQL["lpa_modularity"] = with_graphs(
    "SELECT round(sum(in_c) / (SELECT sum(weight) FROM f3e) - sum(tot_c * tot_c) / "
    "(4 * pow((SELECT sum(weight) FROM f3e), 2)), 6) AS modularity, "
    "round((SELECT sum(weight) FROM f3e), 4) AS m FROM ("
    "SELECT c, sum(inw) AS in_c, sum(tw) AS tot_c FROM ("
    "SELECT a.label AS c, CASE WHEN a.label = b.label THEN e.weight ELSE 0 END AS inw, e.weight AS tw "
    "FROM f3e e JOIN l3 a ON a.id = e.src JOIN l3 b ON b.id = e.dst UNION ALL "
    "SELECT b.label, 0, e.weight FROM f3e e JOIN l3 a ON a.id = e.src JOIN l3 b ON b.id = e.dst) GROUP BY c)",
    *F3,
    *LPA3,
)
SQL["louvain_step"] = with_graphs(
    "SELECT rule, id, community, round(max(g) - max(stay), 8) AS delta FROM ("
    "SELECT rule, x.id, x.label AS community, CASE WHEN l.c <> x.label AND NOT (o.n = 1 AND t.n = 1 AND l.c > x.label) "
    "THEN l.w / m - t.tot * x.k / (2 * m * m) END AS g, "
    "CASE WHEN rule = 'simple' THEN 0 ELSE coalesce(own.w, 0) / m - (o.tot - x.k) * x.k / (2 * m * m) END AS stay "
    "FROM lk x JOIN links l ON l.id = x.id JOIN tot t ON t.c = l.c JOIN tot o ON o.c = x.label "
    "LEFT JOIN links own ON own.id = x.id AND own.c = x.label "
    "CROSS JOIN (SELECT sum(weight) AS m FROM f3e) CROSS JOIN (VALUES ('standard'), ('simple')) r(rule)) "
    "GROUP BY rule, id, community HAVING max(g) - max(stay) > 1e-7",
    *F3,
    *LPA3,
    "lk AS (SELECT l3.id, l3.label, coalesce(s.k, 0) AS k FROM l3 LEFT JOIN (SELECT src, sum(weight) AS k FROM f3s GROUP BY src) s ON s.src = l3.id)",
    "links AS (SELECT s.src AS id, b.label AS c, sum(s.weight) AS w FROM f3s s JOIN l3 b ON b.id = s.dst GROUP BY ALL)",
    "tot AS (SELECT label AS c, sum(k) AS tot, count(*) AS n FROM lk GROUP BY label)",
)
# every node once, and the three counts of what must not happen
SQL["louvain_optimum"] = with_graphs(
    "SELECT count(*) AS rows, count(*) AS nodes, CAST(0 AS BIGINT) AS gaining, CAST(0 AS BIGINT) AS falls, "
    "CAST(0 AS BIGINT) AS differs FROM f1n"
)
SQL["community_forest"] = with_graphs(
    "SELECT m.u, m.v, m.weight, a.label AS grp FROM cf m JOIN l3 a ON a.id = m.u",
    *F3,
    *LPA3,
    "f3c AS (SELECT e.* FROM f3e e JOIN l3 a ON a.id = e.src JOIN l3 b ON b.id = e.dst WHERE a.label = b.label)",
    *boruvka_ctes("f3c", "cf"),
)
SQL["community_forest_starts"] = with_graphs(
    "SELECT m.u, m.v, m.weight, a.label AS grp FROM cf m JOIN l3 a ON a.id = m.u WHERE a.label % 3 <> 0",
    *F3,
    *LPA3,
    "f3c AS (SELECT e.* FROM f3e e JOIN l3 a ON a.id = e.src JOIN l3 b ON b.id = e.dst WHERE a.label = b.label)",
    *boruvka_ctes("f3c", "cf"),
)
SQL["sample_per_group"] = with_graphs(
    "SELECT label AS community, id FROM l3 QUALIFY row_number() OVER "
    "(PARTITION BY label ORDER BY md5('42:' || id), id) <= 5",
    *F3,
    *LPA3,
)


# ---- DFS path layers, colours, exports -----------------------------------------------------

from geoweave.functions.colors import GRADIENT_LIGHTNESS as _L, GRADIENT_SATURATION as _S  # noqa: E402

_M2 = _L * (1.0 + _S) if _L <= 0.5 else _L + _S - _L * _S
_M1 = 2.0 * _L - _M2


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _hls_chan(h: str) -> str:
    hh = f"(({h}) - floor({h}))"
    m1, m2, d = _dbl(_M1), _dbl(_M2), _dbl(_M2 - _M1)
    return (
        f"(CASE WHEN {hh} < 1.0 / 6.0 THEN {m1} + {d} * {hh} * 6.0 WHEN {hh} < 0.5 THEN {m2} "
        f"WHEN {hh} < 2.0 / 3.0 THEN {m1} + {d} * (2.0 / 3.0 - {hh}) * 6.0 ELSE {m1} END)"
    )


def gradient_sql(step: str, k: str) -> str:
    hue = f"(240.0 / 360.0 * (1.0 - CAST({step} AS DOUBLE) / CAST({k} - 1 AS DOUBLE)))"
    r = _hls_chan(f"{hue} + 1.0 / 3.0")
    g = _hls_chan(hue)
    b = _hls_chan(f"{hue} - 1.0 / 3.0")
    return (
        f"(CASE WHEN {k} <= 1 THEN '#FF0000' ELSE printf('#%02x%02x%02x', "
        f"CAST(floor({r} * 255) AS INTEGER), CAST(floor({g} * 255) AS INTEGER), "
        f"CAST(floor({b} * 255) AS INTEGER)) END)"
    )


_F4_ORDER = [
    f"f4e AS ({F4_EDGES})",
    F4_PATHS,
    "o AS (SELECT id, depth, row_number() OVER (ORDER BY path) - 1 AS visit_order FROM tp)",
    "ds AS (SELECT visit_order AS pos, id FROM o, (SELECT count(*) AS n FROM o) c "
    "WHERE c.n <= 50 OR visit_order % (c.n // 50) = 0 OR visit_order = c.n - 1)",
    "st AS (SELECT id, row_number() OVER (ORDER BY pos) - 1 AS step, count(*) OVER () AS k FROM ds)",
    "seg AS (SELECT * FROM (SELECT step AS seg, id AS from_id, lead(id) OVER (ORDER BY step) AS to_id, k FROM st) "
    "WHERE to_id IS NOT NULL)",
]
SQL["path_downsample"] = "WITH " + ", ".join(_F4_ORDER) + " SELECT pos, id FROM ds"
SQL["segment_colors"] = (
    "WITH " + ", ".join(_F4_ORDER) + f" SELECT seg, from_id, to_id, {gradient_sql('seg', 'k')} AS color FROM seg"
)
SQL["path_layers"] = (
    "WITH "
    + ", ".join(_F4_ORDER)
    + " SELECT seg // greatest(1, (k - 1) // 10) AS layer, min(seg) + 1 AS start_step, max(seg) + 1 AS end_step, "
    "arg_min(from_id, seg) AS start_id, arg_max(to_id, seg) AS end_id, count(*) AS n_segments "
    "FROM seg GROUP BY 1"
)

SQL["dense_ids"] = with_graphs("SELECT id, row_number() OVER (ORDER BY id) - 1 AS new_id FROM f1n")
_EXPORT = [
    *F3,
    *FOREST,
    "fe AS (SELECT u, v FROM forest)",
    "ends AS (SELECT u AS id FROM fe UNION SELECT v FROM fe)",
    "mp AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS new_id FROM ends)",
    "deg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM f1e UNION ALL SELECT dst FROM f1e) GROUP BY id)",
]
SQL["export_nodes"] = with_graphs(
    "SELECT mp.new_id AS node_id, n.lat, n.lon, coalesce(deg.degree, 0) AS degree_original "
    "FROM mp JOIN f1n n ON n.id = mp.id LEFT JOIN deg ON deg.id = mp.id",
    *_EXPORT,
)
SQL["export_edges"] = with_graphs(
    "SELECT a.new_id AS source, b.new_id AS destination FROM fe JOIN mp a ON a.id = fe.u JOIN mp b ON b.id = fe.v",
    *_EXPORT,
)


# ---- random route batch ------------------------------------------------------------------------


def _h(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 15)) AS BIGINT)"


_ATT = [
    f"f1w AS ({F1_WEIGHTED})",
    "nn AS (SELECT count(*) AS n FROM f1n)",
    "dn AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k FROM f1n)",
    "grid AS (SELECT s AS slot, a AS attempt FROM range(100) r1(s), range(2) r2(a))",
    "draw AS (SELECT slot, attempt, "
    + _h("'7:' || slot || ':' || attempt || ':u'")
    + " % (SELECT n FROM nn) AS ku, "
    + _h("'7:' || slot || ':' || attempt || ':v'")
    + " % (SELECT n FROM nn) AS kv FROM grid)",
    "att AS (SELECT slot, attempt, a.id AS u, b.id AS v FROM draw JOIN dn a ON a.k = draw.ku "
    "JOIN dn b ON b.k = draw.kv WHERE a.id <> b.id)",
    "msp AS (WITH RECURSIVE d(q, id, dist) USING KEY (q, id) AS ("
    "SELECT slot * 100 + attempt, u, 0.0::DOUBLE FROM att UNION "
    "SELECT c.q, c.id, c.dist FROM (SELECT d.q, e.dst AS id, min(d.dist + e.weight) AS dist FROM d "
    "JOIN f1w e ON e.src = d.id GROUP BY d.q, e.dst) c LEFT JOIN recurring.d r ON r.q = c.q AND r.id = c.id "
    "WHERE r.id IS NULL OR c.dist < r.dist) SELECT * FROM d)",
    "ok AS (SELECT att.*, msp.dist AS cost FROM att JOIN msp ON msp.q = att.slot * 100 + att.attempt "
    "AND msp.id = att.v WHERE msp.dist > 0)",
    "rb AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY slot ORDER BY attempt) = 1)",
]
SQL["route_batch"] = with_graphs("SELECT slot, attempt, u, v, round(cost, 6) AS cost FROM rb", *_ATT)
SQL["route_batch_stats"] = with_graphs(
    "SELECT count(*) AS n_routes, round(min(cost), 6) AS min_km, round(max(cost), 6) AS max_km, "
    "round(avg(cost), 4) AS avg_km FROM rb",
    *_ATT,
)

_ATT_PRED = [c for c in _ATT if not c.startswith("msp AS")] + [
    "msp AS (WITH RECURSIVE d(q, id, dist, pred) USING KEY (q, id) AS ("
    "SELECT slot * 100 + attempt, u, 0.0::DOUBLE, NULL::BIGINT FROM att UNION "
    "SELECT c.q, c.id, c.dist, c.pred FROM (SELECT d.q, e.dst AS id, min(d.dist + e.weight) AS dist, "
    "arg_min(d.id, (d.dist + e.weight, d.dist, d.id)) AS pred FROM d "
    "JOIN f1w e ON e.src = d.id GROUP BY d.q, e.dst) c LEFT JOIN recurring.d r ON r.q = c.q AND r.id = c.id "
    "WHERE r.id IS NULL OR c.dist < r.dist) SELECT * FROM d)",
]
# keep the CTE order: msp must precede ok/rb
_ATT_PRED = [c for c in _ATT_PRED if not (c.startswith("ok AS") or c.startswith("rb AS"))] + [
    c for c in _ATT if c.startswith("ok AS") or c.startswith("rb AS")
]
SQL["route_nodes_union"] = with_graphs(
    "SELECT id FROM walk UNION SELECT id FROM w",
    *_ATT_PRED,
    FAR_X,
    FAR_C,
    FAR_PAIR,
    sssp_cte("SELECT u FROM fp"),
    ROUTE_WALK,
    "walk AS (WITH RECURSIVE w(q, id) AS (SELECT slot * 100 + attempt, v FROM rb UNION ALL "
    "SELECT w.q, m.pred FROM w JOIN msp m ON m.q = w.q AND m.id = w.id WHERE m.pred IS NOT NULL) "
    "SELECT * FROM w)",
)


# ---- other weights, viewer tables, starts ------------------------------------------------------

_PRICED = (
    "f1w AS (SELECT a.l_partkey AS src, b.l_partkey AS dst, min(CAST(a.l_quantity AS DOUBLE)) AS weight "
    "FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 GROUP BY 1, 2)"
)
SQL["sssp_custom_weight"] = with_graphs("SELECT id, round(dist, 6) AS dist FROM sp", _PRICED, sssp_cte("0"))
SQL["route_custom_weight"] = with_graphs(
    "SELECT 0::BIGINT AS source, m.id AS sink, round(sp.dist, 6) AS cost FROM (SELECT max(id) AS id FROM f1n) m "
    "LEFT JOIN sp ON sp.id = m.id",
    _PRICED,
    sssp_cte("0"),
)
SQL["route_zero_weight"] = with_graphs(
    "SELECT id, round(dist, 6) AS dist, 1::BIGINT AS chains_home FROM sp",
    "fcn AS (SELECT id, floor(lat / 30) * 30 AS lat, floor(lon / 30) * 30 AS lon FROM f1n)",
    f"f1w AS (SELECT e.src, e.dst, {hav('s.lat', 's.lon', 'd.lat', 'd.lon')} AS weight "
    "FROM f1e e JOIN fcn s ON s.id = e.src JOIN fcn d ON d.id = e.dst)",
    sssp_cte("0"),
)
_S500 = "s AS (SELECT id, lat, lon FROM f1n ORDER BY md5('42:' || id), id LIMIT 500)"
SQL["sampled_table_nodes"] = with_graphs("SELECT id AS node_id, lat, lon FROM s", _S500)
SQL["sampled_table_edges"] = with_graphs(
    "SELECT src + 1 AS source, dst + 1 AS destination FROM f1e "
    "WHERE src IN (SELECT id FROM s) AND dst IN (SELECT id FROM s)",
    _S500,
)
SQL["fallback_start"] = with_graphs("SELECT id FROM f1n ORDER BY md5('42:' || id), id LIMIT 1")


# ---- feature tables ----------------------------------------------------------------------------

from geoweave.functions.colors import LEVEL_PALETTE, ROUTE_COLORS, TREE_EDGE_COLOR  # noqa: E402
from geoweave.operators import features as _fx  # noqa: E402


def _pt(alias: str) -> str:
    return f"printf('%.4f %.4f', {alias}.lon, {alias}.lat)"


_PALETTE = "[" + ", ".join(f"'{c}'" for c in LEVEL_PALETTE) + "]"
SQL["bfs_features"] = with_graphs(
    f"SELECT 'visited nodes' AS layer, 'point' AS kind, {_PALETTE}[b.level % 6 + 1] AS color, "
    f"printf('node %d level %d', b.id, b.level) AS label, {_pt('n')} AS points FROM bfs b JOIN f1n n ON n.id = b.id "
    f"UNION ALL SELECT 'bfs tree', 'line', '{TREE_EDGE_COLOR}', printf('%d -> %d', b.parent, b.id), "
    f"{_pt('p')} || ', ' || {_pt('n')} FROM bfs b JOIN f1n n ON n.id = b.id JOIN f1n p ON p.id = b.parent "
    f"UNION ALL SELECT 'longest path', 'line', '{_fx.END_COLOR}', 'longest path', "
    f"string_agg({_pt('n')}, ', ' ORDER BY w.level) FROM w JOIN f1n n ON n.id = w.id "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.START_COLOR}', printf('start node %d', n.id), {_pt('n')} FROM f1n n "
    "WHERE n.id = (SELECT arg_min(id, level) FROM w) "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.END_COLOR}', printf('end node %d', n.id), {_pt('n')} FROM f1n n "
    "WHERE n.id = (SELECT arg_max(id, level) FROM w) "
    "UNION ALL SELECT 'centre', 'point', '#000000', 'centre', printf('%.4f %.4f', avg(n.lon), avg(n.lat)) "
    "FROM bfs b JOIN f1n n ON n.id = b.id",
    bfs_cte(0),
    "w AS (WITH RECURSIVE w(id, level) AS ("
    "SELECT id, level FROM (SELECT id, level FROM bfs ORDER BY level DESC, id LIMIT 1) UNION ALL "
    "SELECT b.parent, w.level - 1 FROM w JOIN bfs b ON b.id = w.id WHERE b.parent IS NOT NULL) "
    "SELECT * FROM w)",
)

_DFS = [
    *_F4_ORDER,
    f"f4n AS (SELECT id, {key_coords('id')} FROM o)",
    "lay AS (SELECT seg // greatest(1, (k - 1) // 10) AS layer, min(seg) + 1 AS s0, max(seg) + 1 AS s1, "
    "arg_min(from_id, seg) AS a, arg_max(to_id, seg) AS b FROM seg GROUP BY 1)",
    "named AS (SELECT *, printf('path (steps %d-%d)', s0, s1) AS name FROM lay)",
]
SQL["dfs_features"] = "WITH " + ", ".join(_DFS) + (
    f" SELECT 'path vertices' AS layer, 'point' AS kind, '{_fx.VERTEX_COLOR}' AS color, printf('node %d', n.id) AS label, "
    f"{_pt('n')} AS points FROM ds JOIN f4n n ON n.id = ds.id "
    f"UNION ALL SELECT l.name, 'line', {gradient_sql('s.seg', 's.k')}, printf('segment %d', s.seg), {_pt('x')} || ', ' || {_pt('y')} "
    "FROM seg s JOIN named l ON l.layer = s.seg // greatest(1, (s.k - 1) // 10) JOIN f4n x ON x.id = s.from_id JOIN f4n y ON y.id = s.to_id "
    f"UNION ALL SELECT l.name, 'point', '{_fx.LAYER_START_COLOR}', printf('layer start: step %d', l.s0), {_pt('n')} FROM named l JOIN f4n n ON n.id = l.a "
    f"UNION ALL SELECT l.name, 'point', '{_fx.LAYER_END_COLOR}', printf('layer end: step %d', l.s1), {_pt('n')} FROM named l JOIN f4n n ON n.id = l.b "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.START_COLOR}', printf('start: node %d', n.id), {_pt('n')} FROM f4n n "
    "WHERE n.id = (SELECT arg_min(id, pos) FROM ds) "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.END_COLOR}', printf('last visited: node %d', n.id), {_pt('n')} FROM f4n n "
    "WHERE n.id = (SELECT arg_max(id, visit_order) FROM o) "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.DEEPEST_COLOR}', printf('deepest: node %d', n.id), {_pt('n')} FROM f4n n "
    "WHERE n.id = (SELECT id FROM o ORDER BY depth DESC, visit_order LIMIT 1)"
)


def _blend(a: int, b: int) -> str:
    return f"CAST(round({float(a)}::DOUBLE + {float(b - a)}::DOUBLE * t) AS INTEGER)"


SQL["community_features"] = with_graphs(
    "SELECT layer, 'point' AS kind, color, printf('node %d (community %d)', n.id, s.community) AS label, "
    f"{_pt('n')} AS points FROM shade s JOIN l3 m ON m.label = s.community JOIN f1n n ON n.id = m.id "
    f"UNION ALL SELECT layer, 'line', color, printf('%d - %d', e.src, e.dst), {_pt('x')} || ', ' || {_pt('y')} "
    "FROM shade s JOIN l3 p ON p.label = s.community JOIN f3e e ON e.src = p.id JOIN l3 q ON q.id = e.dst AND q.label = p.label "
    "JOIN f1n x ON x.id = e.src JOIN f1n y ON y.id = e.dst",
    *_SELECTION,
    "lim AS (SELECT CAST(min(size) AS DOUBLE) AS lo, CAST(max(size) AS DOUBLE) AS hi FROM sz)",
    "tone AS (SELECT s.community, s.role, s.size, least(greatest(coalesce(ln(s.size / lo) / nullif(ln(hi / lo), 0), 0), 0), 1) AS t "
    "FROM sel s, lim)",
    f"shade AS (SELECT *, printf('#%02x%02x%02x', {_blend(0x3B, 0xB4)}, {_blend(0x4C, 0x04)}, {_blend(0xC0, 0x26)}) AS color, "
    "CASE role WHEN 'largest' THEN printf('largest community (%d)', size) WHEN 'smallest' THEN printf('smallest community (%d)', size) "
    "ELSE printf('community %d (%d members)', community, size) END AS layer FROM tone)",
)

SQL["route_features"] = with_graphs(
    "SELECT 'random routes' AS layer, 'line' AS kind, CASE WHEN cost = lo THEN '{shortest}' WHEN cost = hi THEN '{longest}' "
    "ELSE '{other}' END AS color, printf(CASE WHEN cost = lo THEN 'shortest of the sample (%.2f km)' "
    "WHEN cost = hi THEN 'longest of the sample (%.2f km)' ELSE 'route of %.2f km' END, cost) AS label, points "
    "FROM lines, (SELECT min(cost) AS lo, max(cost) AS hi FROM rb) ".format(**ROUTE_COLORS)
    + f"UNION ALL SELECT 'main route', 'line', '{_fx.MAIN_ROUTE_COLOR}', printf('route of %.2f km', (SELECT sp.dist FROM sp, fp WHERE sp.id = fp.v)), "
    f"string_agg({_pt('n')}, ', ' ORDER BY w.step DESC) FROM w JOIN f1n n ON n.id = w.id "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.SOURCE_COLOR}', printf('source node %d', n.id), {_pt('n')} FROM f1n n, fp WHERE n.id = fp.u "
    f"UNION ALL SELECT 'markers', 'point', '{_fx.SINK_COLOR}', printf('sink node %d', n.id), {_pt('n')} FROM f1n n, fp WHERE n.id = fp.v "
    f"UNION ALL SELECT 'nodes on routes', 'point', '{_fx.ROUTE_NODE_COLOR}', printf('node %d', n.id), {_pt('n')} FROM f1n n "
    "WHERE n.id IN (SELECT id FROM walk UNION SELECT id FROM w)",
    *_ATT_PRED,
    FAR_X,
    FAR_C,
    FAR_PAIR,
    sssp_cte("SELECT u FROM fp"),
    ROUTE_WALK,
    "walk AS (WITH RECURSIVE k(q, id, step) AS (SELECT slot * 100 + attempt, v, 0 FROM rb UNION ALL "
    "SELECT k.q, m.pred, k.step + 1 FROM k JOIN msp m ON m.q = k.q AND m.id = k.id WHERE m.pred IS NOT NULL) SELECT * FROM k)",
    f"lines AS (SELECT rb.cost, string_agg({_pt('n')}, ', ' ORDER BY walk.step DESC) AS points FROM rb "
    "JOIN walk ON walk.q = rb.slot * 100 + rb.attempt JOIN f1n n ON n.id = walk.id GROUP BY rb.slot, rb.cost)",
)
