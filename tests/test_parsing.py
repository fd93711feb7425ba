"""Text sources: dirty lines (Q1–Q7), line numbering over files and blocks (S4), generators."""

import os
import tempfile

from pyspark.sql import functions as F

from geoweave.sources import generate, text


def lines(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "line_no long, value string")


def test_adjacency_all_tokens_default(spark):
    # generator lines "0,", "1,1", "2,3,3,1" with n = 3
    e = text.parse_adjacency(lines(spark, ["0,", "1,1", "2,3,3,1"]), 3)
    got = sorted((r.src, r.dst) for r in e.collect())
    assert got == [(1, 0), (2, 0), (2, 1), (2, 2)]


def test_adjacency_skip_first(spark):
    e = text.parse_adjacency(lines(spark, ["0,", "1,1", "2,3,3,1"]), 3, skip_first=True)
    assert sorted((r.src, r.dst) for r in e.collect()) == [(1, 0), (2, 0), (2, 2)]


def test_adjacency_dirty_tokens(spark):
    rows = ["2,x,-3,0,1.5,999999999, 7 ,99999999999999999999,²,2", "", "1", "3", "9,9,9"]
    e = text.parse_adjacency(lines(spark, rows), 8)
    got = sorted((r.src, r.dst) for r in e.collect())
    # line 0: 2 (dup), ' 7 '; superscript two and 20-digit tokens rejected; lines ≥ n ignored
    assert got == [(0, 1), (0, 6), (2, 0), (3, 2)]


def test_locations_reject_whole_line_and_shift_ids(spark):
    rows = ["1.0,2.0", "bad", "1.0,abc", "3.5 , -4", "1,2,3", " 5e1,6 ", ""]
    lf = lines(spark, rows)
    nodes = sorted(tuple(r) for r in text.parse_locations(lf).collect())
    assert nodes == [(0, 1.0, 2.0), (1, 3.5, -4.0), (2, 50.0, 6.0)]
    rej = sorted(r.line_no for r in text.location_rejects(lf).collect())
    assert rej == [1, 2, 4, 6]


def test_location_cap_counts_raw_lines(spark):
    lf = lines(spark, ["1,1", "bad", "2,2", "3,3"])
    nodes = text.parse_locations(lf, max_nodes=3)
    assert sorted(r.id for r in nodes.collect()) == [0, 1]


def test_line_numbers_across_files_and_blocks(spark):
    d = tempfile.mkdtemp(prefix="geoweave-lines-")
    expected = []
    for f in range(3):
        body = [f"{f}:{i}:" + "x" * (i % 37) for i in range(4000)]
        expected += body
        with open(os.path.join(d, f"part-{f:02d}.txt"), "w") as fh:
            fh.write("\n".join(body) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # many blocks per file
    try:
        got = text.read_numbered_lines(spark, d).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.line_no for r in got] == list(range(len(expected)))
    assert [r.value for r in got] == expected


def test_generators_roundtrip(spark):
    loc = generate.generate_location_lines(spark, 50, seed=3)
    nodes = text.parse_locations(loc)
    assert nodes.count() == 50
    b = nodes.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    assert -90 <= b[0] and b[1] <= 90 and -180 <= b[2] and b[3] <= 180
    vis = generate.generate_visit_lines(spark, 50, seed=3, max_visits=5)
    assert all(r.value.startswith(f"{r.line_no},") for r in vis.collect())
    e = text.parse_adjacency(vis, 50)
    assert e.filter((F.col("dst") < 0) | (F.col("dst") >= 50)).count() == 0
    # same seed → same data on a different partitioning
    again = generate.generate_visit_lines(spark, 50, seed=3, max_visits=5, num_partitions=7)
    assert sorted(map(tuple, vis.collect())) == sorted(map(tuple, again.collect()))


def test_line_numbers_with_compressed_files(spark):
    import gzip

    d = tempfile.mkdtemp(prefix="geoweave-gz-")
    expected = []
    for f in range(2):
        body = [f"{f},{i}" for i in range(3000)]
        expected += body
        with gzip.open(os.path.join(d, f"part-{f}.txt.gz"), "wt") as fh:
            fh.write("\n".join(body) + "\n")
    got = text.read_numbered_lines(spark, d).orderBy("line_no").collect()
    assert [r.line_no for r in got] == list(range(len(expected)))
    assert [r.value for r in got] == expected


def test_number_grammar_and_padding(spark):
    rows = ["\t1.5,\t2.5 ", "1.0d,2f", "0x1p3,1", "inf,nan", "1_0,2", "1__0,2", "+.5,-3.", "1e3,1E-2", "\u20031,2\u2003", "1 2,3"]
    got = {r.line_no: r.raw for r in text.location_rejects(lines(spark, rows)).collect()}
    assert sorted(got) == [1, 2, 5, 9]
    nodes = [tuple(r)[1:] for r in text.parse_locations(lines(spark, rows)).orderBy("id").collect()]
    assert nodes[0] == (1.5, 2.5) and nodes[1][0] == float("inf") and nodes[2:] == [(10.0, 2.0), (0.5, -3.0), (1000.0, 0.01), (1.0, 2.0)]


def test_tab_padded_destinations(spark):
    e = text.parse_adjacency(lines(spark, ["\t2\t,\x0b3\x0c,1\u00a0"]), 3)
    assert sorted(r.dst for r in e.collect()) == [0, 1, 2]


def test_line_numbers_are_joined_without_shuffling_lines(spark):
    d = tempfile.mkdtemp(prefix="geoweave-plan-")
    with open(os.path.join(d, "a.txt"), "w") as fh:
        fh.write("x\n" * 100)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = text.read_numbered_lines(spark, d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_line_numbers_hold_when_splits_change_between_the_scans(spark):
    d = tempfile.mkdtemp(prefix="geoweave-splits-")
    for k in range(3):
        with open(os.path.join(d, f"part-{k}.txt"), "w") as fh:
            fh.writelines(f"{k * 20_000 + i}\n" for i in range(20_000))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        numbered = text.read_numbered_lines(spark, d)
        spark.conf.set(key, "7001")
        assert numbered.count() == 60_000
        assert numbered.filter(F.col("line_no") != F.col("value").cast("long")).count() == 0
    finally:
        spark.conf.set(key, old)


def test_location_report_of_a_short_file(spark):
    rows = ["1,2", "bad", "3,4", "5,6"]
    got = text.location_report(lines(spark, rows), 5).first()
    assert tuple(got) == (5, 4, 3, 1, True)
    assert text.location_report(lines(spark, rows[:1]), 1).first()["short"] is False
    assert tuple(text.location_report(lines(spark, []), 2).first()) == (2, 0, 0, 0, True)
