"""Graphs derived from the driver's TPC-H-like tables.

Coordinates are integer arithmetic on keys, so Spark and the SQL oracle produce identical values.
Every builder is lazy: nothing runs until an operator asks for rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions.geo import key_lat, key_lon
from geoweave.model import Graph

# Fixed values of the fixture rules.
SUPPLIER_OFFSET = 1_000_000_000  # supplier node id = offset + suppkey
ORDER_OFFSET = 1_000_000_000  # order node id = offset + orderkey
F4_CUSTOMER_OFFSET = 1_000_000_000
F4_SUPPLIER_OFFSET = 2_000_000_000
F4_NATION_OFFSET = 100
F4_REGION_OFFSET = 1
F5_DIRTY_SUFFIX = ",x,-3,0,1.5,999999999, 7 ,99999999999999999999,\t3\t"
F5_ODD_LINES = {5: "bad", 6: "1.0,abc", 7: "1,2,3", 8: "1.0d,2f", 9: "0x1p3,1", 10: "\t1.5,\t2.5 "}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed_nodes(ids: DataFrame, col: str = "id") -> DataFrame:
    """Attach the fixture coordinates to a column of integer keys."""
    return ids.select(
        F.col(col).cast("long").alias("id"), key_lat(col).alias("lat"), key_lon(col).alias("lon")
    )


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_nodes(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 edges: consecutive line items of an order link their parts (distinct pairs)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    a = li.alias("a")
    b = li.alias("b")
    return (
        a.join(
            b,
            (F.col("a.l_orderkey") == F.col("b.l_orderkey"))
            & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1),
        )
        .select(F.col("a.l_partkey").alias("src"), F.col("b.l_partkey").alias("dst"))
        .distinct()
    )


def part_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """directed, dense, one component."""
    return Graph(part_nodes(spark, sf_dir), part_edges(spark, sf_dir), directed=True)


def order_multigraph(spark: SparkSession, sf_dir: str) -> Graph:
    """customer → supplier, one weighted edge per line item (parallel edges)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    edges = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("long").alias("src"),
        (F.lit(SUPPLIER_OFFSET) + F.col("l_suppkey")).cast("long").alias("dst"),
        F.col("l_extendedprice").cast("double").alias("weight"),
    )
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    supp = table(spark, sf_dir, "supplier").select(
        (F.lit(SUPPLIER_OFFSET) + F.col("s_suppkey")).alias("id")
    )
    return Graph(keyed_nodes(cust.unionByName(supp)), edges, directed=True)


def pair_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """all F1 links as an undirected graph without self-loops, haversine weights rounded to 6."""
    from geoweave.operators.geo import edge_weights

    g = part_graph(spark, sf_dir)
    pairs = g.edges.filter(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).distinct()
    weighted = edge_weights(Graph(g.nodes, pairs)).edges.withColumn("weight", F.round("weight", 6))
    return Graph(g.nodes, weighted, directed=False)


def order_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """customers and orders; an undirected edge joins every order with its customer, so there is a
    component for each customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("id"))
    ids = cust.unionByName(orders.select((F.lit(ORDER_OFFSET) + F.col("o_orderkey")).cast("long").alias("id")))
    edges = orders.select(
        F.col("o_custkey").cast("long").alias("src"), (F.lit(ORDER_OFFSET) + F.col("o_orderkey")).cast("long").alias("dst")
    )
    return Graph(keyed_nodes(ids), edges, directed=False)


def coarse_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """F1 with all coordinates cut to whole multiples of 30 degrees, so many nodes coincide and
    many edges weigh zero."""
    g = part_graph(spark, sf_dir)
    coarse = lambda c: (F.floor(F.col(c) / 30) * 30).cast("double").alias(c)
    return g.with_nodes(g.nodes.select("id", coarse("lat"), coarse("lon")))


def priced_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """F8: F1 whose edges carry a weight that is no distance: the lowest quantity of the line items
    that link the two parts."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    a, b = li.alias("a"), li.alias("b")
    same = (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1)
    edges = (
        a.join(b, same)
        .groupBy(F.col("a.l_partkey").alias("src"), F.col("b.l_partkey").alias("dst"))
        .agg(F.min(F.col("a.l_quantity").cast("double")).alias("weight"))
    )
    return Graph(part_nodes(spark, sf_dir), edges, directed=True)


def hierarchy_tree(spark: SparkSession, sf_dir: str) -> Graph:
    """root → regions → nations → customers and suppliers (parent → child edges)."""
    region = table(spark, sf_dir, "region").select("r_regionkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    edges = (
        region.select(F.lit(0).cast("long").alias("src"), (F.col("r_regionkey") + F4_REGION_OFFSET).cast("long").alias("dst"))
        .unionByName(
            nation.select(
                (F.col("n_regionkey") + F4_REGION_OFFSET).cast("long").alias("src"),
                (F.col("n_nationkey") + F4_NATION_OFFSET).cast("long").alias("dst"),
            )
        )
        .unionByName(
            cust.select(
                (F.col("c_nationkey") + F4_NATION_OFFSET).cast("long").alias("src"),
                (F.col("c_custkey") + F4_CUSTOMER_OFFSET).cast("long").alias("dst"),
            )
        )
        .unionByName(
            supp.select(
                (F.col("s_nationkey") + F4_NATION_OFFSET).cast("long").alias("src"),
                (F.col("s_suppkey") + F4_SUPPLIER_OFFSET).cast("long").alias("dst"),
            )
        )
    )
    ids = edges.select(F.col("dst").alias("id")).unionByName(
        spark.range(1).select(F.col("id").cast("long").alias("id"))
    )
    return Graph(keyed_nodes(ids), edges, directed=True)


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 adjacency text: one line per part, destinations + 1 ascending, some dirty tails."""
    g = part_graph(spark, sf_dir)
    lists = g.edges.groupBy("src").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.col("dst") + 1)), lambda x: x.cast("string")),
            ",",
        ).alias("_adj")
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("line_no"))
    text = F.coalesce(F.col("_adj"), F.lit(""))
    return parts.join(lists, parts.line_no == lists.src, "left").select(
        "line_no",
        F.when(F.col("line_no") % 50 == 0, F.concat(text, F.lit(F5_DIRTY_SUFFIX)))
        .otherwise(text)
        .alias("value"),
    )


def location_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 location text: ``%.2f,%.2f`` per part, five kinds of malformed line and one padded by tabs."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("line_no"))
    good = F.format_string("%.2f,%.2f", key_lat("line_no"), key_lon("line_no"))
    r = F.col("line_no") % 97
    value = good
    for rem in sorted(F5_ODD_LINES, reverse=True):
        value = F.when(r == rem, F.lit(F5_ODD_LINES[rem])).otherwise(value)
    return parts.select("line_no", value.alias("value"))
