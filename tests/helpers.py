from pyspark.sql import functions as F

from geoweave.model import Graph


def graph(spark, edges, n=None, coords=None, weights=None, directed=True):
    """Micro-graph from python lists; node ids 0..n-1 with coordinates (default: spread on a line)."""
    if n is None:
        n = max([max(a, b) for a, b in edges] + [-1]) + 1
    coords = coords or {i: (float(i % 17) - 8.0, float(i) * 3.0 - 20.0) for i in range(n)}
    nodes = spark.createDataFrame([(i, coords[i][0], coords[i][1]) for i in range(n)], "id long, lat double, lon double")
    if weights is not None:
        e = spark.createDataFrame([(a, b, float(w)) for (a, b), w in zip(edges, weights)], "src long, dst long, weight double")
    else:
        e = spark.createDataFrame(edges, "src long, dst long") if edges else spark.createDataFrame([], "src long, dst long")
    return Graph(nodes, e, directed)


def as_dict(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def q(spark, qid, source, sink=None):
    if sink is None:
        return spark.createDataFrame([(qid, source)], "qid int, source long")
    return spark.createDataFrame([(qid, source, sink)], "qid int, source long, sink long")
