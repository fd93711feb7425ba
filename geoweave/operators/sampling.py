"""Deterministic sampling (L4–L8, L10): seed-stable, partition-independent, exact size.

The sort key of a row is ``md5('seed:key…')``. ``sample_rows`` returns exactly the ``n`` rows
with the smallest keys without a global sort: a histogram over the first hex digits of the key
(at most 16^4 buckets, independent of the data size) locates the bucket holding the n-th key;
rows in lower buckets are taken as they are and only the boundary bucket is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave.functions.keys import md5_key
from geoweave.plans.iterate import checkpoint

PREFIX_DIGITS = 4
SALTS = 256  # parts of a group that its hash threshold cannot thin


def _key_exprs(key_cols):
    return [F.col(c) if isinstance(c, str) else c for c in key_cols]


def sample_rows(df: DataFrame, n: int, seed: int = 42, key_cols=("id",)) -> DataFrame:
    """The ``n`` rows with the smallest ``md5(seed:key)`` (ties on the key columns).

    Rows in hash buckets entirely below the n-th key are taken as they are. The boundary bucket is
    refined with the next hex digits until it is taken whole or its keys agree in all 32 digits; only
    such equal keys are ever ordered.
    """
    keys = _key_exprs(key_cols)
    cur = df.withColumn("_h", md5_key(seed, *keys))
    cols = df.columns
    taken: list[DataFrame] = []
    need, offset = n, 0
    while True:
        level = cur.withColumn("_b", F.substring("_h", offset + 1, PREFIX_DIGITS))
        # bounded collect: one row per bucket (≤ 16^4), independent of the data size
        hist = sorted((r["_b"], r["c"]) for r in level.groupBy("_b").agg(F.count(F.lit(1)).alias("c")).collect())
        before, boundary, size = 0, None, 0
        for bucket, count in hist:
            if before + count >= need:
                boundary, size = bucket, count
                break
            before += count
        if boundary is None:  # fewer rows than needed: everything qualifies
            taken.append(level.select(*cols))
            break
        need -= before
        if size == need:
            taken.append(level.filter(F.col("_b") <= F.lit(boundary)).select(*cols))
            break
        taken.append(level.filter(F.col("_b") < F.lit(boundary)).select(*cols))
        cur = level.filter(F.col("_b") == F.lit(boundary)).drop("_b")
        offset += PREFIX_DIGITS
        if offset >= 32:
            taken.append(cur.orderBy(*keys).limit(need).select(*cols))
            break
    out = taken[0]
    for p in taken[1:]:
        out = out.unionByName(p)
    return out


def sample_nodes(nodes: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return sample_rows(nodes, n, seed, ("id",))


def sample_edges(edges: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return sample_rows(edges, n, seed, ("src", "dst"))


def sample_per_group(df: DataFrame, group_col: str, cap: int, seed: int = 42, key_cols=("id",)) -> DataFrame:
    """At most ``cap`` rows per group, the smallest ``md5(seed:key)`` first.

    The group's size (a partial aggregate) gives a hash threshold below which about ``4 × cap + 1000`` of
    its rows lie if their keys differ. So a giant group is thinned map-side and no task ranks more
    than the rows below the threshold. A group with too few rows below it, such as one of equal keys, is
    ranked in ``SALTS`` parts first and then over the best of each part.
    """
    keys = _key_exprs(key_cols)
    sizes = df.groupBy(F.col(group_col).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    own = F.col(group_col).eqNullSafe(F.col("_g"))
    keyed = df.withColumn("_h", md5_key(seed, *keys))
    part = F.conv(F.substring("_h", 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    near = keyed.join(sizes, own).filter(part * F.col("_n") < F.lit(4.0 * cap + 1000.0))
    order = ["_h", *keys, *(c for c in df.columns if c != group_col)]
    first = near.withColumn("_r", F.row_number().over(Window.partitionBy(group_col).orderBy(*order))).filter(F.col("_r") <= cap)
    enough = near.groupBy(group_col).agg(F.count(F.lit(1)).alias("_k"))
    lacking = F.coalesce("_k", F.lit(0)) < F.least(F.col("_n"), F.lit(cap))
    few = checkpoint(sizes.join(enough, own, "left").filter(lacking).select("_g"))
    if few.isEmpty():
        return first.select(*df.columns)
    first = first.drop("_g").join(few, own, "left_anti")
    rest = keyed.join(few, own, "left_semi")
    rest = rest.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
    for by in ([group_col, "_salt"], [group_col]):
        rest = rest.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= cap)
    return first.select(*df.columns).unionByName(rest.select(*df.columns))


def stride_downsample(path: DataFrame, max_points: int, pos_col: str = "pos") -> DataFrame:
    """L4: keep every ``step``-th position (``step = len // max_points``) and always the last.

    ``path`` is long form (one row per position, 0-based ``pos``); the length is an aggregate.
    """
    stats = path.agg(F.max(pos_col).alias("_last"), F.count(F.lit(1)).alias("_len"))
    row = stats.first()
    length, last = int(row["_len"] or 0), row["_last"]
    if length <= max_points:
        return path
    step = length // max_points
    return path.filter((F.col(pos_col) % step == 0) | (F.col(pos_col) == F.lit(last)))
