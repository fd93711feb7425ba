"""Distributed ordering helpers that never funnel a large group into one task.

``global_rank`` numbers all rows of a frame in a total order: range-partition on the order key,
sort inside partitions, take the position from ``monotonically_increasing_id`` (documented
layout: partition id in the upper 31 bits, record index in the lower 33), and add a per-partition
offset computed from a table with one row per partition.

``grouped_exclusive_sum`` computes, for every row, the sum of a value over the rows that precede
it inside its group. A hot group (say a hub parent with a third of all rows) is split across
range partitions instead of being processed by one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoweave.plans.iterate import checkpoint

_LOW33 = (1 << 33) - 1


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _partition_offsets(counts: DataFrame, value: str, out: str) -> DataFrame:
    """Exclusive running sum over a table with one row per partition (bounded by #partitions)."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_pid", F.coalesce(F.sum(value).over(w), F.lit(0)).alias(out))


def global_rank_counted(
    df: DataFrame, order_cols, rank_col: str = "rank", start: int = 1, num_partitions: int | None = None
) -> tuple[DataFrame, int]:
    """``global_rank`` plus the number of rows (read from the per-partition count table)."""
    keys = _cols(order_cols)
    # without a fixed count AQE may merge adjacent ranges of small data (order is preserved)
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    # materialised once: partition ids and positions are stored as data, so the offsets and
    # the rows can never disagree (a recomputed range partitioning may pick other bounds)
    ranked = checkpoint(
        ranged.sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranked = ranked.withColumn("_pid", F.shiftright(F.col("_mid"), 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33))
    )
    # one row per partition: a bounded collect; offsets come back as a small local relation
    counts = sorted(
        (r["_pid"], r["_n"]) for r in ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()
    )
    rows, acc = [], 0
    for pid, cnt in counts:
        rows.append((int(pid), acc))
        acc += int(cnt)
    spark = df.sparkSession
    offsets = spark.createDataFrame(rows or [(0, 0)], "_pid long, _off long")
    out = ranked.join(F.broadcast(offsets), "_pid").withColumn(
        rank_col, F.col("_off") + F.col("_pos") + F.lit(start)
    )
    return out.drop("_mid", "_pid", "_pos", "_off"), acc


def global_rank(
    df: DataFrame, order_cols, rank_col: str = "rank", start: int = 1, num_partitions: int | None = None
) -> DataFrame:
    """Add ``rank_col`` = ``start`` + position of the row in ``order_cols`` order.

    ``order_cols`` must be a total order (end with a unique column) for a deterministic result.
    """
    return global_rank_counted(df, order_cols, rank_col, start, num_partitions)[0]


def grouped_exclusive_sum(
    df: DataFrame,
    group_col: str,
    order_cols,
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``out_col`` = sum of ``value_col`` over earlier rows of the same group (0 for the first).

    Skew-safe: rows are range partitioned on (group, order), so a huge group spans several
    partitions; the group's starting offset is found with a partial aggregate (min), not a window.
    """
    keys = [F.col(group_col)] + _cols(order_cols)
    base = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = (
        base.sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
    )
    w_local = Window.partitionBy("_pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # materialised once so that every consumer sees the same partition assignment
    local = checkpoint(ranged.withColumn("_local", F.coalesce(F.sum(value_col).over(w_local), F.lit(0))))
    totals = local.groupBy("_pid").agg(F.sum(value_col).alias("_tot"))
    offsets = _partition_offsets(totals, "_tot", "_off")
    glob = local.join(F.broadcast(offsets), "_pid").withColumn(
        "_g", F.col("_off") + F.col("_local")
    )
    # the group's first row carries its starting offset; a partial aggregate, safe for hot groups
    starts = glob.groupBy(group_col).agg(F.min_by("_g", F.struct(*_cols(order_cols))).alias("_g0"))
    return (
        glob.join(starts, group_col)
        .withColumn(out_col, F.col("_g") - F.col("_g0"))
        .drop("_pid", "_local", "_off", "_g", "_g0")
    )
