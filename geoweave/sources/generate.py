"""Synthetic inputs (S10, S11) in the reference's text formats, generated in parallel.

Values come from hashes of ``(seed, row, position)``, so the output does not depend on the
number of partitions; no shuffle is involved (arrays are built inline).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions.keys import md5_int

_U60 = float(2**60)


def _unit(seed, *cols):
    return md5_int(seed, *cols).cast("double") / F.lit(_U60)


def generate_location_lines(spark: SparkSession, n: int, seed: int = 0, num_partitions: int | None = None) -> DataFrame:
    """``(line_no, value)`` with ``value = 'lat,lon'``, lat ∈ [−90, 90), lon ∈ [−180, 180)."""
    r = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(n)
    lat = _unit(seed, "id", F.lit("lat")) * 180 - 90
    lon = _unit(seed, "id", F.lit("lon")) * 360 - 180
    return r.select(F.col("id").alias("line_no"), F.concat_ws(",", lat.cast("string"), lon.cast("string")).alias("value"))


def generate_visit_lines(
    spark: SparkSession,
    n: int,
    seed: int = 0,
    max_visits: int = 100,
    max_destination: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(line_no, value)`` with ``value = 'user_id,d1,d2,…'`` (``'user_id,'`` when empty).

    Destinations are 1-based in ``1..max_destination``; the default overshoots ``n`` by 0.07 %
    as the reference generator does, so the loader's range filter is exercised.
    """
    top = max_destination or (n + max(1, (n * 7) // 10000))
    r = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(n)
    k = (md5_int(seed, "id", F.lit("k")) % (max_visits + 1)).cast("int")
    dests = F.transform(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
        lambda j: ((md5_int(seed, F.col("id"), j) % top) + 1).cast("string"),
    )
    dests = F.when(k > 0, dests).otherwise(F.array().cast("array<string>"))
    value = F.concat(F.col("id").cast("string"), F.lit(","), F.array_join(dests, ","))
    return r.select(F.col("id").alias("line_no"), value.alias("value"))
