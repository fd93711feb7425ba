"""Iteration kernel for graph algorithms.

Each round of an iterative operator is an ordinary DataFrame plan. At the end of a round the
new state is written as a Parquet table into the session's checkpoint folder
(``spark.checkpoint.dir``) and read back, which cuts the lineage (plans stay O(1) in size) and lets a
job lose executors without recomputing earlier rounds. The driver only ever receives counters per
round (size of the delta, a hash of the table), never rows.
"""

from __future__ import annotations

import gc
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.session import ensure_checkpoint_dir


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the checkpoint folder and read it back.

    The returned frame is a plain file scan: the lineage and the logical plan are cut completely
    (``Dataset.checkpoint`` keeps traces of the origin plan, which grow with every self-join
    round), the data sits on the shared, reliable folder named by ``spark.checkpoint.dir``, and
    AQE sees the real file sizes when it chooses join strategies for the next round.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/rounds/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # a given schema saves the job that infers it
    out._round_path = path  # the frame itself knows its table, so ``release`` cannot mistake it
    return out


def release(*frames: DataFrame | None) -> None:
    """Delete the round tables behind superseded checkpoint frames.

    Call only when nothing lazy still reads the frame (its successor has been written). Frames that
    were not made by ``checkpoint`` are left alone.
    """
    for df in frames:
        path = getattr(df, "_round_path", None) if df is not None else None
        if path is None:
            continue
        df._round_path = None
        spark = df.sparkSession
        table = getattr(df, "_round_table", None)
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def drop_dead_shuffles(like: DataFrame) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more, beside a bucketed (large) table.

    Spark does so when the driver collects its garbage, which a driver with a heap to spare puts off for many rounds,
    while their shuffles pile up on the executors' disks."""
    if getattr(like, "_round_table", None) is not None:
        gc.collect()
        like.sparkSession.sparkContext._jvm.System.gc()


#: a keyed table is bucketed once every bucket would hold this many rows; below, plain files are as good
ROWS_PER_BUCKET = 100_000
#: a keyed table gets more buckets than the session has cores only to keep about this many rows in each
ROWS_IN_FULL_BUCKET = 1_000_000


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets of a keyed table of so many rows: a multiple of the cores if that is at most half the partitions of a
    shuffle, else as many as those.

    A round starts a task for every bucket, and a level of a search writes a file for each, however few rows it has.
    """
    cores, most = spark.sparkContext.defaultParallelism, shuffle_partitions(spark)
    buckets = cores * max(1, -(-rows // (cores * ROWS_IN_FULL_BUCKET)))
    return buckets if 2 * buckets <= most else most


def _save_buckets(df: DataFrame, keys: tuple[str, ...], buckets: int, name: str, path: str) -> None:
    writer = df.repartition(buckets, *keys).write.mode("append").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def keyed(df: DataFrame, *keys: str, rows_per_bucket: int | None = None) -> DataFrame:
    """``checkpoint`` for the fixed side of a loop's joins on ``keys``: a large table is written bucketed and sorted
    by the keys in ``bucket_count`` buckets, so that no round shuffles it again.

    The files lie in the checkpoint folder like those of any round; only the bucketing is noted in the session's
    catalog. The rows are the same either way. ``release`` drops both.
    """
    spark = df.sparkSession
    plain = checkpoint(df)
    rows = plain.count()
    buckets = bucket_count(spark, rows)
    if rows < buckets * (ROWS_PER_BUCKET if rows_per_bucket is None else rows_per_bucket):
        return plain
    name, path = _table_place(spark)
    _save_buckets(plain, keys, buckets, name, path)
    release(plain)
    out = spark.table(name)
    out._round_path, out._round_table, out._round_buckets = path, name, buckets
    return out


def _table_place(spark: SparkSession) -> tuple[str, str]:
    key = uuid.uuid4().hex
    return f"geoweave_round_{key}", f"{ensure_checkpoint_dir(spark).rstrip('/')}/rounds/{key}"


class Found:
    """What a search has found so far, one table of ``keys`` and other columns that grows by a level a round.

    With ``buckets`` (beside a bucketed edge table) every level is appended to one table bucketed by the keys: the
    anti-join of new candidates shuffles only the candidates, and the plan has one scan however many levels there
    are. Without, the levels are plain round tables.
    """

    def __init__(self, keys: list[str], like: DataFrame):
        self.keys, self.levels, self.spark = keys, [], like.sparkSession
        self.buckets = like._round_buckets if getattr(like, "_round_table", None) is not None else None
        if self.buckets is not None:
            self.name, self.path = _table_place(self.spark)

    def add(self, level: DataFrame, number: int) -> DataFrame:
        """Write the rows of one level and return them as read back; ``level`` has a column of that name."""
        if self.buckets is None:
            self.levels.append(checkpoint(level))
            return self.levels[-1]
        _save_buckets(level, tuple(self.keys), self.buckets, self.name, self.path)
        return self.all().filter(F.col("level") == number)

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have the keys, laid out as the buckets are: a join with ``all`` shuffles them, never the
        table, however many partitions the session gives a shuffle. (Spark pushes an anti-join below this.)"""
        return rows if self.buckets is None else rows.repartition(self.buckets, *self.keys)

    def all(self) -> DataFrame:
        if self.buckets is not None:
            return self.spark.table(self.name)
        return reduce(lambda a, b: a.unionByName(b), self.levels)

    def drop_last(self) -> None:
        """Forget the last level where it is empty (its rows change nothing in a bucketed table)."""
        if self.buckets is None:
            release(self.levels.pop())

    def drop_all(self) -> None:
        """Delete all levels in either layout once nothing lazy reads them any more."""
        release(*self.levels)
        self.release()

    def release(self) -> None:
        """Drop a bucketed table that nothing lazy reads any more."""
        if self.buckets is not None:
            done = self.all()
            done._round_path, done._round_table = self.path, self.name
            release(done)


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free hash of all rows: equal for equal tables without repeated rows."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x")).first()
    return int(row["n"]), int(row["x"] or 0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


@dataclass
class RoundLog:
    """Per-round counters of an iterative operator (A19: changes / visited per iteration)."""

    name: str
    rounds: list[dict] = field(default_factory=list)
    _t0: float = field(default_factory=time.perf_counter)

    def record(self, **counters) -> None:
        now = time.perf_counter()
        counters.setdefault("round", len(self.rounds) + 1)
        counters["seconds"] = round(now - self._t0, 4)
        self._t0 = now
        self.rounds.append(counters)

    def to_df(self, spark: SparkSession) -> DataFrame:
        if not self.rounds:
            return spark.createDataFrame([], "round int, seconds double")
        keys: list[str] = []
        for r in self.rounds:
            for k in r:
                if k not in keys:
                    keys.append(k)
        return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in self.rounds], keys)
