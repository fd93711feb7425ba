"""Text sources: globally numbered lines (S4), location and adjacency parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoweave.functions.text import is_digits, tokens, try_double, try_long
from geoweave.operators.ranking import global_rank
from geoweave.plans.iterate import checkpoint

MAX_BLOCKS = 1_000_000  # file blocks whose offsets may be broadcast


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(line_no BIGINT, value STRING)`` with 0-based line numbers in file order.

    Files are ordered by path and lines by their position in the file. One scan writes every line
    together with its file, block and place, so nothing depends on a second scan splitting the files
    alike (splits follow settings and the number of executors). The number of a line is the offset of its
    file block (a cumulative count over a table with one row per block) plus its place in the block. Up to
    ``MAX_BLOCKS`` offsets (counted) are broadcast, so the lines themselves are not shuffled; more are joined.
    """
    lines = checkpoint(
        spark.read.text(path).select(
            F.col("value"),
            F.col("_metadata.file_path").alias("_f"),
            F.col("_metadata.file_block_start").alias("_b"),
            F.monotonically_increasing_id().alias("_m"),
        )
    )
    blocks = lines.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    w = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_f", "_b", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    offsets = checkpoint(offsets)
    few = offsets.count() <= MAX_BLOCKS
    return lines.join(F.broadcast(offsets) if few else offsets, ["_f", "_b"]).select(
        (F.col("_off") + F.col("_m") - F.col("_m0")).alias("line_no"), F.col("value")
    )


def _location_fields(lines: DataFrame) -> DataFrame:
    parts = tokens("value")
    return lines.select(
        "line_no",
        "value",
        F.size(parts).alias("_k"),
        try_double(F.get(parts, F.lit(0))).alias("_lat"),
        try_double(F.get(parts, F.lit(1))).alias("_lon"),
    )


def _valid_location():
    return (F.col("_k") == 2) & F.col("_lat").isNotNull() & F.col("_lon").isNotNull()


def parse_locations(lines: DataFrame, max_nodes: int | None = None) -> DataFrame:
    """``lat,lon`` lines → ``nodes(id, lat, lon)``.

    Only the first ``max_nodes`` raw lines are read (S3). A line is valid iff it has exactly two
    fields and both parse as numbers; an invalid line is rejected as a whole (never half
    appended). Node ids are the 0-based rank of the line among *valid* lines, so a malformed
    line shifts later ids, as in the reference format (Q5).
    """
    if max_nodes is not None:
        lines = lines.filter(F.col("line_no") < max_nodes)
    valid = _location_fields(lines).filter(_valid_location())
    ranked = global_rank(valid.select("line_no", "_lat", "_lon"), ["line_no"], rank_col="id", start=0)
    return ranked.select(
        F.col("id").cast("long").alias("id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon")
    )


def location_rejects(lines: DataFrame, max_nodes: int | None = None) -> DataFrame:
    """Malformed location lines as ``rejects(line_no, raw)``."""
    if max_nodes is not None:
        lines = lines.filter(F.col("line_no") < max_nodes)
    bad = _location_fields(lines).filter(~F.coalesce(_valid_location(), F.lit(False)))
    return bad.select("line_no", F.col("value").alias("raw"))


def parse_adjacency(lines: DataFrame, n: int, skip_first: bool = False) -> DataFrame:
    """Adjacency lines → ``edges(src, dst)``.

    Line ``k`` (0-based) lists the 1-based destinations of node ``k``. A token is kept iff it is
    all ASCII digits after trimming and its value is in ``1..n``; destinations are de-duplicated
    per line; self-loops are kept. Lines at or beyond ``n`` are ignored (S3). With
    ``skip_first`` the first token (a user id in generated files) is not a destination.
    """
    toks = tokens("value")
    if skip_first:
        toks = F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0)))
    vals = F.transform(F.filter(toks, lambda t: is_digits(t)), lambda t: try_long(t))
    dsts = F.array_distinct(F.filter(vals, lambda v: v.isNotNull() & (v >= 1) & (v <= n)))
    return (
        lines.filter((F.col("line_no") >= 0) & (F.col("line_no") < n))
        .select(F.col("line_no").alias("src"), F.explode(dsts).alias("_d"))
        .select(F.col("src").cast("long").alias("src"), (F.col("_d") - 1).cast("long").alias("dst"))
    )


def short_file_report(actual: int, expected: int) -> dict:
    """The short-file warning as a record (actual below expected)."""
    return {"expected": expected, "actual": actual, "short": actual < expected}


def location_report(lines: DataFrame, expected: int) -> DataFrame:
    """One row ``(expected, lines, valid, rejected, short)`` of a location file that should hold
    ``expected`` lines; ``short`` when fewer of them give a node."""
    fields = _location_fields(lines.filter(F.col("line_no") < expected))
    ok = F.coalesce(_valid_location(), F.lit(False))
    return fields.agg(F.count(F.lit(1)).alias("lines"), F.count_if(ok).alias("valid")).select(
        F.lit(expected).cast("long").alias("expected"),
        "lines",
        "valid",
        (F.col("lines") - F.col("valid")).alias("rejected"),
        (F.col("valid") < expected).alias("short"),
    )
