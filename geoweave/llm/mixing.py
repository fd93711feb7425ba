"""Mixing sources to target weights by temperature, in DataFrame functions only.

Every source's share of the tokens is raised to an exponent between 0 (all sources alike) and 1 (as
they come) and normalised. The exponent is bisected to meet a target entropy, given as a share of
the largest possible one; if some source would then repeat more often than ``max_repeats``, it is
bisected again to the smallest exponent that keeps the limit. Each round evaluates ``WAYS`` exponents
in one job over the table of sources, so three rounds reach 15 bits and six reach 30.

The normalised weights are realised under a token budget as block permutations. Within a source the
documents stand in a hashed order; epoch ``e`` walks that order from an offset of its own, whole
epochs take every document and the last takes documents while its share of the budget lasts. A
document's progress through all epochs of its source gives its block, so every block holds the
sources in target proportion; inside a block rows are ordered by a hash.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.operators.ranking import grouped_exclusive_sum
from geoweave.plans.iterate import checkpoint

WAYS = 32
ROUNDS = 6
NO_SOURCE = "<none>"


def token_column(text_col: str):
    """White-space words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0)).cast("long")


def _measures(shares: DataFrame, exponents: list[float], budget: int) -> list[tuple[float, float, float]]:
    """``(exponent, entropy, most repeats)`` per exponent: one row each comes back."""
    grid = shares.select("tokens", "log_share", F.explode(F.array(*map(F.lit, exponents))).alias("x"))
    w = F.exp(F.col("x") * F.col("log_share"))
    rows = grid.groupBy("x").agg(
        F.sum(w).alias("z"), F.sum(w * F.col("x") * F.col("log_share")).alias("s"), F.max(w / F.col("tokens")).alias("r")
    )
    return sorted(
        (r["x"], float(log(r["z"]) - r["s"] / r["z"]), float(r["r"] * budget / r["z"])) for r in rows.collect()
    )


def _bisect(shares: DataFrame, budget: int, keeps_left) -> float:
    """Largest exponent of the falling side: ``keeps_left(entropy, repeats)`` holds left of the answer."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / WAYS for k in range(WAYS + 1)]
        holds = [keeps_left(h, r) for _, h, r in _measures(shares, grid, budget)]
        if not holds[0]:
            return low
        if all(holds):
            return high
        k = holds.index(False)
        low, high = grid[k - 1], grid[k]
    return (low + high) / 2


def source_weights(
    stats: DataFrame, budget: int, entropy_share: float | None = 0.97, max_repeats: float | None = 4.0
) -> tuple[DataFrame, float]:
    """``(source, tokens, weight, repeats)`` of ``stats (source, tokens)`` and the exponent used.

    Sources without tokens get weight 0. With both targets None the exponent is 1.
    """
    held = checkpoint(stats.filter("tokens > 0"))
    total = held.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return stats.select("source", "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("repeats")), 1.0
    shares = held.withColumn("log_share", F.log(F.col("tokens") / F.lit(float(total["t"]))))
    exponent = 1.0
    if entropy_share is not None and total["n"] > 1:
        target = entropy_share * log(total["n"])
        exponent = _bisect(shares, budget, lambda h, r: h >= target)
    if max_repeats is not None:
        # never below what the whole budget asks of the whole corpus
        limit = max(max_repeats, budget / total["t"] * (1 + 1e-9))
        if _measures(shares, [exponent], budget)[0][2] > limit:
            low = _bisect(shares, budget, lambda h, r: r > limit)
            exponent = max(exponent, min(1.0, low + 2.0 ** -(5 * ROUNDS)))
    w = F.exp(F.lit(exponent) * F.col("log_share"))
    z = shares.agg(F.sum(w).alias("z")).first()["z"]
    weighted = shares.select("source", "tokens", (w / F.lit(z)).alias("weight"))
    none = stats.filter("tokens <= 0 or tokens is null").select("source", "tokens", F.lit(0.0).alias("weight"))
    both = weighted.unionByName(none)
    repeats = F.when(F.col("tokens") > 0, F.col("weight") * F.lit(float(budget)) / F.col("tokens")).otherwise(F.lit(0.0))
    return both.withColumn("repeats", repeats), exponent


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget: int | None = None,
    entropy_share: float | None = 0.97,
    max_repeats: float | None = 4.0,
    n_blocks: int = 64,
    seed: int = 23,
) -> DataFrame:
    """``(id_col, source_col, n_tokens, weight, epoch, block, place)``: a row per use of a document.

    ``budget`` defaults to the tokens of the corpus. A null source is a source of its own; documents
    without tokens cost nothing and follow their source, a source without any tokens gives no rows. Repeated rows are
    separate documents; ties of the hashed order fall to the id. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = checkpoint(
        docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("source"),
            token_column(text_col).alias("n_tokens"),
        )
    )
    stats = checkpoint(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    if budget is None:
        budget = stats.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    weights, _ = source_weights(stats, budget, entropy_share, max_repeats)
    ordered = rows.withColumn("_h", F.xxhash64(F.lit(seed), "id", "n_tokens"))
    walked = grouped_exclusive_sum(ordered, "source", [F.col("_h"), F.col("id")], "n_tokens", "before")
    plan = checkpoint(weights.filter("weight > 0"))
    used = (
        walked.join(plan, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil("repeats"))))
        # each epoch starts at an offset of its own in the source's order
        .withColumn("_off", F.pmod(F.xxhash64(F.lit(seed), "source", "epoch"), F.col("tokens")))
        .withColumn("_at", F.pmod(F.col("before") + F.col("_off"), F.col("tokens")))
        .withColumn("_progress", (F.col("epoch") - 1) + F.col("_at") / F.col("tokens"))
        .filter(F.col("_progress") < F.col("repeats"))
    )
    block = F.least(F.floor(F.col("_progress") / F.col("repeats") * n_blocks), F.lit(n_blocks - 1)).cast("int")
    source = F.when(F.col("source") != NO_SOURCE, F.col("source")).cast(docs.schema[source_col].dataType)
    return used.select(
        F.col("id").alias(id_col),
        source.alias(source_col),
        "n_tokens",
        "weight",
        F.col("epoch").cast("int").alias("epoch"),
        block.alias("block"),
        F.xxhash64(F.lit(seed), "epoch", "id").alias("place"),
    )
