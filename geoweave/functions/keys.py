"""Deterministic, partition-independent hash keys (same hex digits as ``md5`` in SQL engines)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(seed, *cols) -> Column:
    """``md5('seed:c1:c2…')`` — a uniform, reproducible sort key for sampling."""
    parts = [F.lit(str(seed))] + [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def md5_int(seed, *cols) -> Column:
    """First 60 bits of ``md5_key`` as a non-negative BIGINT (no overflow under ANSI mode)."""
    return F.conv(F.substring(md5_key(seed, *cols), 1, 15), 16, 10).cast("long")


def md5_bit(seed, *cols) -> Column:
    """One pseudo-random bit (0/1) from the key, used for sweep damping."""
    return (md5_int(seed, *cols) % 2).cast("int")
