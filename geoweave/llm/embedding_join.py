"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine ``>= c`` lie within squared distance ``2 - 2c``. After a fixed random
rotation the coordinates are split into ``blocks`` subspaces; if two vectors are that close, then in
at least one subspace their squared distance is at most that subspace's share of the budget (its
share of the dimensions). Each subspace is joined by range: a vector lives in the grid cell of its
first ``grid`` coordinates and visits every other cell its ball reaches. Inside a cell the subspace
distances are filtered first and the survivors are verified by cosine in double precision on the
original vectors.

Every pair is counted exactly once: in its first subspace within budget, in the home cell of the
smaller id. So a task returns counts and the parts its links join, never the links, and a group of
mutually near vectors costs no more rows than it has members. A crowded cell is dealt as pairs of
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import runs
from geoweave.llm.minhash import parts
from geoweave.operators.components import edge_components
from geoweave.plans.iterate import checkpoint

BLOCK_ROWS = 2048
#: added to a squared distance budget: rounding of the rotated single coordinates
SLACK = 1e-9


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _usable(column: pa.Array, kind: type) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``{dim: (rows, vectors)}`` of the rows whose vector is finite, not zero and without nulls."""
    lists = column.to_pylist()
    by_dim: dict[int, list[int]] = {}
    for i, v in enumerate(lists):
        if v and all(x is not None for x in v):
            by_dim.setdefault(len(v), []).append(i)
    found = {}
    for dim, idx in by_dim.items():
        x = np.array([lists[i] for i in idx], kind)
        ok = np.isfinite(x).all(1) & (x != 0).any(1)
        found[dim] = np.array(idx)[ok], x[ok]
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, by the largest component first."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _cells(vectors: DataFrame, cosine: float, blocks: int, grid: int, width: float) -> DataFrame:
    """``(id, label, dim, space, cell, home, vector)``: every vector in the cells its ball reaches."""
    budget = 2 - 2 * cosine
    kind = _kind(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for dim, (rows, vector) in _usable(batch.column("vector"), kind).items():
                if len(rows) == 0:
                    continue
                turned = _unit(vector) @ rotation(dim)
                packed = pa.array([v.tobytes() for v in vector], pa.binary())
                for space, axes in enumerate(np.array_split(np.arange(dim), min(blocks, dim))):
                    reach = np.sqrt(budget * len(axes) / dim) + SLACK
                    x = turned[:, axes[:grid]]
                    low, high = np.floor((x - reach) / width).astype(np.int64), np.floor((x + reach) / width).astype(np.int64)
                    at_home = np.floor(x / width).astype(np.int64)
                    take, cell, home = np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
                    for k in range(x.shape[1]):
                        span = high[take, k] - low[take, k] + 1
                        again = np.repeat(np.arange(len(take)), span)
                        step = np.arange(len(again)) - np.repeat(np.cumsum(span) - span, span)
                        take, cell, home = take[again], cell[again], home[again]
                        place = low[take, k] + step
                        home &= place == at_home[take, k]
                        cell = cell * 4096 + (place + 2048)
                    n = len(take)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[rows][take], pa.int64()), pa.array(labels[rows][take], pa.int64()),
                            pa.array(np.full(n, dim, np.int64)), pa.array(np.full(n, space, np.int64)),
                            pa.array(cell), pa.array(home), packed.take(pa.array(take)),
                        ],
                        ["id", "label", "dim", "space", "cell", "home", "vector"],
                    )

    return vectors.mapInArrow(run, "id long, label long, dim long, space long, cell long, home boolean, vector binary")


def _kind(vectors: DataFrame) -> type:
    """Precision in which vectors travel: that of the column."""
    return np.float32 if vectors.schema["vector"].dataType.elementType.typeName() == "float" else np.float64


def _verify(celled: DataFrame, cosine: float, blocks: int, kind: type) -> DataFrame:
    """``(src, dst, n)``: a row ``(id, id, links found)`` per vector and run, and the parts' star links with 0."""
    keys = ["label", "dim", "space", "cell", "i", "j"]
    budget = 2 - 2 * cosine

    def links(ids, home, own, unit, dim, space) -> np.ndarray:
        """Boolean matrix of the links this run counts; ``[p, q]`` with ``p`` the smaller id at home."""
        spaces = np.array_split(np.arange(dim), min(blocks, dim))
        turned = unit @ rotation(dim)
        near = np.zeros((len(ids), len(ids)), bool)
        first = np.flatnonzero(home)
        axes = spaces[space]
        x = turned[:, axes]
        square = (x * x).sum(1)
        limit = budget * len(axes) / dim + SLACK
        for a in range(0, len(first), 256):
            p = first[a : a + 256]
            d = square[p][:, None] + square[None] - 2 * x[p] @ x.T
            pp, qq = np.nonzero((d <= limit + SLACK) & (ids[p][:, None] < ids[None]) & own(p))
            pp = p[pp]
            for c in range(0, len(pp), 1 << 15):
                u, v = pp[c : c + (1 << 15)], qq[c : c + (1 << 15)]
                gap = (turned[u] - turned[v]) ** 2
                ok = gap[:, axes].sum(1) <= limit
                for earlier in spaces[:space]:  # counted there
                    ok &= gap[:, earlier].sum(1) > budget * len(earlier) / dim + SLACK
                u, v = u[ok], v[ok]
                ok = np.einsum("ij,ij->i", unit[u], unit[v]) >= cosine
                near[u[ok], v[ok]] = True
        return near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, keys):
            col = {k: table.column(k).to_numpy() for k in ("id", "home", "dim", "space", "_b", "i", "j")}
            raw = table.column("vector").to_pylist()
            src, dst, cnt = [], [], []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if e - s < 2 or not col["home"][s:e].any():
                    continue
                block = col["_b"][s:e]
                cross = col["i"][s] != col["j"][s]
                own = (lambda p: block[p][:, None] != block[None]) if cross else (lambda p: True)  # noqa: B023
                dim = int(col["dim"][s])
                unit = _unit(np.frombuffer(b"".join(raw[s:e]), kind).reshape(-1, dim))
                ids = col["id"][s:e]
                near = links(ids, col["home"][s:e], own, unit, dim, int(col["space"][s]))
                near |= near.T
                n = near.sum(1)
                have = np.flatnonzero(n)
                if len(have) == 0:
                    continue
                label = have[parts(near[np.ix_(have, have)])]
                star = label != have
                src += [ids[have], ids[label[star]]]
                dst += [ids[have], ids[have[star]]]
                cnt += [n[have], np.zeros(int(star.sum()), np.int64)]
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (src, dst, cnt)], ["src", "dst", "n"])

    sizes = celled.groupBy(*keys[:4]).agg(F.count(F.lit(1)).alias("_n"), F.count_if("home").alias("_h"))
    sizes = sizes.filter("_n > 1 and _h > 0").select(*keys[:4], F.ceil(F.col("_n") / F.lit(BLOCK_ROWS)).cast("long").alias("_blocks"))
    dealt = (
        celled.join(sizes, keys[:4])
        .withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_blocks")))
        .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumn("i", F.least("_b", "_o"))
        .withColumn("j", F.greatest("_b", "_o"))
        .drop("_blocks", "_o")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )
    return dealt.mapInArrow(run, "src long, dst long, n long")


def near_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    cosine: float = 0.98,
    blocks: int = 4,
    grid: int = 3,
    width: float = 0.3,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` per row of ``table``.

    Rows are compared when their labels are equal and not null (all rows when ``label_col`` is None) and
    their vectors have the same length. Vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing, nor do rows with a null id (their component is null and
    they are kept). Rows that share an id are one vector: equal repeated rows count once and every
    row is returned. An empty table gives an empty result; other columns are ignored.
    """
    label = F.col(label_col).cast("long") if label_col else F.lit(0).cast("long")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), label.alias("label"))
    usable = rows.filter("id is not null and label is not null and vector is not null").dropDuplicates(["id", "label", "vector"])
    celled = checkpoint(_cells(usable, cosine, blocks, grid, width))
    found = checkpoint(_verify(celled, cosine, blocks, _kind(usable)))
    counts = found.groupBy(F.col("src").alias("id")).agg(F.sum("n").alias("n_links")).filter("n_links > 0")
    result = counts.join(edge_components(found.filter("src <> dst").select("src", "dst")), "id", "left")
    out = table.select(id_col).withColumn("id", F.col(id_col).cast("long")).join(result, "id", "left")
    component = F.coalesce(F.col("component"), F.col("id"))
    return out.select(
        id_col,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
