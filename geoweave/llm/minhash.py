"""MinHash near-duplicates by tensored banding, confirmed on full shingle sets.

A plain banding with ``t`` tables of ``2w`` hashes computes ``2wt`` minhashes. Here two collections of
``halves`` half-keys of ``width`` minhashes each are computed, and a table key combines one half-key
of either collection: ``halves × shifts`` tables out of ``2 × halves × width`` minhashes (56 tables of
8 hashes from 112 minhashes, where plain banding needs 448). At a similarity equal to the threshold
a half-key agrees with probability about 0.52 and a pair shares no table with probability below
0.001; it falls fast above the threshold.

Steps, each a Spark job over distinct shingle sets (copies collapse to the smallest id first):

1. sketch every text once: set size, 128-bit digest of the set, table keys, 64-byte signature;
2. tables with the same members are visited once; inside a table the signatures are compared and
   only the *parts* (trees) of the similarity graph are emitted, never all pairs;
3. connected components of these trees are the candidate groups; every link lies inside one;
4. sets of the candidate groups are compared exactly, block against block; the parts joined by
   true links are emitted and their components are the result.

A table or group larger than a block is dealt as pairs of blocks, so no task holds more than two
blocks however many members there are, and no pair is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import mix, runs, shingles, slices, text_bytes, words
from geoweave.operators.components import edge_components
from geoweave.plans.iterate import checkpoint

SIGNATURE = 64  # bytes
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 19


@dataclass(frozen=True)
class Banding:
    """Texts are linked when ``den * |A ∩ B| >= num * |A ∪ B|`` for their ``size``-word shingles."""

    size: int = 5
    num: int = 80
    den: int = 100
    halves: int = 14
    shifts: int = 4

    @property
    def threshold(self) -> float:
        return self.num / self.den

    @property
    def width(self) -> int:
        """Minhashes of a half-key, so that it agrees in about half the cases at the threshold."""
        return max(1, round(np.log(0.52) / np.log(min(self.threshold, 0.999))))


def _minhashes(h: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """``(texts, count)`` minima of ``count`` permutations of the 32 high bits; every text has shingles."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    seed = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    mask = (seed[:count] >> np.uint64(32)).astype(np.uint32)
    factor = (seed[count:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(starts), count), np.uint32)
    for k in range(count):
        out[:, k] = np.minimum.reduceat((x ^ mask[k]) * factor[k], starts)
    return out


def _keys(m: np.ndarray, b: Banding) -> np.ndarray:
    """Table keys: half-key ``i`` of the first collection with half-keys ``i … i + shifts - 1`` of the second."""
    halves = np.zeros((len(m), 2 * b.halves), np.uint64)
    for k in range(b.width):
        halves = mix(halves * np.uint64(3) + m[:, k :: b.width][:, : 2 * b.halves].astype(np.uint64) + np.uint64(1))
    left, right = halves[:, : b.halves], halves[:, b.halves :]
    cols = []
    for s in range(b.shifts):
        table = np.arange(b.halves, dtype=np.uint64) + np.uint64(s * b.halves)
        cols.append(mix(left * np.uint64(0x9E3779B97F4A7C15) + np.roll(right, -s, axis=1) + mix(table)))
    return np.concatenate(cols, axis=1).view(np.int64)


def _text_shingles(column, b: Banding, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, shingle hashes, rows)`` per slice of the column."""
    data, offsets = text_bytes(column)
    for a, z in slices(offsets, limit):
        part = offsets[a : z + 1] - offsets[a]
        w, row, _, _ = words(data[offsets[a] : offsets[z]], part)
        h, r = shingles(w, row, z - a, b.size)
        yield a, h, r


def sketches(docs: DataFrame, b: Banding) -> DataFrame:
    """``(id, n, digest, keys, signature)`` per row of ``docs (id, text)``; ``n = 0`` has no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n = np.zeros(rows, np.int64)
            digest: list[bytes | None] = [None] * rows
            keys: list[np.ndarray | None] = [None] * rows
            signature: list[bytes | None] = [None] * rows
            for first, h, r in _text_shingles(batch.column("text"), b):
                if len(h) == 0:
                    continue
                have, starts = np.unique(r, return_index=True)
                m = _minhashes(h, starts, 2 * b.halves * b.width)
                key = _keys(m, b)
                short = (mix(m[:, :SIGNATURE].astype(np.uint64)) & np.uint64(255)).astype(np.uint8)
                if short.shape[1] < SIGNATURE:
                    raise ValueError("fewer minhashes than signature bytes")
                ends = np.append(starts[1:], len(h))
                for k, (row, s, e) in enumerate(zip(have.tolist(), starts.tolist(), ends.tolist(), strict=True)):
                    distinct = np.unique(h[s:e])
                    i = first + row
                    n[i] = len(distinct)
                    digest[i] = hashlib.blake2b(distinct.tobytes(), digest_size=16).digest()
                    keys[i] = key[k]
                    signature[i] = short[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
                ["id", "n", "digest", "keys", "signature"],
            )

    return docs.select("id", "text").mapInArrow(run, "id long, n long, digest binary, keys array<long>, signature binary")


def _block_pairs(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Deal every row to the block pairs ``(i, j)``, ``i <= j``, of its group that need it."""
    return (
        rows.withColumn("_b", F.pmod(F.xxhash64("id", F.lit(7)), F.col(blocks)))
        .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .withColumn("i", F.least("_b", "_o"))
        .withColumn("j", F.greatest("_b", "_o"))
        .drop(blocks, "_o")
        .repartition(group, "i", "j")
        .sortWithinPartitions(group, "i", "j", "id")
    )


def parts(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index of every node's part, for a symmetric boolean matrix."""
    n = len(adjacent)
    label = np.full(n, -1)
    for root in range(n):
        if label[root] >= 0:
            continue
        label[root] = root
        front = np.array([root])
        while len(front):
            near = adjacent[front].any(0) & (label < 0)
            front = np.flatnonzero(near)
            label[front] = root
    return label


def _trees(table: pa.Table, starts: np.ndarray, adjacency) -> tuple[np.ndarray, np.ndarray]:
    """Star links ``(id, id)`` of the parts in every run of ``table``."""
    ids = table.column("id").to_numpy()
    block = table.column("_b").to_numpy()
    cross = table.column("i").to_numpy() != table.column("j").to_numpy()
    a, b = [], []
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if e - s < 2:
            continue
        near = adjacency(s, e)
        if cross[s]:
            near &= block[s:e, None] != block[None, s:e]
        label = parts(near)
        own = np.flatnonzero(label != np.arange(e - s))
        a.append(ids[s:e][label[own]])
        b.append(ids[s:e][own])
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    keep = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], ["src", "dst"])


def candidate_trees(reps: DataFrame, b: Banding) -> DataFrame:
    """``(src, dst)`` trees of likely links inside the tables of ``reps (id, n, keys, signature)``."""
    keyed = reps.select("id", F.explode("keys").alias("key"))
    tables = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("id")).alias("_x"), F.min("id").alias("_a"), F.max("id").alias("_z")
    )
    # equal members: visit one of the tables
    once = tables.filter("_n > 1 and _a < _z").groupBy("_n", "_x", "_a", "_z").agg(F.min("key").alias("key"))
    once = once.select("key", F.ceil(F.col("_n") / F.lit(BLOCK_ROWS)).cast("long").alias("_blocks"))
    members = keyed.join(once, "key").join(reps.select("id", "n", "signature"), "id")
    sigma = np.sqrt(b.threshold * (1 - b.threshold) / SIGNATURE)
    least = int(np.floor((b.threshold - 4.5 * sigma) * SIGNATURE))
    num, den = b.num, b.den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["key", "i", "j"]):
            n = table.column("n").to_numpy()
            raw = b"".join(table.column("signature").to_pylist())
            sig = np.frombuffer(raw, np.uint8).reshape(-1, SIGNATURE)

            def adjacency(s: int, e: int) -> np.ndarray:
                x, size = sig[s:e], n[s:e]
                near = np.empty((e - s, e - s), bool)
                for k in range(0, e - s, 64):
                    near[k : k + 64] = (x[k : k + 64, None, :] == x[None]).sum(-1) >= least
                return near & (den * np.minimum.outer(size, size) >= num * np.maximum.outer(size, size))

            yield _edges(*_trees(table, starts, adjacency))

    return _block_pairs(members, "key", "_blocks").mapInArrow(run, "src long, dst long")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from the shingles that at least two sets hold."""
    g = len(sets)
    owner = np.repeat(np.arange(g), [len(x) for x in sets])
    h = np.concatenate(sets)
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    new = np.append(True, h[1:] != h[:-1])
    shared = np.diff(np.append(np.flatnonzero(new), len(h))) > 1
    column = np.cumsum(shared) - 1
    index = np.cumsum(new) - 1
    keep = shared[index]
    owner, col = owner[keep], column[index[keep]]
    width = int(shared.sum())
    inter = np.zeros((g, g), np.float32)
    step = max(256, (1 << 22) // g)
    for a in range(0, width, step):
        lo, hi = np.searchsorted(col, [a, a + step])
        x = np.zeros((g, min(step, width - a)), np.float32)
        x[owner[lo:hi], col[lo:hi] - a] = 1
        inter += x @ x.T
    return inter.astype(np.int64)


def confirmed_trees(grouped: DataFrame, docs: DataFrame, b: Banding) -> DataFrame:
    """``(src, dst)`` trees of true links inside the groups ``grouped (id, n, component)``."""
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("_n"), F.sum("n").alias("_s"))
    blocks = sizes.select(
        "component",
        F.ceil(F.greatest(F.col("_n") / F.lit(BLOCK_ROWS), F.col("_s") / F.lit(BLOCK_SHINGLES))).cast("long").alias("_blocks"),
    )
    # merge: texts are shuffled at every size; the groups' ids are never small enough to count on
    texts = grouped.select("id", "component").join(blocks, "component").hint("merge").join(docs.select("id", "text"), "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = [b""] * batch.num_rows
            for first, h, r in _text_shingles(batch.column("text"), b):
                have, starts = np.unique(r, return_index=True)
                for row, s, e in zip(have.tolist(), starts.tolist(), np.append(starts[1:], len(h)).tolist(), strict=True):
                    out[first + row] = np.unique(h[s:e]).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("component"), batch.column("_blocks"), pa.array(out, pa.binary())],
                ["id", "component", "_blocks", "shingles"],
            )

    rows = texts.mapInArrow(sets, "id long, component long, _blocks long, shingles binary")
    num, den = b.num, b.den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["component", "i", "j"]):
            raw = table.column("shingles").to_pylist()

            def adjacency(s: int, e: int) -> np.ndarray:
                own = [np.frombuffer(x, np.uint64) for x in raw[s:e]]
                inter = _intersections(own)
                size = np.array([len(x) for x in own])
                return den * inter >= num * (size[:, None] + size[None] - inter)

            yield _edges(*_trees(table, starts, adjacency))

    return _block_pairs(rows, "component", "_blocks").mapInArrow(run, "src long, dst long")


def _components(trees: DataFrame) -> DataFrame:
    """``(id, component)`` of trees ``(src root, dst)``, which many tables repeat: every node keeps the link to
    its smallest root, and its other roots are linked with that root, once each."""
    least = trees.groupBy("dst").agg(F.min("src").alias("_m"))
    roots = trees.join(least, "dst").filter("src <> _m").select("src", F.col("_m").alias("dst")).distinct()
    return edge_components(roots.unionByName(least.select(F.col("_m").alias("src"), "dst")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", banding: Banding = Banding()) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable by links (itself included), ``kept`` marks that row.
    Null and empty texts and texts without words have no shingles and link with nothing. A null id
    links with nothing, has a null component and is kept. Ids are expected to be unique: repeated
    rows are each returned with the same result, and rows that share an id but not a text may be
    joined through that id. An empty table gives an empty result; other columns are ignored.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = checkpoint(sketches(ids, banding))
    linkable = sketched.filter("n > 0 and id is not null")
    classes = checkpoint(linkable.groupBy("digest").agg(F.min("id").alias("id")))
    reps = linkable.join(classes, ["id", "digest"], "left_semi")
    candidates = checkpoint(candidate_trees(reps, banding))
    groups = _components(candidates)
    grouped = checkpoint(groups.join(reps.groupBy("id").agg(F.max("n").alias("n")), "id"))
    links = checkpoint(confirmed_trees(grouped, ids.filter("id is not null"), banding))
    named = checkpoint(_components(links).select(F.col("id").alias("rep"), "component"))
    of_class = classes.withColumnRenamed("id", "rep").join(named, "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    out = sketched.select("id", "n", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.col("component_id"), F.col("id")))
    return out.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
