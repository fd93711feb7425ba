"""Quality by importance resampling: two hashed n-gram models, one of target text (labelled good)
and one of raw text (all documents), and the ratio of the two per document.

Tokens are runs of letters and digits and runs of other signs. Three kinds of n-grams go into the
same hashed space: words, word pairs, and pairs of word *shapes* (lower, title, upper, digits,
signs, mixed, with a mark when the word repeats the one before), so that text made of unknown words
still tells its form. A document's importance weight is the product of the ratios; ``log_weight`` is
its logarithm and ``log_ratio`` the mean per n-gram. A one-dimensional logistic fit on labelled rows
turns the mean into ``score``. Documents are drawn without replacement in proportion to their
weights by Gumbel top-k: the ``k`` largest of ``log_weight / temperature + Gumbel noise``.

The raw model counts every document. The target model and the logistic fit use at most ``sample``
labelled rows of either class (a documented bound; rows in hash order).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import mix, slices, text_bytes, words
from geoweave.operators.ranking import global_rank
from geoweave.plans.iterate import checkpoint, release

BUCKETS = 1 << 15
_KIND = np.full(256, 2, np.uint8)  # other signs
_KIND[[0x20, 9, 10, 11, 12, 13]] = 0
for _a, _z in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_z] = 1
_KEEP = np.arange(256, dtype=np.uint8)  # upper case stays apart
_UPPER, _DIGIT = np.zeros(256, np.int64), np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT[48:58] = 1


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, row)`` of all n-grams of the rows."""
    h, row, start, end = words(data, offsets, _KIND, _KEEP)
    if len(h) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = end - start
    upper = np.add.reduceat(_UPPER[data], start)
    digit = np.add.reduceat(_DIGIT[data], start)
    sign = _KIND[data[start]] == 2
    first = _UPPER[data[start]] == 1
    shape = np.select(
        [sign, digit == length, upper == 0, (upper == 1) & first, upper == length], [4, 3, 0, 1, 2], 5
    ).astype(np.uint64)
    shape[sign] += np.minimum(length[sign], 3).astype(np.uint64) * np.uint64(8)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    shape += same.astype(np.uint64) * np.uint64(64)
    pair = row[1:] == row[:-1]
    three = np.uint64(3)
    parts = [
        mix(h + np.uint64(11)),
        mix(h[:-1] * three + h[1:])[pair],
        mix((shape[:-1] * np.uint64(1024) + shape[1:]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5))[pair],
    ]
    bucket = (np.concatenate(parts) % np.uint64(BUCKETS)).astype(np.int64)
    return bucket, np.concatenate([row, row[1:][pair], row[1:][pair]])


def _column_ngrams(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    for a, z in slices(offsets, 1 << 18):
        yield a, z, *ngrams(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all n-grams of ``texts (text)`` by bucket: a row per bucket and task, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, bucket, _ in _column_ngrams(batch.column("text")):
                total += np.bincount(bucket, minlength=BUCKETS)
        have = np.flatnonzero(total)
        if len(have):
            yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(total[have])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.float64)
    for r in counted.toLocalIterator():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, value: int, sample: int) -> DataFrame:
    """``(id, text)`` of at most ``sample`` ids labelled ``value`` whose crc32(id as text) mod 5 is not 0: the first in
    hash order, each with its smallest text, however often it repeats. Written to the checkpoint folder."""
    learn = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0
    chosen = labels.filter((F.col(label_col) == value) & learn).select(id_col).distinct()
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col).limit(sample)  # at most ``sample`` ids
    near = docs.join(F.broadcast(chosen), id_col, "left_semi")
    return checkpoint(near.groupBy(id_col).agg(F.min("text").alias("text")))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a regularised one-dimensional logistic fit with balanced classes."""
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    scale = max(x.std(), 1e-9)
    z, beta = x / scale, np.zeros(2)
    for _ in range(50):
        design = np.stack([z, np.ones_like(z)], 1)
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (p - y)) + 1e-4 * beta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
        beta = beta - np.linalg.solve(hess, grad)
    return float(beta[0] / scale), float(beta[1])


def _scored(docs: DataFrame, text_col: str, ratio: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``log_weight`` and ``n_grams`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS numbers
    source = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = source.drop("_text").withColumns({"log_weight": F.lit(0.0), "n_grams": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        for batch in batches:
            weight, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for a, z, bucket, row in _column_ngrams(batch.column("_text")):
                weight[a:z] = np.bincount(row, r[bucket], minlength=z - a)
                count[a:z] = np.bincount(row, minlength=z - a)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(weight), pa.array(count)], [*keep, "log_weight", "n_grams"]
            )

    return source.mapInArrow(run, schema)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = 4000,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (default: the id) plus ``log_weight, log_ratio, score, accepted`` per row.

    Texts that are null, empty or blank have no n-grams: log weight 0, score 0, not accepted. Without
    labelled rows of both classes the ratio is all there is: score is the logistic of ``log_ratio``.
    Repeated rows are scored each; empty tables give an empty result; label columns are never read
    for a score.
    """
    keep = keep or [id_col]
    labels = labels.select(id_col, label_col)
    texts = docs.select(id_col, F.col(text_col).alias("text"))
    good = labelled(texts, labels, id_col, label_col, 1, sample)
    poor = labelled(texts, labels, id_col, label_col, 0, sample)
    raw, target = bucket_counts(texts), bucket_counts(good)
    # both models are smoothed towards the raw one: unseen n-grams of little raw text say little
    base = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    pull = 0.02 * max(target.sum(), 1.0)
    model = (target + pull * base) / (target.sum() + pull)
    ratio = np.log(model / base) if target.sum() else np.zeros(BUCKETS)
    fit = [
        (r["log_weight"] / r["n_grams"], y)
        for y, part in ((1, good), (0, poor))
        for r in _scored(part, "text", ratio, [id_col]).filter("n_grams > 0").select("log_weight", "n_grams").collect()
    ]  # at most 2 * sample rows: one an id
    release(good, poor)
    x, y = np.array([f[0] for f in fit]), np.array([f[1] for f in fit])
    slope, offset = _logistic(x, y) if len(set(y.tolist())) == 2 else (1.0, 0.0)
    mean = F.when(F.col("n_grams") > 0, F.col("log_weight") / F.col("n_grams")).otherwise(F.lit(0.0))
    score = F.when(F.col("n_grams") > 0, 1 / (1 + F.exp(-(F.lit(slope) * F.col("log_ratio") + F.lit(offset))))).otherwise(F.lit(0.0))
    return (
        _scored(docs, text_col, ratio, keep)
        .withColumn("log_ratio", mean)
        .withColumn("score", score)
        .withColumn("accepted", F.col("score") >= 0.5)
        .drop("n_grams")
    )


def resample(scored: DataFrame, id_col: str = "doc_id", fraction: float = 0.5, temperature: float = 1.0, seed: int = 17) -> DataFrame:
    """Add ``gumbel_key, rank`` and ``sampled``: Gumbel top-k of the accepted rows by importance weight.

    ``k`` is ``fraction`` of the accepted rows, rounded up. Ranks count accepted rows only (others have
    null). Ties of the key fall to the smaller id. The noise depends on id and seed alone.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = checkpoint(scored.withColumn("gumbel_key", F.col("log_weight") / F.lit(temperature) - F.log(-F.log(u))))
    ranked = global_rank(keyed.filter("accepted"), [F.desc("gumbel_key"), F.col(id_col)])
    k = int(np.ceil(fraction * keyed.filter("accepted").count()))
    rest = keyed.filter("not accepted").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).withColumn("sampled", F.coalesce(F.col("rank") <= F.lit(k), F.lit(False)))
