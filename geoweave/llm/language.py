"""Language identification with a string kernel: blended-spectrum n-gram presence, Nyström landmarks
and one-versus-rest kernel ridge regression.

Two texts are compared by the n-grams (1 to ``longest`` characters, hashed to ``BUCKETS`` values)
that both contain: ``k(x, z) = |x ∩ z| / sqrt(|x| |z|)``. ``landmarks`` sample texts span the
Nyström feature map ``K(x, L) K(L, L)^(-1/2)``; a ridge regression per language on these features
gives the classifier. As the kernel is linear in the presence vector, landmarks and weights fold into
one ``BUCKETS × languages`` matrix, and texts are scored by batched products of their presence
matrix with it.

The fit uses at most about ``per_language`` ids of each language (those below a hash threshold that is
set from the language's count of ids) and about ``sample`` in all, one row an id, of the learning fold; scoring
covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import mix
from geoweave.plans.iterate import checkpoint

BUCKETS = 1 << 14
LONGEST = 4
_BATCH_CHARS = 1 << 18
UNKNOWN = "und"


def _codes(lowered: list[str]) -> np.ndarray:
    """Code points of lower-case texts, one after another: every other character than a letter or a sign beyond
    ASCII (digits, signs, line ends) becomes a space, so markup and numbers do not speak for a language."""
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    plain = (codes < 97) | ((codes > 122) & (codes < 170))
    codes[plain] = 32
    return codes


def presence(texts: list[str], longest: int = LONGEST) -> np.ndarray:
    """``(texts, BUCKETS)`` float32 matrix: 1 where the text holds an n-gram of the bucket.

    Long texts are read in pieces that overlap by ``longest - 1`` characters, so memory is bounded by the piece."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    pieces, rows = [], []
    for i, text in enumerate(texts):
        lowered = text.lower()
        for a in range(0, len(lowered), _BATCH_CHARS):
            pieces.append(lowered[a : a + _BATCH_CHARS + longest - 1])
            rows.append(i)
    for a, z in _groups(pieces):
        _mark(out, pieces[a:z], np.array(rows[a:z]), longest)
    return out


def _mark(out: np.ndarray, pieces: list[str], rows: np.ndarray, longest: int) -> None:
    codes = _codes(pieces)
    place = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    blank = codes == 32
    h = np.zeros(len(codes), np.uint64)
    for size in range(1, longest + 1):
        m = len(codes) - size + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + codes[size - 1 :].astype(np.uint64) + np.uint64(1)
        whole = place[:m] == place[size - 1 :]
        whole &= ~blank[:m] | ~blank[size - 1 :]  # not from blank to blank
        bucket = (mix(h[whole] + np.uint64(size << 40)) >> np.uint64(50)).astype(np.int64)
        out[rows[place[:m][whole]], bucket] = 1


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_BATCH_CHARS`` characters and at most 256 rows."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and (size + len(t) > _BATCH_CHARS or i - a >= 256):
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def fit(texts: list[str], langs: list[str], landmarks: int = 256, ridge: float = 0.01) -> tuple[list[str], np.ndarray]:
    """``(languages, BUCKETS × languages matrix)``; the score of a text is its presence vector over
    ``sqrt`` of its size times the matrix. Landmarks are drawn evenly over the languages' rows."""
    names = sorted(set(langs))
    x = np.concatenate([presence(texts[a:z]) for a, z in _groups(texts)])
    size = np.maximum(x.sum(1, keepdims=True), 1)
    x /= np.sqrt(size)
    turn: dict[str, int] = {}
    place = []
    for lang in langs:
        place.append(turn.get(lang, 0))
        turn[lang] = place[-1] + 1
    order = np.argsort(place, kind="stable")
    mark = x[order[:landmarks]]
    gram = mark.astype(np.float64) @ mark.T
    value, vector = np.linalg.eigh(gram)
    ok = value > value.max() * 1e-6
    root = vector[:, ok] / np.sqrt(value[ok])
    phi = (x @ mark.T).astype(np.float64) @ root
    y = np.where(np.array(langs)[:, None] == np.array(names)[None], 1.0, -1.0)
    share = np.array([1 / langs.count(l) for l in names])[np.searchsorted(names, langs)]
    w = share / share.mean()
    weights = np.linalg.solve(phi.T @ (phi * w[:, None]) + ridge * np.eye(phi.shape[1]), phi.T @ (y * w[:, None]))
    return names, (mark.T @ (root @ weights).astype(np.float32)).astype(np.float32)


def predict_batch(texts: list[str], names: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    langs: list[str] = []
    scores = np.zeros(len(texts))
    for a, z in _groups(texts):
        x = presence(texts[a:z])
        raw = (x @ matrix) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        best = raw.argmax(1)
        scores[a:z] = np.clip((raw[np.arange(z - a), best].astype(np.float64) + 1) / 2, 0, 1)
        langs += [names[k] for k in best]
    return langs, scores


def learning_rows(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, languages: int, sample: int
) -> DataFrame:
    """``(id, text, lang)`` to learn from: text and language not null, crc32(id as text) mod 5 not 0.

    The ``languages`` languages of most ids are learnt (ties: the smaller name), each from the ids whose hash falls
    below ``per_language`` (less where ``sample`` rows would not do for all) over its count of ids; counts are
    estimated within 5 %. An id gives one row, of its smallest text, however often it repeats.
    """
    learn = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0
    rows = docs.filter(learn).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    ids = rows.groupBy("lang").agg(F.approx_count_distinct("id", 0.05).alias("n"))
    most = checkpoint(ids.orderBy(F.desc("n"), "lang").limit(languages))  # at most ``languages`` rows
    per_language = min(per_language, max(1, sample // max(1, most.count())))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    near = rows.join(F.broadcast(most), "lang").filter(draw < F.lit(float(per_language)) / F.col("n"))
    return near.groupBy("id").agg(F.min(F.struct("text", "lang")).alias("r")).select("id", "r.*")


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 300,
    landmarks: int = 256,
    keep: list[str] | None = None,
    languages: int = 256,
    sample: int = 6000,
) -> DataFrame:
    """``keep`` columns (default: the id) plus ``held_out, lang_pred, score`` per row of ``docs``.

    ``held_out`` marks rows that are never learnt from. A text that is null or has no letter gets
    ``und`` with score 0, as does every text when there is no row to learn from. Repeated rows are scored
    each; an empty table gives an empty result; columns named like a result are dropped in its favour.

    About ``sample`` rows at most reach the driver: ``learning_rows``.
    """
    out = ["held_out", "lang_pred", "score"]
    keep = [c for c in (keep or [id_col]) if c not in out]
    learnt = learning_rows(docs, id_col, text_col, lang_col, per_language, languages, sample)
    learnt = learnt.orderBy(F.xxhash64("id"), "id").select("text", "lang").collect()
    learnt = [(t, l) for t, l in learnt if any(c.isalpha() for c in t)]
    model = fit([t for t, _ in learnt], [l for _, l in learnt], landmarks) if learnt else None
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS × languages numbers
    held = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    source = docs.select(*keep, F.coalesce(held, F.lit(False)).alias("held_out"), F.col(text_col).alias("_text"))
    schema = source.drop("_text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts = [t or "" for t in part.column("_text").to_pylist()]
                known = np.array([model is not None and any(map(str.isalpha, t)) for t in texts])
                langs, scores = predict_batch(texts, *model) if known.any() else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                langs = [l if k else UNKNOWN for l, k in zip(langs, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in [*keep, "held_out"]), pa.array(langs, pa.string()), pa.array(np.where(known, scores, 0.0))],
                    [*keep, *out],
                )

    return source.mapInArrow(run, schema)
