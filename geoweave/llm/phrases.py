"""Phrase collocation mining in the layout of external-memory n-gram estimation.

Phrases of one to ``max_words`` words are counted into one stream ``(lang, phrase, n)``: tasks send runs
of phrases in the order of their words, and buckets of phrases are added up one after the other. Counts
below ``min_count`` go at once: no part of a candidate is rarer than the candidate itself. The stream is then kept in two orders. In prefix order (words left to right) every phrase follows its own
beginnings, in suffix order (words right to left) its own endings. So one pass over a sorted partition,
which holds the latest count of each length, gives every phrase the counts of all its left (right) parts
and tells each phrase its largest one-word extension: a merge in lockstep, without a hash table. What lies
on the far side of a partition's border (at most one phrase per length) is looked up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import LOWER, mix, text_bytes
from geoweave.llm.arrays import words as word_hashes
from geoweave.operators.ranking import global_rank
from geoweave.plans.iterate import checkpoint, shuffle_partitions

#: 0 between words, 1 in a word, 2 between pieces (. , ; : ! ? and line ends)
KIND = np.ones(256, np.uint8)
KIND[[0x20, 9]] = 0
KIND[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 10, 11, 12, 13]] = 2
ANY_BYTE, SAME = np.ones(256, bool), np.arange(256, dtype=np.uint8)
#: bytes of text looked at in one numpy step
SLICE = 1 << 22
#: buckets to a shuffle partition, phrases of a bundle at most, and phrases gathered before they are added up
BUCKETS, LINES, GATHERED = 16, 256, 1 << 20
#: languages whose totals may be broadcast
FEW_LANGS = 10_000


# ---- counting ------------------------------------------------------------------------------------


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The folded words of texts in order, the piece that each stands in and its first byte."""
    n = len(data)
    kind = KIND[data]
    inside = kind == 1
    change = np.ones(n + 1, bool)
    change[1:n] = inside[1:] != inside[:-1]
    change[offsets] = True
    start = np.flatnonzero(change[:n] & inside)
    end = np.flatnonzero(change[1:] & inside) + 1
    places = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(LOWER[data[inside]]))
    ends = np.searchsorted(np.flatnonzero(kind == 2), start)  # piece ends before the word
    return found, ends + np.searchsorted(offsets, start, "right"), start


def phrase_counts(found: pa.Array, piece: np.ndarray, own: int, max_words: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``(phrases, hashes, counts)`` of each length, in order of their words, of the phrases that start at
    one of the first ``own`` words."""
    coded = found.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    texts = coded.dictionary.take(pa.array(order))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    word = place[coded.indices.to_numpy()]
    size = max(len(texts), 1)
    hashed = own_hash = word_hashes(*text_bytes(texts), ANY_BYTE, SAME)[0]
    code, at = word[:own], np.arange(own)
    counts, last = np.bincount(code, minlength=len(texts)), texts
    yield texts, hashed, counts
    for k in range(1, max_words):
        inside = at + k < len(word)
        at, code = at[inside], code[inside]
        inside = piece[at] == piece[at + k]
        at, code = at[inside], code[inside]
        # a phrase is its beginning (numbered in order) and its last word
        key, code, counts = np.unique(code * size + word[at + k], return_inverse=True, return_counts=True)
        begin, end = key // size, key % size
        texts = pc.binary_join_element_wise(texts.take(pa.array(begin)), last.take(pa.array(end)), " ")
        hashed = mix(hashed[begin] * np.uint64(0x9E3779B97F4A7C15) + own_hash[end])
        yield texts, hashed, counts


def stretches(data: np.ndarray, offsets: np.ndarray, max_words: int):
    """Whole texts of about ``SLICE`` bytes together, or the parts of a long text, as ``(data, offsets,
    own bytes)``: a part goes on for ``max_words`` - 1 words beyond its own bytes, which the next part starts with."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(int(np.searchsorted(offsets, offsets[a] + SLICE, "right")) - 1, a + 1)
        part = data[offsets[a] : offsets[b]]
        if len(part) <= SLICE:
            yield part, offsets[a : b + 1] - offsets[a], len(part)
        else:
            at = 0
            while at < len(part):
                cut = _next_word(part, min(at + SLICE, len(part)))
                end = cut
                for _ in range(max_words - 1):
                    end = _next_word(part, end, 1)
                yield part[at:end], np.array([0, end - at]), cut - at
                at = cut
        a = b


def _next_word(data: np.ndarray, at: int, skip: int = 0) -> int:
    """The place just after the word that ``at`` stands in, after passing ``skip`` words more."""
    for wanted in (*((0, 1) * skip), 0) if skip else (0,):
        while at < len(data):
            part = KIND[data[at : at + 4096]] == 1
            hit = np.flatnonzero(part if wanted else ~part)
            if len(hit):
                at += int(hit[0])
                break
            at += len(part)
    return at


def bundles(lang: str, buckets: int, phrases: pa.Array, hashed: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """``(bucket, lang, n, phrases)``: the phrases of one bucket and equal count, in order, as lines of one string."""
    bucket = ((hashed ^ np.uint64(crc32(lang.encode()))) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((counts, bucket))
    bucket, counts = bucket[order], counts[order].astype(np.int64)
    new = np.ones(len(order), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (counts[1:] != counts[:-1])
    begin = np.flatnonzero(new)
    new |= (np.arange(len(order)) - begin[np.cumsum(new) - 1]) % LINES == 0
    begin = np.flatnonzero(new)
    ends = pa.array(np.append(begin, len(order)).astype(np.int32))
    lines = pc.binary_join(pa.ListArray.from_arrays(ends, phrases.take(pa.array(order))), "\n")
    cols = [pa.array(bucket[begin]), pa.repeat(lang, len(begin)), pa.array(counts[begin]), lines]
    return pa.RecordBatch.from_arrays(cols, ["bucket", "lang", "n", "phrases"])


def summed(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """``(lang, phrase, n)`` with ``n >= min_count`` from bundles sorted by bucket; a bucket's phrases are
    added up whenever ``GATHERED`` more, and as many as are held, have come, so it takes memory for its distinct phrases only."""

    def total(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        return found.rename_columns({"n_sum": "n"})

    def wanted(parts: list[pa.Table]) -> list[pa.RecordBatch]:
        found = total(parts).select(["lang", "phrase", "n"])
        keep = pc.or_(pc.greater_equal(found["n"], min_count), pc.equal(found["phrase"], ""))
        return found.filter(keep).to_batches()

    held, many, base, bucket = [], 0, 0, None
    for batch in batches:
        ends = np.flatnonzero(np.diff(batch.column("bucket").to_numpy())) + 1
        for a, b in pairwise([0, *ends.tolist(), batch.num_rows]):
            if a == b:
                continue
            here = batch.column("bucket")[a].as_py()
            if held and here != bucket:
                yield from wanted(held)
                held, many, base = [], 0, 0
            bucket = here
            lines = pc.split_pattern(batch.column("phrases").slice(a, b - a), "\n")
            row = pc.list_parent_indices(lines)
            lang = batch.column("lang").slice(a, b - a).take(row)
            held.append(pa.table({"lang": lang, "phrase": lines.flatten(), "n": batch.column("n").slice(a, b - a).take(row)}))
            many += len(row)
            if many >= max(GATHERED, base):
                held, many = [total(held)], 0
                base = len(held[0])
    if held:
        yield from wanted(held)


def counted_phrases(docs: DataFrame, max_words: int, min_count: int = 1) -> DataFrame:
    """``(lang, phrase, n)`` of the phrases with ``n >= min_count``; the empty phrase counts the words of a language.

    Tasks send runs of phrases in order, bundled by bucket (a hash of language and phrase). Counting
    takes one bucket at a time, and there are ``BUCKETS`` of them to a shuffle partition."""
    buckets = BUCKETS * shuffle_partitions(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    source = docs.select(lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")):
                texts = batch.column("text").filter(pc.equal(batch.column("lang"), lang))
                for data, offsets, own_bytes in stretches(*text_bytes(texts), max_words):
                    found, piece, start = words(data, offsets)
                    own = int(np.searchsorted(start, own_bytes))
                    if own == 0:
                        continue
                    total = (pa.array([""]), np.zeros(1, np.uint64), np.array([own]))
                    for part in (total, *phrase_counts(found, piece, own, max_words)):
                        yield bundles(lang.as_py(), buckets, *part)

    sent = source.mapInArrow(run, "bucket long, lang string, n long, phrases string")
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: summed(batches, min_count), "lang string, phrase string, n long")


# ---- lockstep passes -----------------------------------------------------------------------------


def lockstep(batches: Iterator[pa.RecordBatch], max_words: int, backwards: bool) -> Iterator[pa.RecordBatch]:
    """One pass over a stream sorted by ``(lang, path)``: ``(lang, phrase, size, n)`` gives
    ``(lang, phrase, size, n, part1 .. part<max_words - 1>, extension)``.

    ``part<k>`` is the count of the first ``k`` words of the path, null where that phrase lies before the
    partition. ``extension`` is the largest count of a phrase that goes on by one word; one that lies
    beyond the batch of its beginning comes as a row of its own with null ``n``.
    """
    held = [None] * max_words  # the latest (lang, phrase, n) of each length that the stream is inside of
    for batch in batches:
        m = batch.num_rows
        if m == 0:
            continue
        lang, phrase = batch.column("lang"), batch.column("phrase")
        size, n = batch.column("size").to_numpy(), batch.column("n").to_numpy()
        at = np.arange(m)
        latest = [np.maximum.accumulate(np.where(size == k, at, -1)) for k in range(1, max_words)]
        extension = np.zeros(m, np.int64)
        outer: list[tuple] = []
        parts = []
        for k in range(1, max_words):
            here = latest[k - 1]
            before = held[k - 1][2] if held[k - 1] else -1
            value = np.where(here >= 0, n[np.maximum(here, 0)], before)
            # only phrases longer than k have a part of k words of their own
            parts.append(pa.array(value, mask=(size <= k) | (value < 0)))
            child = np.flatnonzero(size == k + 1)
            inner = child[here[child] >= 0]
            np.maximum.at(extension, here[inner], n[inner])
            far = child[here[child] < 0]
            if len(far):  # all of one beginning, the latest before this batch
                i = int(far[0])
                owner = held[k - 1][:2] if held[k - 1] else (lang[i].as_py(), _part(phrase[i].as_py(), k, backwards))
                outer.append((*owner, k, int(n[far].max())))
            if here[-1] >= 0:
                i = int(here[-1])
                held[k - 1] = (lang[i].as_py(), phrase[i].as_py(), int(n[i]))
        names = ["lang", "phrase", "size", "n", *(f"part{k}" for k in range(1, max_words)), "extension"]
        yield pa.RecordBatch.from_arrays([lang, phrase, batch.column("size"), batch.column("n"), *parts, pa.array(extension)], names)
        if outer:
            none = pa.nulls(len(outer), pa.int64())
            owner, words_, sizes, most = map(list, zip(*outer, strict=True))
            cols = [pa.array(owner), pa.array(words_), pa.array(sizes, pa.int32()), none, *[none] * (max_words - 1), pa.array(most)]
            yield pa.RecordBatch.from_arrays(cols, names)


def _part(phrase: str, k: int, backwards: bool) -> str:
    """The first (last) ``k`` words of a phrase."""
    found = phrase.split(" ")
    return " ".join(found[len(found) - k :] if backwards else found[:k])


def in_order(grams: DataFrame, backwards: bool, max_words: int) -> DataFrame:
    """The counts of all parts of every phrase in prefix (suffix) order: see ``lockstep``."""
    path = F.split("phrase", " ")
    path = F.reverse(path) if backwards else path
    stream = grams.select("lang", path.alias("path"), "phrase", F.size(path).alias("size"), "n")
    stream = stream.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").drop("path")
    schema = "lang string, phrase string, size int, n long, " + "".join(f"part{k} long, " for k in range(1, max_words)) + "extension long"
    passed = checkpoint(stream.mapInArrow(lambda batches: lockstep(batches, max_words, backwards), schema))
    # beginnings that lie before a partition: at most one phrase per length and partition
    parts = [f"part{k}" for k in range(1, max_words)]
    words_of = F.split("phrase", " ")
    for k, part in enumerate(parts, 1):
        cut = F.slice(words_of, F.size(words_of) - k + 1, k) if backwards else F.slice(words_of, 1, k)
        key = F.when(F.col(part).isNull() & F.col("n").isNotNull() & (F.col("size") > k), F.array_join(cut, " "))
        passed = passed.withColumn(f"_cut{k}", key)
        missing = passed.select("lang", F.col(f"_cut{k}").alias("phrase")).filter("phrase is not null").distinct()
        far = missing.join(grams, ["lang", "phrase"]).select(
            F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("n").alias("_n")
        )
        passed = passed.join(F.broadcast(far), (F.col("lang") == F.col("_l")) & (F.col(f"_cut{k}") == F.col("_p")), "left")
        passed = passed.withColumn(part, F.coalesce(part, "_n")).drop("_l", "_p", "_n", f"_cut{k}")
    return passed


def phrases(
    docs: DataFrame, min_count: int = 10, max_words: int = 3, covered_percent: int = 50, top: int = 2000, scale: int = 1_000_000
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases.

    A candidate has 2 to ``max_words`` words inside one piece and ``a >= min_count`` occurrences. Cut after
    ``k`` words it scores ``floor(scale * a * a / (l * r))``, the counts of its two sides; the lowest cut counts
    (ties: the smallest ``k``). It goes when a longer candidate that holds it has at least ``covered_percent``
    of its count: as counts only fall with length, the extensions by one word tell. Ranks go by score, then
    ``a``, descending, then by phrase in UTF-8 order. ``n`` counts all words of the language.

    Null texts read as empty, a null lang as ``und``; repeated rows count each; a long text is read in parts
    that overlap by ``max_words - 1`` words; an empty table gives an empty result; other columns are not
    read. Products are 38-digit decimals.
    """
    counted = checkpoint(counted_phrases(docs, max_words, min_count))
    grams = counted.filter("phrase <> ''")
    sizes = counted.filter("phrase = ''").select("lang", F.col("n").alias("total"))
    cuts = range(1, max_words)
    left = in_order(grams, False, max_words)
    right = in_order(grams, True, max_words)
    for k in cuts:
        left = left.withColumnRenamed(f"part{k}", f"l{k}").withColumn(f"r{k}", F.lit(None).cast("long"))
        right = right.withColumnRenamed(f"part{k}", f"r{k}").withColumn(f"l{k}", F.lit(None).cast("long"))
    values = ["n", *(f"{side}{k}" for side in "lr" for k in cuts), "extension"]
    merged = left.unionByName(right).filter("size > 1").groupBy("lang", "phrase", "size").agg(*(F.max(c).alias(c) for c in values))
    wide = F.col("n").cast("decimal(19,0)")
    scores = []
    for k in cuts:
        # the right side of a cut after k words has size - k words
        r = F.coalesce(*(F.when(F.col("size") == k + j, F.col(f"r{j}")) for j in cuts))
        l_, r_ = F.col(f"l{k}").cast("decimal(19,0)"), r.cast("decimal(19,0)")
        score = F.call_function("div", wide * wide * F.lit(scale).cast("decimal(10,0)"), l_ * r_)
        cut = F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), r.alias("r"))
        scores.append(F.when(F.col("size") > k, cut))
    scored = merged.filter(F.col("extension") * 100 < F.col("n") * covered_percent).select(
        "lang", "phrase", F.col("n").alias("a"), F.array_min(F.array(*scores)).alias("best")
    )
    found = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # a language can have any number of candidates: ranked over range partitions, not in one window
    ranked = global_rank(found, ["lang", F.desc("score"), F.desc("a"), "phrase"], rank_col="_at", start=0)
    first = ranked.groupBy("lang").agg(F.min("_at").alias("_first")).join(sizes, "lang")
    first = checkpoint(first)
    few = first.count() <= FEW_LANGS  # a language can hold most rows: its row goes to them, not they to it
    out = ranked.join(F.broadcast(first) if few else first, "lang")
    return out.withColumn("rank", F.col("_at") - F.col("_first") + 1).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
