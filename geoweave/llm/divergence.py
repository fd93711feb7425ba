"""Source divergence audit: how far the word use of each source of a language lies from its peers.

The counts are kept as a sparse matrix in term-major form, one row of postings ``(source, n)`` per
kept term. Distances come from Gustavson's row accumulation: the terms are dealt out in blocks; inside
a block every source scatters its terms through the term-major postings into one dense accumulator
with a place per peer, so pairs of postings are never emitted, only one sum per pair of sources and
block. A source without a term has the zero baseline ``z`` there, and the accumulator holds only
corrections to it:

    sum over terms of |p - q|  =  sum over own terms of |p - z(peer)|  +  sum over peer's terms of |q - z|
      + (terms - own - peer's) * |z - z(peer)|
      + sum over shared terms of (|p - q| - |p - z(peer)| - |q - z| + |z - z(peer)|)

The first two sums need no pairs either: they are read off prefix sums over a source's sorted values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoweave.llm.arrays import LOWER, runs, slices, text_bytes
from geoweave.plans.iterate import checkpoint, release

#: bytes of a term: A-Z, a-z and all of every character beyond ASCII
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
#: bytes of text looked at in one numpy step
SLICE = 1 << 22
#: postings of a block: as many as it emits sums, within these bounds
BLOCK_LEAST, BLOCK_MOST = 1 << 15, 1 << 21


# ---- counts --------------------------------------------------------------------------------------


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The folded terms of texts in order, and the row of each."""
    n = len(data)
    inside = LETTER[data]
    change = np.ones(n + 1, bool)
    change[1:n] = inside[1:] != inside[:-1]
    change[offsets] = True
    start = np.flatnonzero(change[:n] & inside)
    end = np.flatnonzero(change[1:] & inside) + 1
    places = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(LOWER[data[inside]]))
    return found, np.searchsorted(offsets, start, "right") - 1


def cuts(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``limit`` bytes that end between terms."""
    a = 0
    while a < len(data):
        b = min(a + limit, len(data))
        while b < len(data) and LETTER[data[b]]:
            gap = np.flatnonzero(~LETTER[data[b : b + limit]])
            b = min(b + (int(gap[0]) if len(gap) else limit), len(data))
        yield data[a:b]
        a = b


def _once(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> pa.Table:
    """``(group, term, n, docs)`` of some whole texts; ``group`` numbers the group of each text."""
    found, row = terms(data, offsets)
    coded = found.dictionary_encode()
    size = max(len(coded.dictionary), 1)
    # (text, term) once each, then (group, term): so a text counts once among a term's documents
    key, n = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
    key, back, docs = np.unique(group[key // size] * size + key % size, return_inverse=True, return_counts=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, back, n)
    return pa.table({"group": key // size, "term": coded.dictionary.take(pa.array(key % size)), "n": total, "docs": docs.astype(np.int64)})


def tallies(texts: pa.Array, group: np.ndarray) -> Iterator[pa.Table]:
    """``(group, term, n, docs)`` of a batch in parts; a text longer than a part counts its distinct terms once."""
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets, SLICE):
        part = data[offsets[a] : offsets[b]]
        if len(part) <= SLICE:
            yield _once(part, offsets[a : b + 1] - offsets[a], group[a:b])
        else:  # one long text
            pieces = [_once(p, np.array([0, len(p)]), group[a:b]) for p in cuts(part, SLICE)]
            whole = pa.concat_tables(pieces).group_by(["group", "term"]).aggregate([("n", "sum")])
            yield pa.table({"group": whole["group"], "term": whole["term"], "n": whole["n_sum"], "docs": pa.array(np.ones(len(whole), np.int64))})


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``; the empty term stands for the group itself."""
    source = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lang, place = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            width = len(place.dictionary)
            group = lang.indices.to_numpy().astype(np.int64) * width + place.indices.to_numpy()
            here = np.unique(group)
            zero = pa.array(np.zeros(len(here), np.int64))
            empty = pa.table({"group": here, "term": pa.array([""] * len(here)), "n": zero, "docs": zero})
            for part in (empty, *tallies(batch.column("text"), group)):
                g = part["group"].to_numpy()
                cols = [lang.dictionary.take(pa.array(g // width)), place.dictionary.take(pa.array(g % width))]
                yield from pa.table([*cols, part["term"], part["n"], part["docs"]], names=_COUNTS).to_batches()

    counted = source.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


_COUNTS = ["lang", "source", "term", "n", "docs"]


# ---- row accumulation ----------------------------------------------------------------------------


def row_sums(term: np.ndarray, group: np.ndarray, p: np.ndarray, z: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For every group ``i`` of a block its row ``s``: ``s[j] + s_of_j[i]`` is the distance of ``i`` and
    ``j`` over the block's terms. ``(term, group, p)`` are the postings, ``z`` the groups' baselines."""
    order = np.lexsort((group, term))
    term, group, p = term[order], group[order], p[order]
    n_terms = int(term[-1]) + 1 if len(term) else 0
    begin = np.searchsorted(term, np.arange(n_terms + 1))  # the term-major index
    length = np.diff(begin)
    by_group = np.argsort(group, kind="stable")
    own = np.searchsorted(group[by_group], np.arange(len(z) + 1))
    for i in range(len(z)):
        mine = by_group[own[i] : own[i + 1]]
        apart = np.abs(z[i] - z)
        # own terms against every peer's baseline
        values = np.sort(p[mine])
        sums = np.concatenate([[0], np.cumsum(values)])
        k = np.searchsorted(values, z, "right")
        acc = z * k - sums[k] + (sums[-1] - sums[k]) - z * (len(mine) - k) - len(mine) * apart
        acc[i + 1 :] += n_terms * apart[i + 1 :]
        # scatter own terms through the index: corrections where the peer has the term as well
        counts = length[term[mine]]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begin[term[mine]] - (ends - counts), counts) + np.arange(total)
        a = np.repeat(p[mine], counts)
        later = group[at] > i
        at, a = at[later], a[later]
        peer, b = group[at], p[at]
        np.add.at(acc, peer, np.abs(a - b) - np.abs(a - z[peer]) - np.abs(b - z[i]) + apart[peer])
        acc[i] = 0
        yield i, acc


def _accumulate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in runs(batches, ["block"]):
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            block = table.slice(a, b - a).combine_chunks()
            mark = pc.is_null(block["term"])
            groups = block.filter(mark).sort_by("source")
            names = groups["source"].combine_chunks()
            posted = block.filter(pc.invert(mark))
            term = posted["term"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            group = pc.index_in(posted["source"], names).to_numpy().astype(np.int64)
            lang = block["lang"][0]
            for i, sums in row_sums(term, group, posted["p"].to_numpy(), groups["p"].to_numpy()):
                first = np.minimum(i, np.arange(len(sums)))
                second = np.maximum(i, np.arange(len(sums)))
                pair = first < second
                cols = [names.take(pa.array(first[pair])), names.take(pa.array(second[pair])), pa.array(sums[pair])]
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, int(pair.sum())), *cols], ["lang", "a", "b", "value"])


# ---- report --------------------------------------------------------------------------------------


def divergence(
    docs: DataFrame, min_docs: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top_terms: int = 50
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every group ``(lang, source)`` of ``docs``.

    A language keeps the terms that stand in at least ``min_docs`` of its rows. A group, or the whole
    language, gives a kept term ``p = 1 + floor(scale * (n + smoothing) / (N + smoothing * V))``. Part
    ``pair``: the sum of ``|p - q|`` over all kept terms, for every other source of the language. Part
    ``term``: the first ``top_terms`` kept terms of the group with ``p`` above the language's. Ranks go by
    value descending, then item ascending in UTF-8.

    Null text, lang and source read as ''; repeated rows count each; a long text is read in pieces cut
    between terms and counts as one document; a group without terms has pairs (0 apart where the language keeps
    no term); an empty table gives an empty result; other columns are not read.
    """
    counted = checkpoint(term_counts(docs))
    # term-major: one row of postings per kept term, at most one posting per source of the language
    posting = F.struct("source", "n")
    index = checkpoint(
        counted.filter("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(posting).alias("postings"))
        .filter(F.col("docs") >= min_docs)
        .select("lang", "term", "lang_n", "postings")
    )
    posted = index.select("lang", "term", "lang_n", F.inline("postings").alias("source", "n"))

    def share(n: Column, total: Column, kept: Column) -> Column:
        wide = (n.cast("decimal(20,0)") + F.lit(smoothing)) * F.lit(scale).cast("decimal(11,0)")
        part = F.when(kept > 0, total + kept * F.lit(smoothing)).otherwise(F.lit(1)).cast("decimal(20,0)")
        return F.call_function("div", wide, part) + F.lit(1)

    langs = index.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"), F.sum(F.size("postings")).alias("nnz")
    )
    totals = posted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        counted.filter("term = ''")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "kept", "lang_total", "nnz"])
    )
    groups = checkpoint(groups.withColumn("z", share(F.lit(0), F.col("total"), F.col("kept"))))

    # blocks of terms: a block emits a sum per pair of sources, so it holds about as many postings
    per_lang = groups.groupBy("lang").agg(F.first("nnz").alias("nnz"), F.count(F.lit(1)).alias("n_groups"))
    width = F.greatest(F.lit(BLOCK_LEAST), F.least(F.lit(BLOCK_MOST), F.col("n_groups") * F.col("n_groups")))
    per_lang = per_lang.select("lang", F.greatest(F.lit(1), F.ceil(F.col("nnz") / width)).cast("long").alias("blocks"))
    before = Window.orderBy("lang").rowsBetween(Window.unboundedPreceding, -1)
    per_lang = checkpoint(per_lang.withColumn("first_block", F.coalesce(F.sum("blocks").over(before), F.lit(0))))

    weighed = posted.join(groups, ["lang", "source"]).withColumns(
        {
            "p": share(F.col("n"), F.col("total"), F.col("kept")),
            "q": share(F.col("lang_n"), F.col("lang_total"), F.col("kept")),
        }
    )
    weighed = checkpoint(weighed.select("lang", "source", "term", "p", "q"))
    place = F.col("first_block") + F.pmod(F.xxhash64("term"), F.col("blocks"))
    entries = weighed.join(per_lang, "lang").select("lang", place.alias("block"), "term", "source", "p")
    every = F.explode(F.sequence(F.col("first_block"), F.col("first_block") + F.col("blocks") - 1))
    marks = groups.join(per_lang, "lang").select(
        "lang", every.alias("block"), F.lit(None).cast("string").alias("term"), "source", F.col("z").alias("p")
    )
    dealt = entries.unionByName(marks).repartition("block").sortWithinPartitions("block")
    sums = dealt.mapInArrow(_accumulate, "lang string, a string, b string, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    way = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = sums.select("lang", F.inline(way).alias("source", "item"), "value")
    above = weighed.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).cast("int")

    def part(frame: DataFrame, name: str) -> DataFrame:
        return frame.withColumn("rank", rank).select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    release(counted)  # everything below reads the index, the groups and the weights
    return part(pairs, "pair").unionByName(part(above, "term").filter(F.col("rank") <= top_terms))
