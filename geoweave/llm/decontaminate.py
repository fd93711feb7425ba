"""Benchmark decontamination with SimHash windows and a multi-index Hamming search, all in
DataFrame functions.

Texts and benchmark items are words (runs of letters and digits, lower case) and runs of five
words. A window of a document is as long as the item it is held against. Only windows that share a
run of words with a benchmark item can reach any similarity above zero, so windows are laid where
such an anchor aligns them; every aligned window is taken.

1. anchors: word runs of all documents joined with those of the benchmark;
2. every window gets a 64-bit SimHash of its weighted runs (weight: letters of the run, times its
   occurrences). The 64 counters are summed in 32 long columns of two 32-bit lanes each;
3. multi-index Hamming search: fingerprints are cut into four blocks of 16 bits. Two fingerprints
   within ``radius`` bits agree in some block up to ``radius // 4`` bits, so the items are stored
   under all block values up to three bits away and each window looks up those within the rest.
   Every pair within the radius is found. The radius of 23 bits is set by the pairs at similarity 0.8: one changed word in
   60 turns about 10 bits, rarely more than 19;
4. candidates are verified by exact weighted Jaccard similarity of their runs.

Equal fingerprints are searched once. Benchmark and window tables are broadcast only when their
counted rows stay under ``broadcast_rows``; beyond that the same joins shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoweave.plans.iterate import checkpoint

BLOCKS = 4
BLOCK_BITS = 16
#: bits up to which items are stored around a block value: 697 rows a block, small enough to broadcast
STORED_BITS = 3


def words_of(text: str) -> Column:
    """Words of a text column: runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _runs(words: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order; fewer words give none."""
    hashed = lambda i: F.xxhash64(*(F.get(F.col(words), i + F.lit(k)) for k in range(size)))
    last = F.size(words) - F.lit(size)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), hashed)).otherwise(
        F.array().cast("array<long>")
    )


def _weighted_runs(words: str, size: int) -> Column:
    """``struct(h, wt)`` of all runs of ``size`` words; ``wt`` is the number of characters."""

    def one(i: Column) -> Column:
        parts = [F.get(F.col(words), i + F.lit(k)) for k in range(size)]
        return F.struct(
            F.xxhash64(*parts).alias("h"), reduce(lambda a, b: a + b, [F.length(p) for p in parts]).cast("long").alias("wt")
        )

    return F.transform(F.sequence(F.lit(0), F.size(words) - F.lit(size)), one)


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` plus ``fp`` (64-bit SimHash) and ``total`` from rows ``(keys, h, wt)``."""
    lanes = 0x0000000100000001
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(lanes)) * F.col("wt")).alias(f"_s{k}") for k in range(32)]
    counted = rows.groupBy(*keys).agg(F.sum("wt").alias("total"), *sums)
    bits = []
    for k in range(32):
        low = F.col(f"_s{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"_s{k}"), 32)
        bits.append(F.when(low * 2 > F.col("total"), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        value = (1 << (k + 32)) if k < 31 else -(1 << 63)
        bits.append(F.when(high * 2 > F.col("total"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    fp = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return counted.select(*keys, fp.alias("fp"), "total")


def _block_values(fp: str) -> Column:
    """The four ``(block, value)`` pairs of a fingerprint."""
    mask = (1 << BLOCK_BITS) - 1
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(F.col(fp), BLOCK_BITS * k).bitwiseAND(F.lit(mask)).cast("int").alias("value"),
            )
            for k in range(BLOCKS)
        )
    )


def hamming_pairs(queries: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Distinct ``(fp, item_fp)`` of two tables of distinct fingerprints within ``radius`` bits."""
    near = radius // BLOCKS
    stored = min(near, STORED_BITS)  # the probes turn the other bits: the two meet half way

    def around(bits: int) -> Column:
        masks = F.lit([m for m in range(1 << BLOCK_BITS) if m.bit_count() <= bits])
        return F.explode(F.transform(masks, lambda m: F.col("b.value").bitwiseXOR(m))).alias("value")

    index = items.select(F.col("fp").alias("item_fp"), F.explode(_block_values("fp")).alias("b")).select(
        "item_fp", F.col("b.block").alias("block"), around(stored)
    )
    probe = queries.select("fp", F.explode(_block_values("fp")).alias("b")).select("fp", "b.block", around(near - stored))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    return probe.join(index, ["block", "value"]).filter(distance <= radius).select("fp", "item_fp").distinct()


def _small(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    run_words: int = 5,
    num: int = 80,
    den: int = 100,
    radius: int = 23,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """``(id_col, item_col, start_word, n_words, hamming, similarity)``: for every document and item the
    best window whose weighted similarity is at least ``num / den``.

    ``start_word`` counts from 0; of equally similar windows the first is given. Null texts
    and those without a word match nothing; an item of fewer than ``run_words`` words is one run of its own and matches
    where it stands whole; repeated rows give one result; texts that share an item id, or have
    none, are held apart and the best is reported; rows with a null id are reported under null; empty tables give an empty result. Columns named like
    the results' do no harm: only the named columns are read.
    """
    src = _keyed(docs, id_col, text_col)
    best = _best_windows(src, benchmark, item_col, item_text_col, run_words, num, den, radius, broadcast_rows)
    ids = src.select("k", "doc").distinct()
    return ids.join(_small(best, broadcast_rows // 10), "k").select(
        F.col("doc").alias(id_col),
        F.col("item").alias(item_col),
        (-F.col("b.s")).alias("start_word"),
        F.col("b.len").alias("n_words"),
        (-F.col("b.d")).alias("hamming"),
        F.col("b.similarity").alias("similarity"),
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, text, k)`` of the rows with a text; ``k`` stands for id and text."""
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).filter("text is not null")
    return src.withColumn("k", F.xxhash64("doc", "text"))


def _best_windows(
    src: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, run_words: int, num: int, den: int, radius: int, broadcast_rows: int
) -> DataFrame:
    """``(k, item, b)``: the best window of every text key and item."""
    listed = benchmark.select(F.col(item_col).alias("item"), words_of(item_text_col).alias("w")).filter(F.size("w") > 0)
    # texts under one id, or under none, are items of their own
    listed = checkpoint(listed.distinct().withColumns({"ik": F.xxhash64("item", "w"), "len": F.size("w")}))
    items = listed.filter(F.col("len") >= run_words).drop("item")
    item_runs = items.select("ik", "len", F.posexplode(_weighted_runs("w", run_words)).alias("item_at", "r")).select(
        "ik", "len", "item_at", F.col("r.h").alias("h"), F.col("r.wt").alias("wt")
    )
    # the fewest runs of an item that can weigh num / den of it: its heaviest
    heavier = Window.partitionBy("ik").orderBy(F.desc("wt"), "item_at")
    weighed = item_runs.withColumns({"upto": F.sum("wt").over(heavier), "all": F.sum("wt").over(Window.partitionBy("ik"))})
    fewest = F.count_if((F.col("upto") - F.col("wt")) * den < F.col("all") * num).alias("need")
    needs = weighed.groupBy("ik", "len").agg(fewest)
    listed_runs = checkpoint(item_runs.select("ik", "h").distinct().join(needs, "ik"))

    # 1. windows: every start from which enough runs of the item lie inside
    doc_runs = src.withColumn("w", words_of("text")).select("k", F.posexplode(_runs("w", run_words)).alias("at", "h"))
    anchors = doc_runs.join(_small(listed_runs, broadcast_rows), "h").select("k", "ik", "len", "need", "at").distinct()
    anchors = checkpoint(anchors.withColumn("nr", F.row_number().over(Window.partitionBy("k", "ik").orderBy("at"))))
    reach = F.col("len") - run_words  # from the first to the last run of a window
    last = anchors.select("k", "ik", F.col("at").alias("_to"), F.col("nr").alias("_nr"))
    enough = anchors.withColumn("_nr", F.col("nr") + F.col("need") - 1).join(last, ["k", "ik", "_nr"]).filter(F.col("_to") - F.col("at") <= reach)
    starts = F.explode(F.sequence(F.greatest(F.col("_to") - reach, F.lit(0)), F.col("at")))
    windows = checkpoint(enough.select("k", starts.alias("start"), "len").distinct())

    # 2. fingerprints
    in_text = windows.groupBy("k").agg(F.collect_set(F.struct("start", "len")).alias("spans"))
    spans = (
        src.select("k", "text").join(_small(in_text, broadcast_rows // 10), "k")
        .select("k", words_of("text").alias("w"), F.explode("spans").alias("s"))
        .select("k", "s.start", "s.len", F.expr("slice(w, s.start + 1, s.len)").alias("v"))
        .filter(F.size("v") >= run_words)
    )
    key = ["k", "start", "len"]
    # repeated rows share the key k
    counted = spans.dropDuplicates(key).select(*key, F.explode(_weighted_runs("v", run_words)).alias("r"))
    counted = checkpoint(counted.select(*key, F.col("r.h").alias("h"), F.col("r.wt").alias("wt")).groupBy(*key, "h").agg(F.sum("wt").alias("wt")))
    prints = checkpoint(simhash(counted, key))
    item_counted = checkpoint(
        items.select("ik", F.explode(_weighted_runs("w", run_words)).alias("r"))
        .select("ik", F.col("r.h").alias("h"), F.col("r.wt").alias("wt"))
        .groupBy("ik", "h")
        .agg(F.sum("wt").alias("wt"))
    )
    item_prints = checkpoint(simhash(item_counted, ["ik"]))

    # 3. all fingerprint pairs within the radius
    pairs = hamming_pairs(prints.select("fp").distinct(), item_prints.select("fp").distinct(), radius)
    lengths = items.select("ik", F.col("len").alias("item_len"))
    named = item_prints.join(lengths, "ik").select("ik", "item_len", F.col("fp").alias("item_fp"), F.col("total").alias("item_total"))
    candidates = (
        prints.join(pairs.join(named, "item_fp"), "fp")
        .filter(F.col("len") == F.col("item_len"))
        .select(*key, "total", "ik", "item_total", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("hamming"))
    )

    # 4. exact weighted similarity
    shared = (
        candidates.join(counted, key)
        .join(item_counted.withColumnRenamed("wt", "item_wt"), ["ik", "h"])
        .groupBy(*key, "ik", "total", "item_total", "hamming")
        .agg(F.sum(F.least("wt", "item_wt")).alias("inter"))
    )
    union = F.col("total") + F.col("item_total") - F.col("inter")
    found = shared.filter(F.lit(den) * F.col("inter") >= F.lit(num) * union).select(
        "k", "ik", "start", "len", "hamming", (F.col("inter") / union).alias("similarity")
    )
    found = found.unionByName(_short_items(src, listed.filter(F.col("len") < run_words), broadcast_rows))
    best = found.join(_small(listed.select("ik", "item"), broadcast_rows), "ik").groupBy("k", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("hamming")).alias("d"), "len")).alias("b")
    )
    return checkpoint(best)


def _short_items(src: DataFrame, short: DataFrame, broadcast_rows: int) -> DataFrame:
    """First place of items shorter than a run, which are one run of their own: found whole or not at all."""
    out = None
    for n in sorted(r[0] for r in short.select("len").distinct().collect()):  # fewer lengths than run_words
        run = short.filter(F.col("len") == n).select("ik", _runs("w", n)[0].alias("h"))
        runs = src.withColumn("w", words_of("text")).select("k", F.posexplode(_runs("w", n)).alias("start", "h"))
        first = runs.join(_small(run, broadcast_rows), "h").groupBy("k", "ik").agg(F.min("start").alias("start"))
        out = first.withColumn("len", F.lit(n)) if out is None else out.unionByName(first.withColumn("len", F.lit(n)))
    if out is None:
        out = src.sparkSession.createDataFrame([], "k long, ik long, start int, len int")
    return out.withColumns({"hamming": F.lit(0), "similarity": F.lit(1.0)})


def drop_contaminated_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    run_words: int = 5,
    num: int = 80,
    den: int = 100,
    radius: int = 23,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """Rows of ``docs`` whose own text has no contaminated window, whatever other rows with the same id or
    without an id hold; rows with a null text stay."""
    src = _keyed(docs, id_col, text_col)
    best = _best_windows(src, benchmark, item_col, item_text_col, run_words, num, den, radius, broadcast_rows)
    hits = checkpoint(best.select(F.col("k").alias("_hit")).distinct())
    own = F.when(F.col(text_col).isNotNull(), F.xxhash64(id_col, text_col))
    return docs.join(hits, own == F.col("_hit"), "left_anti")
