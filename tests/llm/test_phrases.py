import random
import re
from collections import Counter, defaultdict

import pytest

from geoweave.llm import phrases as module
from geoweave.llm.phrases import phrases


def brute(rows, min_count, max_words, percent, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        found = []
        for g, a in cand.items():
            longer = [b for h, b in cand.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if any(100 * b >= percent * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        total = sum(n for g, n in f.items() if len(g) == 1)
        for rank, (s, a, g, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, total, -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [*"abcdefgh", "É", "漢字", "the", "of", "x-1", "#"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "; "]
    out = [("en", None), (None, ""), ("de", " .,"), ("en", "The Of The of")]
    for _ in range(220):
        lang = "en" if rng.random() < 0.5 else rng.choice(["de", None, "und"])
        k = rng.randrange(30)
        out.append((lang, "".join(w + rng.choice(gaps) for w in rng.choices(words, weights=range(1, len(words) + 1), k=k))))
    return out + [("en", "new york city hall")] * 25 + [("en", "new york state")] * 9


@pytest.mark.parametrize(("max_words", "slice_bytes", "gathered"), [(3, 1 << 23, 1 << 21), (3, 13, 50), (4, 64, 1 << 21)])
def test_against_brute_force(spark, rows, monkeypatch, max_words, slice_bytes, gathered):
    monkeypatch.setattr(module, "SLICE", slice_bytes)  # long texts in overlapping parts
    monkeypatch.setattr(module, "GATHERED", gathered)
    monkeypatch.setattr(module, "LINES", 3)
    monkeypatch.setattr(module, "FEW_LANGS", 0 if max_words == 4 else 10_000)
    df = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, n int")
    got = sorted(map(tuple, phrases(df.repartition(5), min_count=6, max_words=max_words, top=40).collect()))
    assert got == brute(rows, 6, max_words, 50, 40)


def test_borders_of_partitions(spark, rows):
    # many range partitions: beginnings and extensions lie on their far sides
    df = spark.createDataFrame(rows, "lang string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = sorted(map(tuple, phrases(df, min_count=6).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == brute(rows, 6, 3, 50, 2000)


def test_large_counts_stay_exact(spark):
    # 38-digit products: a * a * scale beyond 64 bits
    df = spark.createDataFrame([("en", "a b " * 40_000)], "lang string, text string")
    got = {r.phrase: r for r in phrases(df, covered_percent=101, scale=10**9).collect()}
    assert got["a b"].score == 10**9 * 40_000**2 // (40_000 * 40_000)


def test_empty_table(spark):
    assert phrases(spark.createDataFrame([], "lang string, text string")).collect() == []
