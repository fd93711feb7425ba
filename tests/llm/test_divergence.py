import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from geoweave.llm import divergence as module
from geoweave.llm.divergence import cuts, divergence, row_sums, tallies

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, min_docs, smoothing, scale, top):
    rows = [(lang or "", source or "", Counter(TERM.findall(fold(text)))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for la, _, c in rows if la == lang for t in c)
        kept = {t for t, n in docs.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for la, source, c in rows:
            if la == lang:
                for key in ((source,), "all"):
                    counts[key].update({t: n for t, n in c.items() if t in kept})
        p = {}
        for key, c in counts.items():
            total = sum(c.values())
            p[key] = {t: 1 + scale * (c[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}
        for key in counts:
            if key == "all":
                continue
            pairs = [(-sum(abs(p[key][t] - p[o][t]) for t in kept), o[0]) for o in counts if o not in (key, "all")]
            terms = [(p["all"][t] - p[key][t], t) for t in kept if counts[key][t] and p[key][t] > p["all"][t]]
            for part, items in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                items = sorted(items, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, key[0], part, item, -v, k) for k, (v, item) in enumerate(items, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "漢字", "Z"]
    out = [(None, None, "only junk 1 2 3"), ("xx", "a", "few words"), ("xx", "b", None), ("en", "empty", None), ("en", "empty", "123")]
    for _ in range(300):
        lang = rng.choice(["en", "en", "de", None])
        source = "hot" if rng.random() < 0.4 else rng.choice([None, "a", "b", "Ω", "c d"])
        k = rng.randrange(40)
        out.append((lang, source, rng.choice([" ", ", ", "3"]).join(rng.choices(words, weights=range(1, len(words) + 1), k=k))))
    return out + out[-20:]


@pytest.mark.parametrize("least", [4, 1 << 15])
def test_against_brute_force(spark, rows, monkeypatch, least):
    monkeypatch.setattr(module, "BLOCK_LEAST", least)  # a few terms per block, and all in one
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, source string, text string, rank string")
    got = sorted(map(tuple, divergence(df, min_docs=12, top_terms=5).collect()))
    assert got == brute(rows, 12, 5, 1_000_000_000, 5)


def test_row_accumulation():
    rng = np.random.default_rng(1)
    z = rng.integers(1, 50, 6)
    dense = np.where(rng.random((9, 6)) < 0.5, rng.integers(1, 100, (9, 6)), -1)
    term, group = np.nonzero(dense >= 0)
    p = dense[term, group]
    full = np.where(dense >= 0, dense, z)
    shuffled = rng.permutation(len(p))
    n_terms = int(term.max()) + 1
    sums = dict(row_sums(term[shuffled], group[shuffled], p[shuffled], z))
    for i in range(6):
        for j in range(6):
            if i != j:
                assert sums[i][j] + sums[j][i] == np.abs(full[:n_terms, i] - full[:n_terms, j]).sum()


def test_long_text_counts_as_one_document(monkeypatch):
    monkeypatch.setattr(module, "SLICE", 16)
    text = "alpha beta alpha gamma-alpha" * 5 + "x" * 50
    found = {}
    for part in tallies(pa.array(["one two", text, None, ""]), np.array([0, 1, 1, 0])):
        for row in part.to_pylist():
            key = row["group"], row["term"]
            n, d = found.get(key, (0, 0))
            found[key] = n + row["n"], d + row["docs"]
    want = Counter(TERM.findall(text))
    assert {t: n for (g, t), (n, _) in found.items() if g == 1} == dict(want)
    assert {d for _, d in found.values()} == {1}
    data = np.frombuffer(text.encode(), np.uint8)
    assert b"".join(bytes(c) for c in cuts(data, 16)) == text.encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence(df).collect() == []
