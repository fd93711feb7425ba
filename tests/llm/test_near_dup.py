import random
import re

import numpy as np
import pytest

from geoweave.llm import minhash
from geoweave.llm.embedding_join import near_vectors
from geoweave.llm.minhash import Banding, near_duplicates


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, size, num, den):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    ids = list(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, components(ids, links)


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for group in (1, 1, 2, 5, 40, 60):
        base = [rng.choice(vocab) for _ in range(rng.randint(30, 200))]
        for _ in range(group):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 12))):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "  ", "\n"]).join(t).replace("w1", "W1")))
            i += 1
    rows += [(i + k, t) for k, t in enumerate([None, "", " \t\n", "a", "a", "A b", "a  b", "a b c", "É x y", "é x y", rows[3][1], rows[3][1].upper()])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,num,block", [(3, 85, 512), (5, 80, 16)])
def test_minhash_against_brute_force(spark, monkeypatch, size, num, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    rows = corpus()
    n, want = brute(rows, size, num, 100)
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, component_id string, n long")
    got = near_duplicates(df, banding=Banding(size=size, num=num, den=100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (n[i], want[i], want[i] == i) for i in want}


def test_minhash_repeated_rows_nulls_and_long_text(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (3, "x " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, None, True), (2, 1, False), (3, 3, True)], key=repr)
    assert near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("dim,kind", [(64, "float"), (10, "double")])
def test_vectors_against_brute_force(spark, dim, kind):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, dim))
    x[100:160] = x[7] + rng.standard_normal((60, dim)) * 0.14
    x[160:170] = x[8] * 3
    x = x.astype(np.float32 if kind == "float" else np.float64)
    label = [int(k) if k < 3 else None for k in rng.integers(0, 4, 300)]
    rows = [(i, x[i].tolist(), label[i], 1) for i in range(300)]
    rows += [(300, None, 0, 1), (301, [], 0, 1), (302, [0.0] * dim, 0, 1), (303, [float("nan")] + [1.0] * (dim - 1), 0, 1), (304, [None] + [1.0] * (dim - 1), 0, 1), (305, [1.0], 0, 1)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n_links int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.98
    links = [(a, b) for a in range(300) for b in range(a + 1, 300) if near[a, b] and label[a] is not None and label[a] == label[b]]
    comp = components(range(306), links)
    count = {i: sum(i in l for l in links) for i in range(306)}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert got == {i: (count[i], comp[i], comp[i] == i) for i in range(306)}
    twice = near_vectors(df.union(df).union(spark.createDataFrame([(None, [1.0] * dim, 0, 1)], df.schema))).collect()
    assert len(twice) == 613 and {r.vec_id: r.n_links for r in twice if r.vec_id is not None} == count
    assert near_vectors(df.limit(0)).collect() == []
