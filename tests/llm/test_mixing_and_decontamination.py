import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from geoweave.llm import decontaminate as D
from geoweave.llm import mixing as M


# ---- mixing ----------------------------------------------------------------------------------


def corpus(spark, sizes, extra=()):
    rng = random.Random(1)
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join("w" * 1 for _ in range(rng.randint(1, 30))), source, "x"))
            i += 1
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string, source string, weight string")


def entropy(w):
    return -sum(x * math.log(x) for x in w if x > 0)


def test_weights_meet_entropy_and_repetition(spark):
    stats = spark.createDataFrame([("a", 9000), ("b", 500), ("c", 300), ("d", 200), ("e", 0)], "source string, tokens long")
    w, x = M.source_weights(stats, 10_000, entropy_share=0.8, max_repeats=None)
    got = {r.source: r.weight for r in w.collect()}
    assert abs(sum(got.values()) - 1) < 1e-9 and got["e"] == 0
    assert abs(entropy(got.values()) - 0.8 * math.log(4)) < 1e-6 and 0 < x < 1
    share = [9000**x, 500**x, 300**x, 200**x]
    assert all(abs(got[s] - v / sum(share)) < 1e-9 for s, v in zip("abcd", share))
    w, y = M.source_weights(stats, 10_000, entropy_share=0.8, max_repeats=3.0)
    repeats = {r.source: r.repeats for r in w.collect()}
    assert max(repeats.values()) <= 3.0 + 1e-6 and max(repeats.values()) > 2.99 and y > x
    w, z = M.source_weights(stats, 10_000, entropy_share=None, max_repeats=None)
    assert z == 1.0 and abs({r.source: r.weight for r in w.collect()}["a"] - 0.9) < 1e-9


def test_mix_realises_the_budget(spark):
    d = corpus(spark, {"big": 600, "mid": 150, "small": 60})
    tokens = {r.source: r.t for r in d.groupBy("source").agg(F.sum(M.token_column("text")).alias("t")).collect()}
    total = sum(tokens.values())
    rows = M.mix(d, n_blocks=8).collect()
    used, uses, per_block = Counter(), defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        used[r.source] += r.n_tokens
        uses[r.source][r.doc_id] += 1
        per_block[r.block][r.source] += r.n_tokens
    weight = {r.source: r.weight for r in rows}
    for s in tokens:
        assert abs(used[s] - weight[s] * total) <= 31  # at most the document that crosses the budget
        n = weight[s] * total / tokens[s]
        assert set(uses[s].values()) <= {math.floor(n), math.ceil(n)}
        if n >= 1:
            assert len(uses[s]) == {"big": 600, "mid": 150, "small": 60}[s]
    assert sorted(per_block) == list(range(8))
    for block in per_block.values():
        for s in tokens:
            assert abs(block[s] / sum(block.values()) - weight[s]) < 0.08
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    again = M.mix(d.repartition(7), n_blocks=8).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_edges(spark):
    extra = [(900, None, "a", "x"), (901, "", "a", "x"), (902, "w w", None, "x"), (None, "w", "a", "x"), (903, None, "none", "x"), (904, "w " * 50_000, "a", "x"), (905, "w", "a", "x"), (905, "w", "a", "x")]
    rows = M.mix(corpus(spark, {"a": 20, "b": 20}, extra)).collect()
    assert not any(r.source == "none" for r in rows)
    assert any(r.source is None and r.doc_id == 902 for r in rows)
    assert M.mix(corpus(spark, {"a": 1}).limit(0)).collect() == []
    only = M.mix(corpus(spark, {"a": 30})).collect()
    assert len(only) == 30 and {r.epoch for r in only} == {1}


# ---- decontamination -------------------------------------------------------------------------


def brute(docs, items, size=5):
    def words(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    def bag(w):
        c = Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
        return {g: n * sum(map(len, g)) for g, n in c.items()}

    best = {}
    for d, t in docs:
        w = words(t)
        for i, s in items:
            v = words(s)
            b = bag(v)
            for a in range(max(1, len(w) - size + 1)):
                x = bag(w[a : a + len(v)])
                inter = sum(min(n, b[g]) for g, n in x.items() if g in b)
                if not inter:
                    continue
                union = sum(x.values()) + sum(b.values()) - inter
                if 100 * inter >= 80 * union:
                    best[d, i] = max(best.get((d, i), 0), inter / union)
    return best


def test_contaminated_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "é", "tu") for b in ("ra", "so", "ne", "va", "x1")]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(rng.randint(12, 40))) for i in range(12)] + [(50, text(3)), (51, [])]
    items.append((60, list(items[0][1])))
    docs = [(d, text(rng.randint(5, 80))) for d in range(40)]
    for d in range(100, 130):
        i, w = items[rng.randrange(12)]
        w = list(w)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        docs.append((d, text(rng.randint(0, 30)) + w + text(rng.randint(0, 30))))
    join = lambda w: rng.choice([" ", ", ", "\n"]).join(w).title()
    docs = [(d, join(w)) for d, w in docs] + [(200, None), (201, ""), (202, "ka " * 50_000), (100, docs[3][0] and "again")]
    items = [(i, " ".join(w)) for i, w in items]
    df = spark.createDataFrame([(d, t, "z") for d, t in docs], "doc_id long, text string, item_id string")
    bm = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(df, bm).collect()}
    assert set(got) <= set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert set(got) == set(want)  # over all starts
    exact = {k for k, v in want.items() if v > 0.999}
    assert exact and exact <= set(got)
    left = D.drop_contaminated_rows(df, bm).collect()
    assert {r.doc_id for r in left} - {100} == {d for d, _ in docs} - {d for d, _ in got} - {100}
    assert D.contaminated(df.limit(0), bm).collect() == [] and D.contaminated(df, bm.limit(0)).collect() == []


def test_edited_passages_are_all_found(spark):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("aeioukmnrst") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items, docs, want = [], [], {}
    for i in range(240):
        n, edits = rng.choice([(rng.randint(45, 60), 1), (rng.randint(150, 200), 3)])
        w = text(n)
        e = list(w)
        for at in rng.sample(range(n), edits):
            e[at] = rng.choice(vocab)
        items.append((i, " ".join(w)))
        docs.append((i, " ".join(text(3) + e + text(4))))
        # the window aligned by the unchanged words; shifted ones are not laid
        x, y = ({tuple(v[k : k + 5]) for k in range(n - 4)} for v in (w, e))
        share = sum(len("".join(g)) for g in x & y) / sum(len("".join(g)) for g in x | y)
        if share >= 0.8:
            want[i, i] = share
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 160 and set(got) >= set(want)
    assert all(got[k] > want[k] - 1e-9 for k in want)


def test_edits_at_the_ends_and_moved_parts_are_all_found(spark):
    rng = random.Random(23)
    vocab = ["".join(rng.choice("aeioukmnrst") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items, docs = [], []
    for i in range(150):
        w = text(rng.randint(30, 70))
        e = list(w)
        kind = i % 5
        if kind == 0:  # words lost or put in near an end
            at = rng.choice([1, 2, len(e) - 3])
            e[at : at + rng.randint(0, 3)] = text(rng.randint(0, 3))
        elif kind == 1:  # the text starts or ends inside the passage
            e = e[rng.randint(0, 5) :] if rng.random() < 0.5 else e[: len(e) - rng.randint(0, 5)]
        elif kind == 2:  # halves change places
            h = len(e) // 2
            e = e[h:] + e[:h]
        elif kind == 3:
            e[rng.randrange(3)], e[-1 - rng.randrange(3)] = text(2)
        around = (0, 0) if kind == 1 else (rng.randint(0, 20), rng.randint(0, 20))
        items.append((i, " ".join(w)))
        docs.append((i, " ".join(text(around[0]) + e + text(around[1]))))
    want = brute(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 100 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("radius", [3, 7, 15])
def test_hamming_index_finds_all_within_radius(spark, radius):
    rng = random.Random(radius)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(30)]
    near = []
    for b in base:
        for flips in (0, radius // 2, radius, radius + 1):
            x = b
            for k in rng.sample(range(64), flips):
                x ^= 1 << k
            near.append(x)
    a = spark.createDataFrame([(signed(x),) for x in near], "fp long").distinct()
    b = spark.createDataFrame([(signed(x),) for x in base], "fp long").distinct()
    got = {(r.fp, r.item_fp) for r in D.hamming_pairs(a, b, radius).collect()}
    assert got == {(signed(x), signed(y)) for x in near for y in base if (x ^ y).bit_count() <= radius}


def test_simhash_against_definition(spark):
    rng = random.Random(9)
    rows = [(w, rng.getrandbits(64) - (1 << 63), rng.randint(1, 40)) for w in range(6) for _ in range(rng.randint(1, 30))]
    got = {r.w: (r.fp, r.total) for r in D.simhash(spark.createDataFrame(rows, "w long, h long, wt long"), ["w"]).collect()}
    for w in range(6):
        mine = [(h & (2**64 - 1), t) for x, h, t in rows if x == w]
        total = sum(t for _, t in mine)
        fp = sum(1 << k for k in range(64) if 2 * sum(t for h, t in mine if h >> k & 1) > total)
        assert got[w] == (fp - (1 << 64) if fp >> 63 else fp, total)


def test_null_id_rows(spark):
    item = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(None, item), (None, "clean text"), (1, "clean " + item)], "doc_id long, text string")
    bm = spark.createDataFrame([(0, item)], "item_id long, text string")
    assert {r.doc_id for r in D.contaminated(df, bm).collect()} == {None, 1}
    assert [r.text for r in D.drop_contaminated_rows(df, bm).collect()] == ["clean text"]


def test_rows_are_judged_by_their_own_text(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, item), (None, "clean text"), (None, None), (1, "clean " + item), (1, "other clean text"), (2, item), (2, item), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bm = spark.createDataFrame([(0, item)], "item_id long, text string")
    left = corpus_pipeline.drop_contaminated_rows(df, bm)
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([(None, "clean text"), (None, None), (1, "other clean text"), (3, "")], key=repr)


def test_odd_items_are_all_searched(spark):
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen fifteen", "red green blue black white pink")
    items = [(None, a), (None, c), (7, a), (7, b), (7, b), (8, "Solar wind!"), (9, "你好"), (10, "..."), (None, None)]
    docs = [(1, "x " + a), (2, "y y " + b + " z"), (3, c), (4, "the solar wind, a solar wind"), (5, "你好"), (6, "solar x wind"), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.start_word, r.n_words, r.similarity) for r in got), key=repr) == sorted(
        [(1, None, 1, 7, 1.0), (1, 7, 1, 7, 1.0), (2, 7, 2, 8, 1.0), (3, None, 0, 6, 1.0), (4, 8, 1, 2, 1.0), (5, 9, 0, 1, 1.0)], key=repr
    )
