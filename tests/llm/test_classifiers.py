import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoweave.llm import language, quality, toxicity
from geoweave.llm.toxicity import GRAMMAR, INSULT, NEGATED, OUTCOMES, REPORTED, TARGETED, THREAT, Lexicon, outcomes, seed_lexicon

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


# ---- toxicity --------------------------------------------------------------------------------


def outcome(text):
    x = outcomes(text, seed_lexicon())
    return {OUTCOMES[i] for i in np.flatnonzero(x)}


@pytest.mark.parametrize(
    "text,want",
    [
        ("what an idiot.", {(INSULT, 0)}),
        ("you are an idiot", {(INSULT, TARGETED)}),
        ("you are not an idiot", {(INSULT, TARGETED | NEGATED)}),
        ("he said you idiot", {(INSULT, TARGETED | REPORTED)}),
        ("you. an idiot", {(INSULT, 0)}),
        ("we kill time", set()),
        ("they will kill us", {(THREAT, TARGETED)}),
        ("not one two three four five idiot", {(INSULT, 0)}),
        ("IDIOT! MORON", {(INSULT, 0)}),
        ("", set()),
        ("idiots' clownfish", {(INSULT, 0)}),
    ],
)
def test_grammar_outcomes(text, want):
    assert outcome(text) == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("I will kill you", {(THREAT, TARGETED)}),
        ("kill them all", {(THREAT, TARGETED)}),
        ("te mataré", {(THREAT, TARGETED)}),
        ("je vais te tuer", {(THREAT, TARGETED)}),
        ("never kill or hurt you", {(THREAT, TARGETED | NEGATED)}),
        ("he is gone, it is said, we murder you", {(THREAT, TARGETED | REPORTED)}),
        ("kill one two three you", {(THREAT, TARGETED)}),
        ("kill one two three four you", set()),
        ("kill. you", set()),
        ("kill a moron you", {(INSULT, 0), (THREAT, TARGETED)}),
    ],
)
def test_threats_before_their_target(text, want):
    assert outcome(text) == want


def test_waiting_threats_keep_their_strength():
    x = outcomes("kill and murder you", seed_lexicon())
    assert x[OUTCOMES.index((THREAT, TARGETED))] == 3 and x.sum() == 3
    assert outcomes("kill you. murder you", seed_lexicon()).sum() == 6


def test_composed_machine_equals_chain():
    chain = [toxicity._fades(toxicity.TARGET, TARGETED, 4), toxicity._fades(toxicity.NEGATION, NEGATED, 3), toxicity._lasts(toxicity.REPORT, REPORTED), toxicity._matches()]
    rng = random.Random(4)
    for _ in range(300):
        word = [rng.randrange(6) for _ in range(rng.randint(0, 12))]
        state, states = 0, [0] * 4
        for s in word:
            token = (s, 0)
            for k, t in enumerate(chain):
                states[k], token = t.step(states[k], token)
            assert GRAMMAR.out[state][s] == token
            state = GRAMMAR.next[state][s]


@pytest.fixture(scope="module")
def learnt(docs):
    return toxicity.learn(*docs)


def outcome_by_definition(text, lexicon):
    """Outcomes of a text word by word, without transducers: windows looked up in the clause itself."""
    total = {}
    for clause in toxicity._CLAUSE.split(text.lower()):
        found = [lexicon.look_up(w) or (toxicity.OTHER, 0.0) for w in toxicity._WORD.findall(clause)]
        best, waiting = {}, None
        for i, (symbol, strength) in enumerate(found):
            if symbol == toxicity.TARGET and waiting is not None and i - waiting[-1][0] <= 4:
                key = (THREAT, waiting[-1][2] | TARGETED)
                best[key] = max(best.get(key, 0), *(s for k, s, _ in waiting if i - k <= 4))
                waiting = None
            if symbol not in (INSULT, THREAT):
                continue
            flags = TARGETED if any(s == toxicity.TARGET for s, _ in found[max(i - 4, 0) : i]) else 0
            flags |= NEGATED if any(s == toxicity.NEGATION for s, _ in found[max(i - 3, 0) : i]) else 0
            flags |= REPORTED if any(s == toxicity.REPORT for s, _ in found[:i]) else 0
            if symbol == THREAT and not flags & TARGETED:
                waiting = [*(waiting or []), (i, strength, flags)]
            else:
                best[symbol, flags] = max(best.get((symbol, flags), 0), strength)
        for key, s in best.items():
            total[key] = total.get(key, 0) + s
    return total


def test_scores_by_definition(learnt):
    rng = random.Random(11)
    words = ["idiot", "trash", "kill", "hurt", "you", "them", "not", "never", "said", "sky", "blue", "the", "."]
    factor = {0: 1.0, 1: 1.5}
    for _ in range(400):
        text = " ".join(rng.choices(words, k=rng.randint(0, 25)))
        z = learnt.offset
        scale = learnt.weights[OUTCOMES.index((INSULT, 0))]
        for (kind, flags), s in outcome_by_definition(text, learnt.lexicon).items():
            w = factor[int(kind == THREAT)] * (1.25 if flags & TARGETED else 1) * (0.1 if flags & NEGATED else 1) * (0.15 if flags & REPORTED else 1)
            z += scale * w * np.log1p(s)
        assert abs(learnt.score(text) - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


@pytest.mark.parametrize(
    "plain,softened",
    [
        ("you are an idiot", "you are not an idiot, my friend"),
        ("she is stupid", "he said she is stupid"),
        ("what a pathetic clown", "the paper quoted him, what a pathetic clown"),
        ("I will kill you", "I would never kill you"),
        ("I will kill you", "he wrote I will kill you"),
        ("you are trash. you are a moron", "you are not trash. you are not a moron"),
    ],
)
def test_negated_and_reported_clauses_score_low(learnt, plain, softened):
    assert learnt.score(softened) < 0.5 < learnt.score(plain)


def test_marks_of_all_symbols_are_learnt(spark):
    noise = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rng = random.Random(5)

    def prose(n=14):
        return " ".join(rng.choices(noise, k=n))

    toxic = [f"{prose()}. zorgo you are an idiot. {prose()} grunfel you {prose(6)}" for _ in range(60)]
    clean = [f"{prose()}. nixo idiot {prose(3)}. {prose()}. teller {prose(5)} moron" for _ in range(120)] + [f"{prose()} nixo {prose()}" for _ in range(60)]
    toxic = [t.replace("zorgo you are an idiot", "zorgo idiot") for t in toxic]
    rows = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in clean], "text string, y int")
    lex = toxicity.learn_lexicon(rows)
    symbol = {w: lex.known(w)[0] for w in ("idiot", "grunfel", "nixo", "teller", "you") if lex.known(w)}
    assert symbol["idiot"] == INSULT and symbol["you"] == toxicity.TARGET
    assert symbol["nixo"] == toxicity.NEGATION and symbol["teller"] == toxicity.REPORT
    assert symbol["grunfel"] in (INSULT, THREAT)
    assert all(lex.known(w) is None for w in noise)


def test_contexts_count_places():
    got = toxicity.contexts("You are an idiot. a b c d e idiot you", seed_lexicon())
    assert got["you"] == [2, 0, 0, 1, 1, 0] and got["idiot"] == [2, 2, 2, 0, 0, 0]
    assert got["a"] == [1, 0, 0, 0, 0, 1] and got["b"] == [1, 0, 0, 1, 0, 1] and got["e"] == [1, 0, 0, 1, 1, 0]


def test_learning_rows_of_a_hot_id_and_of_copies(spark):
    opening = "this line opens every text of the file and is longer than forty characters "
    base = " ".join(f"x{i}" for i in range(200))
    rows = [(1, f"{opening} {i}") for i in range(500)] + [(2, base), (3, base + " end"), (5, opening + "one two three four five six seven")]
    rows += [(i, opening + " ".join(f"y{i}z{k}" for k in range(40))) for i in range(10, 30)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in {r[0] for r in rows}], "doc_id long, toxic int")
    labels = labels.withColumn("toxic", F.when(F.col("doc_id").isin(2, 3), 0).otherwise(F.col("toxic")))
    got = toxicity.labelled_rows(d, labels, "doc_id", "text", "toxic", 100).collect()
    learnable = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").count()
    copies = labels.filter("doc_id in (2, 3) and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").count()
    assert len(got) == learnable - max(copies - 1, 0)  # openings in common are no copies


def test_lexicon_beginnings():
    lex = Lexicon({"trash": (INSULT, 4.0)}, {"lowei": (INSULT, 6.0)})
    assert lex.known("loweiscop") == (INSULT, 6.0) and lex.known("lowe") is None and lex.known("trash") == (INSULT, 4.0)


def test_toxicity_held_out_accuracy(docs):
    d, labels = docs
    got = toxicity.toxicity(d, labels).join(labels, "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    right = {y: [r.predicted == y for r in got if r.toxic == y] for y in (0, 1)}
    # 6 of the 97 held-out toxic rows hold no toxic word at all (loops, shouting): 0.938 is the most any lexicon reaches
    assert np.mean(right[1]) >= 0.92 and np.mean(right[0]) >= 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_edges(spark):
    rows = [(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "fine"), (4, "word " * 100_000 + "you moron")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(d, none).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 6 and by[1] == by[2] == by[None] < by[3] and by[4] > by[1]
    assert toxicity.toxicity(d.limit(0), none).collect() == []


# ---- language --------------------------------------------------------------------------------


def test_language_held_out_accuracy(docs):
    d, _ = docs
    got = language.identify(d, keep=["doc_id", "lang", "text"]).filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) >= 0.97
    long = [r.lang_pred == r.lang for r in got if len(r.text) > 200]
    assert np.mean(long) >= 0.99


def test_language_edges(spark):
    en, fr = "the of and thing with that ", "le une avec dans être çà "
    rows = [(i, en * (i % 5 + 1), "en") for i in range(60)] + [(100 + i, fr * (i % 5 + 1), "fr") for i in range(60)]
    rows += [(300, None, "en"), (301, "", "en"), (302, "12 ... 34", "en"), (303, fr * 20_000, None), (None, en, "en"), (304, en, None), (304, en, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(9))
    got = language.identify(d).collect()
    by = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows) and by[300] == by[301] == by[302] == "und"
    assert by[303] == "fr" and by[304] == "en" and by[None] == "en"
    assert language.identify(d.limit(0)).collect() == []
    unlabelled = language.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_kernel_equals_definition():
    texts = ["abc ab", "abd", "xyz"]
    x = language.presence(texts)
    def grams(t):
        return {t[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1) if not (t[i] == " " and t[i + n - 1] == " ")}
    for i in range(3):
        for j in range(3):
            assert x[i] @ x[j] >= len(grams(texts[i]) & grams(texts[j])) - 1e-6
            assert abs(x[i] @ x[j] - len(grams(texts[i]) & grams(texts[j]))) <= 1  # a hash may coincide


def test_presence_of_long_texts_in_pieces(monkeypatch):
    texts = ["The quick brown fox: über 12 Füße! " * 9, "", "ab", "ΑΣ ΣΑ " * 20]
    whole = language.presence(texts)
    monkeypatch.setattr(language, "_BATCH_CHARS", 17)
    assert (language.presence(texts) == whole).all()


def test_language_learning_rows_of_hot_ids_and_many_languages(spark):
    rows = [(7, f"hot text {i}", "en") for i in range(3000)] + [(i, f"text {i}", "en") for i in range(100, 200)]
    rows += [(1000 + i, "junk", f"tag{i:03}") for i in range(200)] + [(None, "no id", "en"), (8, None, "en"), (9, "x", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.learning_rows(d, "doc_id", "text", "lang", 300, 5, 6000).collect()
    learn = {r[0] for r in rows if r[0] is not None and __import__("zlib").crc32(str(r[0]).encode()) % 5}
    junk = sorted(t for i, _, t in rows if i in learn and i >= 1000)[:4]
    assert sorted(r.id for r in got if r.lang == "en") == sorted(i for i in learn if i == 7 or 100 <= i < 200)
    assert sorted(r.lang for r in got if r.lang != "en") == junk
    assert [r.text for r in got if r.id == 7] in (["hot text 0"], [])
    few = language.learning_rows(d, "doc_id", "text", "lang", 300, 1, 20).count()
    assert 1 <= few <= 60


# ---- quality ---------------------------------------------------------------------------------


def test_labelled_rows_of_a_hot_id(spark):
    rows = [(7, f"hot text {i}") for i in range(3000)] + [(i, f"text {i}") for i in range(100, 120)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in {r[0] for r in rows}] * 2, "doc_id long, quality int")
    got = {r.doc_id: r.text for r in quality.labelled(d, labels, "doc_id", "quality", 1, 100).collect()}
    learn = [i for i in {r[0] for r in rows} if __import__("zlib").crc32(str(i).encode()) % 5]
    assert got == {i: "hot text 0" if i == 7 else f"text {i}" for i in learn}


def test_quality_held_out_accuracy_and_sampling(docs):
    d, labels = docs
    got = quality.resample(quality.quality_scores(d, labels)).join(labels, "doc_id").collect()
    held = [r for r in got if __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0]
    right = {y: [r.accepted == bool(y) for r in held if r.quality == y] for y in (0, 1)}
    assert np.mean(right[1]) >= 0.97 and np.mean(right[0]) >= 0.9
    assert all(not r.sampled or r.accepted for r in got)


def test_gumbel_top_k_against_brute_force(spark):
    rows = [(i, float(i % 7), i % 3 != 0) for i in range(200)] + [(500, 1.0, True), (500, 1.0, True)]
    s = spark.createDataFrame(rows, "doc_id long, log_weight double, accepted boolean")
    got = quality.resample(s, fraction=0.3).collect()
    keep = sorted([r for r in got if r.accepted], key=lambda r: (-r.gumbel_key, r.doc_id))
    assert sorted(r.rank for r in keep) == list(range(1, len(keep) + 1))
    assert [r.doc_id for r in sorted(keep, key=lambda r: r["rank"])] == [r.doc_id for r in keep]
    assert sum(r.sampled for r in got) == -(-3 * len(keep) // 10)
    assert all(r["rank"] is None and not r.sampled for r in got if not r.accepted)


def test_quality_edges(spark):
    clean = "the of and thing with that word. "
    rows = [(i, clean * (i % 4 + 1)) for i in range(40)] + [(100 + i, "x!!! y%%% z### " * (i % 4 + 1)) for i in range(20)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, clean), (303, clean * 20_000), (304, clean), (304, clean)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("log_weight", F.lit("x"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(20)] + [(None, 1), (5, None)], "doc_id long, quality int")
    by = {}
    got = quality.quality_scores(d, labels).collect()
    for r in got:
        by[r.doc_id] = r
    assert len(got) == len(rows)
    assert not any(by[k].accepted for k in (300, 301, 302, 105)) and all(by[k].accepted for k in (3, 303, 304, None))
    assert quality.quality_scores(d.limit(0), labels.limit(0)).collect() == []
    assert quality.resample(quality.quality_scores(d.limit(0), labels)).collect() == []


def test_ngram_buckets_count_all():
    data = "Aa bb, bb!! 12".encode()
    bucket, row = quality.ngrams(np.frombuffer(data, np.uint8), np.array([0, 6, len(data)]))
    tokens = [3, 3]  # "Aa", "bb", ","  |  "bb", "!!", "12"
    assert np.bincount(row).tolist() == [t + 2 * (t - 1) for t in tokens]
    assert ((0 <= bucket) & (bucket < quality.BUCKETS)).all()
