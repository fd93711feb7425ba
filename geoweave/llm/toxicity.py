"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is cut into clauses at sentence and line signs. Words become symbols (insult, threat, target,
negation, reported speech, other) by a lexicon; a clause is a string of symbols. Five small weighted
transducers rewrite it in turn and are composed into one before any text is read:

* ``insult`` and ``threat`` open a match that waits for its surroundings, a threat also for a target
  after it ("kill you");
* ``target`` marks a match that stands shortly after an address ("you …");
* ``negation`` marks a match shortly after a negator;
* ``report`` marks a match in a clause that reports speech.

The composed machine reads a clause once and leaves per match an *outcome*: kind × targeted ×
negated × reported. A clause gives each of its outcomes the strength of its strongest match there; a
document adds up its clauses by outcome and scores the logistic of the weighted logarithms of these sums. So a
word never scores alone: targets raise and negation and reported speech lower the weight of what they mark
by fixed factors of the grammar, whatever the fit says.

The lexicon is a seed list plus word forms and word beginnings learnt from labelled rows: insults by smoothed
log odds, threats among them by the targets beside them, targets, negators and words of report by where they
stand before matches. A seed keeps its symbol. The scale of the grammar's weights and the offset are fitted on the
same rows. At most ``sample`` toxic and ``2 * sample`` clean rows are learnt from
(documented bound), one per id and one per group of near copies, so that copies of one text do not vote twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.plans.iterate import checkpoint

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SYMBOLS = 6

#: fixed values: seed words by symbol
SEED = {
    INSULT: "idiot idiots moron morons stupid loser losers clown trash scum pathetic worthless disgusting imbecile "
    "dumb retard vermin filth garbage idiota imbécil estúpido estúpida basura idiotin dumm dumme trottel abschaum "
    "müll widerlich imbécile débile ordure minable dégoûtant",
    THREAT: "kill murder hurt destroy stab shoot strangle beat matar mataré golpear töten umbringen schlagen tuer frapper",
    TARGET: "you your yours yourself u ur they them he she him du dich dein deine ihr sie tu te vous toi vos tú usted ustedes",
    NEGATION: "not never nobody neither nor cannot isn't aren't wasn't don't nicht kein keine nie niemals jamais nunca jamás",
    REPORT: "said says say claimed called calls wrote quoted according reported sagte sagt schrieb dit écrit dijo dice llamó",
}
#: clauses end at these signs
_CLAUSE = re.compile(r"[.!?;:\n\r]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: natural logarithm of the odds against chance that a learnt mark must show
EVIDENCE = 16.0
#: a mark is at most this share as frequent in clean rows as in toxic ones
RARE = 0.02
PREFIXES = range(3, 9)


# ---- transducers -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """Deterministic transducer over tagged symbols ``(symbol, flags)``: ``step(state, token)`` gives the
    next state and the token passed on. ``states`` are counted from 0, the start state."""

    states: int
    step: object


@dataclass
class Machine:
    """Composition tabulated over plain symbols: ``next[state][symbol]`` and the token that comes out."""

    next: list[list[int]] = field(default_factory=list)
    out: list[list[tuple[int, int]]] = field(default_factory=list)


TARGETED, NEGATED, REPORTED = 1, 2, 4
WINDOW = 4  # words over which a target or a negator reaches


def _fades(symbol: int, flag: int, window: int) -> Transducer:
    """After ``symbol``, matches within ``window`` words get ``flag``."""

    def step(state: int, token: tuple[int, int]):
        if token[0] == symbol:
            return window, token
        if state and token[0] in (INSULT, THREAT):
            return state - 1, (token[0], token[1] | flag)
        return max(state - 1, 0), token

    return Transducer(window + 1, step)


def _lasts(symbol: int, flag: int) -> Transducer:
    """After ``symbol``, all further matches of the clause get ``flag``."""

    def step(state: int, token: tuple[int, int]):
        if token[0] == symbol:
            return 1, token
        return state, ((token[0], token[1] | flag) if state and token[0] in (INSULT, THREAT) else token)

    return Transducer(2, step)


def _matches(window: int = WINDOW) -> Transducer:
    """Passes insults and threats. A threat needs a target: one without a target before it waits, and comes out
    in place of a target within ``window`` words after it. States hold the words left and the flags of the
    latest waiting threat."""

    def step(state: int, token: tuple[int, int]):
        symbol, flags = token
        if symbol == THREAT and not flags & TARGETED:
            return 1 + (window - 1) * 8 + flags, (OTHER, 0)
        if not state:
            return 0, token
        left, waiting = divmod(state - 1, 8)
        if symbol == TARGET:
            return 0, (THREAT, waiting | TARGETED)
        return (state - 8 if left else 0), token

    return Transducer(1 + window * 8, step)


def compose(chain: list[Transducer]) -> Machine:
    """One machine that does what the chain does, tabulated over reachable states only."""
    index = {(0,) * len(chain): 0}
    todo, machine = [(0,) * len(chain)], Machine()
    while todo:
        state = todo.pop(0)
        row_next, row_out = [], []
        for symbol in range(SYMBOLS):
            token, after = (symbol, 0), []
            for t, s in zip(chain, state, strict=True):
                s, token = t.step(s, token)
                after.append(s)
            key = tuple(after)
            if key not in index:
                index[key] = len(index)
                todo.append(key)
            row_next.append(index[key])
            row_out.append(token)
        machine.next.append(row_next)
        machine.out.append(row_out)
    return machine


GRAMMAR = compose([_fades(TARGET, TARGETED, WINDOW), _fades(NEGATION, NEGATED, WINDOW - 1), _lasts(REPORT, REPORTED), _matches()])
#: outcomes: (kind, flags); the first half insults, the second threats
OUTCOMES = [(k, f) for k, f in product((INSULT, THREAT), range(8))]
_OUTCOME = {o: i for i, o in enumerate(OUTCOMES)}


#: fixed values: the grammar's factors; threats weigh more than insults, targets raise, negation and report lower
THREAT_FACTOR, TARGETED_FACTOR, NEGATED_FACTOR, REPORTED_FACTOR = 1.5, 1.25, 0.1, 0.15


def grammar_weights() -> np.ndarray:
    """The grammar's own weight of every outcome; the fit scales them all alike."""
    w = np.ones(len(OUTCOMES))
    for i, (kind, flags) in enumerate(OUTCOMES):
        w[i] *= THREAT_FACTOR if kind == THREAT else 1.0
        for flag, factor in ((TARGETED, TARGETED_FACTOR), (NEGATED, NEGATED_FACTOR), (REPORTED, REPORTED_FACTOR)):
            w[i] *= factor if flags & flag else 1.0
    return w


# ---- lexicon ---------------------------------------------------------------------------------


@dataclass
class Lexicon:
    """Word forms and word beginnings, each with a symbol and a strength. A beginning stands for longer
    words only: a stem may be harmless as a word of its own."""

    forms: dict[str, tuple[int, float]]
    beginnings: dict[str, tuple[int, float]]
    memory: dict[str, tuple[int, float] | None] = field(default_factory=dict, repr=False)

    def look_up(self, word: str) -> tuple[int, float] | None:
        found = self.forms.get(word)
        if found is None:
            for n in PREFIXES:
                if len(word) <= n:
                    break
                found = max(found or (0, 0.0), self.beginnings.get(word[:n], (0, 0.0)), key=lambda x: x[1])
            found = found if found and found[1] > 0 else None
        return found

    def known(self, word: str) -> tuple[int, float] | None:
        try:
            return self.memory[word]
        except KeyError:
            if len(self.memory) > 300_000:
                self.memory.clear()
            found = self.memory[word] = self.look_up(word)
            return found


def seed_lexicon() -> Lexicon:
    forms = {w: (symbol, 3.0 if symbol in (INSULT, THREAT) else 1.0) for symbol, text in SEED.items() for w in text.split()}
    return Lexicon(forms, {})


def outcomes(text: str, lexicon: Lexicon, machine: Machine = GRAMMAR) -> np.ndarray:
    """Per outcome the sum over clauses of the strength of the clause's strongest match.

    Only clauses with an insult or a threat are run through the machine; the others leave nothing."""
    out = np.zeros(len(OUTCOMES))
    folded = text.lower()
    hits = [w for w in set(_WORD.findall(folded)) if (f := lexicon.known(w)) and f[0] in (INSULT, THREAT)]
    if not hits:
        return out
    some = re.compile("|".join(map(re.escape, sorted(hits))))
    for clause in _CLAUSE.split(folded):
        if not some.search(clause):
            continue
        state, score = 0, np.zeros(len(OUTCOMES))
        waiting: list[tuple[int, float]] = []  # place and strength of threats without a target so far
        for at, word in enumerate(_WORD.findall(clause)):
            found = lexicon.known(word) or (OTHER, 0.0)
            token = machine.out[state][found[0]]
            state = machine.next[state][found[0]]
            if token in _OUTCOME:
                i = _OUTCOME[token]
                strengths = [found[1]]
                if found[0] == TARGET:
                    strengths = [s for k, s in waiting if at - k <= WINDOW]
                    waiting = []
                score[i] = max(score[i], *strengths)
            elif found[0] == THREAT:
                waiting.append((at, found[1]))
        out += score
    return out


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    offset: float

    def score(self, text: str) -> float:
        x = outcomes(text, self.lexicon)
        z = float(np.log1p(x) @ self.weights + self.offset)
        return 1 / (1 + np.exp(-max(min(z, 30.0), -30.0)))


# ---- learning --------------------------------------------------------------------------------


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """``(text, y)`` of at most ``sample`` toxic and ``2 * sample`` clean learnable ids, in hash order: one row per
    id (the smallest text where an id repeats), then one per group of near copies, written to the checkpoint folder."""
    learn = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0
    usable = labels.filter(learn & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    chosen = None
    for y in (0, 1):
        part = usable.filter(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(sample * (2 - y))
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(id_col, F.col(text_col).alias("text")).filter("text is not null")
    single = texts.join(F.broadcast(chosen), id_col).groupBy(id_col).agg(F.min("text").alias("text"), F.first("y").alias("y"))
    return checkpoint(one_per_copy(single.select("text", "y")))


def one_per_copy(rows: DataFrame, size: int = 5, bands: int = 5, per_band: int = 3) -> DataFrame:
    """One row ``(text, y)`` of those that agree in all minhashes of a band over the five-word shingles of their whole
    texts. Of near copies at 0.8, 97 of 100 meet; texts that share a tenth of their shingles, such as a common heading,
    stay apart in 199 of 200 pairs."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (size - 1), F.lit(1)))
    rows = rows.withColumn("_w", F.split(F.lower("text"), r"\s+"))
    rows = rows.withColumn("_s", F.transform(starts, lambda i: F.xxhash64(F.slice("_w", i, size))))

    def least(seed: int):
        return F.array_min(F.transform("_s", lambda h: F.xxhash64(h, F.lit(seed))))

    rows = rows.select("y", "text", F.array(*(least(k) for k in range(bands * per_band))).alias("_m"))
    for k in range(bands):
        band = F.slice("_m", k * per_band + 1, per_band).alias("_b")
        rows = rows.groupBy("y", band).agg(F.min(F.struct("text", "_m")).alias("r")).select("y", "r.*")
    return rows.select("text", "y")


def _divergence(p, base):
    """KL divergence of the share ``p`` from the share ``base``, both columns or numbers, in SQL."""
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(F.lit(0.0))
    return F.when(p > 0, p * F.log(p / base)).otherwise(F.lit(0.0)) + rest


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Seed words plus forms and beginnings that mark toxic rows, counted by Spark over rows ``(text, y)``, then
    marks of the other symbols (``learn_contexts``).

    A mark counts when its split between toxic and clean rows is no chance: with ``t`` toxic and ``c``
    clean rows, ``(t + c) · KL(t / (t + c) ‖ share of toxic rows)`` is at least ``EVIDENCE`` and clean rows hold it at
    most ``RARE`` times as often as toxic rows do.
    """
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = seed_lexicon()
    if not toxic or not clean:
        return lexicon
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+(?:['’]\p{L}+)*)"), F.lit(1)))
    forms = F.transform(words, lambda w: F.concat(F.lit("="), w))

    def beginnings(n: int):
        return F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.substring(w, 1, n)))

    marks = F.flatten(F.array(forms, *(beginnings(n) for n in PREFIXES)))
    counted = (
        rows.select("y", F.explode(marks).alias("mark"))
        .groupBy("mark")
        .agg(F.count_if(F.col("y") == 1).alias("n"), F.count_if(F.col("y") == 0).alias("c"))
    )
    p = F.col("n") / (F.col("n") + F.col("c"))
    evidence = (F.col("n") + F.col("c")) * _divergence(p, F.lit(toxic / (toxic + clean)))
    rare = F.col("c") / clean <= RARE * F.col("n") / toxic
    strong = counted.filter("n >= 3").filter(rare & (evidence >= EVIDENCE))
    found = {r["mark"]: r for r in strong.collect()}  # words of the bounded sample only
    longest: dict[str, list[int]] = {}
    for q, r in found.items():
        text = q.lstrip("=")
        for k in range(PREFIXES.start, len(text)):
            longest.setdefault(text[:k], []).append(r["n"])
    for mark, r in found.items():
        form, text = mark.startswith("="), mark.lstrip("=")
        # a beginning that one longer beginning or one word stands in for says nothing of its own
        if not form and any(x >= 0.95 * r["n"] for x in longest.get(mark, ())):
            continue
        odds = float(np.log((r["n"] + 0.5) / (toxic + 1)) - np.log((r["c"] + 0.5) / (clean + 1)))
        kept = lexicon.forms.get(text, (INSULT, 0.0))[0] if form else INSULT
        if kept in (INSULT, THREAT):  # a seed keeps its symbol
            (lexicon.forms if form else lexicon.beginnings)[text] = (kept, max(odds, 0.1))
    learn_contexts(rows, lexicon)
    return lexicon


def contexts(text: str, lexicon: Lexicon) -> dict[str, list[int]]:
    """Per word of a text the number of its places that are: any; a match; a match with a target within ``WINDOW``
    words; before a match within ``WINDOW`` words; before one as near as a negator reaches; before one further off."""
    got: dict[str, list[int]] = {}
    for clause in _CLAUSE.split(text.lower()):
        words = _WORD.findall(clause)
        symbols = [(lexicon.known(w) or (OTHER, 0.0))[0] for w in words]
        following = None  # place of the next match
        for i in range(len(words) - 1, -1, -1):
            row = got.setdefault(words[i], [0] * 6)
            row[0] += 1
            if symbols[i] in (INSULT, THREAT):
                row[1] += 1
                row[2] += TARGET in symbols[max(i - WINDOW, 0) : i + WINDOW + 1]
                following = i
            elif following is not None:
                row[3] += following - i <= WINDOW
                row[4] += following - i < WINDOW
                row[5] += following - i >= WINDOW
    return got


def learn_contexts(rows: DataFrame, lexicon: Lexicon) -> None:
    """Add to ``lexicon`` the threats, targets, negators and words of report that stand out by their places.

    All tests ask for three rows and for ``EVIDENCE`` against chance. A learnt insult with a target beside it in four
    places of five, more than matches have as a rule, is a threat. A word that stands before matches of toxic rows five
    times as often as words do is a target. A word that stands before matches of clean rows, and in toxic rows at most a
    fifth as often, is a negator if most such places are near, else a word of report. Seeds and other
    marks stay as they are."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # words of the bounded sample only
    counts = ["places", "matches", "aimed", "before", "near", "far"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist(), strict=True):
                got = contexts(text, shared.value)
                if any(v[1] for v in got.values()):
                    got[""] = [0, 0, 0, 0, 1, 0]  # the row has a match: its empty word counts rows with one
                columns = [pa.array([v[k] for v in got.values()], pa.int64()) for k in range(6)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(got), pa.string()), pa.array([y] * len(got), pa.int64()), *columns], ["word", "y", *counts]
                )

    schema = "word string, y long, " + ", ".join(f"{c} long" for c in counts)
    seen = rows.select("text", F.col("y").cast("long").alias("y")).mapInArrow(run, schema)
    toxic, ahead = F.col("y") == 1, F.col("near") + F.col("far") > 0

    def of(condition, column):
        return F.sum(F.when(condition, F.col(column)).otherwise(F.lit(0))).alias(column)

    by_word = checkpoint(
        seen.groupBy("word").agg(
            *(of(toxic, c) for c in counts[:4]),
            *(of(~toxic, c) for c in counts[4:]),
            F.count_if(toxic & (F.col("matches") > 0)).alias("match_rows"),
            F.count_if(toxic & (F.col("before") > 0)).alias("before_rows"),
            F.count_if(toxic & ahead).alias("t"),
            F.count_if(~toxic & ahead).alias("c"),
        )
    )
    whole = by_word.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts[:4])).first()
    marked = by_word.filter("word = ''").select("t", "c").first() or (0, 0)

    def stands_out(n, part, of_all, base):
        share = F.col(part) / F.greatest(F.col(of_all), F.lit(1))
        return (F.col(n) >= 3) & (share > base) & (F.col(n) * _divergence(share, F.lit(base)) >= EVIDENCE), share

    choices = F.lit(None).cast("int")
    if marked[1]:  # clean rows with matches
        base = marked[1] / (marked[0] + marked[1])
        share = F.col("c") / F.greatest(F.col("c") + F.col("t"), F.lit(1))
        clear = (F.col("t") * marked[1] <= 0.2 * F.col("c") * marked[0]) & (base < 1)
        told = (F.col("c") >= 3) & (share > base) & ((F.col("c") + F.col("t")) * _divergence(share, F.lit(min(base, 1 - 1e-9))) >= EVIDENCE)
        choices = F.when(clear & told, F.when(F.col("near") >= F.col("far"), F.lit(NEGATION)).otherwise(F.lit(REPORT))).otherwise(choices)
    if whole["before"]:
        base = min(whole["before"] / whole["places"], 0.5)
        told, share = stands_out("before_rows", "before", "places", base)
        choices = F.when(told & (share >= 5 * base) & (F.col("matches") == 0), F.lit(TARGET)).otherwise(choices)
    if whole["matches"] and whole["aimed"]:
        base = min(whole["aimed"] / whole["matches"], 1 - 1e-9)
        told, share = stands_out("match_rows", "aimed", "matches", base)
        choices = F.when(told & (share >= 0.8), F.lit(THREAT)).otherwise(choices)
    seeds = seed_lexicon().forms
    for r in by_word.filter("word <> ''").select("word", choices.alias("symbol")).filter("symbol is not null").collect():
        known = lexicon.known(r["word"])
        if r["word"] in seeds or (known is not None) != (r["symbol"] == THREAT):
            continue
        lexicon.forms[r["word"]] = (r["symbol"], known[1] if known else 1.0)
    lexicon.memory.clear()


def fit_weights(x: np.ndarray, y: np.ndarray, lexicon: Lexicon) -> Model:
    """Logistic fit of the scale of the grammar's weights and of the offset, classes balanced, with a slight pull
    towards scale 1 and offset -1. ``x`` holds the outcomes of the learnt rows. The scale stays above 0.1, so that no
    match ever speaks for a clean text."""
    prior = grammar_weights()
    if len(set(y.tolist())) < 2:
        return Model(lexicon, prior, -1.0)
    design = np.stack([np.log1p(x) @ prior, np.ones(len(x))], axis=1)
    beta = centre = np.array([1.0, -1.0])
    pull = np.array([2e-3, 1e-4])
    w = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (p - y)) + pull * (beta - centre)
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        beta = beta - np.linalg.solve(hess, grad)
    return Model(lexicon, prior * max(float(beta[0]), 0.1), float(beta[1]))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 1500) -> Model:
    rows = labelled_rows(docs, labels, id_col, text_col, label_col, sample)
    lexicon = learn_lexicon(rows)
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # words of the bounded sample only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [outcomes(t, shared.value).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    got = rows.select("text", F.col("y").cast("long").alias("y")).mapInArrow(run, "x array<double>, y long").collect()
    # at most 3 * sample rows of numbers
    return fit_weights(np.array([r["x"] for r in got]).reshape(-1, len(OUTCOMES)), np.array([r["y"] for r in got]), lexicon)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = 1500,
) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` per row of ``docs``; the whole text is read.

    Null and empty texts score like a text without a match. Rows whose ``crc32(id as text) mod 5`` is 0
    are held out of learning (a null id is never learnt from and counts as not held out). Without labelled rows of both
    classes the seed lexicon and the grammar's own weights are used. Repeated rows are scored each;
    empty tables give an empty result; other columns are ignored.
    """
    model = learn(docs, labels, id_col, text_col, label_col, sample)
    model.lexicon.memory.clear()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words of the bounded sample only
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    source = docs.select(id_col, held.alias("held_out"), F.col(text_col).alias("_text"))
    schema = source.drop("_text").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(t or "") for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("held_out"), pa.array(scores, pa.float64())], [id_col, "held_out", "score"]
            )

    return source.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
