"""Secret scan: rules are regular expressions, a trigram index says which texts can match at all.

Every rule's expression is turned into a Boolean query over trigrams (each match must hold these
three-byte runs). An index segment, one per Arrow batch, keeps for every trigram that some query names
the sorted list of the rows that hold it. A rule's query is answered by intersecting and uniting
those lists; only the rows left are searched by the expression itself. A rule without mandatory
trigrams (a run of hexadecimal digits) searches every row. Index and queries fold A-Z to a-z, so they
serve rules of either case; folding only adds candidates, never loses one.

Segments are private to a task: nothing is shuffled, and a lost executor costs its own batches only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op
from re import _parser as parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import LOWER, text_bytes

#: sets of texts and character classes larger than this say nothing more than their trigrams so far
FEW = 24
FEW_CHARS = 8
#: bytes looked at in one numpy step
BLOCK = 1 << 22


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched leftmost and without overlap; a match whose ``group`` has fewer than
    ``min_length`` characters is dropped (it still uses up its characters)."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0
    ignore_case: bool = False

    def compile(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# fixed values: the base rules, then public formats of well-known tokens
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_length=12,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", min_length=18),
    # the same spans as runs of any length of which those under 16 are dropped
    Rule("hex", r"[0-9a-f]{16,}"),
)
FORMAT_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pay", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("url", r"://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&*+=-]+@"),
)
RULES = BASE_RULES + FORMAT_RULES

# ---- Boolean queries ----------------------------------------------------------------------------

#: a query is ANY, a trigram, or ("and" | "or", set of queries)
ANY = ()


def both(*queries):
    """All of them hold."""
    parts = frozenset().union(*(q[1] if q and q[0] == "and" else {q} for q in queries if q != ANY))
    return ANY if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def either(*queries):
    """One of them holds."""
    if ANY in queries:
        return ANY
    parts = frozenset().union(*(q[1] if q[0] == "or" else {q} for q in queries))
    # a part that asks for all that another asks for, and more, adds nothing
    parts = frozenset(p for p in parts if not any(_asked(o) < _asked(p) for o in parts))
    return next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _asked(query) -> frozenset:
    return query[1] if query[0] == "and" else frozenset({query})


def holds(texts: frozenset[str]):
    """One of ``texts`` stands in the row: any of them, each by all its trigrams."""
    return either(*(both(*(t[i : i + 3] for i in range(len(t) - 2))) for t in texts))


class Facts(NamedTuple):
    """What is known of the matches of a part of an expression: all of them (``exact``), or what each
    begins and ends with; ``query`` holds in any case."""

    exact: frozenset[str] | None
    prefix: frozenset[str]
    suffix: frozenset[str]
    query: object


def known(texts) -> Facts:
    texts = frozenset(texts)
    return Facts(texts, texts, texts, ANY)


EMPTY = known({""})
UNKNOWN = Facts(None, frozenset({""}), frozenset({""}), ANY)


def settle(f: Facts):
    """Everything that ``f`` says as one query."""
    return both(f.query, holds(f.prefix), holds(f.suffix))


def _joined(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
    return frozenset(x + y for x, y in product(a, b))


def _cut(f: Facts) -> Facts:
    """Large sets become their trigrams and the two characters next to the rest."""
    if f.exact is not None and len(f.exact) <= FEW:
        return f
    if f.exact is None and len(f.prefix) <= FEW and len(f.suffix) <= FEW:
        return f
    query = settle(f)
    prefix, suffix = f.prefix, f.suffix
    for k in (2, 1, 0):
        if len(prefix) > FEW:
            prefix = frozenset(t[:k] for t in prefix)
        if len(suffix) > FEW:
            suffix = frozenset(t[len(t) - min(k, len(t)) :] for t in suffix)
    return Facts(None, prefix, suffix, query)


def chain(a: Facts, b: Facts) -> Facts:
    """``a`` followed by ``b``."""
    if a.exact is not None and b.exact is not None:
        return _cut(known(_joined(a.exact, b.exact))._replace(query=both(a.query, b.query)))
    query = both(a.query, b.query, holds(_joined(a.suffix, b.prefix)), holds(a.prefix), holds(b.suffix))
    prefix = _joined(a.exact, b.prefix) if a.exact is not None else a.prefix
    suffix = _joined(a.suffix, b.exact) if b.exact is not None else b.suffix
    return _cut(Facts(None, prefix, suffix, query))


def branch(a: Facts, b: Facts) -> Facts:
    """``a`` or ``b``."""
    if a.exact is not None and b.exact is not None:
        return _cut(known(a.exact | b.exact)._replace(query=either(a.query, b.query)))
    return _cut(Facts(None, a.prefix | b.prefix, a.suffix | b.suffix, either(settle(a), settle(b))))


def repeat(a: Facts, low: int, high: int) -> Facts:
    if low == 0:
        return branch(a, EMPTY) if high == 1 else UNKNOWN
    copies = reduce(chain, [a] * min(low, 3))
    return copies if low == high <= 3 else chain(chain(copies, UNKNOWN), a)


def _characters(items) -> Facts:
    """A character class; large, negated and not plain ones say nothing."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < 64:
            found.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return UNKNOWN
    folded = {c.lower() for c in found}
    return known(folded) if len(folded) <= FEW_CHARS and all(c.isascii() for c in folded) else UNKNOWN


def facts(tree) -> Facts:
    """Facts of a parsed expression."""
    out = EMPTY
    for kind, value in tree:
        if kind is op.LITERAL:
            part = known({chr(value).lower()}) if value < 128 else UNKNOWN
        elif kind is op.IN:
            part = _characters(value)
        elif kind is op.SUBPATTERN:
            part = facts(value[-1])
        elif kind is op.BRANCH:
            part = reduce(branch, map(facts, value[1]))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            part = repeat(facts(value[2]), value[0], value[1])
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            part = EMPTY  # takes no characters
        else:
            part = UNKNOWN
        out = chain(out, part)
    return out


def trigram_query(pattern: str):
    """The Boolean trigram query that every text with a match of ``pattern`` satisfies (folded to a-z)."""
    return settle(facts(parser.parse(pattern)))


def named(query) -> set[str]:
    """The trigrams that a query names."""
    if query == ANY:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(named, query[1]))


# ---- index segments ------------------------------------------------------------------------------


class Index:
    """Builds segments for the trigrams that a set of queries names."""

    def __init__(self, queries):
        self.trigrams = sorted(set().union(*map(named, queries)) if queries else set())
        self.slot = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(self.trigrams):
            a, b, c = t.encode("ascii")
            self.slot[a << 16 | b << 8 | c] = i + 1

    def segment(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """``{trigram: sorted rows}`` of a batch of texts, read in blocks of ``BLOCK`` bytes."""
        n = len(offsets) - 1
        keys = [np.zeros(0, np.int64)]
        for at in range(0, max(len(data) - 2, 0), BLOCK):
            d = LOWER[data[at : at + BLOCK + 2]].astype(np.uint32)
            slot = self.slot[d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]]
            hit = np.flatnonzero(slot)
            row = np.searchsorted(offsets, hit + at, "right") - 1
            inside = hit + at + 2 < offsets[row + 1]
            keys.append(np.unique((slot[hit[inside]].astype(np.int64) - 1) * n + row[inside]))
        key = np.unique(np.concatenate(keys))
        ends = np.searchsorted(key, np.arange(len(self.trigrams) + 1) * n)
        return {t: key[ends[i] : ends[i + 1]] - i * n for i, t in enumerate(self.trigrams)}


def candidates(query, segment: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Rows of a segment that satisfy ``query``, ascending; rarest lists first."""
    if query == ANY:
        return np.arange(n)
    if isinstance(query, str):
        return segment[query]
    lists = sorted((candidates(q, segment, n) for q in query[1]), key=len)
    join = np.intersect1d if query[0] == "and" else np.union1d
    return reduce(lambda a, b: join(a, b) if len(a) or query[0] == "or" else a, lists)


def find(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Spans of a rule in one text, in code points."""
    return [m.span() for m in compiled.finditer(text) if len(m[rule.group]) >= rule.min_length]


_built: dict[tuple, tuple] = {}


def _prepared(rules: tuple[Rule, ...]):
    if rules not in _built:
        queries = [trigram_query(r.pattern) for r in rules]
        _built[rules] = queries, Index(queries), [r.compile() for r in rules]
    return _built[rules]


def spans_of(texts: pa.Array, rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Per text its spans ``(start, rule number, end)``, ascending."""
    queries, index, compiled = _prepared(rules)
    segment = index.segment(*text_bytes(texts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    for number, (rule, query, regex) in enumerate(zip(rules, queries, compiled, strict=True)):
        for row in candidates(query, segment, len(texts)).tolist():
            found[row] += [(a, number, b) for a, b in find(rule, regex, texts[row].as_py() or "")]
    return [sorted(x) for x in found]


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``spans``: an array of ``(kind, start, end)`` in code
    points, end exclusive, by start and then by the order of ``rules``.

    Null and empty texts have no spans; a long text is searched whole; spans that tie on start and
    kind cannot occur (matches of one rule do not overlap); repeated rows are scanned each; an empty
    table gives an empty result; a column of ``docs`` named ``spans`` is dropped in favour of the result.
    """
    kept = [c for c in docs.columns if c not in (text_col, "spans")]
    source = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = source.drop("_text").withColumn("spans", F.lit(None).cast(_SPANS)).schema
    kinds = pa.array([r.kind for r in rules], pa.string())
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of(batch.column("_text"), rules)
            flat = np.array([s for row in found for s in row], np.int32).reshape(-1, 3)
            parts = [kinds.take(pa.array(flat[:, 1])), pa.array(flat[:, 0]), pa.array(flat[:, 2])]
            ends = np.concatenate([[0], np.cumsum([len(row) for row in found])]).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, fields=list(item)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), spans], [*kept, "spans"])

    return source.mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined; empty without spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``n_<kind>`` of every base rule, ``base_sha256`` of the base spans and all ``spans`` as text."""
    kinds = [r.kind for r in base]

    def of(*wanted: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*wanted))

    return found.select(
        *keep,
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(joined(of(*kinds)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
