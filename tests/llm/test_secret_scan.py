import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from geoweave.llm.arrays import text_bytes
from geoweave.llm.secret_scan import ANY, BASE_RULES, RULES, Index, Rule, candidates, digest, named, scan, spans_of, trigram_query

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
PARTS = [
    "password", "PassWd", "API_KEY", "apikey", "Token", "secret", ":", "=", " ", "  ", '"', "'", "abcDEF0123456", "short", "AKIA",
    "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "x", "é", "漢字", "\n", "ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----",
    "https://user:pass@host", "xoxb-1234567890ab", "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "sk_live_" + "a" * 24, "AIza" + "b" * 35, "ſecret=", "toKen=",
]


def brute(text):
    return sorted(
        (m.start(), k, m.end()) for k, (kind, (p, g, n)) in enumerate(BASE.items()) for m in p.finditer(text) if len(m[g]) >= n
    )


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return ["".join(rng.choices(PARTS, k=rng.randrange(12))) for _ in range(4000)]


def test_queries_of_expressions():
    assert trigram_query("abcd") == ("and", frozenset({"abc", "bcd"}))
    assert trigram_query("AbC|xyz") == ("or", frozenset({"abc", "xyz"}))
    assert trigram_query("a[0-9a-f]{16,}z") == ANY
    assert trigram_query("(foo)?bar") == "bar"
    assert trigram_query("x(ab|cd)+y") == ANY or named(trigram_query("x(ab|cd)+y")) >= {"xab", "xcd"}
    assert trigram_query("^foo(?=bar)b") == ("and", frozenset({"foo", "oob"}))
    assert trigram_query(".*|foo") == ANY
    assert [r.kind for r in RULES if trigram_query(r.pattern) == ANY] == ["hex"]  # scans fully


def test_candidates_lose_no_match(texts):
    rules = [*RULES, Rule("star", "(tok|sec)[a-z]*(en|et)"), Rule("alt", "(?:AKIA|gh[po]_)[A-Za-z0-9]{3}"), Rule("rep", "(de?a){2,3}d?"), Rule("fold", "SECRET", ignore_case=True)]
    queries = [trigram_query(r.pattern) for r in rules]
    segment = Index(queries).segment(*text_bytes(pa.array(texts)))
    for rule, query in zip(rules, queries, strict=True):
        matching = {i for i, t in enumerate(texts) if rule.compile().search(t)}
        found = candidates(query, segment, len(texts))
        assert matching <= set(found.tolist()) and (np.diff(found) > 0).all(), rule.kind
        if query != ANY and len(matching) < 500:
            assert len(found) < len(texts) / 2


def test_base_spans_against_plain_search(texts):
    for text, spans in zip(texts, spans_of(pa.array(texts), RULES), strict=True):
        assert [s for s in spans if s[1] < len(BASE_RULES)] == brute(text)


def test_postings_across_blocks(monkeypatch):
    monkeypatch.setattr("geoweave.llm.secret_scan.BLOCK", 7)
    texts = ["abcabc", "", "xxab", "cabcd", "ab"]
    segment = Index(["abc", "bcd"]).segment(*text_bytes(pa.array(texts)))
    assert {k: v.tolist() for k, v in segment.items()} == {"abc": [0, 3], "bcd": [3]}


def test_digest(spark):
    long = "word " * 100_000 + "token = abcdefghijklmnop"
    rows = [(1, "é password: abcdefghijkl deadbeefdeadbeef"), (2, None), (3, ""), (4, long), (4, long), (None, "AKIAABCDEFGHIJKLMN")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in digest(scan(df)).collect()}
    assert digest(scan(df)).count() == len(rows)
    base = "assign:2:24,hex:25:41"
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex, got[1].spans) == (1, 0, 1, base)
    assert got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[2].spans == got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[4].spans == "assign:500000:500024" and got[None].n_access == 1
    assert scan(df.filter("doc_id = 77")).collect() == []
