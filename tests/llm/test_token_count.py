import random

import pytest
from tokenizers import Tokenizer

from geoweave.llm.token_count import count_tokens, token_counts, tokenizer_path


@pytest.fixture(scope="module")
def reference():
    tok = Tokenizer.from_file(tokenizer_path())
    return lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)


def test_counts_equal_whole_text_encoding(spark, reference):
    rng = random.Random(3)
    parts = ["the", " a", "  ", "\n", "\t", " é", "ß1", "<|endoftext|>", " <|endoftext|> ", "don't", "—", "12 345", "x y", " ", "　", "\x1f", "\r\n", "🙂", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["", " ", "a" * 5000, "ab cd " * 3000, None, " x", "x "]
    assert count_tokens([t or "" for t in texts], "byte_bpe_50k.json", batch_bytes=500) == [reference(t) for t in texts]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = {r.doc_id: r for r in token_counts(df, limit=10).collect()}
    for i, t in enumerate(texts):
        n = reference(t)
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((t or "").encode()), n, n > 10)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(df).collect() == []
