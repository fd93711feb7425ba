"""Token counts by Arrow batches: the tokenizer runs inside ``mapInArrow`` and returns lengths only.

Batches are balanced by bytes, not rows: texts are gathered until a byte budget is full. Every text
is split at safe boundaries; the distinct pieces of a batch are encoded once by ``encode_batch_fast``
and their lengths added up per text, so a piece that repeats costs a table lookup and a long text
never reaches the tokenizer in one string.

A boundary is safe for a byte-level BPE with the usual word pattern when a single space stands
between two characters that are no white space: the space always opens the next pre-token, merges
never cross pre-tokens and no added token holds a space, so the counts of the pieces add up to the
count of the whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: a space beside white space or at either end of the text: not every space is a safe boundary
_UNSAFE = re.compile(r"(?:^|\s) | (?:\s|$)")
#: lengths of pieces are remembered up to this many pieces of at most 64 characters
CACHE_PIECES = 400_000
_loaded: dict[str, object] = {}
_lengths: dict[str, dict[str, int]] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(name: str):
    if name not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer_path(name) if os.sep not in name else name)
        tok.no_truncation()
        tok.no_padding()
        _loaded[name] = tok
    return _loaded[name]


def pieces(text: str) -> list[str]:
    """``text`` cut at its safe boundaries; every piece but the first keeps its leading space out."""
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


def count_tokens(texts: list[str], name: str, batch_bytes: int = 1 << 20) -> list[int]:
    """Tokens of every text, without special tokens added, truncation or padding."""
    tok = _tokenizer(name)
    known = _lengths.setdefault(name, {})
    counts = [0] * len(texts)

    def flush(held: list[tuple[int, str, list[str]]]) -> None:
        distinct = set().union(*(rest for _, _, rest in held))
        new = list(distinct.difference(known))
        if len(known) + len(new) > CACHE_PIECES:
            known.clear()
            new = list(distinct)
        lengths = {p: len(e) for p, e in zip(new, tok.encode_batch_fast([" " + p for p in new], add_special_tokens=False), strict=True)}
        known.update((p, n) for p, n in lengths.items() if len(p) <= 64)
        here = known if all(len(p) <= 64 for p in new) else known | lengths
        heads = tok.encode_batch_fast([head for _, head, _ in held], add_special_tokens=False)
        for (i, _, rest), head in zip(held, heads, strict=True):
            counts[i] = len(head) + sum(map(here.__getitem__, rest))

    held, size = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        head, *rest = pieces(text)
        held.append((i, head, rest))
        size += len(text)
        if size >= batch_bytes:
            flush(held)
            held, size = [], 0
    if held:
        flush(held)
    return counts


def token_counts(
    docs: DataFrame,
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 1024,
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (``n_tokens > limit``).

    Null and empty texts count 0 bytes and 0 tokens; repeated rows are counted each; an empty table
    gives an empty result; columns of ``docs`` named like a result are dropped in its favour.
    """
    out = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in docs.columns if c != text_col and c not in out]
    # the scan's partitions follow the stored bytes, so no shuffle is needed for balance
    source = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = source.drop("_text").withColumns(
        {"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            text = batch.column("_text")
            n_bytes = pc.binary_length(text.cast(pa.large_binary())).cast(pa.int64())
            n_tokens = pa.array(count_tokens(text.to_pylist(), tokenizer, batch_bytes), pa.int64())
            cols = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, n_bytes, n_tokens], [*kept, "n_bytes", "n_tokens"])

    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
