"""Array helpers of the text operators: vectorised word hashes over Arrow string buffers and
runs over key-sorted Arrow batches. All of it is plain numpy inside a Spark task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)

#: bytes that end a word: space and the controls 9 to 13
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 1 << 16)
        inv = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        _powers = np.cumprod(np.full(size, _PRIME, np.uint64))
        _inverse = np.cumprod(np.full(size, inv, np.uint64))
    return _powers, _inverse


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string array; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ~SEPARATOR, fold: np.ndarray = LOWER):
    """``(hash, row, start, end)`` of every word: longest runs of bytes of one nonzero ``kind``, folded.

    A polynomial hash is summed per word by ``reduceat`` and shifted back to the word's start by
    the inverse power, so no Python code runs per word.
    """
    n = len(data)
    none = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    if n == 0:
        return none
    k = kind[data]
    inside = k != 0
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    change[1:n] = k[1:] != k[:-1]
    change[offsets] = True
    start = np.flatnonzero(change[:n] & inside)
    end = np.flatnonzero(change[1:] & inside) + 1
    if len(start) == 0:
        return none
    power, inverse = _power_tables(n)
    value = (fold[data].astype(np.uint64) + np.uint64(1)) * power[:n]
    value[~inside] = 0
    total = np.add.reduceat(value, start) * inverse[start]
    row = np.searchsorted(offsets, start, "right") - 1
    return mix(total), row, start, end


def shingles(word: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of every run of ``size`` words of one row; a row with fewer words gives its
    whole sequence as one shingle."""
    counts = np.bincount(row, minlength=n_rows)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _PRIME) | np.uint64(1)
    parts, rows = [], []
    m = len(word) - size + 1
    if m > 0:
        keep = row[:m] == row[size - 1 :]
        h = np.zeros(m, np.uint64)
        for k in range(size):
            h += word[k : k + m] * factors[k]
        parts.append(mix(h[keep]))
        rows.append(row[:m][keep])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(counts)])
        whole = np.array(
            [
                int((word[begin[r] : begin[r] + counts[r]] * factors[: counts[r]]).sum(dtype=np.uint64)) ^ int(counts[r])
                for r in short
            ],
            np.uint64,
        )
        parts.append(mix(whole))
        rows.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, r = np.concatenate(parts), np.concatenate(rows)
    order = np.argsort(r, kind="stable")
    return h[order], r[order]


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the start of each group (and the end of the last), from batches
    that are sorted by ``keys`` (long columns without nulls)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        tail = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
        if last == tail and all(batch.column(k)[0].as_py() == v for k, v in zip(keys, tail, strict=True)):
            continue  # one group goes on through the whole batch
        last = tail
        table = pa.Table.from_batches(held)
        starts = _starts(table, keys)
        if len(starts) > 1:
            cut = int(starts[-1])
            yield table.slice(0, cut), starts
            held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.append(_starts(table, keys), table.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)
