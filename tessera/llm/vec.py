"""Vectorised hashing of the words of many texts (numpy over Arrow string buffers).

A word's hash is a polynomial over its bytes modulo 2**64, read off prefix sums, then mixed; no
Python object is made per word.  Words are those of :mod:`tessera.llm.words`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text handled at once (one longer text is handled alone).
CHUNK = 1 << 20
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", _INV)):
            seq = np.full(size, base, dtype=np.uint64)
            seq[0] = 1
            _POW[name] = np.multiply.accumulate(seq)
    return _POW["up"][:n], _POW["down"][:n]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts joined, and where each begins (one entry more than texts); NULL: empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each row (rows + 1)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~_GAP[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~solid[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, ~solid[1:]
    start = np.flatnonzero(solid & (before | edge[:-1]))
    end = np.flatnonzero(solid & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off, "left")


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + U(1)) * up[:-1], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words of a row, and where each row's begin (rows + 1).

    A row of fewer words, but at least one, has one shingle: all its words.
    """
    n, count = len(words), np.diff(first)
    sh = np.zeros(n, dtype=np.uint64)
    for k in range(min(width, n)):
        sh[:n - k] = mix(sh[:n - k] * U(0x9FB21C651E98DF25) + words[k:] + U(k + 1)) \
            if k else mix(words + U(1))
    per = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(per)])
    at = np.repeat(first[:-1] - begin[:-1], per) + np.arange(begin[-1])
    out = sh[at]
    for r in np.flatnonzero((count > 0) & (count < width)):
        h = np.full(1, U(0xA0761D6478BD642F) + U(count[r]), dtype=np.uint64)
        for w in words[first[r]:first[r + 1]]:
            h = mix(h * U(0x9FB21C651E98DF25) + w)
        out[begin[r]] = h[0]
    return out, begin


def ragged(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow binary column, one value per array."""
    return pa.array([v.tobytes() for v in values], type=kind)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``keys``, as tables that split no group of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        same = np.ones(batch.num_rows, dtype=bool)
        for k, v in zip(keys, last):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == v.as_py()
        cut = batch.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        if not cut:
            if held and any(held[-1].column(k)[held[-1].num_rows - 1].as_py() != v.as_py()
                            for k, v in zip(keys, last)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each run of equal keys begins, and the number of rows."""
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), n)
