"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A benchmark item of ``m`` characters occurs in a text if some stretch of the text is within
``k = floor(edit_rate * m)`` edits of it (case folded, white space runs as one space).  By the q-gram
lemma such a stretch shares at least ``m - q + 1 - k q`` q-grams with the item, on diagonals that lie
within ``k`` of each other.  So shared q-grams are counted in diagonal bands of width ``2 (k + 1)``
that overlap by half; bands that reach the bound are aligned within the band and kept if the alignment
has at most ``k`` edits.

Texts are handled where they lie (no shuffle).  Items go to the tasks in blocks of bounded size, one
scan of the texts a block; any number of items is handled.

Defined results: a NULL or empty text has no hit; NULL items and items of fewer than ``q`` characters
are ignored (for short items ``k`` is lowered until the bound is positive); repeated rows and
repeated items each have hits of their own; overlapping hits of one item count as one, that of fewest
edits (then the earliest).  An empty table gives an empty result; extra columns are kept by
:func:`drop_contaminated`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import need
from tessera.session import scratch_dir

Q = 10
EDIT_RATE = 0.08
#: Characters of items that one scan looks for, of texts handled at once, and q-gram matches
#: expanded at once.
BLOCK_CHARS, CHUNK_CHARS, MATCHES = 4 << 20, 1 << 20, 2 << 20
_U = np.uint64
_KEPT: dict[str, Index] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(1 << 16, dtype=np.uint32)
    gap = np.zeros(1 << 16, dtype=bool)
    for i in range(1 << 16):
        c = chr(i)
        if len(c.lower()) == 1:
            low[i] = ord(c.lower())
        gap[i] = c.isspace()
    return low, gap


_LOW, _GAP = _tables()


def fold(codes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points, and the place of each among ``codes``; ``row`` says whose they are."""
    small = codes < 1 << 16
    at = np.where(small, codes, 0)
    gap = small & _GAP[at]
    drop = np.zeros(len(codes), dtype=bool)
    drop[1:] = gap[1:] & gap[:-1] & (row[1:] == row[:-1])
    kept = np.flatnonzero(~drop)
    out = np.where(gap, np.uint32(32), np.where(small, _LOW[at], codes))
    return out[kept], kept


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of ``q`` code points."""
    n = max(0, len(codes) - q + 1)
    h = np.zeros(n, dtype=np.uint64)
    wide = codes.astype(np.uint64) + _U(1)
    for k in range(q):
        h = h * _U(0x9E3779B97F4A7C15) + wide[k:k + n]
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


class Index:
    """Q-grams of a block of items."""

    def __init__(self, items: list[str], q: int, edit_rate: float):
        self.q = q
        folded = []
        for text in items:
            codes = code_points(text.strip())
            folded.append(fold(codes, np.zeros(len(codes), np.int8))[0])
        self.items = folded
        m = np.array([len(x) for x in folded], dtype=np.int64)
        self.k = np.minimum((edit_rate * m).astype(np.int64), np.maximum(0, (m - q) // q))
        self.least = m - q + 1 - self.k * q
        grams = [gram_hashes(x, q) for x in folded]
        h = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(folded)), [len(g) for g in grams])
        pos = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)])
        order = np.argsort(h, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.grams, self.first, self.count = np.unique(
            h[order], return_index=True, return_counts=True)
        self.bits = max(16, min(26, int(len(h)).bit_length() + 6))
        self.maybe = np.zeros(1 << self.bits, dtype=bool)
        self.maybe[(self.grams >> _U(64 - self.bits)).astype(np.int64)] = True

    def matches(self, codes: np.ndarray, row: np.ndarray) -> Iterator[tuple]:
        """Row, item and diagonal of q-gram matches, in parts of bounded size."""
        if not len(self.grams) or len(codes) < self.q:
            return
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.maybe[(h >> _U(64 - self.bits)).astype(np.int64)]
                            & (row[:len(h)] == row[self.q - 1:]))
        place = np.searchsorted(self.grams, h[at])
        place[place == len(self.grams)] = 0
        hit = self.grams[place] == h[at]
        at, place = at[hit], place[hit]
        total = np.cumsum(self.count[place])
        start = 0
        while start < len(at):
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + MATCHES, "right")))
            p, count = place[start:stop], self.count[place[start:stop]]
            ends = np.cumsum(count)
            post = np.repeat(self.first[p] - (ends - count), count) + np.arange(ends[-1])
            where = np.repeat(at[start:stop], count)
            yield row[where].astype(np.int64), self.item[post], where - self.pos[post]
            start = stop

    def regions(self, codes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, item and band of regions that reach the q-gram bound."""
        n, parts = len(self.items), []
        sums = [np.unique(r * n + i, return_counts=True) for r, i, _ in self.matches(codes, row)]
        keys, counts = _sum_up(sums)
        able = keys[counts >= self.least[keys % n]] if len(keys) else keys
        if not len(able):
            return (np.zeros(0, np.int64),) * 3
        span = 2 * len(codes) + 4
        for r, i, d in self.matches(codes, row):
            key = r * n + i
            place = np.searchsorted(able, key)
            place[place == len(able)] = 0
            ok = able[place] == key
            place, i, d = place[ok], i[ok], d[ok]
            band = d // (self.k[i] + 1) + len(codes)
            both = np.concatenate([place * span + band, place * span + band - 1])
            parts.append(np.unique(both, return_counts=True))
        keys, counts = _sum_up(parts)
        pair, band = able[keys // span], keys % span - len(codes)
        ok = counts >= self.least[pair % n]
        return pair[ok] // n, pair[ok] % n, band[ok]

    def align(self, item: int, lows: np.ndarray, codes: np.ndarray, begin: np.ndarray,
              end: np.ndarray) -> tuple[np.ndarray, ...]:
        """Edits, start and end of the best match of an item on diagonals from ``lows``, each within
        its own row's ``begin`` to ``end``."""
        text, k = self.items[item], int(self.k[item])
        width, big = 4 * k + 3, 1 << 20
        col = np.arange(width)
        d0 = lows - k
        cost = np.tile(col, (len(lows), 1)).astype(np.int64)  # edits * big + start diagonal
        cost[(d0[:, None] + col < begin[:, None]) | (d0[:, None] + col > end[:, None])] += big * big
        for r in range(1, len(text) + 1):
            j = d0[:, None] + col + (r - 1)
            inside = (j >= begin[:, None]) & (j < end[:, None])
            same = inside & (codes[np.where(inside, j, 0)] == text[r - 1])
            new = cost + np.where(same, 0, np.where(inside, big, big * big))
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + big)
            cost = np.minimum.accumulate(new - col * big, axis=1) + col * big
        best = cost.argmin(axis=1)
        value = cost[np.arange(len(lows)), best]
        return value // big, d0 + value % big, d0 + best + len(text)

    def hits(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, start, end, edits)`` of verified matches; places in the texts as given."""
        size = np.array([len(t) for t in texts], dtype=np.int64)
        raw = code_points("".join(texts))
        owner = np.repeat(np.arange(len(texts)), size)
        codes, kept = fold(raw, owner)
        row = owner[kept]
        rows, items, bands = self.regions(codes, row)
        begin, end = (np.searchsorted(row, np.arange(len(texts)), side) for side in
                      ("left", "right"))
        first = np.cumsum(size) - size
        found = []
        for item in np.unique(items):
            of = np.flatnonzero(items == item)
            for part in range(0, len(of), 512):
                sel = of[part:part + 512]
                lows = bands[sel] * (self.k[item] + 1)
                edits, a, b = self.align(item, lows, codes, begin[rows[sel]], end[rows[sel]])
                for e, x, y, r in zip(edits, a, b, rows[sel]):
                    if e <= self.k[item] and y > x:
                        found.append((int(r), int(item), int(e), int(x), int(y)))
        out, taken = [], {}
        for r, item, e, x, y in sorted(found):
            spans = taken.setdefault((r, item), [])
            if all(y <= s or x >= t for s, t in spans):
                spans.append((x, y))
                out.append((r, item, int(kept[x] - first[r]), int(kept[y - 1] + 1 - first[r]), e))
        return sorted(out)


def _sum_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)


def _scan(token: str, items: list[str], q: int, edit_rate: float, batch: pa.RecordBatch):
    """Row ranges of a batch with their hits."""
    if token not in _KEPT:
        _KEPT.clear()
        _KEPT[token] = Index(items, q, edit_rate)
    index = _KEPT[token]
    texts = [t or "" for t in batch.column("text").to_pylist()]
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) <= CHUNK_CHARS):
            total += len(texts[j])
            j += 1
        yield i, index.hits(texts[i:j])
        i = j


def item_blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of items, in blocks of at most ``limit`` characters (or one item)."""
    ids, texts, total = [], [], 0
    rows = benchmark.where("text IS NOT NULL").select("item_id", "text")
    for r in rows.toLocalIterator():
        if texts and total + len(r.text) > limit:
            yield ids, texts
            ids, texts, total = [], [], 0
        ids.append(r.item_id)
        texts.append(r.text)
        total += len(r.text)
    if texts:
        yield ids, texts


def find_items(docs: DataFrame, benchmark: DataFrame, q: int = Q,
               edit_rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: each occurrence of an item, by character places."""
    need(docs, "doc_id", "text")
    need(benchmark, "item_id", "text")
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, start long, end long, edits long"
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found, last = [], None
    for ids, texts in item_blocks(bench, BLOCK_CHARS):
        if last is not None:  # more than one block: a scan each, written before the next is held
            out = scratch_dir(spark, "hits")
            last.write.parquet(out)
            found.append(spark.read.schema(schema).parquet(out))
        last = _find_block(plain, ids, texts, q, edit_rate, schema)
    if last is None:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, [*found, last])


def _find_block(plain: DataFrame, ids: list, texts: list[str], q: int, edit_rate: float,
                schema: str) -> DataFrame:
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            rows = [(docs[i + r], ids[item], s, e, n)
                    for i, hits in _scan(token, texts, q, edit_rate, batch)
                    for r, item, s, e, n in hits]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)],
                names=["doc_id", "item_id", "start", "end", "edits"])
    return plain.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q,
                      edit_rate: float = EDIT_RATE) -> DataFrame:
    """``docs`` without the documents in which an item occurs; all columns kept."""
    need(docs, "text")
    need(benchmark, "item_id", "text")
    out, blocks = docs, 0
    for _, texts in item_blocks(benchmark, BLOCK_CHARS):
        if blocks:
            path = scratch_dir(docs.sparkSession, "clean")
            out.write.parquet(path)
            out = docs.sparkSession.read.schema(docs.schema).parquet(path)
        out, blocks = _drop_block(out, texts, q, edit_rate), blocks + 1
    return out


def _drop_block(docs: DataFrame, texts: list[str], q: int, edit_rate: float) -> DataFrame:
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for i, hits in _scan(token, texts, q, edit_rate, batch):
                keep[[i + h[0] for h in hits]] = False
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
