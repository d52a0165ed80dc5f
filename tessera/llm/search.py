"""Ranked lexical search over a length-stratified index.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII; A-Z count as a-z.
With N documents that hold a term, L terms in all and n terms in one document, the document's
normaliser is ``m = 100 - 90 + (90 * n * N) div L``.  A term of weight ``w`` that it holds ``tf`` times
adds ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` to its score: the impact depends on (term, m, tf)
alone.

* **Index.**  Documents of equal ``m`` are a stratum.  A stratum is dealt out in lots of bounded size and
  these are cut into pieces, so a stratum that holds a third of all documents spreads over many tasks.  A piece has
  one row per term: its distinct ``tf`` values, highest first, and per value the documents that hold the
  term so often.  Impacts are worked out once per value, not once per document.
* **Search.**  A piece can give an item at most the sum of the impacts of its terms' highest ``tf``.
  Pieces are visited in the order of these bounds: first the few of the highest, whose k-th best score
  is a threshold; then all others whose bound reaches it.  The result is exact.

Terms are identified by 64-bit hashes.  Defined results: NULL and empty texts hold no term and are in no
result; equal rows, and rows that repeat an id, are documents of their own and may each take a rank.
Equal scores go by document id, a NULL id last.  Items are told apart by id and text: equal rows are one
item, an item without terms gives no rows, a NULL item id is kept.  Empty tables give an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import vec
from tessera.llm.words import need
from tessera.session import ensure_checkpoint_dir, scratch_dir

#: Documents, and (document, term) pairs, of a piece; terms of a lot of a stratum and of a partition.
PIECE, PAIRS, LOT = 4096, 1 << 20, 1 << 21
#: Pieces of an item that are visited before its threshold is known; items scored together.
FIRST, ITEMS = 8, 1024
#: Tables of up to so many rows of 16 bytes, as (item, term) pairs or strata, are broadcast.
BROADCAST_PAIRS = 1 << 18
KEY = ["piece", "block"]

_CLEAN = np.full(256, 0x20, dtype=np.uint8)
_CLEAN[0x30:0x3A] = np.arange(0x30, 0x3A)
_CLEAN[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLEAN[0x41:0x5B] = np.arange(0x61, 0x7B)
_CLEAN[0x80:] = np.arange(0x80, 0x100)

_FORWARD = "doc_id long, salt int, n long, terms array<long>, tfs array<int>"
_INDEX = "m long, piece long, term long, docs int, top int, tfs array<int>, runs array<int>, who binary, " \
         "ids array<long>"


def _lists(values: np.ndarray, count: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, type=kind))


def term_counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of texts: row of the first, terms per text, distinct terms per text, and the distinct
    terms' hashes with their number of occurrences, text by text."""
    raw, off = vec.utf8(texts)
    for i, j in vec.chunks(off):
        part = _CLEAN[raw[off[i]:off[j]]]
        start, end, first = vec.word_spans(part, off[i:j + 1] - off[i])
        hashes = vec.word_hashes(part, start, end).view(np.int64)
        n = np.diff(first)
        text = np.repeat(np.arange(j - i), n)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        yield i, n, np.bincount(text[at], minlength=j - i), hashes[at], np.diff(np.append(at, len(hashes)))


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms per text."""
    for batch in batches:
        raw, off = vec.utf8(batch.column("text"))
        for i, j in vec.chunks(off):
            _, _, first = vec.word_spans(_CLEAN[raw[off[i]:off[j]]], off[i:j + 1] - off[i])
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(first))], names=["n"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = 0
    for batch in batches:
        for i, n, kinds, terms, tfs in term_counts(batch.column("text")):
            full = np.flatnonzero(n)
            ids = batch.column("doc_id").slice(i, len(n)).take(pa.array(full))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array((salt + full).astype(np.int32)), pa.array(n[full]),
                 _lists(terms, kinds[full], pa.int64()),
                 _lists(tfs.astype(np.int32), kinds[full], pa.int32())],
                names=["doc_id", "salt", "n", "terms", "tfs"])
            salt += len(n)


def _piece(ids: pa.Array, m: int, piece: int, terms: np.ndarray, kinds: np.ndarray,
           tfs: np.ndarray) -> pa.RecordBatch:
    """Rows of one piece: its document ids (in order), then one row per term."""
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), kinds)
    order = np.lexsort((doc, -tfs, terms))
    terms, tfs, doc = terms[order], tfs[order], doc[order]
    new_term = np.ones(len(terms), dtype=bool)
    new_term[1:] = terms[1:] != terms[:-1]
    new_run = new_term.copy()
    new_run[1:] |= tfs[1:] != tfs[:-1]
    run = np.flatnonzero(new_run)
    first = np.flatnonzero(new_term)
    runs_of = np.diff(np.append(np.flatnonzero(new_term[run]), len(run)))
    docs_of = np.diff(np.append(first, len(terms)))
    cut = np.concatenate([[0], np.cumsum(docs_of)]).astype(np.int32) * 4
    who = pa.Array.from_buffers(pa.binary(), len(first), [
        None, pa.py_buffer(cut.tobytes()), pa.py_buffer(doc.astype("<i4").tobytes())])
    n, none = len(first) + 1, pa.nulls
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, m)), pa.array(np.full(n, piece)),
         pa.concat_arrays([none(1, pa.int64()), pa.array(terms[first])]),
         pa.array(np.append(len(ids), docs_of).astype(np.int32)),
         pa.concat_arrays([none(1, pa.int32()), pa.array(tfs[first])]),
         pa.concat_arrays([none(1, pa.list_(pa.int32())), _lists(tfs[run], runs_of, pa.int32())]),
         pa.concat_arrays([none(1, pa.list_(pa.int32())), _lists(
             np.diff(np.append(run, len(terms))).astype(np.int32), runs_of, pa.int32())]),
         pa.concat_arrays([none(1, pa.binary()), who]),
         pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                           none(n - 1, pa.list_(pa.int64()))])],
        names=["m", "piece", "term", "docs", "top", "tfs", "runs", "who", "ids"])


def _pieces(most: int):
    """Rows sorted by ``m`` and document become pieces of one ``m`` and at most ``most`` documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in vec.whole_groups(_bounded(batches, most), ["m", "cut"]):
            table = table.combine_chunks()
            bounds = vec.group_bounds(table, ["m", "cut"])
            m = table.column("m").to_numpy()
            col = {c: table.column(c).chunk(0) for c in ("doc_id", "terms", "tfs")}
            for s, e in zip(bounds[:-1], bounds[1:]):
                terms, tfs = col["terms"].slice(s, e - s), col["tfs"].slice(s, e - s)
                kinds = np.asarray(terms.value_lengths())
                yield _piece(col["doc_id"].slice(s, e - s), int(m[s]), number,
                             terms.flatten().to_numpy(), kinds, tfs.flatten().to_numpy())
                number += 1
    return run


def _bounded(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows with ``cut``: consecutive rows that make a piece of bounded size."""
    cut = docs = pairs = 0
    last = None
    for batch in batches:
        cuts = []
        for m, k in zip(zip(batch.column("m").to_pylist(), batch.column("lot").to_pylist()),
                        np.asarray(batch.column("terms").value_lengths()).tolist()):
            if m != last or docs == most or pairs + k > PAIRS:
                cut, docs, pairs, last = cut + 1, 0, 0, m
            docs, pairs = docs + 1, pairs + k
            cuts.append(cut)
        if cuts:
            yield batch.append_column("cut", pa.array(cuts, pa.int64()))


@dataclass
class Index:
    """Rows per piece and term (``_INDEX``; the row without a term holds the piece's document ids), the
    number of documents with a term, and of all terms."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def _written(df: DataFrame, name: str) -> DataFrame:
    out = scratch_dir(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def build_index(docs: DataFrame, piece: int = PIECE) -> Index:
    """Index of every document's whole text, written to the shared folder."""
    need(docs, "doc_id", "text")
    ensure_checkpoint_dir(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lengths = _written(texts.select("text").mapInArrow(_lengths, "n long").where("n > 0").groupBy("n").agg(
        F.count(F.lit(1)).alias("docs")), "search-lengths")
    n_docs, n_terms = (x or 0 for x in lengths.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first())
    m = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    # A stratum's documents go to as many lots as its terms fill, by a hash.
    lots = lengths.groupBy(m.alias("m")).agg(
        F.ceil(F.sum(F.col("n") * F.col("docs")) / F.lit(LOT)).alias("lots"))
    if lots.count() <= BROADCAST_PAIRS:
        lots = F.broadcast(lots)
    lot = F.pmod(F.xxhash64("doc_id", "salt"), F.col("lots")).alias("lot")
    forward = texts.mapInArrow(_forward, _FORWARD).withColumn("m", m)
    rows = forward.join(lots, "m").select("m", lot, "doc_id", "salt", "terms", "tfs").repartition(
        max(1, -(-n_terms // LOT)), "m", "lot").sortWithinPartitions(
        "m", "lot", F.asc_nulls_last("doc_id"), "salt").mapInArrow(_pieces(piece), _INDEX)
    return Index(_written(rows, "search-index"), n_docs, n_terms)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, n, kinds, terms, _ in term_counts(batch.column("text")):
            item = batch.column("item").slice(i, len(n)).take(pa.array(np.repeat(np.arange(len(n)), kinds)))
            yield pa.RecordBatch.from_arrays([item, pa.array(terms)], names=["item", "term"])


def _score(k: int):
    """Per piece and block of items: each item's ``k`` best documents that reach its threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vec.whole_groups(batches, KEY):
            bounds = vec.group_bounds(table, KEY)
            m = table.column("m").to_numpy()
            cols = {c: table.column(c) for c in ("ids", "tfs", "runs", "who", "w", "items", "least")}
            out: list[tuple] = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                # The first row has the ids, and the items to visit with their thresholds.
                ids, docs = cols["ids"][s].as_py(), {}
                visits = dict(zip(cols["items"][s].as_py(), cols["least"][s].as_py()))
                for r in range(s + 1, e):
                    tf = cols["tfs"][r].values.to_numpy().astype(np.int64)
                    gain = cols["w"][r].as_py() * ((10 ** 9 * tf) // (1000 * tf + 8 * m[s]))
                    who = np.frombuffer(cols["who"][r].as_py(), "<i4")
                    both = who, np.repeat(gain, cols["runs"][r].values.to_numpy())
                    for item in visits.keys() & set(cols["items"][r].as_py()):
                        docs.setdefault(item, []).append(both)
                for item, least in visits.items():
                    score = np.zeros(len(ids), dtype=np.int64)
                    for who, gain in docs.get(item, []):
                        score[who] += gain
                    at = np.flatnonzero(score >= max(1, least))
                    if len(at) > k:
                        at = at[score[at] >= np.partition(score[at], -k)[-k]]
                    at = at[np.argsort(-score[at], kind="stable")][:k]
                    out += [(item, ids[a], int(score[a])) for a in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in (zip(*out) if out else [[]] * 3)],
                names=["item", "doc_id", "score"])
    return run


def _waves(index: Index, terms: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Best documents of the pieces that ``visits`` (``item, block, piece, least``) names."""
    todo = visits.groupBy("piece", "block").agg(
        F.collect_list(F.struct("item", "least")).alias("v")).select(
        "piece", "block", F.col("v.item").alias("items"), F.col("v.least").alias("least"))
    ids = index.rows.where("term IS NULL").select("piece", "m", "term", "ids").join(todo, "piece")
    held = index.rows.where("term IS NOT NULL").drop("ids", "docs", "top").join(terms, "term").join(
        todo.select("piece", "block"), KEY, "left_semi")
    rows = ids.unionByName(held, allowMissingColumns=True)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *KEY).sortWithinPartitions(
        *KEY, F.asc_nulls_first("term")).mapInArrow(_score(k), "item long, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int = 10, first: int = FIRST,
           block: int = ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents of a score above 0."""
    need(queries, "item_id", "text")
    items = _written(queries.select("item_id", "text").distinct().withColumn(
        "item", F.xxhash64("item_id", "text")), "search-items")
    pairs = _written(items.select("item", "text").mapInArrow(
        _query_terms, "item long, term long"), "search-terms")
    small = pairs.count() <= BROADCAST_PAIRS
    hint = F.broadcast if small else (lambda df: df)
    blocks = max(1, -(-items.count() // block))
    part = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
    held = index.rows.where("term IS NOT NULL").select("term", "piece", "m", "docs", "top").join(
        hint(pairs.select("term").distinct()), "term")
    df = held.groupBy("term").agg(F.sum("docs").alias("df"))
    weights = _written(df.select("term", F.floor(F.lit(1000.0) * F.log(
        F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1))).cast("long").alias("w")),
        "search-weights")
    weighted = pairs.join(weights, "term")
    bounds = _written(held.join(hint(weighted), "term").groupBy("item", "piece").agg(
        F.sum(F.expr("w * ((1000000000L * top) div (1000L * top + 8L * m))")).alias("bound")).where(
        "bound > 0").select("item", "piece", "bound", part), "search-bounds")
    terms = hint(weighted.groupBy("term", "w", part).agg(F.collect_list("item").alias("items")))

    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "piece")
    top = bounds.withColumn("place", F.row_number().over(by_bound)).where(
        F.col("place") <= first).withColumn("least", F.lit(0).cast("long")).drop("place")
    top = _written(top, "search-first")
    found = _written(_best(_waves(index, terms, top, k), k), "search-found")
    least = found.where(F.col("rank") == k).select("item", F.col("score").alias("least"))
    rest = bounds.join(top.select("item", "piece"), ["item", "piece"], "left_anti").join(
        least, "item", "left").withColumn("least", F.coalesce("least", F.lit(0)))
    more = _waves(index, terms, rest.where("bound >= least"), k)
    best = _best(found.drop("rank").unionByName(more), k)
    return best.join(items.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: The same by scoring every pair of an item and a document that share a term.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
e AS (SELECT *, len(terms) AS n FROM d WHERE len(terms) > 0),
g AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM e),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM e) GROUP BY r, term),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, g GROUP BY term, nn),
s AS (SELECT item_id, q.text, e.r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN p ON q.term = p.term JOIN w ON w.term = p.term JOIN e ON e.r = p.r, g
  GROUP BY item_id, q.text, e.r, doc_id),
k AS (SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""
