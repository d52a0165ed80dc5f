"""Substring deduplication over sliding runs of sentences.

A sentence ends at a word that ends in ``.``, ``!`` or ``?`` (closing quotes and brackets may follow),
at a line break or at the end of the text.  From every sentence on, the shortest run of consecutive
sentences that has ``SENTENCES`` sentences and ``LEAST`` words, or ``LONG`` words, is hashed by its
words; with ``both_ends`` also the shortest such run up to every sentence, and these together cover
every repeated run of that length or more.  Equal runs of all texts meet by their hash; the first is the one in the document of least id,
and there the earliest.  Sentences that any other one covers are removed.

Hashes are grouped with partial aggregation, and only repeated ones are joined back to their runs
(a plain join whose hot keys Spark can split); no group is gathered.

Defined results: NULL and empty texts have no runs, nor has a text too short for one; NULL document
ids sort last, and rows of different texts without an id are different documents, in order of the hash of
the text; rows that repeat a document id (or a text without an id) count as the same document (a run that
they share is not a repeat), but each text has its own stretches.  Extra columns are kept by :func:`remove_repeats`.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import vec
from tessera.llm.words import aside, need
from tessera.session import ensure_checkpoint_dir, scratch_dir

SENTENCES, LEAST, LONG = 2, 15, 50
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
_CLOSE = np.zeros(256, dtype=bool)
_CLOSE[[ord(c) for c in "\"')]}"]] = True


def runs_of(raw: np.ndarray, off: np.ndarray, both_ends: bool = False) -> tuple[np.ndarray, ...]:
    """Row, hash, first and last-plus-one character (in its row) of every run."""
    start, end, first = vec.word_spans(raw, off)
    n = len(start)
    if not n:
        return (np.zeros(0, np.int64),) * 4
    words = vec.word_hashes(raw, start, end)
    tail = raw[end - 1]
    tail = np.where(_CLOSE[tail] & (end - start > 1), raw[np.maximum(end - 2, 0)], tail)
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    stop = _STOP[tail]
    stop[:-1] |= breaks[start[1:]] > breaks[end[:-1]]
    row = np.searchsorted(first, np.arange(n), "right") - 1
    stop[-1] = True
    stop[:-1] |= row[1:] != row[:-1]
    ends = np.flatnonzero(stop) + 1  # words before the end of each sentence
    begins = np.concatenate([[0], ends[:-1]])
    at = np.arange(len(ends))
    last = np.minimum(np.searchsorted(ends, begins + LONG, "left"),
                      np.maximum(at + SENTENCES - 1, np.searchsorted(ends, begins + LEAST, "left")))
    ok = last < len(ends)
    pairs = at[ok] * len(ends) + last[ok]
    if both_ends:
        upto = np.maximum(np.searchsorted(begins, ends - LONG, "right") - 1,
                          np.minimum(at - SENTENCES + 1,
                                     np.searchsorted(begins, ends - LEAST, "right") - 1))
        back = upto >= 0
        # A run that is the shortest from its first and up to its last sentence counts once.
        pairs = np.unique(np.concatenate([pairs, upto[back] * len(ends) + at[back]]))
    at, last = np.divmod(pairs, len(ends))
    ok = row[begins[at]] == row[begins[last]]
    at, last = at[ok], last[ok]
    a, b = begins[at], ends[last]
    up, down = vec._powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    h = vec.mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    base = chars[off[row[a]]]
    return row[a], h.view(np.int64), chars[start[a]] - base, chars[end[b - 1]] - base


def _emit(batches: Iterator[pa.RecordBatch], both_ends: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = vec.utf8(batch.column("text"))
        for i, j in vec.chunks(off):
            row, h, a, b = runs_of(raw[off[i]:off[j]], off[i:j + 1] - off[i], both_ends)
            order = np.lexsort((h, row))
            again = np.zeros(len(h), dtype=bool)
            again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
            own = [batch.column(c).slice(i, j - i).take(pa.array(row, type=pa.int64()))
                   for c in ("doc_id", "key")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, type=pa.int64()), *own, pa.array(a, type=pa.int64()).cast(pa.int32()),
                 pa.array(b, type=pa.int64()).cast(pa.int32()), pa.array(again)],
                names=["h", "doc_id", "key", "start", "end", "again"])


def repeated_regions(docs: DataFrame, both_ends: bool = False) -> DataFrame:
    """``doc_id, start, end, runs, first_doc``: stretches of text (character places) that repeated
    runs cover, overlapping ones merged; ``first_doc`` is the least document that has one of them."""
    return _regions(docs, both_ends).drop("key")


def _regions(docs: DataFrame, both_ends: bool) -> DataFrame:
    """:func:`repeated_regions` and ``key``, the hash of the text."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    out = scratch_dir(spark, "runs")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"),
                "text").mapInArrow(
        partial(_emit, both_ends=both_ends),
        "h long, doc_id long, key long, start int, end int, again boolean").write.parquet(out)
    runs = spark.read.parquet(out)
    without = F.when(F.col("doc_id").isNull(), F.col("key"))  # documents without an id
    repeated = runs.groupBy("h").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
        F.min(without).alias("first_key"), F.max(without).alias("last_key"),
        F.max("again").alias("inside")).where(
        "first_doc <> last_doc OR first_key <> last_key OR inside OR "
        "(first_doc IS NOT NULL AND first_key IS NOT NULL)")
    firsts = repeated.select("h", "first_doc", "first_key").checkpoint(eager=True)
    later = runs.join(firsts, "h").where(
        "again OR doc_id <> first_doc OR "
        "(doc_id IS NULL AND (first_doc IS NOT NULL OR key <> first_key))")
    order = Window.partitionBy("doc_id", "key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") < F.col("reach"), 0).otherwise(1)
    merged = (later.withColumn("reach", reach).withColumn("part", F.sum(new).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "key", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                       F.count(F.lit(1)).alias("runs"),
                                       F.min("first_doc").alias("first_doc")))
    return merged.select("doc_id", F.col("start").cast("long").alias("start"),
                         F.col("end").cast("long").alias("end"), "runs", "first_doc", "key")


def remove_repeats(docs: DataFrame, both_ends: bool = False) -> DataFrame:
    """``docs`` with the repeated regions cut out of their texts; all rows and columns kept."""
    cuts = _regions(docs, both_ends).groupBy(F.col("doc_id").alias("__doc"), F.col("key").alias("__key")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cut"))
    own, back = aside(docs)
    whole = F.col(own.columns[docs.columns.index("text")])
    own_id = F.col(own.columns[docs.columns.index("doc_id")]).cast("long")

    def piece(i):
        begin = F.coalesce(F.get("__cut", i - 1)["end"], F.lit(0))
        stop = F.coalesce(F.get("__cut", i)["start"], F.length(whole))
        return F.substring(whole, (begin + 1).cast("int"), (stop - begin).cast("int"))

    pieces = F.transform(F.sequence(F.lit(0), F.size("__cut")), piece)
    text = F.when(F.col("__cut").isNull(), whole).otherwise(F.array_join(pieces, ""))
    joined = own.join(cuts, own_id.eqNullSafe(F.col("__doc")) & (F.xxhash64(whole) == F.col("__key")), "left")
    return joined.select(*[text.alias("text") if c == "text" else b for c, b in zip(docs.columns, back)])
