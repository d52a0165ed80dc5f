"""Near duplicates by HyperMinHash.

Texts are sets of word 4-grams (A-Z count as a-z); texts whose sets have a Jaccard similarity of at least
0.8 are linked, and linked texts are one component.  Texts of equal sets are one node.

1. **Sketch.**  An n-gram's hash names one of 128 buckets; a bucket keeps its least remaining hash as the
   count of leading zeros (6 bits) and the 10 bits after the leading one, 16 bits in all.
2. **Bands.**  For banding alone, an empty register borrows the next full one to its right and a mark of
   how far it came.  32 bands of 4 registers: two sets of similarity 0.8 share none with a chance below
   1e-7.
3. **Estimate.**  Of the registers that either set fills, the share that agree, corrected for the share
   that agree by accident (the register's cells are coarse), estimates the similarity; sets that may
   reach the threshold are then compared by their full n-gram sets.
4. **Links.**  First every set meets the set that leads its bands (the one of most company), and one such
   pair per set is verified; connected components of these links follow.  Then the sets of a band whose
   components differ are compared with each other: a pair within a component can no longer change
   anything, so most of a large group of copies costs a comparison each, and no link between components
   is left out.  No pair of this step is ever a row: groups of bounded size pass on a forest of links.

Defined results: a text of fewer than four words is one n-gram of all its words; a text without words
(or NULL) has no n-grams, no links, and is a component of its own.  Equal rows and rows that repeat an id
are documents of their own; a NULL id never names a component unless all its ids are NULL.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import vec
from tessera.llm.components import connected_components
from tessera.llm.words import need
from tessera.session import ensure_checkpoint_dir, scratch_dir

WIDTH = 4
THRESHOLD = 0.8
BUCKETS, ZEROS, MANTISSA = 128, 6, 10
BANDS, ROWS = 32, 4
#: Sets of a band that meet as many others in one group; larger bands make several groups.
BLOCK = 1024
KEY = ["band", "p", "q"]
#: Standard deviations that an estimate may be below the threshold.
SPREAD = 4.5
#: Pairs that are verified in one group.
PAIRS = 512

_BUCKET_BITS = BUCKETS.bit_length() - 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def text_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Row number of the first text of a chunk, and its texts' sorted distinct n-gram hashes."""
    raw, off = vec.utf8(texts)
    for i, j in vec.chunks(off):
        part = _LOWER[raw[off[i]:off[j]]]
        start, end, first = vec.word_spans(part, off[i:j + 1] - off[i])
        grams, begin = vec.shingles(vec.word_hashes(part, start, end), first, width)
        yield i, [np.unique(grams[a:b]) for a, b in zip(begin[:-1], begin[1:])]


def set_id(grams: np.ndarray) -> bytes:
    """128 bits that depend on the set only."""
    one = np.add.reduce(vec.mix(grams ^ np.uint64(0x2545F4914F6CDD1D)))
    two = np.bitwise_xor.reduce(vec.mix(grams + np.uint64(0x9E6C63D0876A9A47)))
    return np.array([one, two + np.uint64(len(grams))], dtype="<u8").tobytes()


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches (one row per set): 0 for an empty bucket, else leading zeros + 1 and mantissa."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    least = np.full(len(sets) * BUCKETS, np.iinfo(np.uint64).max, dtype=np.uint64)
    if size.sum():
        flat = vec.mix(np.concatenate(sets) ^ np.uint64(0xD1B54A32D192ED03))
        cell = np.repeat(np.arange(len(sets)), size) * BUCKETS + (
            flat >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        # 53 bits after the bucket's: exact in a double.
        np.minimum.at(least, cell, (flat << np.uint64(_BUCKET_BITS)) >> np.uint64(11))
    full = least != np.iinfo(np.uint64).max
    part, power = np.frexp(least.astype(np.float64))
    zeros = np.minimum(53 - power, 2 ** ZEROS - 2)
    mantissa = ((part * 2 - 1) * 2 ** MANTISSA).clip(0).astype(np.int64)
    out = np.where(full, ((zeros + 1) << MANTISSA) | mantissa, 0)
    return out.astype(np.uint16).reshape(-1, BUCKETS)


def accidental(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chance that a register of disjoint sets of ``a`` and ``b`` n-grams agrees though both fill it:
    the sum over leading zeros of the chance that both least hashes fall into one cell."""
    low = 0.5 ** np.arange(1, 2 ** ZEROS - 1)[None, :]  # least hashes in [low, 2 low)
    a, b = (np.asarray(x, dtype=np.float64)[:, None] / BUCKETS * low for x in (a, b))
    return (a * b / (a + b) * np.exp(-a - b) * -np.expm1(-a - b)).sum(axis=1) / 2 ** MANTISSA


def estimate(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity estimates of rows of sketches of sets of sizes ``a`` and ``b``, and the number of
    registers that they rest on."""
    used = ((x > 0) | (y > 0)).sum(axis=-1)
    share = ((x == y) & (x > 0)).sum(axis=-1) / np.maximum(used, 1)
    chance = accidental(a, b)
    return (share - chance) / (1 - chance), used


def may_link(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether estimates leave room for the threshold, and sizes allow it."""
    found, used = estimate(x, y, a, b)
    room = SPREAD * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    return (found >= threshold - room) & (np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9)


def _filled(sketch: np.ndarray) -> np.ndarray:
    """Registers for banding: an empty one takes the next full one to its right (around the end)."""
    n = sketch.shape[1]
    twice = np.concatenate([sketch, sketch], axis=1)
    at = np.where(twice > 0, np.arange(2 * n)[None, :], 2 * n)
    at = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :n]
    away = at - np.arange(n)[None, :]
    return np.take_along_axis(twice, np.minimum(at, 2 * n - 1), axis=1).astype(np.uint64) | (
        away.astype(np.uint64) << np.uint64(16))


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band (rows x 32)."""
    cells = vec.mix(_filled(sketch) + np.uint64(0x5851F42D4C957F2D)).reshape(len(sketch), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xDA942042E4DD58B5)
    for k in range(ROWS):
        key = vec.mix(key + cells[:, :, k])
    return key.view(np.int64)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in text_sets(batch.column("text"), width):
                part = batch.slice(i, len(sets))
                sketch = registers(sets)
                full = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tkey"),
                     pa.array([len(s) for s in sets], type=pa.int64()),
                     pa.array([set_id(s) if f else None for s, f in zip(sets, full)], type=pa.binary()),
                     pa.array([r.tobytes() for r in sketch], type=pa.binary()),
                     pa.ListArray.from_arrays(
                         np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32),
                         pa.array(band_keys(sketch).reshape(-1)))],
                    names=["doc_id", "tkey", "n_shingles", "set_id", "sketch", "bands"])
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    out = scratch_dir(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def _rows_of(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, BUCKETS)


def _estimated(threshold: float):
    """Of pairs ``a, b`` with both sketches, those that may reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_rows_of(batch.column(c)) for c in ("sketch_a", "sketch_b"))
            ok = may_link(x, y, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), threshold)
            yield batch.select(["a", "b", "weight"]).filter(pa.array(ok))
    return run


def _crossing(threshold: float):
    """Per group of a band: its seekers and targets that a pair of different components may link, each
    seeker with a bit map of its targets.  A pair is looked at in the first band that it shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vec.whole_groups(batches, KEY):
            bounds = vec.group_bounds(table, KEY)
            keys = [table.column(k).to_numpy() for k in KEY]
            col = {c: table.column(c).to_numpy() for c in ("seeker", "out", "h", "n_shingles")}
            ids, sketch = table.column("set_id").to_pylist(), _rows_of(table.column("sketch"))
            comp = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
            out: list[tuple] = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                n = int(col["seeker"][s:e].sum())  # seekers come first
                own, found = band_keys(sketch[s:e]), np.zeros((n, e - s - n), dtype=bool)
                place = int((own[0] == keys[0][s]).argmax())
                for r in range(n):
                    at = np.flatnonzero((comp[s + n:e] != comp[s + r]) & (
                        ~col["out"][s + n:e] | (col["h"][s + n:e] >= col["h"][s + r])))
                    at = at[~(own[n + at, :place] == own[r, :place]).any(axis=1)]
                    if len(at):
                        size = col["n_shingles"][s + n + at]
                        found[r, at] = may_link(sketch[s + r][None, :], sketch[s + n + at], np.full(
                            len(at), col["n_shingles"][s + r]), size, threshold)
                rows, cols = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
                bits = np.packbits(found[np.ix_(rows, cols)], axis=1)
                key = tuple(int(k[s]) for k in keys)
                out += [(*key, k, ids[s + r], bits[k].tobytes()) for k, r in enumerate(rows)]
                out += [(*key, len(rows) + k, ids[s + n + c], None) for k, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*out) if out else [[]] * 6, [
                    pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()])],
                names=[*KEY, "idx", "set_id", "targets"])
    return run


def _joined(threshold: float):
    """Per group: its pairs compared by their full sets; links that join its sets, a forest at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vec.whole_groups(batches, KEY):
            bounds = vec.group_bounds(table, KEY)
            ids, bits = table.column("set_id").to_pylist(), table.column("targets").to_pylist()
            grams, out = table.column("grams"), []
            for s, e in zip(bounds[:-1], bounds[1:]):
                sets = [np.frombuffer(grams[r].as_py(), "<u8") for r in range(s, e)]
                size = np.array([len(x) for x in sets])
                n = sum(b is not None for b in bits[s:e])
                kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
                first, root = np.cumsum(size) - size, list(range(e - s))

                def top(x: int) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x
                for r in range(n):
                    at = n + np.flatnonzero(np.unpackbits(np.frombuffer(bits[s + r], np.uint8))[:e - s - n])
                    held = np.zeros(len(kinds), dtype=np.int64)
                    held[flat[first[r]:first[r] + size[r]]] = 1
                    both = np.add.reduceat(held[flat[first[n]:]], first[n:] - first[n])[at - n]
                    for c in at[both >= threshold * (size[r] + size[at] - both) - 1e-9].tolist():
                        x, y = top(r), top(c)
                        if x != y:
                            root[y] = x
                            out.append((ids[s + r], ids[s + c]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.binary()) for c in (zip(*out) if out else [[]] * 2)],
                names=["src", "dst"])
    return run


def _wanted_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in text_sets(batch.column("text"), width):
                want = batch.column("want").slice(i, len(sets)).to_pylist()
                keep = [(w, s) for w, s in zip(want, sets) if len(s) and set_id(s) == w]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in keep], type=pa.binary()),
                     pa.array([s.astype("<u8").tobytes() for _, s in keep], type=pa.binary())],
                    names=["set_id", "grams"])
    return run


def _verified(threshold: float):
    """Per group: the first row has the set of ``a``, the others those of its partners ``b``."""
    key = ["a", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            for a, part, b, grams in zip(*(batch.column(c).to_pylist() for c in (*key, "b", "grams"))):
                own = np.frombuffer(grams, "<u8")
                if b is None:
                    head, base = (a, part), own
                    continue
                assert head == (a, part)
                at = np.searchsorted(base, own)
                at[at == len(base)] = 0
                both = int((base[at] == own).sum())
                if both >= threshold * (len(base) + len(own) - both) - 1e-9:
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.binary()) for c in (zip(*out) if out else [[]] * 2)],
                names=["src", "dst"])
    return run


class _Corpus:
    """Work tables of one run."""

    def __init__(self, docs: DataFrame, threshold: float, width: int) -> None:
        self.threshold, self.width = threshold, width
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                F.xxhash64("text").alias("tkey"))
        self.rows = _written(self.docs.select("doc_id", "tkey", "text").mapInArrow(
            _sketches(width), "doc_id long, tkey long, n_shingles long, set_id binary, sketch binary, "
                              "bands array<long>"), "sketches")
        self.sets = _written(self.rows.where("set_id IS NOT NULL").groupBy("set_id").agg(
            F.min(F.struct("doc_id", "tkey")).alias("one"), F.min("doc_id").alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "sets")

    def grams(self, ids: DataFrame) -> DataFrame:
        """``set_id, grams`` of the distinct ids, read off one text of each set."""
        want = self.sets.select("set_id", "one.*").join(ids, "set_id").select(
            F.col("set_id").alias("want"), F.col("doc_id").alias("__doc"), F.col("tkey").alias("__key"))
        of = self.docs.join(want, (F.col("tkey") == F.col("__key")) & F.col("doc_id").eqNullSafe(
            F.col("__doc")))
        return _written(of.select("text", "want").mapInArrow(
            _wanted_sets(self.width), "set_id binary, grams binary").dropDuplicates(["set_id"]), "grams")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs ``a, b``, those whose full sets reach the threshold (``src, dst``)."""
        grams = self.grams(pairs.select(F.col("a").alias("set_id")).unionAll(
            pairs.select(F.col("b").alias("set_id"))).distinct())
        # The partners of a set in parts: its own n-grams come once a part.
        parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAIRS)).cast("int").alias("parts"))
        heads = parts.join(grams.withColumnRenamed("set_id", "a"), "a").select(
            "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.lit(None).cast("binary").alias("b"), "grams")
        tails = pairs.join(parts, "a").select(
            "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b").join(
            grams.withColumnRenamed("set_id", "b"), "b").select("a", "part", "b", "grams")
        n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return _written(heads.unionByName(tails).repartition(n, "a", "part").sortWithinPartitions(
            "a", "part", F.asc_nulls_first("b")).mapInArrow(
            _verified(self.threshold), "src binary, dst binary"), "links")


def _size_fits(a: str, b: str, threshold: float) -> Column:
    return F.least(a, b) >= F.lit(threshold) * F.greatest(a, b) - 1e-9


def _across(data: _Corpus, met: DataFrame, comps: DataFrame, sketch: DataFrame, block: int) -> DataFrame:
    """Links between components: in each band, its sets outside the largest component seek partners
    among all of the band's sets, in groups of bounded size."""
    named = met.select("band", "set_id", "n_shingles").join(
        comps.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id"))
    mixed = named.groupBy("band", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("band").agg(
        F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("n"),
        F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(
        "band", F.col("top.component").alias("main"),
        F.ceil((F.col("n") - F.col("top.c")) / F.lit(block)).cast("int").alias("n_p"),
        F.ceil(F.col("n") / F.lit(block)).cast("int").alias("n_q"))
    rows = named.join(mixed, "band").withColumn("out", F.col("component") != F.col("main")).withColumn(
        "h", F.xxhash64("set_id"))
    p, q = (F.pmod("h", F.col(c)).cast("int") for c in ("n_p", "n_q"))
    kept = ["band", "p", "q", "seeker", "out", "h", "set_id", "component", "n_shingles"]
    seekers = rows.where("out").withColumn("p", p).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1))).withColumn("seeker", F.lit(True))
    targets = rows.withColumn("q", q).withColumn(
        "p", F.explode(F.sequence(F.lit(0), F.col("n_p") - 1))).withColumn("seeker", F.lit(False))
    n = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _written(seekers.select(kept).unionAll(targets.select(kept)).join(sketch, "set_id").repartition(
        n, *KEY).sortWithinPartitions(*KEY, F.desc("seeker")).mapInArrow(
        _crossing(data.threshold),
        "band long, p int, q int, idx int, set_id binary, targets binary"), "crossing")
    grams = data.grams(found.select("set_id").distinct())
    return _written(found.join(grams, "set_id").repartition(n, *KEY).sortWithinPartitions(
        *KEY, "idx").mapInArrow(_joined(data.threshold), "src binary, dst binary"), "links")


def components(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH,
               block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    need(docs, "doc_id", "text")
    ensure_checkpoint_dir(docs.sparkSession)
    data = _Corpus(docs, threshold, width)
    sizes = data.sets.select("set_id", "n_shingles")
    banded = data.sets.select("set_id", "n_shingles", F.explode("bands").alias("band"))
    bands = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = _written(banded.join(bands, "band"), "bands")
    # The set of most company over all its bands leads a band: of near copies, the one in their midst.
    weight = met.groupBy("set_id").agg(F.sum("n").alias("w"))
    leads = met.select("band", "set_id").join(weight, "set_id").groupBy("band").agg(
        F.max(F.struct("w", "set_id")).alias("m")).select(
        "band", F.col("m.set_id").alias("lead"), F.col("m.w").alias("weight"))
    met = _written(met.join(leads, "band"), "led-bands")

    # One pair per set: with the leading set of its bands, of those it may be linked to, of most weight.
    lead = sizes.select(F.col("set_id").alias("lead"), F.col("n_shingles").alias("n_lead"))
    stars = met.where("set_id <> lead").select("set_id", "n_shingles", "lead", "weight").distinct().join(
        lead, "lead").where(_size_fits("n_shingles", "n_lead", threshold))
    sketch = data.sets.select("set_id", "sketch")
    both = stars.join(sketch.withColumnRenamed("sketch", "sketch_b"), "set_id").join(
        sketch.select(F.col("set_id").alias("lead"), F.col("sketch").alias("sketch_a")), "lead")
    likely = both.select(F.col("lead").alias("a"), F.col("set_id").alias("b"), "weight",
                         F.col("n_lead").alias("n_a"), F.col("n_shingles").alias("n_b"),
                         "sketch_a", "sketch_b").mapInArrow(
        _estimated(threshold), "a binary, b binary, weight long")
    pairs = _written(likely.groupBy("b").agg(F.max(F.struct("weight", "a")).alias("m")).select(
        "m.a", "b"), "pairs")
    links = data.verify(pairs)
    comps = _written(connected_components(links), "components-1")
    more = _across(data, met, comps, sketch, block)
    comps = _written(connected_components(links.unionAll(more)), "components-2")

    info = data.sets.select("set_id", "least").join(
        comps.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id"))
    names = info.groupBy("component").agg(F.min("least").alias("component_id"))
    info = _written(info.select("set_id", "component").join(names, "component").select(
        F.col("set_id").alias("__set"), "component_id"), "component-names")
    named = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return data.rows.select("doc_id", "n_shingles", "set_id").join(
        info, F.col("set_id") == F.col("__set"), "left").select(
        "doc_id", "n_shingles", named.alias("component_id"), F.col("doc_id").eqNullSafe(named).alias("kept"))


#: The same by counting the n-grams that every two texts share, and all texts that links reach.
SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4
    THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2),
    lambda i: array_to_string(w[i:i + 3], ' ')) END) AS grams FROM d),
e AS MATERIALIZED (SELECT r, len(grams) AS n, unnest(grams) AS gram FROM g),
links AS MATERIALIZED (SELECT a.r AS x, b.r AS y FROM e a JOIN e b ON a.gram = b.gram AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT r AS x, r AS y FROM g UNION SELECT reach.x, links.y FROM reach JOIN links
  ON reach.y = links.x),
c AS (SELECT reach.x AS r, min(g.doc_id) AS component_id FROM reach JOIN g ON reach.y = g.r GROUP BY reach.x)
SELECT doc_id, len(grams)::BIGINT AS n_shingles, component_id,
  doc_id IS NOT DISTINCT FROM component_id AS kept
FROM g JOIN c ON g.r = c.r"""
