"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-grams; all pairs of texts with Jaccard similarity of at least the threshold
are linked.  Texts of equal sets are one node, so copies are never expanded into pairs.

1. Each set gets a signature of 128 min-hash tokens.  A node of the search tree holds the sets that
   share the tokens chosen on its path: from the root, each run samples two tokens per node (by a
   hash of the path) and splits the node's sets on them.  A node of few sets, or whose sets agree on
   most sampled tokens, is a leaf; others are split again.
2. In a leaf all pairs are compared by signature, and those that could reach the threshold by their
   5-gram sets: the check is exact.  A leaf of many sets is cut into blocks that meet pairwise, so
   no task holds more than two blocks.  A pair that meets in several leaves is checked in one only,
   and no pair is ever a row: tasks return link counts and a spanning forest.
3. A pair at the threshold survives in one run's tree with probability ``survival(threshold)``; runs
   repeat until the chance of having found it reaches the target recall.

Defined results: a text of fewer than five words is one n-gram of all its words; a text without
words (or NULL) has no links and is its own class.  Rows that repeat a document id are documents of
their own with equal ids; NULL ids are kept.  Extra columns are ignored by the join and kept by
:func:`keep_one`.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import vec
from tessera.llm.components import connected_components
from tessera.llm.words import need
from tessera.session import ensure_checkpoint_dir, scratch_dir

WIDTH = 5
THRESHOLD = 0.8
TOKENS = 128
BRANCH = 2
#: Sets that a leaf holds at most before it is split further, and sets of a block of a large leaf.
LEAF, BLOCK = 64, 1024
#: A node is a leaf as well where two of its sets agree on a sampled token this often.
ALIKE = 0.5
DEPTH = 8
KEY = ["path", "i", "j"]


def survival(threshold: float, branch: int = BRANCH) -> float:
    """Chance that a pair at the threshold stays together along some path of any depth."""
    s = 1.0
    for _ in range(200):
        s = 1 - (1 - threshold * s) ** branch
    return s


def runs_for(recall: float, threshold: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(threshold)))


def _factors() -> np.ndarray:
    return vec.mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) \
        | np.uint64(1)


def text_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Row number of the first text, and each text's sorted distinct n-gram hashes."""
    raw, off = vec.utf8(texts)
    for i, j in vec.chunks(off):
        part = raw[off[i]:off[j]]
        start, end, first = vec.word_spans(part, off[i:j + 1] - off[i])
        grams, begin = vec.shingles(vec.word_hashes(part, start, end), first, width)
        yield i, [np.unique(grams[a:b]) for a, b in zip(begin[:-1], begin[1:])]


def set_id(grams: np.ndarray) -> bytes:
    """128 bits that depend on the set only."""
    total = np.add.reduce(vec.mix(grams)), np.bitwise_xor.reduce(
        vec.mix(grams + np.uint64(0x632BE59BD9B4E019)))
    return np.array([total[0], total[1] + np.uint64(len(grams))], dtype="<u8").tobytes()


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors()
        for batch in batches:
            for i, sets in text_sets(batch.column("text"), width):
                part = batch.slice(i, len(sets))
                size = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(size)
                sig = np.zeros((len(sets), TOKENS), dtype=np.uint32)
                if len(full):
                    flat = np.concatenate(sets)
                    at = (np.cumsum(size) - size)[full]
                    for k, a in enumerate(factors):
                        sig[full, k] = np.minimum.reduceat(flat * a, at) >> np.uint64(32)
                ids = [set_id(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("tkey"),
                     pa.array(ids, type=pa.binary()),
                     pa.ListArray.from_arrays(
                         np.arange(0, TOKENS * len(sets) + 1, TOKENS, dtype=np.int32),
                         pa.array(sig.view(np.int32).reshape(-1))),
                     pa.array([s.tobytes() for s in sig.astype(np.uint8)], type=pa.binary())],
                    names=["doc_id", "tkey", "set_id", "sig", "low"])
    return run


def _leaves(sets: DataFrame, runs: int, seed: int) -> DataFrame:
    """``set_id, path, n``: the leaves that each set is in, of two sets at least."""
    def child(path, coord):
        return F.xxhash64(path, coord, F.element_at("sig", coord + 1))

    def coords(path):
        out, first = [], F.pmod(F.xxhash64(F.lit(1), path), F.lit(TOKENS)).cast("int")
        step = F.pmod(F.xxhash64(F.lit(2), path), F.lit((TOKENS - 1) // BRANCH)).cast("int")
        for k in range(BRANCH):
            out.append(F.pmod(first + F.lit(k) * (step + 1), F.lit(TOKENS)).cast("int"))
        return out

    roots = [F.xxhash64(F.lit(seed), F.lit(r)) for r in range(runs)]
    nodes = sets.select("set_id", F.explode(F.array(*[
        child(p, c) for p in roots for c in coords(p)])).alias("path"))
    leaves = None
    for depth in range(1, DEPTH + 1):
        counts = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        nodes = nodes.join(counts.checkpoint(eager=True), "path").checkpoint(eager=True)
        large = nodes.where(F.col("n") > LEAF)
        done = nodes.where(F.col("n") <= LEAF)
        last = depth == DEPTH or large.isEmpty()
        if last:
            done = nodes
        else:
            kids = large.join(sets.select("set_id", "sig"), "set_id").select(
                "set_id", "path", "n", F.posexplode(F.array(*[
                    child(F.col("path"), c) for c in coords(F.col("path"))])).alias("k", "kid"))
            kids = kids.checkpoint(eager=True)
            alike = (kids.groupBy("path", "n", "k", "kid").agg(F.count(F.lit(1)).alias("c"))
                     .groupBy("path").agg((F.sum(F.col("c").cast("double") * F.col("c"))
                                           / F.max(F.col("n").cast("double") * F.col("n"))
                                           / BRANCH >= ALIKE).alias("alike"))
                     .checkpoint(eager=True))
            stay = alike.where("alike").select("path")
            done = done.unionAll(large.join(stay, "path", "left_semi").select(nodes.columns))
            nodes = kids.join(alike.where("NOT alike").select("path"), "path", "left_semi").select(
                "set_id", F.col("kid").alias("path"))
        done = done.select("set_id", "path", "n")
        leaves = done if leaves is None else leaves.unionAll(done)
        if last:
            return leaves


def _blocks(leaves: DataFrame) -> DataFrame:
    """``set_id, path, i, j, b``: large leaves cut into blocks that meet pairwise."""
    cut = leaves.withColumn("nb", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")).withColumn(
        "b", F.pmod(F.xxhash64("set_id"), F.col("nb")).cast("int"))
    return cut.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "set_id", "path", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b")


def _grouped(df: DataFrame, *more: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *KEY).sortWithinPartitions(*KEY, *more)


def _pair_mask(b: np.ndarray, i: int, j: int) -> np.ndarray:
    mask = np.triu(np.ones((len(b), len(b)), dtype=bool), 1)
    return mask if i == j else mask & (b[:, None] != b[None, :])


def _met_before(paths: list[np.ndarray], path: int) -> np.ndarray | None:
    """Pairs of rows that share a leaf of a lesser path."""
    row = np.repeat(np.arange(len(paths)), [len(p) for p in paths])
    flat = np.concatenate(paths)
    row, flat = row[flat < path], flat[flat < path]
    kinds, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[at] > 1
    if not shared.any():
        return None
    _, at = np.unique(at[shared], return_inverse=True)
    held = np.zeros((len(paths), int(at.max()) + 1), dtype=np.float32)
    held[row[shared], at] = 1
    return held @ held.T > 0


def _candidates(least: int):
    """Per block: its sets with a bit map of the later sets that each must be checked against."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vec.whole_groups(batches, KEY):
            bounds = vec.group_bounds(table, KEY)
            keys = [table.column(k).to_numpy() for k in KEY]
            b = table.column("b").to_numpy()
            ids, copies = table.column("set_id").to_pylist(), table.column("copies").to_numpy()
            low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(
                -1, TOKENS)
            paths = table.column("paths").combine_chunks()
            flat = paths.flatten().to_numpy()
            lens = np.asarray(pc.list_value_length(paths))
            offs = np.concatenate([[0], np.cumsum(lens)])
            out: list[tuple] = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s < 2:
                    continue
                path, i, j = (int(k[s]) for k in keys)
                mask = _pair_mask(b[s:e], i, j)
                met = _met_before([flat[offs[r]:offs[r + 1]] for r in range(s, e)], path)
                if met is not None:
                    mask &= ~met
                own = low[s:e]
                for r in np.flatnonzero(mask.any(axis=1)):
                    cols = np.flatnonzero(mask[r])
                    mask[r, cols] = (own[cols] == own[r]).sum(axis=1) >= least
                used = np.flatnonzero(mask.any(axis=1) | mask.any(axis=0))
                bits = np.packbits(mask[np.ix_(used, used)], axis=1)
                out += [(path, i, j, k, ids[s + r], int(copies[s + r]), bits[k].tobytes())
                        for k, r in enumerate(used)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(
                    zip(*out) if out else [[]] * 7,
                    [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(),
                     pa.binary()])], names=[*KEY, "idx", "set_id", "copies", "partners"])
    return run


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Size of the intersection of sets ``a[k]`` and ``b[k]``."""
    out = np.zeros(len(a), dtype=np.int64)
    used = np.unique(np.concatenate([a, b]))
    kinds, at = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True)
    if len(a) * 10_000 > len(used) ** 2 * len(kinds) * 1e-1:  # many pairs over few n-grams
        row = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        total = np.zeros((len(used), len(used)), dtype=np.float64)
        for c in range(0, len(kinds), 4096):
            x, y = np.searchsorted(at, [c, c + 4096])
            held = np.zeros((len(used), 4096), dtype=np.float32)
            held[row[x:y], at[x:y] - c] = 1
            total += held @ held.T
        place = {u: k for k, u in enumerate(used)}
        return total[[place[x] for x in a], [place[x] for x in b]].astype(np.int64)
    for k, (x, y) in enumerate(zip(a, b)):
        p, q = (sets[x], sets[y]) if len(sets[x]) < len(sets[y]) else (sets[y], sets[x])
        at = np.searchsorted(q, p)
        at[at == len(q)] = 0
        out[k] = int((q[at] == p).sum())
    return out


def _verify(threshold: float):
    """Per block and set: links to other sets and to their documents, and the set's root there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vec.whole_groups(batches, KEY):
            bounds = vec.group_bounds(table, KEY)
            ids, copies = table.column("set_id").to_pylist(), table.column("copies").to_numpy()
            partners, grams = table.column("partners"), table.column("grams")
            out: list[tuple] = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                sets = [np.frombuffer(grams[r].as_py(), "<u8") for r in range(s, e)]
                bits = np.frombuffer(b"".join(partners[r].as_py() for r in range(s, e)), np.uint8)
                mask = np.unpackbits(bits.reshape(e - s, -1), axis=1)[:, :e - s].astype(bool)
                a, b = np.nonzero(mask)
                size = np.array([len(x) for x in sets])
                both = _overlaps(sets, a, b)
                ok = both >= threshold * (size[a] + size[b] - both) - 1e-9
                a, b = a[ok], b[ok]
                weight = copies[s:e]
                links = np.bincount(a, minlength=e - s) + np.bincount(b, minlength=e - s)
                docs = np.bincount(a, weight[b], e - s) + np.bincount(b, weight[a], e - s)
                root = list(range(e - s))
                for x, y in zip(a.tolist(), b.tolist()):
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    while root[y] != y:
                        root[y] = y = root[root[y]]
                    root[max(x, y)] = min(x, y)
                for r in range(e - s):
                    x = r
                    while root[x] != x:
                        x = root[x]
                    if links[r]:
                        out.append((ids[s + r], int(links[r]), int(docs[r]), ids[s + x]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(
                    zip(*out) if out else [[]] * 4,
                    [pa.binary(), pa.int64(), pa.int64(), pa.binary()])],
                names=["set_id", "links", "docs", "root"])
    return run


def _grams_of(width: int):
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


def _cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here."""
    out = scratch_dir(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def similar_classes(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH,
                    recall: float = 0.99999, seed: int = 7) -> DataFrame:
    """One row per document: ``doc_id, tkey, class_id, copy_id, n_links``.

    ``class_id`` is the least document id of the class that links connect, ``copy_id`` the least of
    the texts with the same n-gram set, ``n_links`` the number of other documents with similarity of
    at least ``threshold``; ``tkey`` is a hash of the text; ``leads`` marks the first row of a class.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tkey"))
    known = _cut(rows.select("doc_id", "tkey", "text").mapInArrow(
        _signatures(width), "doc_id long, tkey long, set_id binary, sig array<int>, low binary"),
        "signatures")
    sets = _cut(known.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("copy_id"), F.min(F.struct("doc_id", "tkey")).alias("one"),
        F.count(F.lit(1)).alias("copies"),
        F.first("sig").alias("sig"), F.first("low").alias("low")),
        "sets")
    leaves = _cut(_leaves(sets.select("set_id", "sig"), runs_for(recall, threshold), seed), "leaves")
    paths = leaves.groupBy("set_id").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    met = sets.select("set_id", "copies", "low").join(paths, "set_id")
    spread = math.sqrt(threshold * (1 - threshold) / TOKENS)
    least = math.floor(TOKENS * max(0.0, threshold - 4.5 * spread))
    checks = _cut(_grouped(_blocks(leaves).join(met, "set_id").select(
        *KEY, "b", "set_id", "copies", "low", "paths")).mapInArrow(
            _candidates(least), "path long, i int, j int, idx int, set_id binary, copies long, "
                                "partners binary"), "checks")
    wanted = sets.select("set_id", "one").join(checks.select("set_id").distinct(), "set_id").select(
        F.col("set_id").alias("want"), F.col("one.doc_id").alias("__doc"),
        F.col("one.tkey").alias("__tkey"))
    of_sets = rows.join(wanted, (F.col("tkey") == F.col("__tkey"))
                        & F.col("doc_id").eqNullSafe(F.col("__doc")))
    grams = _cut(of_sets.select("text", "want").mapInArrow(
        _grams_of(width), "set_id binary, grams binary"), "grams").dropDuplicates(["set_id"])
    linked = _cut(_grouped(checks.join(grams, "set_id").select(
        *KEY, "idx", "set_id", "copies", "partners", "grams"), "idx").mapInArrow(
            _verify(threshold), "set_id binary, links long, docs long, root binary"), "links")
    degree = linked.groupBy("set_id").agg(F.sum("docs").alias("docs"))
    comps = connected_components(linked.select(F.col("set_id").alias("src"),
                                               F.col("root").alias("dst")))
    info = sets.select("set_id", "copy_id", "copies").join(
        degree, "set_id", "left").join(
        comps.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id"))
    lead = info.groupBy("component").agg(F.min(F.struct(
        F.col("copy_id").isNull(), "copy_id", "set_id")).alias("lead"))
    info = _cut(info.join(lead, "component").select(
        F.col("set_id").alias("__set"), "copy_id", F.col("lead.copy_id").alias("class_id"),
        (F.col("lead.set_id") == F.col("set_id")).alias("first_set"),
        (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links")), "classes")
    alone = F.col("set_id").isNull()
    return known.select("doc_id", "tkey", "set_id").join(
        info, F.col("set_id") == F.col("__set"), "left").select(
        "doc_id", "tkey",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, True).otherwise(F.col("first_set") & F.col("doc_id").eqNullSafe(
            F.col("class_id"))).alias("leads"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: the one of least id; others keep all columns."""
    need(docs, "doc_id", "text")
    leaders = similar_classes(docs, **options).where("leads").select(
        F.col("doc_id").alias("__doc"), F.col("tkey").alias("__tkey"))
    keyed = docs.withColumn("__t", F.xxhash64("text"))
    kept = keyed.join(leaders, F.col("doc_id").eqNullSafe(F.col("__doc"))
                      & (F.col("__t") == F.col("__tkey")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__t"]).drop("__t")
