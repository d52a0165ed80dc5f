"""Merkle manifest of a dataset, with the hash states kept that its parents pass through.

A row's leaf is the SHA-256 of its fields.  Per source, leaves ascend by document id; while there are
several nodes, every 16 consecutive ones become their parent (the hash of their digests' hexadecimal
texts), also where the last run is shorter.  What remains is the source's subroot; subroots, ordered by
source, give the root in the same way.

* A parent stores its children's digests and, per child, the hash state *before* that child's slot.  A
  digest's text is one block of SHA-256, so a state is 32 bytes.
* Folding a changed child takes up the state before its slot and hashes the new digest and the right
  siblings only; the left ones are not touched.

Trees are built in rounds of three levels.  A round deals its nodes out in groups of 16**3 consecutive
ones, so no task holds more than one group and a source of any size spreads over all of them; each group
passes one node on, and rounds repeat until every tree has one.  Ways up are handed down in the same
groups: a group gets the way from its own top to the root once, and adds the levels within.

Defined results: rows of equal id stand in the order of their leaves, a NULL id before all others; a
NULL source is a source of its own, before all others.  NULL fields hash as ``-``.  Equal rows are leaves
of their own.  An empty table has no trees and gives no rows.  Extra columns are not part of a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import sha, vec
from tessera.llm.words import need
from tessera.session import ensure_checkpoint_dir, scratch_dir

FANOUT = 16
#: Levels of a round: a group has 16**3 nodes at its lowest level.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
KEY = ["tree", "grp"]
_NODES = ("tree string, grp long, level int, idx long, children binary, states binary, digest binary, "
          "size long")


def leaf_hash(*fields: str | Column) -> Column:
    """Hexadecimal SHA-256 of the fields: ``-`` if NULL, else the UTF-8 byte count, ``:`` and the value."""
    parts = []
    for f in fields:
        text = (F.col(f) if isinstance(f, str) else f).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: str | Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(F.col(text) if isinstance(text, str) else text, ascii_uppercase, ascii_lowercase)


def _source_tree(source: str) -> Column:
    """Name of a source's tree; names order as sources do, NULL first."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def places(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` with ``idx`` (from 0) in the order of its rows within ``tree``, and ``size`` of the tree.

    Rows are range-partitioned, so a tree of any size spreads over partitions; a row's place is its
    place in the partition plus the counts of the partitions before.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, "tree", *order).sortWithinPartitions("tree", *order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    runs = ranged.groupBy("__pid", "tree").agg(F.count(F.lit(1)).alias("__n"),
                                               F.min("__mid").alias("__start"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per tree and partition that holds it.
    runs = runs.select("__pid", "tree", "__start", F.sum("__n").over(whole).alias("size"),
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return ranged.join(runs, ["__pid", "tree"]).withColumn(
        "idx", F.col("__off") + F.col("__mid") - F.col("__start")).drop(
        "__pid", "__mid", "__start", "__off")


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 32)


def _runs(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For groups of so many consecutive nodes: first node and length of every run of 16, and the number
    of runs of each group."""
    per = -(-count // FANOUT)
    within = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    first = np.repeat(np.cumsum(count) - count, per) + FANOUT * within
    return first, np.minimum(FANOUT, np.repeat(count, per) - FANOUT * within), per


def _parents(nodes: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states before each slot (16 per run), and the parents' digests."""
    cur = np.tile(sha.START, (len(count), 1))
    states = np.zeros((len(count), FANOUT, 32), dtype=np.uint8)
    for slot in range(count.max()):
        on = np.flatnonzero(count > slot)
        states[on, slot] = sha.to_bytes(cur[on])
        cur[on] = sha.absorb(cur[on], sha.hex_blocks(nodes[first[on] + slot]))
    return states, sha.finish(cur, count)


def _rise(levels: int):
    """Per group: a row for every parent, and one of level 0 for the node that it passes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
                 pa.int64()]
        names = [c.split()[0] for c in _NODES.split(", ")]
        for table in vec.whole_groups(batches, KEY):
            bounds = vec.group_bounds(table, KEY)
            tree = table.column("tree").take(pa.array(bounds[:-1])).to_pylist()
            grp = table.column("grp").to_numpy()[bounds[:-1]]
            size, nodes = table.column("size").to_numpy()[bounds[:-1]], _digests(table.column("digest"))
            # Groups that still have several nodes in their tree, and the nodes of those groups.
            live, count = np.arange(len(grp)), np.diff(bounds)
            size, base, out = size.copy(), grp * FANOUT ** levels, []
            for level in range(1, levels + 2):
                single = size[live] == 1
                stop = single | (level > levels)
                first = np.cumsum(count) - count
                for k in np.flatnonzero(stop):
                    g = live[k]
                    out.append((tree[g], int(grp[g]), 0, int(grp[g]), None, None,
                                nodes[first[k]].tobytes(), int(size[g])))
                nodes = nodes[np.repeat(~stop, count)]
                live, count = live[~stop], count[~stop]
                if not len(live):
                    break
                size[live], base[live] = -(-size[live] // FANOUT), base[live] // FANOUT
                first, length, per = _runs(count)
                states, ups = _parents(nodes, first, length)
                owner = np.repeat(live, per)
                at = base[owner] + np.arange(len(first)) - np.repeat(np.cumsum(per) - per, per)
                for k, g in enumerate(owner.tolist()):
                    f, n = int(first[k]), int(length[k])
                    out.append((tree[g], int(grp[g]), level, int(at[k]), nodes[f:f + n].tobytes(),
                                states[k, :n].tobytes(), None, None))
                nodes, count = ups, per
            yield _batch(out, kinds, names)
    return run


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds)], names=names)


def _grouped(df: DataFrame, *order: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *KEY).sortWithinPartitions(*KEY, *order)


def _written(df: DataFrame, name: str) -> DataFrame:
    out = scratch_dir(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def _group(levels: int) -> Column:
    return F.shiftright(F.col("idx"), 4 * levels)


def _build(rows: DataFrame, name: str, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Parent tables of all rounds over ``tree, idx, size, digest``, and the ``tree, digest`` of the
    trees' last nodes."""
    rounds, tops = [], None
    while True:
        nodes = _written(_grouped(rows.select("tree", _group(levels).alias("grp"), "idx", "digest",
                                              "size"), "idx").mapInArrow(_rise(levels), _NODES), name)
        rounds.append(nodes.where("level > 0").drop("digest", "size"))
        up = nodes.where("level = 0").select("tree", "idx", "digest", "size")
        done = up.where("size = 1").select("tree", "digest", F.lit(len(rounds) - 1).alias("round"))
        tops = done if tops is None else tops.unionAll(done)
        rows = up.where("size > 1")
        if rows.isEmpty():
            return rounds, tops


@dataclass
class Manifest:
    """Leaves (``tree, idx`` and the caller's columns), parents per round within the sources and above
    them, subroots (``tree, round, idx, digest``) and the root (None without rows)."""

    leaves: DataFrame
    rounds: list[DataFrame]
    upper: list[DataFrame]
    subroots: DataFrame
    root: bytes | None
    levels: int


def build(rows: DataFrame, leaf: str = "leaf", id_col: str = "doc_id",
          source: str = "source", levels: int = LEVELS) -> Manifest:
    """The manifest of rows that carry the hexadecimal digest ``leaf``; other columns are kept."""
    need(rows, leaf, id_col, source)
    ensure_checkpoint_dir(rows.sparkSession)
    keyed = rows.select(F.col(id_col).alias("id"), _source_tree(source).alias("tree"),
                        F.unhex(leaf).alias("digest"),
                        F.struct(*[F.col(c) for c in rows.columns]).alias("row"))
    leaves = places(keyed, [F.asc_nulls_first("id"), "digest"]).drop("id")
    leaves = _written(leaves, "manifest-leaves")
    rounds, tops = _build(leaves, "manifest-nodes", levels)
    tops = _written(tops, "manifest-tops").withColumnRenamed("tree", "name")
    subroots = places(tops.withColumn("tree", F.lit("")), ["name"])
    upper, last = _build(subroots.select("tree", "idx", "size", "digest"), "manifest-upper", levels)
    found = last.select("digest").take(1)
    return Manifest(leaves, rounds, upper, subroots.select(
        F.col("name").alias("tree"), "round", "idx", "digest"), bytes(found[0][0]) if found else None, levels)


# ---- ways up: per level the child's slot, the state before it and the children, lowest level first

def _step(slot: int, state: bytes, children: bytes) -> bytes:
    return bytes([len(children) // 32, slot]) + state + children


def _steps(way: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    at = 0
    while at < len(way):
        n, slot = way[at], way[at + 1]
        yield slot, way[at + 2:at + 34], way[at + 34:at + 34 + 32 * n]
        at += 34 + 32 * n


class _Group:
    """Parents of a group by level and place."""

    def __init__(self, table: pa.Table) -> None:
        self.above = self.subroot = b""
        self.levels: dict[int, list[tuple[bytes, bytes]]] = {}
        self.first: dict[int, int] = {}
        cols = [table.column(c).to_pylist() for c in
                ("level", "idx", "children", "states", "way", "subroot")]
        for level, idx, children, states, way, subroot in zip(*cols):
            if level == 0:
                self.above, self.subroot = way, subroot
            else:
                self.first.setdefault(level, idx)
                self.levels.setdefault(level, []).append((children, states))

    def step(self, level: int, idx: int) -> tuple[int, bytes, bytes]:
        """Slot, state and children of the parent at ``level`` over the node ``idx`` below it."""
        children, states = self.levels[level][idx // FANOUT - self.first[level]]
        slot = idx % FANOUT
        return slot, states[32 * slot:32 * slot + 32], children

    def steps(self, idx: int) -> list[tuple[int, bytes, bytes]]:
        """From the group's lowest node ``idx`` to the group's top."""
        return [self.step(level, idx // FANOUT ** (level - 1)) for level in sorted(self.levels)]

    def way(self, idx: int) -> bytes:
        return b"".join(_step(*s) for s in self.steps(idx)) + self.above


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[_Group], pa.Table, np.ndarray]]:
    """Groups (parents and the way above), the rows of their members, and the group of each member."""
    for table in vec.whole_groups(batches, KEY):
        bounds = vec.group_bounds(table, KEY)
        member = table.column("kind").to_numpy() == 1
        groups = []
        for s, e in zip(bounds[:-1], bounds[1:]):
            groups.append(_Group(table.slice(s, int((~member[s:e]).sum()))))
        owner = np.repeat(np.arange(len(groups)), np.diff(bounds))
        yield groups, table.filter(pa.array(member)), owner[member]


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Way up and subroot of every lowest node of each group."""
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
    for groups, members, owner in _parts(batches):
        out = [(tree, i, groups[g].way(i), groups[g].subroot) for tree, i, g in zip(
            members.column("tree").to_pylist(), members.column("idx").to_pylist(), owner.tolist())]
        yield _batch(out, kinds, ["tree", "idx", "way", "subroot"])


def _fold_level(new: np.ndarray, steps: list[tuple[int, bytes, bytes]]) -> np.ndarray:
    """Digests of the parents in which the child at each step's slot is replaced by ``new``."""
    slot = np.array([s[0] for s in steps])
    count = np.array([len(s[2]) // 32 for s in steps])
    cur = sha.from_bytes(np.frombuffer(b"".join(s[1] for s in steps), np.uint8).reshape(-1, 32))
    flat = np.frombuffer(b"".join(s[2] for s in steps), np.uint8).reshape(-1, 32)
    first = np.cumsum(count) - count
    cur = sha.absorb(cur, sha.hex_blocks(new))
    for k in range(1, FANOUT):
        on = np.flatnonzero(slot + k < count)
        if not len(on):
            break
        cur[on] = sha.absorb(cur[on], sha.hex_blocks(flat[first[on] + slot[on] + k]))
    return sha.finish(cur, count)


def _siblings(slot: int, children: bytes) -> bytes:
    text = children.hex()
    return (text[:64 * slot] + text[64 * slot + 64:]).encode()


def _climb(new: np.ndarray, ways: list[list[tuple[int, bytes, bytes]]]) -> np.ndarray:
    """Digests at the end of each one's own way up."""
    new, length = new.copy(), np.array([len(w) for w in ways], dtype=np.int64)
    for k in range(length.max(initial=0)):
        on = np.flatnonzero(length > k)
        new[on] = _fold_level(new[on], [ways[i][k] for i in on])
    return new


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per leaf: hash of its siblings up to the root, and the root that its replacement folds to."""
    for groups, members, owner in _parts(batches):
        if not members.num_rows:
            continue
        owners = owner.tolist()
        ways = [groups[g].steps(i) for g, i in zip(owners, members.column("idx").to_pylist())]
        above = [list(_steps(g.above)) for g in groups]
        rest = [b"".join(_siblings(s, c) for s, _, c in steps) for steps in above]
        proofs = [hashlib.sha256(b"".join([*(_siblings(s, c) for s, _, c in way), rest[g]])).digest()
                  for way, g in zip(ways, owners)]
        tops = _climb(_digests(members.column("new")), ways)
        # Above a group the way is the same for all its members: equal digests are folded once.
        both = np.concatenate([tops, owner.astype("<u8").view(np.uint8).reshape(-1, 8)], axis=1)
        _, one, back = np.unique(both.view("V40").reshape(-1), return_index=True, return_inverse=True)
        roots = _climb(tops[one], [above[g] for g in owner[one]])
        yield pa.RecordBatch.from_arrays(
            [members.column("row").combine_chunks(),
             pa.array([groups[g].subroot for g in owners], pa.binary()), pa.array(proofs, pa.binary()),
             pa.array([roots[k].tobytes() for k in back], pa.binary())],
            names=["row", "subroot", "proof", "folded"])


def _meet(parents: DataFrame, above: DataFrame, members: DataFrame, levels: int) -> DataFrame:
    """Rows of each group: the way above it, its parents by level, then its members."""
    first = above.select("tree", F.col("idx").alias("grp"), F.lit(0).alias("kind"),
                         F.lit(0).alias("level"), F.col("idx"), "way", "subroot")
    second = parents.select("tree", "grp", F.lit(0).alias("kind"), "level", "idx", "children", "states")
    third = members.withColumn("grp", _group(levels)).withColumn("kind", F.lit(1))
    rows = first.unionByName(second, allowMissingColumns=True).unionByName(
        third, allowMissingColumns=True)
    return _grouped(rows, "kind", "level", "idx")


def _ways_of(rounds: list[DataFrame], above_of, levels: int) -> DataFrame:
    """Ways up at the top of the groups of the lowest round; ``above_of(r)``: those of the trees that
    end in round ``r``."""
    above = above_of(len(rounds) - 1)
    for r in range(len(rounds) - 1, 0, -1):
        # The members of a round's groups are the tops of the groups of the round before.
        members = rounds[r - 1].select("tree", F.col("grp").alias("idx")).distinct()
        big = rounds[r].select("tree").distinct()
        members = members.join(big, "tree", "left_semi")
        down = _written(_meet(rounds[r], above, members, levels).mapInArrow(
            _descend, "tree string, idx long, way binary, subroot binary"), "manifest-ways")
        above = above_of(r - 1).unionByName(down)
    return above


def fold(manifest: Manifest, new: str) -> DataFrame:
    """Every leaf's row with ``subroot``, ``proof_sha256`` (hash of all its siblings up to the root, left
    to right) and ``folded_root``: the root if the row's hexadecimal digest ``new`` took its place."""
    none, levels = F.lit(None).cast("binary"), manifest.levels
    top = manifest.subroots.limit(0).select(F.lit("").alias("tree"), F.lit(0).cast("long").alias("idx"),
                                            F.lit(b"").alias("way"), none.alias("subroot"))
    root_way = manifest.leaves.sparkSession.createDataFrame(
        [("", 0, b"", None)], "tree string, idx long, way binary, subroot binary")

    last = len(manifest.upper) - 1
    above = _ways_of(manifest.upper, lambda r: root_way if r == last else top, levels)
    members = manifest.subroots.select(F.lit("").alias("tree"), "idx")
    ways = _written(_meet(manifest.upper[0], above, members, levels).mapInArrow(
        _descend, "tree string, idx long, way binary, subroot binary"), "manifest-ways")
    subways = _written(manifest.subroots.join(ways.select("idx", "way"), "idx").select(
        "tree", "round", F.lit(0).cast("long").alias("idx"), "way", F.col("digest").alias("subroot")),
        "manifest-subways")
    above = _ways_of(manifest.rounds, lambda r: subways.where(F.col("round") == r).drop("round"),
                     levels)
    leaves = manifest.leaves.select("tree", "idx", F.unhex(f"row.{new}").alias("new"), "row")
    kind = leaves.schema["row"].dataType
    found = _meet(manifest.rounds[0], above, leaves, levels).mapInArrow(
        _fold, f"row {kind.simpleString()}, subroot binary, proof binary, folded binary")
    text = {c: F.lower(F.hex(c)) for c in ("subroot", "proof", "folded")}
    return found.select("row.*", text["subroot"].alias("subroot"),
                        text["proof"].alias("proof_sha256"), text["folded"].alias("folded_root"))


def tampered(id_col: str = "doc_id") -> Column:
    """Whether 5 divides the CRC-32 of the id's decimal text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Manifest of ``docs``, and what it says of a copy in which some texts were tampered with:
    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    need(docs, *FIELDS)
    fields = [F.when(tampered(), lower_ascii("text")).otherwise(F.col("text")) if f == "text" else f
              for f in FIELDS]
    rows = docs.select("doc_id", "source", leaf_hash(*FIELDS).alias("leaf"),
                       leaf_hash(*fields).alias("now"))
    made = build(rows, levels=levels)
    root = made.root.hex() if made.root else ""
    return fold(made, "now").select("doc_id", "leaf", "subroot", F.lit(root).alias("root"),
                                    "proof_sha256", "folded_root",
                                    (F.col("folded_root") == F.lit(root)).alias("verified"))


# ---- the same in SQL: one pair of steps a level, for trees of at most 16**7 nodes

def _sql() -> str:
    def hashed(text: str) -> str:
        parts = [f"coalesce(strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR, '-')"
                 for f in (*FIELDS[:-1], text)]
        return f"sha256({' || '.join(parts)})"

    bits = ("flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: "
            "list_transform(range(0, 8), lambda b: (ascii(c) >> b) & 1)))")
    crc = (f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda s, b: "
           "xor(s >> 1, CASE WHEN xor(s, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)")
    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    steps = [f"""leafs AS (SELECT doc_id, source, {hashed('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {hashed(lowered)}
       ELSE {hashed('text')} END AS now FROM documents),
a0 AS (SELECT source AS t, doc_id, leaf AS h, now, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leafs),
wa0 AS (SELECT t, doc_id, h AS leaf, pos, now AS cur, '' AS proof FROM a0)"""]
    depth = 7

    def climb(tree: str) -> None:
        for k in range(depth):
            steps.append(f"""r{tree}{k} AS (SELECT t, pos // 16 AS run, list(h ORDER BY pos) AS hs,
  any_value(n) AS n FROM {tree}{k} GROUP BY t, pos // 16),
{tree}{k + 1} AS (SELECT t, run AS pos, (n + 15) // 16 AS n,
  CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM r{tree}{k})""")

    def walk(tree: str, keep: str, place: str, joined: str) -> None:
        for k in range(depth):
            slot = f"({place} % 16)"
            steps.append(f"""w{tree}{k + 1} AS (SELECT {keep}, {place} // 16 AS {place},
  CASE WHEN n = 1 THEN cur ELSE sha256(array_to_string(
    hs[1:{slot}] || [cur] || hs[{slot} + 2:], '')) END AS cur,
  proof || CASE WHEN n = 1 THEN '' ELSE array_to_string(hs[1:{slot}] || hs[{slot} + 2:], '') END AS proof
  FROM w{tree}{k} w JOIN r{tree}{k} r ON {joined} AND w.{place} // 16 = r.run)""")

    climb("a")
    steps.append(f"""b0 AS (SELECT 0 AS t, t AS name, h, count(*) OVER () AS n,
  row_number() OVER (ORDER BY t NULLS FIRST) - 1 AS pos FROM a{depth})""")
    climb("b")
    walk("a", "w.t, doc_id, leaf", "pos", "w.t IS NOT DISTINCT FROM r.t")
    steps.append(f"""wb0 AS (SELECT doc_id, leaf, b0.h AS subroot, b0.pos AS pos, cur, proof
  FROM wa{depth} w JOIN b0 ON w.t IS NOT DISTINCT FROM b0.name)""")
    walk("b", "doc_id, leaf, subroot", "pos", "true")
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, b{depth}.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
  cur = b{depth}.h AS verified FROM wb{depth}, b{depth}"""


SQL = _sql()
