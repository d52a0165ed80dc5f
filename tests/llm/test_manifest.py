"""Merkle manifest against a direct recomputation, over several rounds and edge rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from tessera.llm import manifest, sha

from ..conftest import SF_SMALL


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    out = ""
    for v in row:
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(out)


def tree(nodes, fanout=16):
    """All levels, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([H("".join(cur[i:i + fanout])) for i in range(0, len(cur), fanout)])
    return levels


def way(levels, i, fanout=16):
    for level in levels[:-1]:
        run = i // fanout * fanout
        yield i - run, level[run:run + fanout]
        i //= fanout


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            now = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now[4] = re.sub("[A-Z]", lambda m: m[0].lower(), r[4])
            cur, sibs = leaf(now), ""
            for slot, run in [*way(trees[s], i), *way(top, k)]:
                sibs += "".join(run[:slot] + run[slot + 1:])
                cur = H("".join(run[:slot] + [cur] + run[slot + 1:]))
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, H(sibs), cur, cur == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, way string"


def found(spark, rows, levels=3):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = manifest.audit(docs.repartition(3), levels)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_hashes():
    rng = np.random.default_rng(3)
    d = rng.integers(0, 256, (5000, 32), dtype=np.uint8)
    state = np.tile(sha.START, (5000, 1))
    for k in range(3):
        state = sha.absorb(state, sha.hex_blocks(np.roll(d, k, axis=0)))
        if k == 0:
            state = sha.from_bytes(sha.to_bytes(state))
    got = sha.finish(state, np.full(5000, 3))
    for i in (0, 1, 4095, 4096, 4999):
        text = "".join(bytes(np.roll(d, k, axis=0)[i]).hex() for k in range(3))
        assert bytes(got[i]).hex() == H(text)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = manifest.audit(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_several_rounds(spark, levels):
    # Groups of 16 or 256 nodes: sources of one to three rounds, and two rounds over the sources.
    rows, n = [], 0
    for s, size in enumerate([1, 2, 16, 17, 255, 257, 300, *[1] * 40]):
        for _ in range(size):
            rows.append((n, f"s{s}", "en", n % 7, f"Text {n}"))
            n += 1
    assert found(spark, rows, levels) == brute(rows)


def test_edge_rows(spark):
    long = "Ä long Text " * 20_000
    rows = [(1, None, None, None, None), (None, None, "en", 3, "A"), (None, None, "en", 3, "B"),
            (2, "", "", 0, ""), (2, "", "", 0, "X"), (2, "", "", 0, "X"), (5, "Z", "de", 1, long),
            (6, "a", "de", -1, "É x"), (7, "ä", "de", 1, "q\x00Q"), (5, "Z", None, 1, "5:"),
            *[(i, "hot", "en", i, f"Some TEXT {i}") for i in range(40)]]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[4:5]) == brute(rows[4:5])
    assert found(spark, []) == []
