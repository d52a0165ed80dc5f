"""HyperMinHash components against all pairs by brute force; sketches against their theory."""

import random
import re

import numpy as np
import pytest

from tessera.llm import hyperminhash as H

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    sets = [grams(t) for _, t in rows]
    by, root = {}, list(range(len(rows)))
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x, y in {(x, y) for m in by.values() for x in m for y in m if x < y}:
        both = len(sets[x] & sets[y])
        if 100 * both >= 80 * len(sets[x] | sets[y]):
            a, b = find(x), find(y)
            root[max(a, b)] = min(a, b)
    least = {}
    for x, (d, _) in enumerate(rows):
        least.setdefault(find(x), []).append(d)
    name = {x: min((d for d in ids if d is not None), default=None) for x, ids in least.items()}
    return sorted(((d, len(sets[x]), name[find(x)], d == name[find(x)]) for x, (d, _) in enumerate(rows)),
                  key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, text string, component string, band int")
    got = H.components(docs.repartition(3), **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in H.components(docs).collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("block", [512, 5])
def test_groups_of_near_copies(spark, block):
    # Chains in which only neighbours are near, stars of near copies, and passages that many share.
    rng = random.Random(block)
    words = [f"w{i}" for i in range(4000)]
    common, texts = rng.choices(words, k=60), []
    for size, edits in ((80, 2), (60, 9), (25, 5), (3, 1), (1, 0)):
        text = rng.choices(words, k=rng.randint(80, 150))
        for _ in range(size):
            t = list(text)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(t)
    chain = rng.choices(words, k=120)
    for _ in range(30):
        chain = chain[6:] + rng.choices(words, k=6)
        texts.append(chain)
    texts += [common + rng.choices(words, k=rng.randint(5, 60)) for _ in range(60)]
    texts += [t[:k] for t in texts[:4] for k in (5, 8, 9, 12)]
    texts += [texts[0]] * 5
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert found(spark, rows, block=block) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"v{i % 7001}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (5, "x y Z"), (4, "X y z"), (6, long), (7, long + " end"),
            (None, "x y z"), (None, None), (8, "solo words in this one text"), (8, "other words entirely here"),
            (None, "no id at all here"), (None, "no id at all here"), (9, "É b c d"), (10, "é b c d"),
            (4, "X y z")]
    want = brute(rows)
    want = sorted([(d, n, c, d == c) for d, n, c, _ in want], key=repr)
    assert found(spark, rows) == want
    assert found(spark, []) == []


def test_estimates():
    rng = np.random.default_rng(5)
    for size, shared in ((40, 36), (400, 356), (4000, 2000)):
        got = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, 2 * size - shared).astype(np.uint64)
            x, y = H.registers([pool[:size], pool[size - shared:]])
            got.append(H.estimate(x[None, :], y[None, :], [size], [size])[0][0])
        want = shared / (2 * size - shared)
        assert abs(np.mean(got) - want) < 4 * (want * (1 - want) / (60 * min(128, size))) ** 0.5


def test_accidental_agreement_is_corrected(monkeypatch):
    # With two bits of mantissa a tenth of the registers of disjoint sets agree by accident.
    monkeypatch.setattr(H, "MANTISSA", 2)
    rng = np.random.default_rng(6)
    x, y = (H.registers([rng.integers(0, 1 << 63, 3000).astype(np.uint64) for _ in range(400)])
            for _ in range(2))
    share, expected = ((x == y) & (x > 0)).mean(), H.accidental([3000], [3000])[0]
    assert expected > 0.03 and abs(share - expected) < 0.005
    assert abs(H.estimate(x, y, [3000] * 400, [3000] * 400)[0].mean()) < 0.006


def test_bands_rarely_part_a_pair():
    rng = np.random.default_rng(7)
    apart = 0
    for k in range(600):
        size = int(rng.choice([5, 9, 30, 100, 1000]))
        shared = size - size // 9
        pool = rng.integers(0, 1 << 63, 2 * size - shared).astype(np.uint64)
        keys = H.band_keys(H.registers([pool[:size], pool[size - shared:]]))
        apart += not (keys[0] == keys[1]).any()
    assert apart == 0
