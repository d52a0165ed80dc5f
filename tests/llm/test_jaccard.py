"""Chosen-path join against all pairs by brute force."""

import random
import re
from collections import defaultdict

import pytest

from tessera.llm import jaccard

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    near = {p for g, m in by.items() if len(m) < 400 for x in m for y in m if x < y for p in [(x, y)]}
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = [0] * len(rows)
    for x, y in near:
        both = len(sets[x] & sets[y])
        if both >= threshold * len(sets[x] | sets[y]) - 1e-9:
            links[x] += 1
            links[y] += 1
            a, b = find(x), find(y)
            root[max(a, b)] = min(a, b)
    least = {}
    for x, (d, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), d), d)
    return sorted((d, least[find(x)], links[x]) for x, (d, _) in enumerate(rows))


def found(df, rows):
    docs = df.createDataFrame([(*r, "x", 1) for r in rows],
                              "doc_id long, text string, sig string, path int")
    return jaccard.similar_classes(docs)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = jaccard.similar_classes(docs).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute(rows)


@pytest.mark.parametrize("leaf, block", [(64, 256), (4, 7)])
def test_groups_of_near_copies(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(leaf)
    words = [f"w{i}" for i in range(3000)]
    common = rng.choices(words, k=40)
    rows, n = [], 0
    for size in (1, 1, 2, 3, 60):
        text = rng.choices(words, k=rng.randint(60, 120))
        for _ in range(size):
            t = list(text)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((n, " ".join(t)))
            n += 1
    for _ in range(40):  # a passage that many texts share
        rows.append((n, " ".join(common + rng.choices(words, k=rng.randint(5, 80)))))
        n += 1
    rows += [(n, rows[4][1]), (n + 1, rows[4][1].replace(" ", "  ")), (n + 2, "a b"),
             (n + 3, " a\nb"), (n + 4, "a b c d e f"), (n + 5, rows[5][1])]
    got = found(spark, rows).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"v{i % 7001}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (5, "x y z"), (4, "x y z"), (6, long), (7, long + " end"),
            (None, "x y z"), (None, None), (8, "solo words in this one text")]
    got = found(spark, rows).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=repr) == sorted([
        (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (5, 4, 2), (None, 4, 2), (6, 6, 1), (7, 6, 1),
        (None, None, 0), (8, 8, 0)], key=repr)
    assert found(spark, []).count() == 0
    docs = spark.createDataFrame([(*r, "s") for r in [*rows, (4, "x y z")]],
                                 "doc_id long, text string, path string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        [1, 2, 3, 4, 6, None, 8], key=repr)


def test_runs_reach_the_target():
    assert abs(jaccard.survival(0.8) - 0.9375) < 1e-6
    assert (1 - jaccard.survival(0.8)) ** jaccard.runs_for(0.99999, 0.8) <= 1e-5
