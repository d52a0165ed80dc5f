"""Length-stratified search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest

from tessera.llm import search

from ..conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(t)) for d, text in docs if (t := terms_of(text))]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        scores = []
        for d, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // total
            s = sum(w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, piece=search.PIECE, **options):
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, m int, term int")
    q = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = search.search(search.build_index(df.repartition(3), piece), q, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_whole_table(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                 [tuple(r) for r in items.select("item_id", "text").collect()])
    got = search.search(search.build_index(docs), items).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


@pytest.mark.parametrize("piece, first, block", [(4096, 8, 1024), (3, 1, 2), (40, 2, 5)])
def test_pieces_and_blocks(spark, piece, first, block):
    rng = random.Random(piece)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([3, 20, 20, 20, 90])))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # ties in one stratum
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(12)] + [(50, docs[5][1])]
    assert found(spark, docs, items, piece, first=first, block=block) == brute(docs, items)


def test_edge_rows(spark):
    long = "lorem Ipsum " * 40_000
    docs = [(1, None), (2, ""), (3, " .;!"), (4, "Ünï code-ÜNÏ"), (5, "A b"), (5, "a B c"), (5, "a B c"),
            (None, "a b"), (None, "a b"), (6, long), (7, "a"), (8, "x\x00y"), (9, "word word other")]
    items = [(1, "A"), (2, "b A a"), (2, "b A a"), (2, "lorem"), (None, "ünï"), (3, None), (4, "--"),
             (5, "absent"), (6, "ÜNÏ"), (7, "X"), (8, "word other"), (9, long)]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, piece=1, k=2) == brute(docs, items, 2)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_wide_query_sets_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(search, "BROADCAST_PAIRS", 0)
    docs = [(i, f"a{i % 7} b{i % 3} c") for i in range(50)]
    items = [(i, f"a{i} b1") for i in range(9)]
    assert found(spark, docs, items) == brute(docs, items)
