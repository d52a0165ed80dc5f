"""The conditional random field against enumeration, and its held-out accuracy."""

import itertools
import zlib

import numpy as np
import pyarrow as pa

from tessera.llm import crf, vec
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    size = [1, 4, 2, 6, 3]
    first = np.concatenate([[0], np.cumsum(size)])
    emission, pairs = rng.normal(size=first[-1]) * 3, rng.normal(size=(2, 2)) * 2
    got, expected = crf.marginals(first, emission, pairs)
    want, total = np.zeros(first[-1]), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        weights, rows = [], list(itertools.product((0, 1), repeat=b - a))
        for y in rows:
            s = sum(emission[a + t] for t in range(b - a) if y[t])
            weights.append(np.exp(s + sum(pairs[p, c] for p, c in zip(y, y[1:]))))
        weights = np.array(weights) / sum(weights)
        for w, y in zip(weights, rows):
            want[a:b] += w * np.array(y)
            for p, c in zip(y, y[1:]):
                total[p, c] += w
    assert np.allclose(got, want) and np.allclose(expected, total)


def test_lines():
    texts = ["One two.\n\n x \nx", None, "", "\n \n", "ABC| a", "é\r\nb"]
    raw, off = vec.utf8(pa.array(texts))
    first, size, feats = crf.lines_of(raw, off)
    assert np.diff(first).tolist() == [3, 1, 1, 1, 1, 2]
    assert size.tolist() == [9, 4, 1, 1, 1, 1, 6, 4, 1]
    same = feats[:, crf.OWN.index("same_as_before")]
    assert same.tolist() == [0, 0, 1, 0, 0, 0, 0, 0, 0]
    assert feats[6, crf.OWN.index("upper")] == 0.5 and not feats[3:6].any()


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op5_quality_crf"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(r.quality, got[r.doc_id].predicted) for r in labels if got[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.95


def test_scores_of_the_query_equal_a_plain_recomputation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = crf.fit(docs, spark.read.parquet(f"{SF}/labels.parquet").where(~crf.held_out()))
    got = {r.doc_id: r.score for r in QUERIES["op5_quality_crf"](spark, SF).collect()}
    for r in docs.select("doc_id", "text").limit(60).collect():
        raw, off = vec.utf8(pa.array([r.text]))
        first, size, feats = crf.lines_of(raw, off)
        bias = model.emission(crf.with_neighbours(first, feats.astype("<f4").astype(np.float64)))
        n, e, t = len(bias), np.exp(bias), np.exp(model.pairs)
        ahead, back = [np.array([1.0, e[0]])], [np.ones(2)]
        for k in range(1, n):  # chances of all labels up to a line, and of all after it
            ahead.append(np.array([sum(ahead[-1][p] * t[p, c] for p in (0, 1)) * (1.0, e[k])[c]
                                   for c in (0, 1)]))
            ahead[-1] /= ahead[-1].sum()
            j = n - k
            back.append(np.array([sum(t[p, c] * (1.0, e[j])[c] * back[-1][c] for c in (0, 1))
                                  for p in (0, 1)]))
            back[-1] /= back[-1].sum()
        both = [a * b for a, b in zip(ahead, reversed(back))]
        want = sum(b[1] / b.sum() * s for b, s in zip(both, size)) / size.sum()
        assert abs(got[r.doc_id] - want) < 1e-9


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 50_000), (3, "word " * 50_000), (None, "a\nb"),
            (4, "\n".join(f"line {i}." for i in range(5000))), (5, "THE!! END!!")]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (2, None), (3, 1)],
                                   "doc_id long, quality int")
    got = crf.score(docs, crf.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert got[2].score == got[3].score
    untrained = crf.fit(docs, labels.limit(0))
    assert {r.score for r in crf.score(docs, untrained).collect()} == {0.5}
    assert crf.score(docs.limit(0), untrained).count() == 0
