"""Mixing against a brute-force version, its distribution, and edge rows."""

import math
from collections import defaultdict

import pytest

from tessera.llm import mix
from tools.check_oracle import compare, duck_connect

from ..conftest import SF_SMALL
from .test_pipeline import copies, targets
from .test_rules import WORD


def brute(rows, weights=(3.0, 1.0, 2.0)):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    goal = targets(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    out = []
    for d, text, source in rows:
        n = len(WORD.findall(text or ""))
        rate = goal[source] / sizes[source] if sizes[source] else 0.0
        out.append((d, n, sizes[source], round(goal[source], 6),
                    n * copies("null" if d is None else d, rate)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken)
                   for r in mix.report(df).collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert result(mix.mix_sources(docs)) == brute(rows)
    n, issues = compare(mix.report(mix.mix_sources(docs)), duck_connect(SF_SMALL), mix.SQL)
    assert n == len(rows) and not issues


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('w ', int(1 + pmod(hash(id), 50))) AS text",
        "IF(id % 3 = 0, 'hot', concat('s', id % 7)) AS source")
    rows = mix.report(mix.mix_sources(docs)).collect()
    taken, goal = defaultdict(int), {}
    for r in rows:
        taken[r.source_size, r.target] += r.taken
        goal[r.source_size, r.target] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[k] / goal[k] - 1) < 0.1 for k in goal)


@pytest.mark.parametrize("limit", [mix.BROADCAST_BYTES, 0])
def test_edge_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(mix, "BROADCAST_BYTES", limit)
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "d e", None), (4, "d e", None),
            (None, "f g h i", "y"), (5, "word " * 100_000, "z"), (6, " \n", "empty"),
            (7, "a", ""), (7, "b c", "X")]
    docs = spark.createDataFrame([(*r, 1) for r in rows],
                                 "doc_id long, text string, source string, weight int")
    mixed = mix.mix_sources(docs)
    assert result(mixed) == brute(rows)
    out = mix.emit_copies(mixed)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in mixed.collect())
    assert mix.emit_copies(mix.mix_sources(docs.limit(0))).count() == 0
    clash = docs.withColumnRenamed("weight", "Rate").selectExpr("*", "7 AS copies", "8 AS `__source`")
    again = mix.mix_sources(clash)
    assert again.columns == [*clash.columns, "size", "source_size", "target", "rate_", "copies_"]
    assert result(again) == brute(rows)
    out = mix.emit_copies(again)
    assert out.columns == clash.columns and out.count() == mix.emit_copies(mixed).count()
    assert {(r.Rate, r.copies, r["__source"]) for r in out.collect()} == {(1, 7, 8)}


def test_targets_are_shared_again_until_none_is_above():
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 1, None: 500}
    goal = targets(sizes)
    assert math.isclose(sum(goal.values()), 1.5 * sum(sizes.values()))
    assert goal["a"] == 20 and goal["d"] == 2 and all(goal[s] <= 2 * sizes[s] for s in sizes)
