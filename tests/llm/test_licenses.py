"""Licence scan against a brute-force scorer, and held-out paragraphs."""

import dataclasses
import math
import random
import re
import textwrap

import pytest

from tessera.llm import licenses

from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def grams(line):
    w = [x for x in re.split("[^a-z0-9]+", line.lower()) if x]
    return {x for x in w if len(x) >= 5} | {f"{a} {b}" for a, b in zip(w, w[1:])}


def brute(rows, model):
    weights = {r.gram: (r.gid, r.w) for r in model.weights.collect()}
    templates = {}
    for r in model.templates.collect():
        templates.setdefault((r.family, r.template), set()).add(r.gid)
    out = []
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            hit = [weights[g] for g in grams(line) if g in weights]
            if not hit:
                continue
            z = [(b + sum(w[k] for _, w in hit)) / model.temperature
                 for k, b in enumerate(model.intercepts)]
            top = max(z)
            total = sum(math.exp(x - top) for x in z)
            family = model.classes[z.index(top)]
            if family == licenses.UNKNOWN or 1 / total < licenses.CHANCE:
                continue
            ids = {g for g, _ in hit}
            share = max(len(ids & t) / len(t) for (f, _), t in templates.items() if f == family)
            out.append((doc_id, n, family, share >= licenses.CONFIRM, round(share, 6),
                        round(1 / total, 6)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.line, r.family, r.confirmed, round(r.share, 6), round(r.chance, 6))
                   for r in df.collect()), key=repr)


def test_whole_table(spark, model):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = result(licenses.scan(docs, model))
    assert got == brute(rows, model)
    marked = {(d, n) for d, t in rows for n, line in enumerate(t.split("\n"))
              if re.search("licen[sc]e", line, re.I)}
    assert marked and marked == {g[:2] for g in got if g[3]}


def test_unseen_variants_and_other_text(spark, model):
    rng = random.Random(9)
    held = licenses.variants(licenses.TEMPLATES, seed=77, rounds=4)
    other = [" ".join(rng.sample(s.split(), len(s.split()))) for s in licenses.OTHER] \
        + ["The city of the north is near the lake", "You are free to go at any time"]
    rows = list(enumerate([t for _, t in held] + other))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    right = [i for i, (f, _) in enumerate(held) if i in got and got[i].family == f]
    assert len(right) > 0.93 * len(held)
    assert not [i for i in range(len(held), len(rows)) if i in got and got[i].confirmed]


def test_edge_rows(spark, model):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, f"x\n\n{mit}\n"), (3, f"x\n\n{mit}\n"), (None, mit),
            (4, "word " * 100_000 + mit), (5, "\n" * 10_000 + mit.upper())]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows],
                                 "doc_id long, text string, line string, uid int")
    got = result(licenses.scan(docs, model))
    assert got == brute(rows, model)
    assert [g[:3] for g in got] == [(3, 2, "MIT"), (3, 2, "MIT"), (4, 0, "MIT"), (5, 10_000, "MIT"),
                                    (None, 0, "MIT")]
    assert licenses.scan(docs.limit(0), model).count() == 0
    empty = licenses.fit(docs.limit(0))
    assert licenses.scan(docs, empty).count() >= 4


def test_wrapped_notices(spark, model):
    long = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t) > 120]
    assert len(long) >= 5
    marks = ["", "# ", " * ", "// ", "dnl ", "-- "]
    rows, want = [], []
    for i, (family, text) in enumerate(long):
        for k, mark in enumerate(marks):
            wrapped = textwrap.wrap(text, 72 - len(mark))
            lines = ["int x;", mark.strip() if mark != "dnl " else "", *(mark + x for x in wrapped), "",
                     "int main()"]
            rows.append((10 * i + k, "\n".join(lines)))
            want.append((10 * i + k, 2, family))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.line, r.family) for r in licenses.scan(docs, model).collect() if r.confirmed]
    assert sorted(got) == sorted(want)


def test_texts_left_out_before_scoring_have_no_result(spark, model):
    assert model.pattern is not None
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    more = [(-i, t) for i, (_, t) in enumerate(licenses.variants(licenses.TEMPLATES, seed=5, rounds=3))]
    more += [(None, "dnl released under\ndnl the MIT\nREM license"), (-900, "rem MIT\nREM license\n")]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    every = dataclasses.replace(model, pattern=None)
    assert result(licenses.scan(docs, model)) == result(licenses.scan(docs, every))


@pytest.mark.parametrize("bias, needed", [([-1.0, 3.0], {"b", "c d"}), ([-1.0, 20.0], set()),
                                          ([3.0, -1.0], None)])
def test_needed_grams(bias, needed):
    grams, gain = ["a", "b", "b x", "c d"], [2.0, 2.5, 1.0, 3.0]
    got = licenses.needed_grams(grams, [gain, [0.0] * 4], bias, {"a": 9, "b x": 5, "b": 2})
    if needed is None:
        assert got is None
        return
    holds = {g for g in grams if re.search(got, " " + g)}
    assert needed <= holds
    rest = [g for g in range(4) if grams[g] not in holds]
    assert sum(gain[g] for g in rest) < bias[1] - bias[0]


def test_hard_lines_and_files_that_do_not_matter(spark):
    rows = [(i, f"the licence fee number {i} is due\n{licenses.TEMPLATES['MIT'][0]}\nplain words {i}")
            for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = licenses.fit(docs.repartition(3), sample=20)
    again = licenses.fit(docs.orderBy(docs.doc_id.desc()).coalesce(1), sample=20)
    assert (first.intercepts, first.temperature) == (again.intercepts, again.temperature)
    assert first.weights.orderBy("gid").collect() == again.weights.orderBy("gid").collect()
    found = licenses.scan(docs, first).collect()
    assert sorted((r.doc_id, r.line, r.family) for r in found) == [(i, 1, "MIT") for i in range(60)]
