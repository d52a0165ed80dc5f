"""The pipeline against a brute-force version of its stages."""

import hashlib
import math
from collections import Counter, defaultdict

import corpus_pipeline
from tessera.llm import decontam, rules

from ..conftest import SF_SMALL
from .test_decontam import distance, folded
from .test_jaccard import brute as classes
from .test_rules import WORD, base
from .test_tokens import expected


def targets(sizes):
    """Shares of 1.5 times all words by weights 3, 1, 2; none above twice its source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2.0 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and weight[s] * rest / free >= 2.0 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * rest / free for s in order}
        capped |= over


def copies(doc_id, rate):
    u = int(hashlib.md5(f"mix:{doc_id}".encode()).hexdigest()[:15], 16) / 2 ** 60
    return math.floor(rate) + (u < rate - math.floor(rate))


def test_run_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: (r.text, r.source) for r in table.collect()}
    good = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    score = {r.doc_id: r.quality.kept for r in rules.judge(table, good).collect()}
    left = [d for d, (t, _) in rows.items() if not base(t)[-1] and score[d]]
    left = [d for d, c, _ in classes([(d, rows[d][0]) for d in sorted(left)]) if d == c]
    items = [folded(r.text) for r in
             spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    bad = {r.doc_id for r in decontam.find_items(
        table, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    for d in left:
        text = folded(rows[d][0])
        if d not in bad:
            assert not any(x in text for x in items)
        else:
            assert any(x in text or distance(x, text) <= len(x) * decontam.EDIT_RATE for x in items)
    left = [d for d in left if d not in bad]
    sizes = defaultdict(int)
    for d in left:
        sizes[rows[d][1]] += len(WORD.findall(rows[d][0]))
    goal = targets(sizes)
    mixed = [(d, rows[d][0]) for d in sorted(left)
             for _ in range(copies(d, goal[rows[d][1]] / sizes[rows[d][1]]))]
    got = corpus_pipeline.run(spark, SF_SMALL).orderBy("start").collect()
    assert [tuple(r)[:4] for r in got] == expected(mixed)
    assert Counter(r.doc_id for r in got).most_common(1)[0][1] <= 2


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).schema.names == docs.columns


def test_stages_on_edge_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, text, "en", None, 5),
            (3, text, None, "s", None), (3, text, None, "s", None), (4, text + " more", "en", "s", 1),
            (5, "v " * 100_000, "en", "t", 1), (6, " ".join(f"x{i * i}" for i in range(500)), "en", "s", 1)]
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    order = [schema.names.index(c) for c in ("doc_id", "text", "lang", "source", "n_chars")]
    docs = spark.createDataFrame([tuple(r[order.index(i)] for i in range(5)) for r in rows], schema)
    for _, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, SF_SMALL)
            assert out.count() <= 2 * table.count()
