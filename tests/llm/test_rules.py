"""Quality rules against a brute-force version."""

import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tessera.llm import rules

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(cover), failed)


def grams(text, buckets):
    w = WORD.findall(text or "")
    one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    two = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(one, w[1:])]
    return [(h - (1 << 64) if h >> 63 else h) % buckets for h in one + two]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.quality for r in rules.judge(docs, good, 1024, -0.05).collect()}
    assert got.keys() == texts.keys()
    sample = {r.text for r in rules.trusted_texts(docs, good).where("NOT held").collect()}
    trusted = [t for d, t in texts.items()
               if t in sample and d in {r.doc_id for r in good.collect()}]
    raw, target = Counter(), Counter()
    for t in texts.values():
        raw.update(grams(t, 1024))
    for t in trusted:
        target.update(grams(t, 1024))
    shift = math.log(sum(raw.values()) + 1024) - math.log(sum(target.values()) + 1024)
    ratio = [math.log(target[b] + 1) - math.log(raw[b] + 1) + shift for b in range(1024)]
    for d, t in texts.items():
        q = got[d]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words,
                q.base_failed) == base(t)
        g = grams(t, 1024)
        score = sum(ratio[b] for b in g) / max(1, len(g))
        assert abs(score - q.score) < 1e-9
        assert q.kept == (not q.base_failed and q.score >= -0.05)


def test_edge_rows(spark):
    rep = " ".join("abcdefgh") + " "
    rows = [(1, None), (2, ""), (3, rep * 3 + "x y z " + rep), (4, "w " * 40), (5, "a#b\n\na#b\n a"),
            (None, "plain words here"), (1, None), (6, "long " * 20_000 + "end"),
            (7, "é b c" * 30)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, text string, score string, n_words int")
    none = spark.createDataFrame([], "doc_id long")
    out = rules.judge(docs, none, 64)
    assert out.columns == docs.columns + ["quality"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words,
                q.base_failed) == base(r.text)
        assert q.score == 0.0 and q.kept == (not q.base_failed)
    assert rules.judge(docs.limit(0), none, 64).count() == 0


def test_every_trusted_text_counts(spark):
    # More trusted documents than any sample held: each word counts once, none is left out.
    n = 60_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("one").alias("text"))
    trusted = rules.trusted_texts(docs, docs.select("doc_id"))
    held = trusted.where("held").count()
    assert 0.19 * n < held < 0.21 * n
    assert trusted.count() == n
    [row] = rules.bucket_counts(docs, trusted.where("NOT held"), 64).collect()
    assert (row.raw, row.good) == (n, n - held)


def test_threshold_of_all_held_out_scores(spark):
    rows = [(f"{'good ' * (i % 7 + 1)}{'bad ' * (i % 11)}",) for i in range(500)]
    held = spark.createDataFrame(rows, "text string")
    ratio = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i / 64.0)
    got = rules.held_out_threshold(held, ratio, 64)
    scores = sorted(sum(b / 64 for b in grams(t, 64)) / len(grams(t, 64)) for t, in rows)

    def at(p):
        x = p * (len(scores) - 1)
        k = math.floor(x)
        return scores[k] + (x - k) * (scores[min(k + 1, len(scores) - 1)] - scores[k])
    assert abs(got - (at(0.5) - rules.SPREAD * (at(0.5) - at(0.01)))) < 1e-9
    assert rules.held_out_threshold(held.limit(0), ratio, 64) == rules.THRESHOLD


def test_the_query_equals_a_recomputation(spark):
    """Every column of the query's rows, with its own buckets and its threshold from held-out texts."""
    from tessera.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").collect()}
    held = {r.doc_id for r in spark.createDataFrame([(d,) for d, _ in docs], "doc_id long").where(
        F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(5)) == 0).collect()}
    n, own = rules.BUCKETS, {d: grams(t, rules.BUCKETS) for d, t in docs}
    raw, target = Counter(), Counter()
    for d, _ in docs:
        raw.update(own[d])
        if d in good and d not in held:
            target.update(own[d])
    shift = math.log(sum(raw.values()) + n) - math.log(sum(target.values()) + n)
    score = {d: sum(math.log(target[b] + 1) - math.log(raw[b] + 1) + shift for b in g) / max(1, len(g))
             for d, g in own.items()}
    ranked = sorted(score[d] for d, _ in docs if d in good and d in held)

    def at(p):
        x = p * (len(ranked) - 1)
        return ranked[math.floor(x)] + (x % 1) * (ranked[math.ceil(x)] - ranked[math.floor(x)])
    least = at(0.5) - rules.SPREAD * (at(0.5) - at(0.01))
    got = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and len(ranked) > 5
    for d, t in docs:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t)
        assert abs(r.score - score[d]) < 1e-9 and abs(score[d] - least) > 1e-7
        assert r.kept == (not r.base_failed and score[d] >= least)


def test_columns_of_the_caller_stay(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", 0.5)], "doc_id long, text string, quality string, __ratio double")
    [r] = rules.judge(docs, docs.select("doc_id"), 64, name="verdict").collect()
    assert (r.quality, r["__ratio"], r.verdict.n_words) == ("mine", 0.5, 2)
