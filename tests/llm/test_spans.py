"""Sentence-run deduplication against a brute-force version."""

import random
import re
from collections import defaultdict

from tessera.llm import queries, spans

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(text):
    """``(words, start, end)`` of the shortest run from every sentence on."""
    text = text or ""
    sents, cur = [], []
    found = list(WORD.finditer(text))
    for k, m in enumerate(found):
        cur.append(m)
        gap = text[m.end():found[k + 1].start()] if k + 1 < len(found) else "\n"
        w = m[0]
        last = w[-2] if len(w) > 1 and w[-1] in "\"')]}" else w[-1]
        if last in ".!?" or "\n" in gap:
            sents.append(cur)
            cur = []
    out = []
    for i in range(len(sents)):
        words = []
        for e in range(i, len(sents)):
            words += sents[e]
            if len(words) >= spans.LONG or e - i >= spans.SENTENCES - 1 and len(words) >= spans.LEAST:
                out.append((tuple(m[0] for m in words), words[0].start(), words[-1].end()))
                break
    return out


def brute(rows):
    first = {}
    per = [(d, runs(t)) for d, t in rows]
    key = lambda d: (d is None, d or 0)
    for d, found in sorted(per, key=lambda x: key(x[0])):
        for w, a, _ in found:
            first.setdefault(w, (d, a))
            if first[w][0] == d:
                first[w] = (d, min(a, first[w][1]))
    out = defaultdict(set)
    for d, found in per:
        seen = set()
        for w, a, b in found:
            if first[w][0] != d or w in seen:
                out[d].update(range(a, b))
            seen.add(w)
    return {d: s for d, s in out.items() if s}


def covered(got):
    out = defaultdict(set)
    for r in got:
        out[r.doc_id].update(range(r.start, r.end))
    return dict(out)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = spans.repeated_regions(docs).collect()
    assert want and covered(got) == want
    for r in got:
        assert r.first_doc <= r.doc_id
    cut = {r.doc_id: r.text for r in spans.remove_repeats(docs).collect()}
    for d, t in rows:
        assert cut[d] == "".join(c for i, c in enumerate(t) if i not in want.get(d, ()))


def test_edge_rows(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(2, 7)))
    sent = lambda n: " ".join(word() for _ in range(n)) + rng.choice([".", "!", '."', "?)", "\n"])
    passage = " ".join(sent(rng.randint(6, 12)) for _ in range(7))
    block = " ".join(word() for _ in range(60))
    rows = [(1, None), (2, ""), (3, "Short. Text."), (4, "Short. Text."), (9, passage),
            (5, sent(8) + " " + passage + " " + sent(9)), (6, passage + "\n" + passage),
            (7, sent(5) + "\n" + block + "\n" + sent(4)), (8, block), (None, passage + " x"),
            (10, " ".join(sent(6) for _ in range(3000))), (11, "Of. As. The."), (12, "Of. As. The."),
            (13, passage), (13, passage)]
    docs = spark.createDataFrame([(r[0], r[1], 1, "h") for r in rows],
                                 "doc_id long, text string, start int, h string")
    want = brute(rows)
    got = spans.repeated_regions(docs).collect()
    assert covered(got) == want
    assert set(want) == {6, 8, 9, None, 13}
    cut = spans.remove_repeats(docs)
    assert cut.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in cut.collect() if r.doc_id) == sorted(
        (d, "".join(c for i, c in enumerate(t or "") if i not in want.get(d, ())))
        for d, t in rows if d)
    assert spans.repeated_regions(docs.limit(0)).count() == 0


def every_run(text):
    """All runs above the bound, not just the shortest ones."""
    found, sents = list(WORD.finditer(text)), [[]]
    for m, after in zip(found, [*found[1:], None]):
        sents[-1].append(m)
        last = m[0][-2] if len(m[0]) > 1 and m[0][-1] in "\"')]}" else m[0][-1]
        if last in ".!?" or after and "\n" in text[m.end():after.start()]:
            sents.append([])
    sents = [x for x in sents if x]
    for i in range(len(sents)):
        words = []
        for e in range(i, len(sents)):
            words += sents[e]
            if len(words) >= spans.LONG or e - i >= spans.SENTENCES - 1 and len(words) >= spans.LEAST:
                yield tuple(m[0] for m in words), words[0].start(), words[-1].end()


def brute_every_run(rows):
    first, want = {}, defaultdict(set)
    for d, t in sorted(rows):
        for w, a, b in every_run(t):
            if first.setdefault(w, (d, a)) != (d, a):
                want[d].update(range(a, b))
    return want


def test_tails_of_repeated_passages(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(3, 7)))
    sent = lambda n: " ".join(word() for _ in range(n)) + "."
    rows = []
    for k, sizes in enumerate([(53, 6), (20, 3, 3, 3), (6, 53), (3, 3, 3, 20), (3, 4, 5, 2, 1),
                               (53, 2, 54, 2, 2), (49,), (9, 9, 9, 51, 2, 2)]):
        passage = " ".join(sent(n) for n in sizes)
        rows += [(10 * k + i, f"{sent(7)} {passage} {sent(8)} {sent(5)}") for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_every_run(rows)
    assert len(want) == 7
    assert covered(spans.repeated_regions(docs, both_ends=True).collect()) == want
    for r in spans.remove_repeats(docs, both_ends=True).where("doc_id in (2, 12)").collect():
        assert len(WORD.findall(r.text)) == 20  # only the sentences around the passage


def test_query_covers_every_repeated_run(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute_every_run([(r.doc_id, r.text) for r in docs.collect()])
    assert covered(queries.op4_sentence_spans(spark, SF_SMALL).collect()) == want


def test_passages_are_caught_and_phrases_left_alone(spark):
    # By passage, not by rule: over 50 words that begin and end within sentences; and clean texts that
    # share a few short sentences only.
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 8)))
    sent = lambda n: " ".join(word() for _ in range(n)) + "."
    rows, phrases = [], [sent(4), sent(3), sent(4)]
    for k in range(40):
        inner = " ".join(sent(rng.randint(5, 14)) for _ in range(5))
        shared = f"{' '.join(word() for _ in range(8))}. {inner} {' '.join(word() for _ in range(8))}"
        rows += [(10 * k + i, f"{sent(9)} {word()} {shared} {word()}. {sent(6)}") for i in (1, 2)]
        rows.append((10 * k + 3, f"{sent(30)} {' '.join(phrases)} {sent(24)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id for r in spans.repeated_regions(docs, both_ends=True).collect()}
    assert found == {d for d, _ in rows if d % 10 == 2}


def test_documents_without_an_id_and_ids_with_several_texts(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 8)))
    sent = lambda n: " ".join(word() for _ in range(n)) + "."
    shared, other, own = (" ".join(sent(9) for _ in range(6)) for _ in range(3))
    texts = [f"{sent(7)} {shared} {sent(k)}" for k in (5, 6, 7)] + [f"{sent(4)} {other}", f"{other} {sent(4)}"]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (5, other), (7, f"{own} {sent(5)}"),
                                         (7, f"{sent(80)} {own}"), (8, f"{own} {sent(3)}")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows],
                                 "doc_id long, text string, key string, __doc int")
    got = spans.remove_repeats(docs, both_ends=True)
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    holds = lambda passage: sorted((d is None, d) for d, t in left if passage in t)
    # One of the texts without an id keeps the passage; its copy is the same document.
    assert len({t for d, t in left if d is None and shared in t}) == 1
    assert sum(shared in t for _, t in left) <= 2
    assert holds(other) == [(False, 5)] and holds(own) == [(False, 7), (False, 7)]
    for d, t in left:  # nothing but passages is cut
        assert any(a == d and re.sub(r"\s+", " ", b.replace(shared, " ").replace(other, " ").replace(own, " "))
                   .strip() in re.sub(r"\s+", " ", t.replace(shared, " ").replace(other, " ").replace(own, " "))
                   for a, b in rows)
    found = spans.repeated_regions(docs, both_ends=True).collect()
    assert {(r.doc_id, r.first_doc) for r in found} == {(None, None), (None, 5), (8, 7)}
