"""Decontamination against brute-force approximate matching."""

import random

from tessera.llm import decontam

from ..conftest import SF_SMALL


def distance(item, text):
    """Least edits between ``item`` and any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def folded(text):
    return " ".join((text or "").lower().split())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = decontam.find_items(docs, bench).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if folded(x) in folded(t)}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        stretch, item = folded(texts[r.doc_id][r.start:r.end]), folded(items[r.item_id])
        assert distance(item, stretch) == r.edits <= len(item) * decontam.EDIT_RATE
    left = decontam.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == texts.keys() - {r.doc_id for r in got}


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdehilnorst", k=rng.randint(2, 8)))
    items = [" ".join(word() for _ in range(rng.randint(4, 40))) for _ in range(6)]
    texts = []
    for n in range(40):
        item = rng.choice(items)
        x = list(item)
        for _ in range(rng.randint(0, max(1, len(x) // 9))):
            at, what = rng.randrange(len(x)), rng.choice("sid")
            x[at:at + (what != "i")] = [] if what == "d" else [rng.choice("xyz ")]
        pad = [" ".join(word() for _ in range(rng.randint(0, 20))) for _ in range(2)]
        texts.append(pad[0] + " " + "".join(x).replace(" ", " \n" if n % 3 else " ") + " " + pad[1])
    return items, texts


def test_edited_items_are_found_like_by_brute_force():
    items, texts = planted(3)
    index = decontam.Index(items, 6, 0.1)
    got = {(r, i): n for r, i, _, _, n in index.hits(texts)}
    for r, t in enumerate(texts):
        for i, x in enumerate(items):
            near = distance(folded(x), folded(t))
            want = near if near <= index.k[i] else None
            assert got.get((r, i)) == want


def test_edge_rows(spark, monkeypatch):
    items = [(1, "The quick brown fox jumps over the lazy dog"), (2, None), (3, "tiny"), (4, ""),
             (1, "The quick brown fox jumps over the lazy dog"), (None, "one more item of some length")]
    rows = [(1, None), (2, ""), (3, "x THE  quick brown\nfox jumps over the lazy dog y"), (3, "tiny"),
            (None, "the quick brown fox jumps over the lazy dog"), (4, "é" * 200_000),
            (5, "the quick brown fox jumps over the lazy dog " * 3), (6, "one more item of some lngth"),
            (3, "x THE  quick brown\nfox jumps over the lazy dog y")]
    docs = spark.createDataFrame([(*r, 1, "a") for r in rows],
                                 "doc_id long, text string, start int, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 30):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", limit)
        got = sorted((tuple(r) for r in decontam.find_items(docs, bench).collect()), key=repr)
        one = [(3, 1, 2, 46, 0)] * 4 + [(None, 1, 0, 43, 0)] * 2 + [
            (5, 1, 44 * k, 44 * k + 43, 0) for k in range(3) for _ in range(2)] + [(6, None, 0, 27, 1)]
        assert got == sorted(one, key=repr)
        left = decontam.drop_contaminated(docs, bench)
        assert left.columns == docs.columns
        assert sorted(r.text or "" for r in left.collect()) == sorted(
            ["", "", "tiny", "é" * 200_000])
    assert decontam.find_items(docs.limit(0), bench).count() == 0
    assert decontam.find_items(docs, bench.limit(0)).count() == 0
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == len(rows)
