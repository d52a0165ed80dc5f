"""Transcript parsing against a brute-force Viterbi and the true roles."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    model = chat.Model(rng.normal(size=chat.N), rng.normal(size=(chat.N, chat.N)), [])
    for n, before, last in ((1, None, None), (4, None, None), (3, 2, None), (4, 1, 5)):
        scores = rng.normal(size=(n, chat.N))

        def value(path):
            v = model.start[path[0]] if before is None else model.move[before, path[0]]
            return v + scores[range(n), path].sum() + sum(model.move[a, b]
                                                          for a, b in zip(path, path[1:]))
        best = max((p for p in itertools.product(range(chat.N), repeat=n)
                    if last is None or p[-1] == last), key=value)
        assert tuple(chat.viterbi(model, scores, before, last)) == best


@pytest.mark.parametrize("parts", ["1", "5", "40"])
def test_partitions_do_not_matter(spark, parts):
    rng = random.Random(4)
    rows = []
    for conv, turns in ((1, 300), (2, 1), (3, 2), (None, 4), (5, 90)):
        for t in range(turns):
            role = ("user", "assistant")[t % 2] if rng.random() < 0.9 else "system"
            mark = {"user": "User: ", "assistant": "AI: ", "system": "System: "}[role]
            body = "\n".join("w " * rng.randint(0, 9) for _ in range(rng.randint(1, 3)))
            body += rng.choice(("", "\n", "\n \t", "\n\u2003"))
            rows.append((conv, t, (mark if rng.random() < 0.5 else "") + body, role))
    blocks = spark.createDataFrame(rows, "conv_id long, turn int, text string, role string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        ordered = chat.in_order(blocks.selectExpr("*", "true AS learn"))
        before = chat.lines_before(ordered)
        model = chat.fit(ordered, before)
        got = chat.parse(ordered, model, before).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        lines = [x for r in own for x in r[2].split("\n")]
        parsed = chat.block_features([r[2] for r in own])
        assert [f[1] for fs, _ in parsed for f in fs] == [
            int(not re.sub("[ \t]", "", x)) for x in ["", *lines[:-1]]]
        states = chat.viterbi(model, model.scores([f for fs, _ in parsed for f in fs]), None, None)
        at = 0
        for r, (_, said) in zip(own, parsed):
            want[conv, r[1]] = chat.render(states[at:at + len(said)], said)
            at += len(said)
    assert {(r.conv_id, r.turn): r.rendered for r in got} == want
    counted = np.zeros((chat.N, chat.N))
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        seq = chat._true_states([r[3] for r in own], [r[2].count("\n") + 1 for r in own])
        for a, b in zip(seq, seq[1:]):
            counted[a, b] += 1
    smooth = counted + 0.5
    assert np.allclose(model.move, np.log(smooth / smooth.sum(axis=1, keepdims=True)))


def test_roles_are_recovered(spark):
    got = QUERIES["op1_chat_format"](spark, SF)
    true = spark.read.parquet(f"{SF}/conversations.parquet")
    both = got.withColumnRenamed("role", "found").join(true, ["conv_id", "turn"])
    held = both.where(~chat.not_held_out()).collect()
    assert got.count() == true.count() and len(held) > 20
    assert np.mean([r.found == r.role for r in held]) > 0.95
    whole = [r for r in held if r.n_turns == 1 and r.found == r.role and "<|" not in r.text]
    assert all(r.rendered in (f"<|{r.role}|>\n{r.text}", f"<|{r.role}|>\n{r.text}".rstrip())
               for r in whole) and len(whole) > 0.9 * len(held)


def test_turns_are_found_where_rows_do_not_end_with_them(spark):
    true = chat.as_transcript(spark.read.parquet(f"{SF}/conversations.parquet"))
    blocks = [tuple(r) for r in true.select("conv_id", "turn", "text", "role").collect()]
    held = {r[0] for r in true.where(~chat.not_held_out()).select("conv_id").collect()}
    rows = [r for r in blocks if r[0] not in held]  # known turns to learn from
    begins = {}
    for conv in held:
        lines = []
        for _, turn, text, role in sorted(r for r in blocks if r[0] == conv):
            lines += [(x, role if k == 0 else None) for k, x in enumerate(text.split("\n"))]
        begins[conv] = [role for _, role in lines if role]
        rows += [(conv, i, "\n".join(x for x, _ in lines[i:i + 2]), None) for i in range(0, len(lines), 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, role string")
    got = {}
    for r in chat.format_transcripts(df).where(F.col("conv_id").isin(list(held))).orderBy(
            "conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).extend(re.findall(r"<\|(\w+)\|>", r.rendered))
    assert len(held) > 10 and np.mean([got[c] == begins[c] for c in held]) > 0.85


def test_edge_rows(spark):
    rows = [(1, 0, None, "user"), (1, None, "", None), (None, 2, "User: hi?\n\nAI: <|x", "user"),
            (1, 1, "Assistant: ok", "assistant"), (1, 1, "Assistant: ok", "assistant"),
            (2, 0, "line\n" * 20_000, "odd role")]
    blocks = spark.createDataFrame([(*r, 3) for r in rows], "conv_id long, turn int, text string, "
                                                            "role string, pid int")
    got = chat.format_transcripts(blocks).collect()
    assert len(got) == len(rows) and {r.n_lines for r in got} == {1, 3, 20_001}
    assert sum(r.rendered.endswith("ok") for r in got) == 2
    assert any("< |x" in r.rendered for r in got)
    assert chat.format_transcripts(blocks.limit(0)).count() == 0
