"""Chat formatting: roles of raw transcripts by a hidden Markov model, then canonical turns.

A raw transcript is the blocks of a conversation in order of ``turn``; a block is some lines, and where
it ends says nothing.  Each line has a hidden state, a role that begins or goes on; the
model sees the line's speaker marker, if any, whether a blank line (or none) precedes, its length and
whether it asks.  The most likely states of a whole conversation (Viterbi) give its turns.

Conversations are range-partitioned by conversation, turn and text, so one of any length spreads over
several partitions.  Each partition sums up what its ends need (a max-plus matrix of its first
conversation, scores of its last); the states at the borders follow from those few numbers on the
driver, one row a partition, and every partition then decodes exactly between fixed ends.

Defined results: a NULL or empty text is one empty line; a NULL ``turn`` comes first; blocks that
share a turn are ordered by a hash of their text; NULL ``conv_id`` is one conversation; an empty table
gives an empty result; extra columns are ignored.  A ``<|`` inside a text is written ``< |``; blank lines
at the end of a block are not rendered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import need
from tessera.session import ensure_checkpoint_dir

ROLES = ("user", "assistant", "system")
#: Marker words of each role, before a colon or inside brackets.
MARKERS = {"user": "user|human|question|q|instruction|prompter|customer|me|input",
           "assistant": "assistant|ai|bot|answer|a|response|gpt|model|agent|output",
           "system": "system|sys|context|developer|rules"}
_MARK = re.compile(r"[ \t]*(?:#{1,6}[ \t]*|\[|<\||\*\*)?(?:" + "|".join(
    f"(?P<{r}>{w})" for r, w in MARKERS.items()) + r")(?:\]:?|\|>|\*\*:|:)[ \t]*", re.IGNORECASE)
STATES = [(r, begins) for r in ROLES for begins in (True, False)]
N = len(STATES)
#: What a blank line may hold.
GAP = " \t\r\f\v"
#: Values of each line feature: marker (none or a role), blank line before, length, question.
SIZES = (1 + len(ROLES), 2, 8, 2)


def as_transcript(conversations: DataFrame, omit: float = 0.2) -> DataFrame:
    """Blocks ``conv_id, turn, text`` of raw transcripts from turns whose roles are known.

    A hash of the conversation picks its style of markers, one of the turn leaves out markers.  Each
    turn ends in a blank line.
    """
    styles = [("User: ", "Assistant: ", "System: "), ("Human: ", "AI: ", "Context: "),
              ("### Instruction:\n", "### Response:\n", "### System:\n"),
              ("[Q] ", "[A] ", "[SYS] "), ("<|user|>\n", "<|assistant|>\n", "<|system|>\n")]
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(len(styles)))
    mark: Column = F.lit("")
    for i, names in enumerate(styles):
        for role, name in zip(ROLES, names):
            mark = F.when((style == i) & (F.col("role") == role), F.lit(name)).otherwise(mark)
    bare = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(1000)) < int(omit * 1000)
    text = F.concat(F.when(bare, F.lit("")).otherwise(mark), F.coalesce("text", F.lit("")), F.lit("\n"))
    return conversations.withColumn("text", text)


def line_features(text: str | None, blank: bool) -> tuple[list[tuple[int, int, int, int]], list[str]]:
    """Features of each line of a block, and its words without the marker; ``blank`` tells whether a
    blank line, or none, precedes the block."""
    feats, said = [], []
    for line in (text or "").split("\n"):
        m, after = _MARK.match(line), blank
        blank = not line.strip(GAP)
        mark = 0
        if m:
            mark = 1 + next(i for i, r in enumerate(ROLES) if m[r])
            line = line[m.end():]
        size = min(7, len(line.split()).bit_length())
        feats.append((mark, int(after), size, int(line.rstrip().endswith("?"))))
        said.append(line)
    return feats, said


def block_features(texts: list[str | None], blank: bool = True) -> list[tuple[list, list]]:
    """:func:`line_features` of blocks that follow each other."""
    out = []
    for text in texts:
        out.append(line_features(text, blank))
        blank = not (text or "").rpartition("\n")[2].strip(GAP)
    return out


def lines_before(ordered: DataFrame) -> dict[int, tuple[int | None, bool]]:
    """For each partition but the first, the conversation that ends the one before, and whether its last
    line there is blank."""
    line = F.substring_index(F.coalesce("text", F.lit("")), "\n", -1)
    rows = ordered.select("pid", F.struct("conv_id", line.rlike(r"^[ \t\r\f\x0B]*\z").alias("blank"))
                          .alias("end"), F.monotonically_increasing_id().alias("at")).groupBy("pid").agg(
        F.max_by("end", "at").alias("end")).orderBy("pid").collect()  # one row a partition
    return {b.pid: (a.end.conv_id, a.end.blank) for a, b in zip(rows, rows[1:])}


@dataclass
class Model:
    """Log chances: of the first state, of the next state, and of each feature's values."""

    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]

    def scores(self, feats: list[tuple]) -> np.ndarray:
        at = np.asarray(feats, dtype=np.int64).reshape(-1, len(SIZES))
        return sum(table[:, at[:, k]] for k, table in enumerate(self.emit)).T


def viterbi(model: Model, scores: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
    """Most likely states; ``before`` is the state ahead of the first line, ``last`` that of the
    last, where known."""
    n = len(scores)
    value = scores[0] + (model.start if before is None else model.move[before])
    back = np.zeros((n, N), dtype=np.int8)
    for t in range(1, n):
        step = value[:, None] + model.move
        back[t] = step.argmax(axis=0)
        value = step.max(axis=0) + scores[t]
    states = np.empty(n, dtype=np.int8)
    states[-1] = value.argmax() if last is None else last
    for t in range(n - 1, 0, -1):
        states[t - 1] = back[t, states[t]]
    return states


def _conversations(batches: Iterator[pa.RecordBatch], columns: list[str],
                   before: dict[int, tuple]) -> Iterator[tuple]:
    """Conversation id, rows and features of its blocks, for each run of rows of one conversation.
    ``columns`` begin with conversation, text and partition."""
    conv, rows, first = None, [], True

    def run() -> tuple:
        end = before.get(rows[0][2]) if first else None
        blank = True if end is None or end[0] != conv else end[1]
        return conv, rows, block_features([r[1] for r in rows], blank)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if rows and row[0] != conv:
                yield run()
                rows, first = [], False
            conv = row[0]
            rows.append(row)
    if rows:
        yield run()


def _true_states(roles: list[str | None], counts: list[int]) -> list[int | None]:
    out: list[int | None] = []
    for role, n in zip(roles, counts):
        known = role in ROLES
        out += [2 * ROLES.index(role) + (k > 0) if known else None for k in range(n)]
    return out


def _count(before: dict[int, tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    move, start = np.zeros((N, N), np.int64), np.zeros(N, np.int64)
    emit = [np.zeros((N, s), np.int64) for s in SIZES]
    first, last, pid = None, None, None
    for conv, rows, parts in _conversations(batches, ["conv_id", "text", "pid", "role", "learn"], before):
        pid = rows[0][2]
        feats = [f for f, _ in parts]
        states = _true_states([r[3] if r[4] else None for r in rows], [len(f) for f in feats])
        for (a, b) in zip(states, states[1:]):
            if a is not None and b is not None:
                move[a, b] += 1
        for s, f in zip(states, (f for block in feats for f in block)):
            if s is not None:
                for k, v in enumerate(f):
                    emit[k][s, v] += 1
        if first is None:
            first = (conv, states[0])
        elif states[0] is not None:
            start[states[0]] += 1
        last = (conv, states[-1])
    if first is not None:
        numbers = np.concatenate([start, move.ravel(), *[e.ravel() for e in emit]])
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], type=t) for v, t in (
                (pid, pa.int32()), (first[0], pa.int64()), (first[1], pa.int32()),
                (last[0], pa.int64()), (last[1], pa.int32()),
                (numbers.tolist(), pa.list_(pa.int64())))],
            names=["pid", "first", "first_state", "last", "last_state", "numbers"])


def fit(ordered: DataFrame, before: dict[int, tuple]) -> Model:
    """Model from counts over all rows of :func:`in_order` with a known ``role`` and ``learn``;
    ``before`` as :func:`lines_before` gives it."""
    rows = ordered.select("conv_id", "text", "role", "learn", "pid").mapInArrow(
        partial(_count, before), "pid int, first long, first_state int, last long, last_state int, "
                "numbers array<long>").collect()  # one row a partition
    total = np.zeros(N + N * N + N * sum(SIZES), dtype=np.int64)
    prior = None
    for r in sorted(rows, key=lambda r: r.pid):
        total += np.array(r.numbers)
        if r.first_state is not None:
            if prior is None or prior.last != r.first:
                total[r.first_state] += 1
            elif prior.last_state is not None:
                total[N + prior.last_state * N + r.first_state] += 1
        prior = r

    def log_share(counts: np.ndarray) -> np.ndarray:
        smooth = counts + 0.5
        return np.log(smooth / smooth.sum(axis=-1, keepdims=True))
    at, emit = N + N * N, []
    for s in SIZES:
        emit.append(log_share(total[at:at + N * s].reshape(N, s)))
        at += N * s
    return Model(log_share(total[:N]), log_share(total[N:N + N * N].reshape(N, N)), emit)


def in_order(blocks: DataFrame) -> DataFrame:
    """Blocks range-partitioned and sorted by conversation and turn, with their partition ``pid``."""
    ensure_checkpoint_dir(blocks.sparkSession)
    keys = ["conv_id", "turn", F.xxhash64("text")]
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (blocks.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
            .withColumn("pid", F.spark_partition_id()).checkpoint(eager=True))


def _ends(model: Model, before: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, pid, single, matrix, tail, conv = None, None, True, None, None, None
        for conv, rows, parts in _conversations(batches, ["conv_id", "text", "pid"], before):
            scores = model.scores([f for fs, _ in parts for f in fs])
            tail = model.start + scores[0]
            link = model.move + scores[0]
            for s in scores[1:]:
                tail = (tail[:, None] + model.move).max(axis=0) + s
                if first is None:
                    link = (link[:, :, None] + model.move[None]).max(axis=1) + s
            if first is None:
                first, pid, matrix = (conv,), rows[0][2], link
            else:
                single = False
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], type=t) for v, t in (
                    (pid, pa.int32()), (first[0], pa.int64()), (conv, pa.int64()),
                    (single, pa.bool_()), (matrix.ravel().tolist(), pa.list_(pa.float64())),
                    (tail.tolist(), pa.list_(pa.float64())))],
                names=["pid", "first", "last", "single", "matrix", "tail"])
    return run


def border_states(rows: list) -> dict[int, tuple[int | None, int | None]]:
    """For each partition the state ahead of its first line and that of its last line, where its
    first (last) conversation goes on from the partition before (into the next)."""
    rows = sorted(rows, key=lambda r: r.pid)
    n = len(rows)
    joined = [i > 0 and rows[i - 1].last == rows[i].first for i in range(n)]
    matrix = [np.array(r.matrix).reshape(N, N) for r in rows]
    rest = [np.zeros(N) for _ in range(n + 1)]  # best score of what follows partition i
    for i in range(n - 2, -1, -1):
        if joined[i + 1]:
            after = rest[i + 1] if rows[i + 1].single else np.zeros(N)
            rest[i] = (matrix[i + 1] + after).max(axis=1)
    out, before = {}, None
    for i, r in enumerate(rows):
        ahead = before if joined[i] else None
        last = None
        if i + 1 < n and joined[i + 1]:
            value = np.array(r.tail) if not r.single or ahead is None else matrix[i][ahead]
            last = int((value + rest[i]).argmax())
        out[r.pid] = (ahead, last)
        before = last
    return out


def render(states: np.ndarray, said: list[str]) -> str:
    """Canonical turns of a block's lines; lines that go on a turn have no header."""
    out = []
    for s, line in zip(states, said):
        role, begins = STATES[s]
        if begins:
            out.append(f"<|{role}|>")
            if not line.strip():
                continue
        out.append(line.replace("<|", "< |"))
    while out and not out[-1].strip(GAP):
        out.pop()
    return "\n".join(out)


def _decode(model: Model, borders: dict[int, tuple], before: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def decoded(rows: list, parts: list, ahead: int | None, last: int | None) -> pa.RecordBatch:
            states = viterbi(model, model.scores([f for fs, _ in parts for f in fs]), ahead, last)
            out, at = [], 0
            for r, (_, said) in zip(rows, parts):
                own = states[at:at + len(said)]
                at += len(said)
                out.append((r[0], r[3], len(said), int(sum(STATES[s][1] for s in own)),
                            STATES[own[0]][0], render(own, said)))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*out), _OUT)], names=_NAMES)

        held, first = None, True
        for _, rows, parts in _conversations(batches, ["conv_id", "text", "pid", "turn"], before):
            if held is not None:
                yield decoded(*held, borders[held[0][0][2]][0] if first else None, None)
                first = False
            held = rows, parts
        if held is not None:
            ahead, last = borders[held[0][0][2]]
            yield decoded(*held, ahead if first else None, last)
    return run


_NAMES = ["conv_id", "turn", "n_lines", "n_turns", "role", "rendered"]
_OUT = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def parse(ordered: DataFrame, model: Model, before: dict[int, tuple]) -> DataFrame:
    """``conv_id, turn, n_lines, n_turns, role, rendered`` for each block of :func:`in_order`:
    turns that begin in the block, the role of its first line, and its canonical rendering."""
    ends = ordered.select("conv_id", "text", "pid").mapInArrow(
        _ends(model, before), "pid int, first long, last long, single boolean, matrix array<double>, "
                      "tail array<double>").collect()  # one row a partition
    return ordered.select("conv_id", "text", "turn", "pid").mapInArrow(
        _decode(model, border_states(ends), before),
        "conv_id long, turn long, n_lines long, n_turns long, role string, rendered string")


def format_transcripts(blocks: DataFrame, learn: Column | None = None) -> DataFrame:
    """Fit on the blocks whose ``role`` is known (and ``learn`` holds), and parse all blocks; the
    roles are not read for parsing."""
    need(blocks, "conv_id", "turn", "text", "role")
    rows = blocks.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.col("turn").cast("long").alias("turn"), "text", "role")
    ordered = in_order(rows.withColumn("learn", F.lit(True) if learn is None else learn))
    before = lines_before(ordered)
    return parse(ordered, fit(ordered, before), before)


def not_held_out() -> Column:
    """Conversations that the model may learn from: four fifths, by a hash."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit("held"), "conv_id"), F.lit(5)) != 0, F.lit(False))
