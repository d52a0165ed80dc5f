"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad; its potentials come from features of itself and of the lines before and
after, and neighbouring labels interact.  A text's score is the mean of its lines' forward-backward
marginals for good, weighted by length.

Lines that hold a word count; a text without one (NULL and empty ones too) is a single empty line.
Training lines carry the label of their document.  The model is fitted on at most ``TRAIN``
labelled documents, those with the smallest id hashes, by gradient steps on the conditional
likelihood.  Scoring is row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import vec
from tessera.llm.words import least_hashes, need

#: Labelled documents that the model is fitted on, at most.
TRAIN = 4_000
STEPS, RATE, PENALTY = 150, 0.1, 1e-3
#: Byte classes counted per line.
CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58),
           "mark": b"#*$%&<>", "bar": b"|", "bang": b"!", "stop": b".,;:?", "wide": range(128, 256)}
OWN = [*CLASSES, "word_length", "n_words", "short_words", "kinds", "stop_end", "same_as_before"]
NEAR = ["upper", "mark", "bar", "bang", "kinds", "n_words"]


def lines_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines before each text (texts + 1), bytes of each line, and its features."""
    n = len(off) - 1
    start, end, first = vec.word_spans(raw, off)
    cut = np.union1d(off[:-1], np.flatnonzero(raw == 10) + 1)
    cut = cut[cut < len(raw)] if len(raw) else np.zeros(0, np.int64)
    stop = np.append(cut[1:], len(raw))[:len(cut)]
    stop = np.minimum(stop, off[np.searchsorted(off, cut, "right")]) if len(cut) else stop
    a, b = np.searchsorted(start, cut), np.searchsorted(start, stop)
    solid = b > a
    cut, stop, a, b = cut[solid], stop[solid], a[solid], b[solid]
    row = np.searchsorted(off, cut, "right") - 1
    size = (stop - cut).astype(np.float64)
    feats = np.zeros((len(cut), len(OWN)))
    for k, members in enumerate(CLASSES.values()):
        table = np.zeros(256, dtype=np.uint8)
        table[list(members)] = 1
        total = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        feats[:, k] = (total[stop] - total[cut]) / np.maximum(size, 1)
    if len(cut):
        words = vec.word_hashes(raw, start, end)
        count = (b - a).astype(np.float64)
        length = np.concatenate([[0], np.cumsum(end - start)])
        short = np.concatenate([[0], np.cumsum(end - start <= 3)])
        line = np.repeat(np.arange(len(cut)), b - a)
        kinds = np.unique(vec.mix(words + vec.mix(line.astype(np.uint64) + np.uint64(1))),
                          return_index=True)[1]
        many = np.bincount(line[kinds], minlength=len(cut))
        k = len(CLASSES)
        feats[:, k] = np.minimum((length[b] - length[a]) / count, 30) / 10
        feats[:, k + 1] = np.log1p(count) / 5
        feats[:, k + 2] = (short[b] - short[a]) / count
        feats[:, k + 3] = many / count
        feats[:, k + 4] = raw[end[b - 1] - 1] == ord(".")
        total = np.zeros(len(words) + 1, dtype=np.uint64)
        up, down = vec._powers(len(words) + 1)
        np.cumsum(words * up[:-1], out=total[1:])
        whole = (total[b] - total[a]) * down[a]
        feats[1:, k + 5] = (whole[1:] == whole[:-1]) & (row[1:] == row[:-1])
    per = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    empty = np.flatnonzero(per == 0)
    if len(empty):  # one empty line
        at = np.concatenate([[0], np.cumsum(per)])[empty]
        feats, size = np.insert(feats, at, 0.0, axis=0), np.insert(size, at, 1.0)
        per = np.maximum(per, 1)
    return np.concatenate([[0], np.cumsum(per)]), size, feats


def with_neighbours(first: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """A line's own features, some of the lines before and after it, and whether there are any."""
    pick = [OWN.index(n) for n in NEAR]
    n = len(feats)
    before, after = np.ones(n), np.ones(n)
    before[first[:-1]], after[first[1:] - 1] = 0, 0
    prev = np.zeros((n, len(pick)))
    following = np.zeros((n, len(pick)))
    prev[1:], following[:-1] = feats[:-1, pick], feats[1:, pick]
    return np.hstack([feats, prev * before[:, None], following * after[:, None],
                      before[:, None], after[:, None]])


@dataclass
class Model:
    """Weights of good (bad has 0) on scaled features, and of pairs of neighbouring labels."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    pairs: np.ndarray  # [label before, label], 0 bad and 1 good

    def emission(self, feats: np.ndarray) -> np.ndarray:
        x = (feats - self.mean) / self.scale
        return np.clip(x @ self.weight[1:] + self.weight[0], -30, 30)


def marginals(first: np.ndarray, emission: np.ndarray,
              pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of good for each line, and expected label pairs summed over all texts."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    at, size = first[:-1][order], size[order]
    push = np.exp(pairs - pairs.max())
    good = np.exp(np.minimum(emission, 0)), np.exp(np.minimum(-emission, 0))
    local = np.stack([good[1], good[0]], axis=1)  # scaled: the larger of the two is 1
    fore, back = np.empty_like(local), np.ones_like(local)
    steps = int(size[0]) if len(size) else 0
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(steps + 1)]
    for t in range(steps):
        here = at[:live[t]] + t
        f = local[here] if not t else local[here] * (fore[here - 1] @ push)
        fore[here] = f / f.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        here = at[:live[t + 1]] + t
        g = (local[here + 1] * back[here + 1]) @ push.T
        back[here] = g / g.sum(axis=1, keepdims=True)
    both = fore * back
    expected = np.zeros((2, 2))
    inner = np.ones(len(emission), dtype=bool)
    inner[first[:-1]] = False
    k = np.flatnonzero(inner)
    if len(k):
        joint = fore[k - 1][:, :, None] * push[None] * (local[k] * back[k])[:, None, :]
        expected = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return both[:, 1] / both.sum(axis=1), expected


def train(first: np.ndarray, feats: np.ndarray, label: np.ndarray) -> Model:
    """Fit on texts whose lines all carry the text's label (0 or 1)."""
    mean, scale = feats.mean(axis=0), feats.std(axis=0)
    scale[scale < 1e-9] = 1.0
    model = Model(mean, scale, np.zeros(feats.shape[1] + 1), np.zeros((2, 2)))
    x = np.hstack([np.ones((len(feats), 1)), (feats - mean) / scale])
    y = np.repeat(label, np.diff(first)).astype(float)
    seen = np.zeros((2, 2))
    for v in (0, 1):
        seen[v, v] = np.maximum(np.diff(first)[label == v] - 1, 0).sum()
    n = len(feats)
    step = [np.zeros_like(model.weight), np.zeros((2, 2))]
    size = [np.zeros_like(model.weight), np.zeros((2, 2))]
    for i in range(1, STEPS + 1):  # Adam
        good, expected = marginals(first, np.clip(x @ model.weight, -30, 30), model.pairs)
        grads = [x.T @ (y - good) / n - PENALTY * model.weight,
                 (seen - expected) / n - PENALTY * model.pairs]
        for k, (value, g) in enumerate(zip((model.weight, model.pairs), grads)):
            step[k] = 0.9 * step[k] + 0.1 * g
            size[k] = 0.99 * size[k] + 0.01 * g * g
            value += RATE * step[k] / (1 - 0.9 ** i) / (np.sqrt(size[k] / (1 - 0.99 ** i)) + 1e-8)
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = vec.utf8(batch.column("text"))
        for i, j in vec.chunks(off):
            first, _, feats = lines_of(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            feats = feats.astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality").slice(i, j - i).cast(pa.int32()),
                 pa.array([feats[a:b].tobytes() for a, b in zip(first[:-1], first[1:])],
                          type=pa.binary())], names=["quality", "feats"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN) -> Model:
    """Fit on documents of ``labels`` (``doc_id, quality``), at most ``limit`` of them."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality")
    some = least_hashes(known.distinct(), limit, "doc_id", "quality")
    rows = (docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
            .select("quality", "text").mapInArrow(_features, "quality int, feats binary")
            .limit(limit).collect())  # features of a bounded sample
    if not rows:
        d = with_neighbours(np.array([0, 1]), np.zeros((1, len(OWN)))).shape[1]
        return Model(np.zeros(d), np.ones(d), np.zeros(d + 1), np.zeros((2, 2)))
    rows.sort(key=lambda r: (r.quality, bytes(r.feats)))
    parts = [np.frombuffer(r.feats, "<f4").reshape(-1, len(OWN)) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    feats = with_neighbours(first, np.concatenate(parts).astype(np.float64))
    return train(first, feats, np.array([r.quality for r in rows]))


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    """Length-weighted mean marginal of good, for each text."""
    raw, off = vec.utf8(texts)
    out = []
    for i, j in vec.chunks(off):
        first, size, feats = lines_of(raw[off[i]:off[j]], off[i:j + 1] - off[i])
        feats = feats.astype("<f4").astype(np.float64)
        good, _ = marginals(first, model.emission(with_neighbours(first, feats)), model.pairs)
        out.append(np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1]))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (chance that the text is good, 0 to 1)."""
    need(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score_texts(model, batch.column("text")))],
                names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def held_out() -> Column:
    """Documents whose labels the model never sees."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
