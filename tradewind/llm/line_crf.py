"""Quality rules by line labelling: a linear-chain conditional random field marks content and boilerplate.

A line is described by a few binned features of its own; nothing of the whole text is among them, so that good and bad
lines of one text can part. The field scores each label by the weights of the line's
bins plus transitions between neighbours; Viterbi decoding takes the best labelling of a whole text.
A text is kept if at least half of its words stand in content lines.

Labels of lines are not given, so training starts from labels of texts: lines of good texts are content,
lines of bad ones boilerplate. A model of single lines learned from that finds the ordinary lines inside
bad texts; with these turned to content, the field is trained by its likelihood (forward-backward), on the texts and on good and bad
ones put together, which show it where labels change. Training runs in the driver on at most `TRAIN` labelled texts of at most `MAX_LINES` lines each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import wordhash
from tradewind.llm.common import durable
from tradewind.llm.textstats import Stats

TRAIN, MAX_LINES = 4000, 500
STEPS, RATE, RIDGE = 120, 0.1, 1e-3
MIN_WORDS, REPEAT_PERCENT, CONTENT_SHARE = 10, 20, 0.5
CONTENT, BOILERPLATE = 0, 1


def _bin(value: np.ndarray, edges: list[float]) -> np.ndarray:
    return np.searchsorted(np.array(edges), value, "left")


#: Number of bins of each feature, in the order of `describe`.
SIZES = [6, 5, 4, 4, 4, 4, 2, 2, 4, 3]


def describe(s: Stats) -> np.ndarray:
    """One row per line: the bin of each feature."""
    words, chars = np.maximum(s.line_words, 1), np.maximum(s.line_chars, 1)
    letters = np.maximum(s.line_counts["letters"], 1)
    first = np.append(True, s.line_last[:-1]) if len(s.line_last) else s.line_last
    return np.stack([
        _bin(s.line_words, [0, 1, 4, 9, 24]),
        _bin(s.line_counts["symbols"] / chars, [0, 0.02, 0.06, 0.15]),
        _bin(s.line_counts["upper"] / letters, [0.15, 0.4, 0.8]),
        _bin(s.line_counts["pipes"] / words, [0, 0.2, 0.4]),
        _bin(s.line_counts["bangs"] / words, [0, 0.1, 0.5]),
        _bin(s.line_repeat / words, [0, 0.2, 0.6]),
        s.line_again.astype(int), s.line_stop.astype(int),
        _bin(s.line_counts["digits"] / chars, [0, 0.05, 0.2]),
        first.astype(int) + 2 * (s.line_last & ~first).astype(int),
    ], axis=1)


OFFSETS = np.concatenate(([0], np.cumsum(SIZES)[:-1]))


@dataclass
class Field:
    """Weights of bins for boilerplate against content, and of (label before, label) pairs."""

    bins: np.ndarray
    move: np.ndarray
    start: np.ndarray

    @staticmethod
    def blank() -> Field:
        return Field(np.zeros(sum(SIZES)), np.zeros((2, 2)), np.zeros(2))

    def emissions(self, described: np.ndarray) -> np.ndarray:
        return self.bins[described + OFFSETS].sum(1)

    def decode(self, emission: list[float]) -> list[int]:
        """Best labels of one text; ties go to content."""
        (cc, cb), (bc, bb) = self.move.tolist()
        c, b = float(self.start[0]), float(self.start[1]) + emission[0]
        back = []
        for e in emission[1:]:
            to_c, to_b = b + bc > c + cc, b + bb >= c + cb
            back.append((to_c, to_b))
            c, b = (b + bc if to_c else c + cc), e + (b + bb if to_b else c + cb)
        label = BOILERPLATE if b > c else CONTENT
        out = [label]
        for to_c, to_b in reversed(back):
            label = int(to_b if label else to_c)
            out.append(label)
        return out[::-1]


def _line_model(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bin weights of a logistic model of single lines, bad and good lines weighing the same in all."""
    w, bias = np.zeros(sum(SIZES)), 0.0
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(300):
        p = 1 / (1 + np.exp(-(w[x].sum(1) + bias)))
        g = weight * (y - p)
        w += 4 * (np.bincount(x.ravel(), np.repeat(g, x.shape[1]), len(w)) - RIDGE * w)
        bias += 4 * g.sum()
    return w[x].sum(1) + bias


def _spliced(good: list[tuple], bad: list[tuple]) -> list[tuple]:
    """Good and bad texts put together in pairs, either first: whole texts alone would teach that a label hardly ever changes."""
    pairs = [(good[i % len(good)], bad[i % len(bad)]) for i in range(max(len(good), len(bad)))]
    return [tuple(np.concatenate(part) for part in zip(*(pair[::-1] if i % 2 else pair))) for i, pair in enumerate(pairs)]


def train(texts: list[np.ndarray], bad: np.ndarray) -> Field:
    """From described texts and their labels. Without both labels all is content."""
    model = Field.blank()
    if len(np.unique(bad)) < 2:
        model.start[BOILERPLATE] = -1.0
        return model
    x = np.concatenate(texts) + OFFSETS
    ends = np.cumsum([len(t) for t in texts])
    label = np.repeat(bad, [len(t) for t in texts])
    label = label * (_line_model(x, label.astype(float)) > 0)
    own = [(x[e - len(t):e], label[e - len(t):e]) for t, e in zip(texts, ends)]
    own += _spliced([t for t, b in zip(own, bad) if not b], [t for t, b in zip(own, bad) if b])
    own.sort(key=lambda t: -len(t[0]))
    x, y = np.concatenate([t[0] for t in own]), np.concatenate([t[1] for t in own])
    size = np.array([len(t[0]) for t in own])
    owner = np.repeat(np.arange(len(own)), size)
    # Lines by place in their text: the texts that have a t-th line are the first ones, as they are sorted by size.
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    active = [int((size > t).sum()) for t in range(size.max())]
    same = np.append(owner[1:] == owner[:-1], False)
    seen_move = np.zeros((2, 2))
    np.add.at(seen_move, (y[same[:len(y)]], y[1:][same[:-1]]), 1)
    seen_start = np.bincount(y[begin], minlength=2)
    seen_bins = np.bincount(x.ravel(), np.repeat(y, x.shape[1]), sum(SIZES))
    theta = np.zeros(sum(SIZES) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        bins, move, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        emit = np.stack([np.zeros(len(x)), bins[x].sum(1)], axis=1)
        alpha, beta = np.zeros((len(x), 2)), np.zeros((len(x), 2))
        alpha[begin] = start + emit[begin]
        for t in range(1, len(active)):
            at = begin[:active[t]] + t
            alpha[at] = np.logaddexp(alpha[at - 1, :1] + move[0], alpha[at - 1, 1:] + move[1]) + emit[at]
        for t in range(len(active) - 2, -1, -1):
            at = begin[:active[t + 1]] + t
            nxt = emit[at + 1] + beta[at + 1]
            beta[at] = np.logaddexp(nxt[:, :1] + move[:, 0], nxt[:, 1:] + move[:, 1])
        log_z = np.logaddexp(*alpha[begin + size - 1].T)[owner]
        p = np.exp(alpha + beta - log_z[:, None])
        pairs = np.flatnonzero(same[:len(x)])
        joint = np.exp(alpha[pairs][:, :, None] + move + (emit + beta)[pairs + 1][:, None, :] - log_z[pairs][:, None, None])
        grad = np.concatenate([seen_bins - np.bincount(x.ravel(), np.repeat(p[:, 1], x.shape[1]), sum(SIZES)),
                               (seen_move - joint.sum(0)).ravel(), seen_start - p[begin].sum(0)]) / len(own)
        grad -= RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:-6].copy(), theta[-6:-2].reshape(2, 2).copy(), theta[-2:].copy())


def fit(docs: DataFrame, labels: DataFrame, size: int = TRAIN, max_lines: int = MAX_LINES) -> Field:
    """Trained on the labelled ids with the smallest hashes; a repeated label counts by its mean."""
    chosen = durable(labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").where(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.avg("quality") < 0.5).cast("int").alias("bad")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size), "line-sample")

    def run(batches):
        for batch in batches:
            for block in wordhash.blocks(batch.column(2)):
                s = Stats(block)
                cells = describe(s).astype(np.uint8)
                ends = np.concatenate(([0], np.cumsum(s.n_lines)))
                few = np.flatnonzero(s.n_lines <= max_lines)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n).take(pa.array(few)),
                     batch.column(1).slice(block.first, block.n).take(pa.array(few)),
                     pa.array([cells[ends[i]:ends[i + 1]].tobytes() for i in few], pa.binary())], names=["doc_id", "bad", "cells"])

    # `size` rows of 12 bytes at most. Of rows with one id one is used, so that as many come to the driver as there are ids.
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "bad", "text").mapInArrow(run, "doc_id bigint, bad int, cells binary").groupBy("doc_id", "bad").agg(F.max("cells").alias("cells"))
    rows = sorted((r["doc_id"], r["bad"], bytes(r["cells"])) for r in known.collect())
    return train([np.frombuffer(r[2], np.uint8).reshape(-1, len(SIZES)).astype(int) for r in rows],
                 np.array([r[1] for r in rows], int))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame, model: Field) -> DataFrame:
    """Per row of `docs` (doc_id, text): the counts, base_failed, kept, n_content_words, and labels of the lines.

    Null texts have no words and one empty line. Texts whose base rules fail are labelled too, and not
    kept. Repeated rows are judged alike; other columns are not looked at."""
    schema = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
              + ", base_failed boolean, kept boolean, n_content_words bigint, labels string")

    def run(batches):
        for batch in batches:
            for block in wordhash.blocks(batch.column(1)):
                s = Stats(block)
                emission = model.emissions(describe(s)).tolist()
                ends = np.concatenate(([0], np.cumsum(s.n_lines))).tolist()
                labels = [model.decode(emission[a:b]) for a, b in zip(ends, ends[1:])]
                content = np.bincount(s.line_doc, s.line_words * (np.concatenate(labels) == CONTENT), s.n).astype(np.int64)
                failed = (s.n_words < MIN_WORDS) | (100 * s.n_repeat_words > REPEAT_PERCENT * s.n_words)
                kept = ~failed & (content >= CONTENT_SHARE * s.n_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n), *[pa.array(getattr(s, c).astype(np.int64)) for c in COUNTS],
                     pa.array(failed), pa.array(kept), pa.array(content),
                     pa.array(["".join("CB"[x] for x in own) for own in labels])],
                    names=["doc_id", *COUNTS, "base_failed", "kept", "n_content_words", "labels"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
