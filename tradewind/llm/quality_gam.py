"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins; a feature adds an entry of its table to the log-odds, a chosen pair of
features an entry of a small grid. Tables are learned by cyclic gradient boosting: round after round
each feature in turn gets a shallow tree on what the others leave, at a small rate. Then the pairs
that explain most of the rest are found and boosted in the same way. Scoring is a look-up and an addition per
feature, for whole batches.

It is trained in the driver on at most `TRAIN` labelled rows: those with the smallest hash of their id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import wordhash
from tradewind.llm.common import durable, row_hash
from tradewind.llm.textstats import Stats

TRAIN, BINS, PAIR_BINS, PAIRS = 20_000, 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, SMOOTH, LEAST = 150, 40, 0.1, 5.0, 8
CUT = 0.7
FEATURES = ["words", "word_length", "symbols", "upper", "digits", "points", "bangs", "pipes", "distinct",
            "echo", "long_words", "short_words", "repeat_words", "dup_lines", "line_words", "letters"]


def features(s: Stats) -> np.ndarray:
    words, chars = np.maximum(s.n_words, 1), np.maximum(s.word_chars, 1)
    lines, letters = np.maximum(s.n_lines, 1), np.maximum(s.counts["letters"], 1)
    return np.stack([
        np.log1p(s.n_words), s.word_chars / words, s.n_symbols / chars, s.counts["upper"] / letters,
        s.counts["digits"] / chars, s.counts["points"] / words, s.counts["bangs"] / words, s.counts["pipes"] / words,
        s.n_distinct / words, s.n_echo / words, s.n_long / words, s.n_short / words, s.n_repeat_words / words,
        s.n_dup_lines / lines, s.n_words / lines, s.counts["letters"] / chars], axis=1).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Best gain and place of one cut of ordered bins; (0, 0) if none leaves enough rows on both sides."""
    cg, ch, cn = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = cg**2 / (ch + SMOOTH) + (g.sum() - cg)**2 / (h.sum() - ch + SMOOTH) - g.sum()**2 / (h.sum() + SMOOTH)
    gain = np.where((cn >= LEAST) & (n.sum() - cn >= LEAST), gain, 0)
    if not len(gain) or gain.max() <= 0:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a shallow tree, one per bin."""
    cut = _split(g, h, n)[1] if depth else 0
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + SMOOTH))
    return np.concatenate([_tree(g[:cut], h[:cut], n[:cut], depth - 1), _tree(g[cut:], h[cut:], n[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts one feature of a grid, then the other on each side."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b, c = (x.T if turned else x for x in (g, h, n))
        for cut in range(1, len(a)):
            value, gain = np.zeros_like(a), -a.sum()**2 / (b.sum() + SMOOTH)
            for side in (slice(0, cut), slice(cut, None)):
                sg, sh, sn = a[side].sum(0), b[side].sum(0), c[side].sum(0)
                value[side] = _tree(sg, sh, sn, 1)
                gain += _split(sg, sh, sn)[0] + sg.sum()**2 / (sh.sum() + SMOOTH)
            if gain > best[0]:
                best = (gain, value.T if turned else value)
    return best


@dataclass
class Model:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    grids: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, j], "right")]
        coarse = {k: np.searchsorted(self.pair_edges[k], x[:, k], "right") for i, j, _ in self.grids for k in (i, j)}
        for i, j, grid in self.grids:
            total += grid[coarse[i], coarse[j]]
        return sigmoid(total)


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Without rows, or with one label only, the model is that label's share (one half without rows)."""
    mean = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    model = Model(float(np.log(mean / (1 - mean))))
    if len(np.unique(y)) < 2:
        return model
    quantiles = lambda c, k: np.unique(np.quantile(x[:, c], np.linspace(0, 1, k + 1)[1:-1]))
    columns = range(x.shape[1])
    model.edges = [quantiles(c, BINS) for c in columns]
    bins = [np.searchsorted(e, x[:, c], "right") for c, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    total = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for b, table, n in zip(bins, model.tables, rows):
            p = sigmoid(total)
            step = RATE * _tree(np.bincount(b, y - p, len(table)), np.bincount(b, p * (1 - p), len(table)), n)
            table += step
            total += step[b]
    model.pair_edges = [quantiles(c, PAIR_BINS) for c in columns]
    coarse = [np.searchsorted(e, x[:, c], "right") for c, e in enumerate(model.pair_edges)]
    size = [len(e) + 1 for e in model.pair_edges]

    def grid(i, j, weights):
        return np.bincount(coarse[i] * size[j] + coarse[j], weights, size[i] * size[j]).reshape(size[i], size[j])

    p = sigmoid(total)
    gains = sorted(((_pair_tree(grid(i, j, y - p), grid(i, j, p * (1 - p)), grid(i, j, None))[0], i, j)
                    for i in columns for j in columns if i < j), reverse=True)
    chosen = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.grids = [(i, j, np.zeros((size[i], size[j]))) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.grids:
            p = sigmoid(total)
            step = RATE * _pair_tree(grid(i, j, y - p), grid(i, j, p * (1 - p)), grid(i, j, None))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows never trained on; those without id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(labels: DataFrame, size: int = TRAIN) -> DataFrame:
    """(doc_id, quality): at most `size` labelled ids outside the held-out part. A repeated label counts by its mean."""
    asked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").where(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    return asked.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(size)


def fit(docs: DataFrame, labels: DataFrame, size: int = TRAIN) -> Model:
    chosen = durable(sample(labels, size), "quality-sample")

    def run(batches):
        for batch in batches:
            for block in wordhash.blocks(batch.column(2)):
                rows = features(Stats(block))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n), batch.column(1).slice(block.first, block.n),
                     pa.array(list(rows), pa.list_(pa.float32()))], names=["doc_id", "quality", "x"])

    # `size` rows of 12 bytes at most.
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "quality", "text").mapInArrow(run, "doc_id bigint, quality int, x array<float>")
    rows = sorted({(r["doc_id"], r["quality"], tuple(r["x"])) for r in known.collect()})
    x = np.array([r[2] for r in rows], np.float32).reshape(-1, len(FEATURES))
    return train(x, np.array([r[1] for r in rows], float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, _row, score of every row; null and empty texts are scored like any other, with counts of 0."""
    def run(batches):
        for batch in batches:
            for block in wordhash.blocks(batch.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n), batch.column(1).slice(block.first, block.n),
                     pa.array(model.score(features(Stats(block))))], names=["doc_id", "_row", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_hash(F.col("text")).alias("_row"), "text").mapInArrow(
        run, "doc_id bigint, _row bigint, score double")


def accepted(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of `docs` that score at least `cut`, with all their columns, in one pass over the texts."""
    @F.pandas_udf("double")
    def score(texts):
        found = [model.score(features(Stats(b))) for b in wordhash.blocks(pa.array(texts, pa.string()))]
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    return docs.where(score(F.col("text")) >= cut)
