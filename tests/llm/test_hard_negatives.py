"""Hard negatives: the index against whole products, windows against plain Python, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tradewind.llm import hard_negatives as hn
from tradewind.llm.common import durable


@pytest.mark.parametrize("scale", [1, 2**12, 2**22])  # scores in 32-bit floats, 64-bit floats, integers
def test_index_finds_all_pairs_above_thresholds(scale):
    rng = np.random.default_rng(5)
    spread = np.exp(-np.arange(24) / 6)
    a, x = ((rng.normal(size=(n, 24)) * spread * 90).astype(np.int64) * scale + rng.integers(-3, 4, (n, 24)) for n in (40, 700))
    order = list(rng.permutation(24))
    whole = a @ x.T
    for t in (np.full(40, int(np.quantile(whole, 0.99))), np.full(40, -10), rng.choice(whole.ravel(), 40), np.full(40, hn.LOW)):
        who, row, score = hn.above(hn._Side(a, order), hn._Side(x, order), t)
        want = set(zip(*np.nonzero(whole >= t[:, None])))
        assert set(zip(who.tolist(), row.tolist())) == want and len(who) == len(want)
        assert (score == whole[who, row]).all()


def test_high_thresholds_leave_dimensions_out(monkeypatch):
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(500, 64)) * 256 / 8).astype(np.int64)
    used = []
    real = np.einsum
    monkeypatch.setattr(np, "einsum", lambda *a: used.append(len(a[1])) or real(*a))
    hn.above(hn._Side(x[:20], list(range(64))), hn._Side(x, list(range(64))), np.full(20, 30_000))
    assert 0 < max(used) < 20 * 500 / 2  # few pairs are finished from the dimensions that no list has


def plain(rows, positives=5, negatives=10):
    whole = []
    for i, v, label in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole.append((i, [math.floor(256 * c) for c in v], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for a, x, label in whole:
        if a is None or a % 100:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), i, same) for i, y, same in ((i, y, m == label) for i, y, m in whole) if i != a]
        scored.sort(key=lambda s: (-s[0], *last(s[1])))
        for ps, p, _ in [s for s in scored if s[2]][:positives]:
            near = [s for s in scored if not s[2] and 30 * ps <= 100 * s[0] <= 90 * ps][:negatives]
            out += [(a, p, k, n, ps, ns) for k, (ns, n, _) in enumerate(near, 1)]
    return sorted(out, key=str)


SCHEMA = "vec_id long, embedding array<float>, label int"


def mined(frame):
    return sorted(map(tuple, hn.mine(frame).collect()), key=str)


def test_odd_rows_against_plain_python(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=12) * 0.4).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(0, 900, 3)]
    hot = rows[4][1]
    rows += [(1000 + i, hot, 1) for i in range(200)] + [(5000 + i, hot, 2) for i in range(50)]  # ties far beyond a window
    rows += [(None, hot, 1), (None, rows[8][1], 3), (300, rows[9][1], 0), (300, rows[9][1], 0), (303, rows[10][1], 2), (303, rows[10][1], 2)]
    rows += [(7000, [], 1), (7100, [0.5], 1), (7200, hot + [0.3] * 9, 2), (7300, None, 1), (7400, hot, None), (7500, [0.1, None], 1),
             (7600, [float("nan")] * 12, 1), (7700, [float("inf")], 2), (-100, hot, 1), (7800, [0.0] * 12, 3)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "'x' AS w", "2 AS a", "3 AS score", "4 AS rank").repartition(4)
    assert mined(frame) == plain(rows)


def test_small_tables(spark):
    frame = spark.createDataFrame([(100, [0.5, 0.5], 1), (1, [0.4, 0.6], 1), (2, [0.3, 0.3], 2), (None, [0.3, 0.3], 2)], SCHEMA)
    assert [r[3] for r in mined(frame)] == [2, None] and mined(frame) == plain([tuple(r) for r in frame.collect()])
    assert mined(frame.limit(0)) == [] and mined(frame.where("vec_id <> 100")) == [] and mined(frame.where("label = 1")) == []


def test_scores_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(100, [1e20], 1), (1, [1e20], 1)], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        mined(frame)


def test_thresholds_fall_until_windows_fill(spark, monkeypatch):
    rng = np.random.default_rng(8)
    frame = spark.createDataFrame([(i, rng.normal(size=8).astype(np.float32).tolist(), i % 3) for i in range(400)], SCHEMA)
    asked = []
    real = hn.search
    monkeypatch.setattr(hn, "search", lambda b, o, w, k: asked.append((k, w.count())) or real(b, o, w, k))
    rows = [tuple(r) for r in frame.collect()]
    assert mined(frame) == plain(rows)
    tens = [n for k, n in asked if k == 10]
    assert tens == sorted(tens, reverse=True) and len(tens) > 1 and tens[-1] < tens[0]


def test_blocks_hold_every_row_once(spark):
    frame = spark.createDataFrame([(i, [float(i)] * (1 + i % 3), 1) for i in range(1000)], SCHEMA)
    blocks = hn.row_blocks(hn.integer_rows(frame))
    ids = np.concatenate([np.frombuffer(b.ids, np.int64) for b in blocks.collect()])
    assert sorted(ids.tolist()) == list(range(1000)) and durable(blocks, "x").count() == blocks.count()
