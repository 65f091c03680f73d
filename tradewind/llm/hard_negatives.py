"""Hard negatives: threshold joins of anchors with all rows over a pruned inverted index, in blocks.

Rows stand in blocks of a few thousand, anchors in blocks of some hundred; a task joins one block of each. For every
dimension the index lists the rows of its block that need it: with dimensions in one order (most energy first), a row is
listed up to the dimension from which its suffix norm, times that of any anchor of the block, stays below the anchor's threshold:
the omitted rest alone can't reach it. Scores are accumulated list by list; a pair is dropped as soon as
its partial score plus the product of both remaining norms is below the threshold, and what survives is finished from the
omitted dimensions. So every pair at or above the threshold is found with its exact score.

A window asks for the first k rows with a score within lo..hi. Thresholds start high and are lowered, for windows that
are not full only, until k rows are found or the threshold has come down to lo. First the anchors' positives are mined, from a
threshold that a sample of one block suggests, then the negatives, from the upper end of their window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import durable

VALUES = 1 << 18  # of a block of rows: 4,096 rows of 64 dimensions
ANCHORS, SLICE = 1_024, 256  # of a block, and at once
CELLS = 16  # of a task, when there are more of them than cores
STEP = 8  # dimensions of a list
LOW, HIGH = -(2**62), 2**62
BLOCK = "r bigint, n int, ids binary, no_id binary, labels binary, x binary, energy array<double>"
MOST = 2**31 - 1  # of a component; more doesn't fit a score of 64 bits


def integer_rows(vectors: DataFrame, relabel: Column | None = None) -> DataFrame:
    """id, no_id, label, x for the rows of `vectors` (vec_id, embedding, label) that take part: those with a label and with
    a vector whose components are all finite numbers. A component becomes floor(256 x)."""
    whole = F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.forall(
        "embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(v))
    codes = F.transform("embedding", lambda v: F.floor(v.cast("double") * 256).cast("bigint"))
    label = F.col("label").cast("bigint") if relabel is None else relabel
    return vectors.where(whole).select(F.coalesce(F.col("vec_id").cast("bigint"), F.lit(2**63 - 1)).alias("id"),
                                       F.col("vec_id").isNull().alias("no_id"), label.alias("label"), codes.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    size = np.array([len(x) for x in column], np.int64)
    out = np.zeros((len(column), int(size.max(initial=0))), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    if len(flat) and max(-int(flat.min()), int(flat.max())) > MOST:
        raise ArithmeticError("a component of 2^23 or more gives scores beyond 64 bits")
    return out


def row_blocks(rows: DataFrame) -> DataFrame:
    """The rows packed in blocks, one row each, written: what the index lists are made of."""
    def run(batches):
        number = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                wide = max(len(batch.column(3)[at]), 1)
                part = batch.slice(at, max(VALUES // wide, 1))
                x = _matrix(part.column(3))
                if x.size > 2 * VALUES:  # a longer vector follows shorter ones
                    part = part.slice(0, max(VALUES // x.shape[1], 1))
                    x = _matrix(part.column(3))
                at += len(part)
                yield pa.RecordBatch.from_pylist([{
                    "r": number, "n": len(part), "ids": part.column(0).to_numpy().tobytes(),
                    "no_id": part.column(1).to_numpy(zero_copy_only=False).tobytes(),
                    "labels": part.column(2).to_numpy().tobytes(), "x": x.astype(np.int32).tobytes(),
                    "energy": (x.astype(float)**2).sum(0).tolist()}], schema=kinds)
                number += 1

    kinds = pa.schema([("r", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("no_id", pa.binary()), ("labels", pa.binary()),
                       ("x", pa.binary()), ("energy", pa.list_(pa.float64()))])
    packed = rows.select("id", "no_id", "label", "x").mapInArrow(run, BLOCK)
    return durable(packed.withColumn("r", F.monotonically_increasing_id()), "row-blocks")


def dimension_order(blocks: DataFrame) -> list[int]:
    """Dimensions by falling sum of squares; as many numbers as the longest vector has."""
    energy = blocks.select(F.posexplode("energy").alias("d", "e")).groupBy("d").agg(F.sum("e").alias("e"))
    return [r["d"] for r in energy.orderBy(F.desc("e"), "d").select("d").collect()]


class _Side:
    """Vectors with their dimensions in order, and the norm of what is left after each list."""

    def __init__(self, x: np.ndarray, order: list[int]):
        wide = np.zeros((len(x), max(len(order), 1)), np.int64)
        if x.shape[1]:
            wide[:, :x.shape[1]] = x
            wide[:, :len(order)] = wide[:, order]
        self.x = wide
        self.cuts = list(range(0, wide.shape[1], STEP))
        squares = wide.astype(float)**2
        rest = [np.sqrt(squares[:, c:].sum(1)) for c in (*self.cuts, wide.shape[1])]
        self.rest = np.stack(rest)  # [list, row]; a hair more than exact, so that rounding drops nothing
        self.rest *= 1 + 1e-9


def above(anchors: _Side, rows: _Side, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose score reaches the anchor's threshold."""
    top = float(anchors.rest[0].max(initial=0) * rows.rest[0].max(initial=0))
    kind = np.float32 if top < 2**23 else np.float64 if top < 2**52 else np.int64
    if top >= 2**62:
        raise ArithmeticError("a score doesn't fit 64 bits")
    t = threshold.astype(float)
    t -= np.abs(t) * 1e-12
    a, x = anchors.x.astype(kind), rows.x.astype(kind)
    # How many lists a row is in: up to the first suffix that reaches no anchor's threshold.
    lists = np.zeros(x.shape[0], np.int64)
    for j in range(len(rows.cuts)):
        # Anchors differ in threshold and norm; the largest norm a unit of threshold bounds them all.
        needed = rows.rest[j] * (anchors.rest[j] / t).max(initial=0) >= 1 if (t > 0).all() else np.ones(len(lists), bool)
        lists[needed] = j + 1
    order = np.argsort(-lists, kind="stable")
    x, lists, rest = x[order], lists[order], rows.rest[:, order]
    score = np.zeros((len(a), int((lists > 0).sum())), kind)
    for j, c in enumerate(rows.cuts):
        listed = int((lists > j).sum())
        if listed:
            score[:, :listed] += a[:, c:c + STEP] @ x[:listed, c:c + STEP].T
    # The suffix that is not in the lists is bounded by the norms of both sides from there on.
    n = score.shape[1]
    left = lists[:n]
    who, which = np.nonzero(score + anchors.rest[left].T * rest[left, np.arange(n)] >= t[:, None])
    found, left = score[who, which].astype(np.float64 if kind == np.float32 else kind), left[which]
    for j, c in enumerate(rows.cuts):  # finish from the omitted dimensions, dropping what falls behind
        open_ = left <= j
        if not open_.any():
            continue
        p, q = who[open_], which[open_]
        found[open_] += np.einsum("ij,ij->i", a[p, c:c + STEP], x[q, c:c + STEP])
        bound = found.astype(float)
        bound[open_] += anchors.rest[j + 1, p] * rest[j + 1, q]
        keep = ~open_ | (bound >= t[who])
        who, which, found, left = who[keep], which[keep], found[keep], left[keep]
    exact = found.astype(np.int64)
    keep = exact >= threshold[who]
    return who[keep], order[which[keep]], exact[keep]


def _first(who: np.ndarray, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each window: higher scores first, then smaller ids."""
    order = np.lexsort((ids, no_id, -score, who))
    w = who[order]
    begin = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(begin, np.diff(np.append(begin, len(w))))
    return order[rank < k]


FOUND = pa.schema([("w", pa.int64()), ("id", pa.int64()), ("no_id", pa.bool_()), ("score", pa.int64())])


def _cell(block: dict, anchors: pa.Table, order: list[int], k: int) -> pa.Table:
    """What the windows of some anchors find in one block, the first k each."""
    ids, labels = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["labels"], np.int64)
    no_id = np.frombuffer(block["no_id"], bool)
    rows = _Side(np.frombuffer(block["x"], np.int32).reshape(len(ids), -1).astype(np.int64), order)
    asks = anchors.column("asks").to_pylist()
    threshold = np.array([min(w["t"] for w in own) for own in asks], np.int64)
    who, row, score = above(_Side(_matrix(anchors.column("x").combine_chunks()), order), rows, threshold)
    own_id, own_label = (anchors.column(c).to_numpy() for c in ("anchor_id", "label"))
    fits = (ids[row] != own_id[who]) | no_id[row]
    picked = []
    for slot in range(max(map(len, asks))):
        get = lambda key: np.array([own[slot][key] if slot < len(own) else -1 for own in asks], np.int64)  # noqa: B023, E731
        there = np.array([slot < len(own) for own in asks])
        near = fits & there[who] & (score >= get("t")[who]) & (score <= get("hi")[who]) & (
            (labels[row] == own_label[who]) == get("same")[who].astype(bool))
        w, r, v = get("w")[who[near]], row[near], score[near]
        at = _first(w, v, no_id[r], ids[r], k)
        picked.append(pa.table([pa.array(w[at]), pa.array(ids[r[at]]), pa.array(no_id[r[at]]), pa.array(v[at])], schema=FOUND))
    return pa.concat_tables(picked)


def search(blocks: DataFrame, order: list[int], windows: DataFrame, k: int) -> DataFrame:
    """(w, id, no_id, score, rank): the first k rows of each window (w, a, anchor_id, label, x, same, t, lo, hi) with a
    score in t..hi and the anchor's label (`same`) or another; no row has the anchor's own id. Written.

    Each anchor `a` may have some windows; they are told apart by `w`."""
    conf = blocks.sparkSession.sparkContext
    n_blocks, n_anchors = (x.count() for x in (blocks, windows.select("a").distinct()))
    n_groups = max(-(-n_anchors // ANCHORS), 1)
    cells = max(n_blocks, 1) * n_groups
    tasks = max(min(cells, conf.defaultParallelism), -(-cells // CELLS))
    asked = windows.groupBy("a").agg(*[F.first(c).alias(c) for c in ("anchor_id", "label", "x")], F.collect_list(
        F.struct("w", F.col("same").cast("int").alias("same"), "t", "hi")).alias("asks"))
    dealt = asked.withColumn("q", F.pmod(F.xxhash64("a"), F.lit(n_groups))).withColumn(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_blocks, 1) - 1).cast("long")))).drop("a")
    listed = blocks.withColumn("b", F.pmod(F.xxhash64("r"), F.lit(max(n_blocks, 1)))).withColumn(
        "q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long")))).drop("energy", "r", "n")

    def join(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = [_cell(block, anchors.slice(at, SLICE), order, k)
                 for block in rows.to_pylist() for at in range(0, anchors.num_rows, SLICE)]
        return pa.concat_tables(found) if found else FOUND.empty_table()

    met = listed.repartition(tasks, "b", "q").groupBy("b", "q").cogroup(dealt.repartition(tasks, "b", "q").groupBy("b", "q"))
    found = met.applyInArrow(join, "w bigint, id bigint, no_id boolean, score bigint")
    first = F.row_number().over(W.partitionBy("w").orderBy(F.desc("score"), "no_id", "id"))
    return durable(found.withColumn("rank", first).where(F.col("rank") <= k), "window-rows")


def filled(blocks: DataFrame, order: list[int], windows: DataFrame, k: int) -> DataFrame:
    """`search` for windows with falling thresholds (`steps`, the last one is the window's lower end): a window that has
    found k rows is done, all others go on with a lower threshold."""
    steps = windows.select(F.max(F.size("steps"))).head()[0] or 0
    done, open_ = [], windows
    for turn in range(steps):
        found = search(blocks, order, open_.withColumn("t", F.element_at("steps", turn + 1)), k)
        if turn == steps - 1:
            done.append(found)
            break
        full = durable(found.groupBy("w").count().where(F.col("count") == k).select("w"), "full-windows")
        done.append(found.join(full, "w", "left_semi"))
        open_ = durable(open_.join(full, "w", "left_anti"), "open-windows")
        if not open_.limit(1).count():
            break
    result = done[0] if done else search(blocks, order, windows.withColumn("t", F.lit(LOW)), k)
    for d in done[1:]:
        result = result.unionByName(d)
    return result


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 10, relabel: Column | None = None, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for `vectors` (vec_id, embedding, label).

    Anchors are the rows whose id `every` divides. A row with a null label, a null vector or any null or non-finite component
    takes no part; a vector that is shorter than another one ends in zeros. A row without an id is no anchor and comes
    last among equal scores; its id stays null. A row that repeats is as many rows, but rows with an anchor's id are none of
    its others. Other columns are not looked at. Without anchors, positives or negatives there are no rows.
    Scores are exact; one that needs more than 64 bits is an ArithmeticError."""
    rows = integer_rows(vectors, relabel)
    blocks = row_blocks(rows)
    order = dimension_order(blocks)
    anchors = durable(rows.where(~F.col("no_id") & (F.col("id") % every == 0)), "anchors").select(
        F.monotonically_increasing_id().alias("a"), F.col("id").alias("anchor_id"), "label", "x")
    anchors = durable(anchors, "anchors")

    every_row = anchors.select(F.col("a").alias("w"), "*", F.lit(True).alias("same"), F.lit(LOW).alias("lo"), F.lit(HIGH).alias("hi"))
    sample = blocks.orderBy(F.desc("n"), "r").limit(1)  # a first threshold only: no row is left out for it
    seen = search(durable(sample, "sample-block"), order, every_row.withColumn("t", F.lit(LOW)), positives)
    guess = seen.groupBy("w").agg(F.max("score").alias("_best"), F.when(F.count("*") == positives, F.min("score")).alias("_last"))
    steps = F.array_compact(F.array("_best", "_last", F.lit(LOW)))
    steps = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.coalesce(F.get(steps, i), F.lit(LOW)))
    best = filled(blocks, order, every_row.join(guess, "w", "left").withColumn("steps", steps).drop("_best", "_last"), positives)

    pairs = durable(best.where(F.col("score") >= 0).select(F.monotonically_increasing_id().alias("w"), F.col("w").alias("a"),
                                                          F.col("id").alias("positive_id"), F.col("no_id").alias("_p"),
                                                          F.col("score").alias("positive_score")), "positives")
    tens, rest = F.expr("positive_score div 10"), F.col("positive_score") % 10
    lo, hi = tens * 3 + F.ceil(rest * 3 / 10), tens * 9 + F.floor(rest * 9 / 10)
    windows = pairs.join(anchors, "a").select("w", "a", "anchor_id", "label", "x", F.lit(False).alias("same"), lo.alias("lo"), hi.alias("hi"))
    down = lambda part: F.col("hi") - F.expr(f"(hi - lo) div {part}")
    windows = durable(windows.withColumn("steps", F.array(down(32), down(8), down(2), "lo")), "windows")
    found = filled(blocks, order, windows, negatives)
    named = found.select("w", F.when(~F.col("no_id"), F.col("id")).alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    return named.join(pairs, "w").join(anchors.select("a", "anchor_id"), "a").select(
        "anchor_id", F.when(~F.col("_p"), F.col("positive_id")).alias("positive_id"), "rank", "negative_id", "positive_score",
        "negative_score")
