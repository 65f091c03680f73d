from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tradewind import session
from tradewind.llm import line_store


def kept(docs):
    """Brute force: long lines held by two documents stay in the smallest only."""
    owners = {}
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(fold)
    for i, text in docs:
        for x in (text or "").split("\n"):
            if i is not None and len(key(x)) >= 10:
                owners.setdefault(key(x), set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if i is None or len(owners.get(key(x), ())) < 2 or min(owners[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def documents(n, seed):
    rng = random.Random(seed)
    pool = [f"common line number {i}" for i in range(6)] + ["short", "", "éééééééééé", "  COMMON line number 1\t"]
    return [(i, "\n".join(rng.choice([*pool, f"own line {i} {k}"]) for k in range(rng.randrange(6)))) for i in range(n)]


def test_filter_holds_all_and_forgets():
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, (50_000, 2))
    import pandas as pd

    def step(k, sign, filters):
        frame = pd.DataFrame({"shard": 0, "k0": k[:, 0], "k1": k[:, 1], "sign": sign})
        out = line_store._update(frame, filters)
        return out[out.layer >= 0][["shard", "layer", "slots"]], out[out.layer < 0]

    empty = pd.DataFrame({"shard": [], "layer": [], "slots": []})
    filters, hits = step(keys[:30_000], 1, empty)
    assert not len(hits)
    filters, hits = step(keys, 1, filters)
    assert len(hits) >= 30_000 and len(hits) < 30_100  # all that were there, few mistakes
    mistaken = hits.merge(pd.DataFrame(keys[30_000:], columns=["k0", "k1"]), on=["k0", "k1"]).to_numpy()[:, -2:].astype(np.int64)
    filters, _ = step(mistaken, 2, filters)
    filters, _ = step(keys[:25_000], -1, filters)
    _, hits = step(keys, 1, filters)
    stay = set(map(tuple, keys[25_000:].tolist()))
    assert stay <= set(zip(hits.k0, hits.k1)) and len(hits) < 25_100


def test_insert_delete_equal_brute_force(spark):
    docs = [*documents(60, 3), (None, "common line number 1\nx"), (61, None), (62, "common line number 2"), (62, "common line number 2")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    path = session.scratch_dir(spark, "test-lines")
    store = line_store.LineStore(spark, path, 3)
    store.insert(frame.where("doc_id % 3 = 0 or doc_id is null"))
    store.insert(frame.where("doc_id % 3 <> 0"))
    assert rows(store.apply(frame)) == kept(docs)
    gone = {0, 1, 2, 3, 4, 5, 7, 11}
    store = line_store.LineStore(spark, path, 3)  # opened again
    store.delete(frame.where(F.col("doc_id").isin(gone)))
    left = [d for d in docs if d[0] not in gone]
    assert rows(store.apply(frame.where(~F.col("doc_id").isin(gone) | F.col("doc_id").isNull()))) == kept(left)
    store.insert(frame.where(F.col("doc_id").isin(gone)))
    assert rows(store.apply(frame)) == kept(docs)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    store = line_store.LineStore(spark, session.scratch_dir(spark, "test-lines"), 2)
    assert rows(store.apply(docs)) == []
    store.insert(docs)
    store.delete(docs)
    assert rows(store.apply(docs)) == []
