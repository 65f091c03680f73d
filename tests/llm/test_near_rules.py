"""The near-duplicate stage: five words at 0.80 and op1's rule as well."""

from __future__ import annotations

import itertools
import random

import pytest

import corpus_pipeline
from tradewind.llm import minhash_dedup


def grams(text, n):
    w = text.lower().split()
    return {tuple(w[k:k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set()


def alike(a, b, n):
    x, y = grams(a, n), grams(b, n)
    return len(x & y) / len(x | y)


def fresh(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def kept_by_hand(texts, rules):
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, least, of in rules:
        sets = [grams(t, n) for t in texts]
        for a, b in itertools.combinations(range(len(texts)), 2):
            both = len(sets[a] & sets[b])
            if both and of * both >= least * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [i for i in range(len(texts)) if top(i) == i]


def test_reach():
    assert minhash_dedup.reach(85, 100) == (21, 11) and minhash_dedup.reach(80, 100) == (27, 14)
    with pytest.raises(ValueError):
        minhash_dedup.reach(0, 100)


def test_stage_takes_pairs_between_80_and_85(spark):
    rng = random.Random(8)
    base = fresh(rng, 200)
    edited = fresh(rng, 300)
    scattered = [f"x{i}" if i % 40 == 20 else w for i, w in enumerate(edited)]
    texts = [" ".join(t) for t in (base, base + fresh(rng, 40), edited, scattered, fresh(rng, 200), base[:150] + fresh(rng, 90))]
    assert 0.80 <= alike(texts[0], texts[1], 5) < 0.85 and alike(texts[0], texts[1], 3) < 0.85
    assert alike(texts[2], texts[3], 5) < 0.80 and alike(texts[2], texts[3], 3) >= 0.85
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect())
    assert got == kept_by_hand(texts, corpus_pipeline.NEAR) == [0, 2, 4, 5]


def test_stage_against_all_pairs(spark):
    rng = random.Random(21)
    texts = []
    for _ in range(60):  # copies with one block added or removed, and with words replaced, about both limits; chains of them
        base = fresh(rng, rng.randrange(60, 300))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            at, n = rng.randrange(len(base)), len(base)
            base = (base[:at] + fresh(rng, int(n * rng.uniform(0.1, 0.3))) + base[at:] if rng.random() < 0.5
                    else [f"y{rng.randrange(10**9)}" if rng.random() < rng.choice([0.01, 0.02, 0.03]) else w for w in base])
            texts.append(" ".join(base))
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in minhash_dedup.deduplicated(docs, corpus_pipeline.NEAR).select("doc_id").collect())
    assert got == kept_by_hand(texts, corpus_pipeline.NEAR)
    assert got != kept_by_hand(texts, corpus_pipeline.NEAR[:1]) and got != kept_by_hand(texts, corpus_pipeline.NEAR[1:])
