"""The pipeline on a small table: each stage's decisions take effect, nothing else changes."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tradewind.llm import decontaminate, minhash_dedup, mixing, quality_gam
from tradewind.llm.common import durable, read


@pytest.fixture(scope="module")
def steps(spark, root):
    out = [durable(read(spark, root, "documents"), "test")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(durable(stage(spark, out[-1], root), "test"))
    return out


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def test_filters(spark, root, steps):
    docs, good, single, clean = steps[:4]
    scores = quality_gam.scored(docs, quality_gam.fit(docs, read(spark, root, "labels"))).collect()
    assert ids(good) == Counter(r.doc_id for r in scores if r.score >= quality_gam.CUT)
    assert ids(single) == Counter(r.doc_id for r in minhash_dedup.groups(good).collect() if r.kept)
    found = decontaminate.contamination(single, read(spark, root, "benchmark")).collect()
    assert ids(clean) == Counter(r.doc_id for r in found if not (r.n_hit and 20 * r.n_hit >= r.n_words))
    assert len(ids(docs)) > len(ids(good)) > len(ids(single)) > len(ids(clean)) > 0
    texts = {r.doc_id: r for r in docs.collect()}
    assert all(r == texts[r.doc_id] for r in clean.collect())


def test_mix_and_shards(steps):
    clean, mixed, placed = steps[3:]
    words = lambda t: len(t.split())
    taken = {r.doc_id: r.taken for r in mixing.totals(clean).collect()}
    got = Counter()
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in mixed.collect():
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
        got[r.doc_id] += words(r.text)
    assert got == Counter({i: n for i, n in taken.items() if n})
    assert ids(mixed) == ids(placed) and placed.columns == [*mixed.columns, "shard", "slot"]
    sizes = Counter(r.shard for r in placed.collect())
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1
