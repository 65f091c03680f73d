"""Nulls, empty and very long texts, ties and repeated rows, empty tables, clashing columns: each operator's defined results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tradewind import session
from tradewind.llm import (chat_windows, decontaminate, hash_ring, line_crf, line_store, minhash_dedup, mixing, page_diff,
                           quality_gam, secret_index)

LONG = " ".join(f"word{i % 5000} and{i}" for i in range(60_000))
CLASH = ["_row", "n_words", "kept", "component_id", "shard", "slot", "size", "token", "key", "pos", "score", "labels", "begin",
         "id", "drop", "text_crc32", "target", "taken", "kind", "k0", "_cell", "_before", "d0", "end", "component", "items"]
DOCS = [(None, None, None), (1, "", "a"), (2, " \n\t", "a"), (3, LONG, "b"), (4, "same words here now", None), (4, "same words here now", None),
        (5, "same words here now", "a"), (None, "text without any id", "b"), (6, "é☃ 𝄞 password: abcdef123", "c"), (7, None, "c")]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    return frame.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.char_length("text").cast("long").alias("n_chars"),
                        *[F.lit("x").alias(c) for c in CLASH]).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "words here"), (2, None), (None, "𝄞")], "item_id long, text string").withColumn("wid", F.lit(1))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (3, 1), (4, 1), (4, 1), (None, 1), (5, None), (6, 1)], "doc_id long, quality int").withColumn("toxic", F.lit(0))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_minhash(docs):
    got = rows(minhash_dedup.groups(docs))
    assert len(got) == len(DOCS)
    by = {(r[0], r[1]): r[2:] for r in got}
    assert by[1, 0] == (1, True) and by[2, 0] == (2, True) and by[None, 0] == (None, True) and by[7, 0] == (7, True)
    assert by[4, 2] == (4, True) and by[5, 2] == (4, False) and by[None, 2] == (None, True)
    assert rows(minhash_dedup.groups(docs.limit(0))) == []
    kept = minhash_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(DOCS) - 1


def test_minhash_copies_without_id(spark):
    texts = [(1, "some words of a document"), (None, "some words of a document"), (None, "Some words  of a document"), (None, "no id has this text"),
             (None, "no id has this text"), (None, "NO id has this text"), (None, "another one alone"), (None, ""), (None, ""), (None, None), (2, None)]
    frame = spark.createDataFrame([(i, t, str(n)) for n, (i, t) in enumerate(texts)], "doc_id long, text string, _row string")
    for kept in (minhash_dedup.deduplicated(frame), corpus_pipeline.near_duplicates(spark, frame, "")):
        got = [(r.doc_id, (r.text or "").lower()) for r in kept.collect()]
        assert kept.columns == frame.columns and sorted(got, key=str) == sorted(
            [(1, texts[0][1]), (2, ""), (None, "no id has this text"), (None, "another one alone")] + [(None, "")] * 3, key=str)


def test_line_crf(docs, labels):
    model = line_crf.fit(docs, labels)
    got = rows(line_crf.judged(docs, model).select("doc_id", "n_words", "base_failed", "kept"))
    assert len(got) == len(DOCS) and (None, 0, True, False) in got and (3, 120_000, False, True) in got
    assert got.count((4, 4, True, False)) == 2
    assert rows(line_crf.judged(docs.limit(0), line_crf.fit(docs.limit(0), labels.limit(0)))) == []


def test_pages(spark):
    pages = [(None, None, None), (1, "", ""), (2, "http://h/1", "<p>" + "long " * 100_000), (2, "http://h/1", "<p>" + "long " * 100_000),
             (3, "http://h/2", "<p>x</p>"), (None, "http://h/3", "<p>y</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for c in ("host", "path", "rank", "_row", "drop", "text", "hashes", "before"):
        frame = frame.withColumn(c, F.lit("x"))
    got = [(a, len(c)) for a, _, c in rows(page_diff.extract(frame))]
    assert sorted(got, key=str) == sorted([(None, 0), (1, 0), (2, 499_999), (2, 499_999), (3, 1), (None, 1)], key=str)
    assert rows(page_diff.extract(frame.limit(0))) == []


def test_chats(spark):
    turns = [(None, None, None, None), (1, 0, "system", None), (1, 0, "system", None), (1, None, "user", "<|im_end|>"), (2, 5, "assistant", "a b " * 30_000),
             (3, 0, "odd\nrole", "x"), (3, 1, "assistant", "")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for c in ("begin", "end", "tokens", "stretch", "kind", "_row"):
        frame = frame.withColumn(c, F.lit("x"))
    got = {r.conv_id: r for r in chat_windows.digests(chat_windows.windows(frame)).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in got.items()} == {None: (1, 0), 1: (3, 0), 2: (1, 120_000), 3: (2, 0)}
    assert rows(chat_windows.digests(chat_windows.windows(frame.limit(0)))) == []


def test_secrets(docs):
    got = rows(secret_index.findings(docs))
    assert len(got) == len(DOCS)
    found = [r for r in got if r[-1]]
    assert found == [(6, 1, 0, 0, "assign:5:24", "assign:5:24")]
    assert rows(secret_index.findings(docs.limit(0))) == []


def test_quality(docs, labels):
    model = quality_gam.fit(docs, labels)
    got = rows(quality_gam.scored(docs, model))
    assert len(got) == len(DOCS) and all(0 <= r[2] <= 1 for r in got)
    assert quality_gam.accepted(docs, model).columns == docs.columns
    empty = quality_gam.fit(docs.limit(0), labels.limit(0))
    assert rows(quality_gam.scored(docs.limit(0), empty)) == [] and {r[2] for r in rows(quality_gam.scored(docs, empty))} == {0.5}
    held = {r[0]: r[1] for r in docs.select("doc_id", quality_gam.held_out(F.col("doc_id"))).collect()}
    assert held[None] is False


def test_contamination(docs, items):
    got = [(r[0], r[2], r[3], r[4]) for r in rows(decontaminate.contamination(docs, items))]
    assert len(got) == len(DOCS)
    assert got.count((4, 4, 2, ["1"])) == 2 and (6, 4, 1, []) in got and (None, 0, 0, []) in got and (3, 120_000, 0, []) in got
    assert rows(decontaminate.contamination(docs.limit(0), items)) == []
    assert len(rows(decontaminate.contamination(docs, items.limit(0)))) == len(DOCS)
    clean = decontaminate.clean(docs, items)
    assert clean.count() == len(DOCS) - 4 and [c for c in clean.columns] == [c for c in docs.columns]


def test_lines(spark, docs):
    store = line_store.LineStore(spark, session.scratch_dir(spark, "test-lines"), 2)
    store.insert(docs)
    got = [(a, b, c) for a, b, c, _ in rows(store.apply(docs))]
    assert len(got) == len(DOCS) and (5, 1, 1) in got and got.count((4, 1, 0)) == 2 and got.count((None, 1, 0)) == 2 and (2, 2, 0) in got


def test_mix(docs):
    got = rows(mixing.totals(docs))
    assert len(got) == len(DOCS) and all(r[4] <= 2 * r[1] for r in got)
    by = {r[0]: r for r in got}
    assert by[7][1:] == (0, 4, 8.0, by[7][4]) or by[7][1] == 0
    assert by[3][1] == 120_000 and abs(by[3][4] - by[3][3]) < 0.05 * by[3][3] + 300
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()
    assert sum(r.n for r in words) == sum(r[4] for r in got)
    assert rows(mixing.totals(docs.limit(0))) == [] and mixing.mixed_documents(docs.limit(0)).count() == 0


def test_ring(docs):
    placed = hash_ring.assign(docs, shards=3)
    got = placed.select("shard", "slot").collect()
    assert sorted(tuple(r) for r in got) == [(s, i) for s in range(3) for i in range(sum(r.shard == s for r in got))]
    sizes = [sum(r.shard == s for r in got) for s in range(3)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(DOCS)
    assert hash_ring.assign(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        hash_ring.assign(docs, shards=0)


def test_pipeline_stages(spark, root, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        assert out.count() <= len(DOCS) or name == "source mix"
        assert stage(spark, docs.limit(0), root).count() == 0
