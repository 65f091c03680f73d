"""Packing: ids against the tokenizer, pieces against a plain cut, the round trip, and odd rows."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import packing
from tradewind.llm.common import read
from tradewind.llm.queries import QUERIES, tokenizer_file


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


ODD = ["", None, " \t\n\x0b\x0c\r ", "ΣΑΣ ΟΔΟΣ Σ", "don't we'll I'VE", "é ́x ́", "a\x01b \x01 \x01\x01", "<|endoftext|> x<|startoftext|>y",
       "nbsp here em\x1cfs\x85nel", "가가 한글", "İstanbul ǅ ß", "🙂👍🏽 12345 ٣٤", "word " * 30_000, "x" * 50_000, "﻿bom ​zero"]


def test_words_give_the_ids_of_whole_texts(tokenizer):
    encode = packing.tokenizer_encoder(tokenizer_file())
    for _ in range(2):  # the second time from the cache
        got = [list(map(int, x)) for x in encode(pa.array(ODD, pa.string()))]
        assert got == [ids_of(tokenizer, t)[:-1] for t in ODD]
    small = packing.WordEncoder(lambda ts: [tokenizer.encode(t, add_special_tokens=False).ids for t in ts], cached=3)
    for t in ODD:
        assert list(map(int, next(small.texts(pa.array([t], pa.string()))))) == ids_of(tokenizer, t)[:-1]


def check(pieces, docs, tokenizer, length):
    """The pieces of each document cover its ids once; sequences are full but for the last; no gaps."""
    tokens = sorted((len(i), tuple(i), d if d is not None else -1) for d, i in ((d, ids_of(tokenizer, t)) for d, t in docs))
    at, total = {}, sum(x[0] for x in tokens)
    for p in pieces:
        at[p.sequence_id * length + p.offset] = p
        assert 0 < p.length <= length - p.offset
    place, found, open_ = 0, [], []
    while place < total:
        p = at.pop(place)
        assert p.start == sum(x.length for x in open_)
        open_.append(p)
        place += p.length
        if p.start + p.length == p.doc_tokens:
            found.append(open_)
            open_ = []
    assert not at and not open_ and len(found) == len(docs)
    return found


def test_query_against_plain_cut(spark, root, tokenizer):
    docs = [(r.doc_id, r.text) for r in read(spark, root, "documents").select("doc_id", "text").collect()]
    text = dict(docs)
    rows = QUERIES["op12_concat_pack"](spark, root).collect()
    found = check(rows, docs, tokenizer, 4096)
    assert [f[0].doc_id for f in found] == sorted(text)
    for f in found:
        ids = ids_of(tokenizer, text[f[0].doc_id])
        assert f[0].doc_tokens == len(ids)
        for p in f:
            part = ids[p.start:p.start + p.length]
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_odd_rows_and_round_trip(spark, tokenizer):
    docs = list(enumerate(ODD)) + [(3, ODD[3]), (3, "another text"), (None, "no id"), (None, None)] + [(99, "a copy")] * 40
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS at", "'x' AS ids", "0 AS _part")
    pieces = packing.pieces(frame.repartition(5), tokenizer_file(), length=64)
    rows = pieces.collect()
    found = check(rows, docs, tokenizer, 64)
    got = sorted((f[0].doc_id if f[0].doc_id is not None else -1, b"".join(bytes(p.ids) for p in f)) for f in found)
    want = sorted((d if d is not None else -1, np.array(ids_of(tokenizer, t), "<u4").tobytes()) for d, t in docs)
    assert got == want
    made = sorted(packing.sequences(pieces, 64, pad=7).collect(), key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in made] == list(range(len(made))) and all(len(r.ids) == 256 for r in made)
    line = b"".join(bytes(r.ids)[:4 * r.n_tokens] for r in made)
    assert line == b"".join(b"".join(bytes(p.ids) for p in f) for f in found)
    assert all(r.n_tokens == 64 for r in made[:-1]) and set(struct.unpack("<64I", made[-1].ids)[made[-1].n_tokens:]) <= {7}
    assert packing.pieces(frame.limit(0), tokenizer_file()).count() == 0


def test_order_does_not_depend_on_files(spark, tokenizer):
    frame = spark.createDataFrame([(i, f"text {i} " * (i % 7)) for i in range(300)], "doc_id long, text string")
    one, other = (sorted(map(tuple, packing.pieces(f, tokenizer_file(), length=50, digest=True).collect())) for f in (
        frame.repartition(1), frame.repartition(9)))
    assert one == other


def test_whole_texts_for_other_vocabularies(tokenizer):
    whole = packing.tokenizer_encoder(tokenizer_file("byte_bpe_50k.json"), by_words=False)
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    assert [list(map(int, x)) for x in whole(pa.array(["a  b\n", None], pa.string()))] == [plain.encode("a  b\n").ids, []]
