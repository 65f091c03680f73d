"""Packing: documents are concatenated and cut into sequences of equal length.

Pass one: documents are sorted over all partitions and become token ids, each partition counts its tokens, and rows
carry the sum of what stands before them in the partition. Pass two: prefix sums over the partitions' totals give every
partition its place on the one long line of tokens, so each document knows its global offset, and fixed windows of
`length` tokens are cut there. A boundary record tells which run of a document lies in which window. No padding but
in the last sequence.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm import wordhash
from tradewind.llm.common import durable, row_hash

LENGTH, END = 4096, 2
CACHED_WORDS, FRESH = 1_000_000, 30_000  # some 40 MB of a worker; then its cache of words starts anew
JOINED = 256  # new words that are encoded at once
MARK = "\x01"  # stands between them


class WordEncoder:
    """Token ids of texts for vocabularies that drop white space: a text's ids are those of its words in their order.

    A word is known by a 64-bit hash of its bytes and encoded once while the cache holds it: a wrong id needs two
    words of one hash."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], cached: int = CACHED_WORDS):
        self.encode, self.cached = encode, cached
        probe = encode([MARK])[0]
        self.mark = probe[0] if len(probe) == 1 else None
        self._reset()

    def _reset(self) -> None:
        # What is new goes to the small table, which joins the large one when it has grown; both are sorted by key.
        self.large = self.small = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))  # key, begin, size
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encoded(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Many words are one call, told apart by a mark that no word contains."""
        out: list[list[int] | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if MARK not in w] if self.mark is not None else []
        runs = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        for run, ids in zip(runs, self.encode([f" {MARK} ".join(words[i] for i in run) for run in runs]) if runs else []):
            ids = np.asarray(ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(run) - 1:
                continue
            for i, a, b in zip(run, np.append(0, cuts + 1), np.append(cuts, len(ids))):
                out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.encode([words[i] for i in rest]) if rest else []):
            out[i] = np.asarray(ids, np.uint32)
        return out

    def _learn(self, block: wordhash.Block, keys: np.ndarray, first: np.ndarray) -> None:
        """`keys` (sorted) are new; `first` are words of the block that have them."""
        raw = block.data.tobytes()
        found = self._encoded([raw[a:b].decode() for a, b in zip(block.start[first], block.end[first])])
        size = np.array([len(x) for x in found], np.int32)
        begin = self.used + np.cumsum(size) - size
        total = self.used + int(size.sum())
        if total > len(self.ids):
            self.ids = np.concatenate((self.ids[:self.used], np.zeros(total, np.uint32)))
        self.ids[self.used:total] = np.concatenate(found)
        self.used = total
        self.small = _joined(self.small, (keys, begin, size))
        if len(self.small[0]) > FRESH:
            self.large, self.small = _joined(self.large, self.small), (keys[:0], begin[:0], size[:0])

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of the column; null is empty."""
        for block in wordhash.blocks(column):
            block.words()
            if len(self.large[0]) > self.cached:
                self._reset()
            keys, first, which = np.unique(block.hashes(fold=False), return_index=True, return_inverse=True)
            known = _found(self.large, keys) | _found(self.small, keys)
            if not known.all():
                self._learn(block, keys[~known], first[~known])
            begin, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            for table in (self.large, self.small):
                here = _found(table, keys)
                at = np.searchsorted(table[0], keys[here])
                begin[here], size[here] = table[1][at], table[2][at]
            begin, size = begin[which], size[which]
            ends = np.cumsum(size)
            flat = self.ids[np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))]
            cut = np.append(0, ends)[np.searchsorted(block.doc, np.arange(block.n + 1))]
            for i in range(block.n):
                yield flat[cut[i]:cut[i + 1]]


def _joined(a: tuple, b: tuple) -> tuple:
    at = np.searchsorted(a[0], b[0])
    return tuple(np.insert(x, at, y) for x, y in zip(a, b))


def _found(table: tuple, keys: np.ndarray) -> np.ndarray:
    if not len(table[0]):
        return np.zeros(len(keys), bool)
    return table[0][np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)] == keys


@functools.cache
def tokenizer_encoder(path: str, by_words: bool = True) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """Encodes columns of texts by a tokenizer file; `by_words` for a vocabulary that drops white space. A worker
    process keeps it, with its words, from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if by_words:
        return WordEncoder(encode).texts
    return lambda column: (np.asarray(encode([t or ""])[0], np.uint32) for t in column.to_pylist())


def tokenized(docs: DataFrame, tokenizer_path: str, end: int = END, by_words: bool = True) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, `end` last), n, _part, _before: documents in the order of the line.

    The order is that of doc_id (null first), then text, whatever files the documents come from."""
    schema = "doc_id bigint, ids binary, n bigint, _part int, _before bigint"

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        encode = tokenizer_encoder(tokenizer_path, by_words)
        for batch in batches:
            ids = [np.append(x, np.uint32(end)).astype("<u4") for x in encode(batch.column(1))]
            n = np.array([len(x) for x in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(n),
                 pa.array(np.full(len(n), part, np.int32)), pa.array(before + np.cumsum(n) - n)],
                names=["doc_id", "ids", "n", "_part", "_before"])
            before += int(n.sum())

    # Rows that are alike throughout are told apart by their place, so no id or text is more than its share of a partition.
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_hash(F.col("text")).alias("_row"),
                        F.monotonically_increasing_id().alias("_at"))
    sort = ["doc_id", "_row", "_at"]
    laid = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort).select("doc_id", "text")
    return durable(laid.mapInArrow(run, schema), "tokens")


def offsets(laid: DataFrame) -> DataFrame:
    """`laid` with `at`, the place of each document on the line of all tokens."""
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    # Written first, so that its true size decides how it is joined.
    bases = durable(laid.groupBy("_part").agg(F.sum("n").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")), "token-bases")
    return laid.join(bases, "_part").withColumn("at", F.col("_base") + F.col("_before")).drop("_base", "_before", "_part")


PIECE = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end: int = END, by_words: bool = True,
           digest: bool = False) -> DataFrame:
    """Boundary records: doc_id, start, length, doc_tokens, sequence_id, offset, and the piece's ids (or with `digest`
    only their checksum `ids_crc32`), for every row of `docs` (doc_id, text).

    A null or empty text is the end token alone. Repeated rows are documents of their own. Rows without an id come
    first and keep a null id. Other columns are not looked at. An empty table gives no pieces. A document of any length is cut
    wherever a sequence ends."""
    if length < 1:
        raise ValueError("a sequence has at least one token")
    schema = PIECE.replace("ids binary", "ids_crc32 bigint") if digest else PIECE

    def cut(batches):
        for batch in batches:
            at, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n"))
            first = at // length
            count = (at + n - 1) // length - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(sequence * length, at[doc])
            stop = np.minimum((sequence + 1) * length, (at + n)[doc])
            start, size = begin - at[doc], stop - begin
            held = [memoryview(b.as_buffer()) for b in batch.column("ids")]
            runs = [held[d][4 * s:4 * (s + k)] for d, s, k in zip(doc.tolist(), start.tolist(), size.tolist())]
            last = pa.array([zlib.crc32(r) for r in runs], pa.int64()) if digest else pa.array([bytes(r) for r in runs], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(n[doc]), pa.array(sequence),
                 pa.array(begin - sequence * length), last], names=[f.split()[0] for f in schema.split(", ")])

    return offsets(tokenized(docs, tokenizer_path, end, by_words)).select("doc_id", "ids", "n", "at").mapInArrow(cut, schema)


def sequences(packed: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """sequence_id, ids (padded to `length`), n_tokens, doc_ids and begins (where each piece begins): the training rows.

    `packed` are pieces with their ids; a sequence holds at most `length` of them."""
    joined = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("_p"), F.sum("length").alias("n_tokens"))
    filler = F.lit(int(pad).to_bytes(4, "little"))
    fill = F.repeat(F.hex(filler), (F.lit(length) - F.col("n_tokens")).cast("int"))
    body = F.aggregate("_p", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return joined.select("sequence_id", F.concat(body, F.unhex(fill)).alias("ids"), "n_tokens",
                         F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"), F.transform("_p", lambda p: p["offset"]).alias("begins"))
