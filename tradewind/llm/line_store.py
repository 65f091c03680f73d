"""Line dedup that can be added to and undone: sharded cuckoo filters over an exact reference log.

A store is a folder of numbered steps; each is one inserted or deleted batch of documents:
* `refs`: (k0, k1, doc_id, sign), one row per document and distinct long line, +1 or -1. Summed, it is the
  exact reference count of every line.
* `probed`: lines that may have been there before the step, by the filters, or are in several documents
  of the batch. A line held by two documents is in some step's `probed`, so only these are counted.
* `filters`: after the step, one row per shard and layer, the slots of a cuckoo filter of all live lines.

A batch is probed shard by shard against the filters, so a new line costs no look into the exact
log; a line that seems known is looked up there, and one taken for known by mistake is added as well.
So the filters hold one fingerprint for each live line and can forget a line when its last document
goes. A shard that fills up gets one more layer of the same size, in which fingerprints have the same places.
A step counts from the moment its last part is complete; a job that died is simply run again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_CHARS, MIN_DOCS = 10, 2
LAYER_BUCKETS = 1 << 14
SPACES = b" \t\n\x0b\x0c\r"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of the stripped line with a-z for A-Z; None for lines too short to count."""
    key = line.strip(SPACES)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key.translate(_FOLD), digest_size=16).digest()


class Cuckoo:
    """A cuckoo filter with four 16-bit fingerprints in a bucket; whole arrays of keys at a time."""

    def __init__(self, slots: np.ndarray | None = None, buckets: int = LAYER_BUCKETS):
        self.slots = np.zeros((buckets, 4), np.uint16) if slots is None else slots

    def places(self, k0: np.ndarray, k1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fp = (k1.view(_U) & _U(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        return fp, ((k1.view(_U) >> _U(16)) % _U(len(self.slots))).astype(np.int64)

    def _other(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return bucket ^ (((fp.astype(_U) * _U(0x5BD1E995)) >> _U(3)) % _U(len(self.slots))).astype(np.int64)

    def has(self, k0: np.ndarray, k1: np.ndarray) -> np.ndarray:
        fp, b = self.places(k0, k1)
        return ((self.slots[b] == fp[:, None]) | (self.slots[self._other(b, fp)] == fp[:, None])).any(1)

    def room(self) -> int:
        """Keys that still fit for sure, at a load of 85 percent."""
        return int(0.85 * self.slots.size) - int(np.count_nonzero(self.slots))

    def add(self, fp: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts fingerprints into buckets; returns those that found no place in 300 rounds of moving."""
        for turn in range(300):
            if not len(fp):
                break
            bucket, pick = np.unique(b, return_index=True)  # one key a bucket each round
            row = self.slots[bucket]
            free = row == 0
            full = ~free.any(1)
            slot = np.where(full, (turn + bucket) % 4, free.argmax(1))
            out = row[np.arange(len(bucket)), slot]
            self.slots[bucket, slot] = fp[pick]
            rest = np.ones(len(fp), bool)
            rest[pick] = False
            # Keys that found a full bucket push one out, which goes to its other bucket.
            b = np.concatenate((b[rest], self._other(bucket, out)[full]))
            fp = np.concatenate((fp[rest], out[full]))
        return fp, b

    def remove(self, k0: np.ndarray, k1: np.ndarray) -> np.ndarray:
        """Takes out keys that are in; True where one was found."""
        fp, b = self.places(k0, k1)
        found = np.zeros(len(fp), bool)
        for i in range(len(fp)):
            for bucket in (b[i], self._other(b[i:i + 1], fp[i:i + 1])[0]):
                at = np.flatnonzero(self.slots[bucket] == fp[i])
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    found[i] = True
                    break
        return found


def _layers(rows: pd.DataFrame) -> list[Cuckoo]:
    return [Cuckoo(np.frombuffer(s, np.uint16).reshape(-1, 4).copy()) for s in rows.sort_values("layer")["slots"]]


def _update(keys: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """One shard of a step: filter rows after it, and the added keys that may have been there before.

    A key's sign is 1 (add unless it seems known), 2 (add) or -1 (remove)."""
    shard = int(keys["shard"].iloc[0] if len(keys) else rows["shard"].iloc[0])
    layers = _layers(rows)
    k0, k1 = keys["k0"].to_numpy(np.int64), keys["k1"].to_numpy(np.int64)
    sign = keys["sign"].to_numpy()
    seen = np.zeros(len(k0), bool)
    for layer in layers:
        seen |= layer.has(k0, k1)
    new = (sign == 2) | (sign == 1) & ~seen
    if new.any() and not layers:
        layers.append(Cuckoo(buckets=max(LAYER_BUCKETS, 1 << int(new.sum() / 3.2).bit_length())))
    if new.any():
        fp, bucket = layers[0].places(k0[new], k1[new])
        while len(fp):
            n = max(layers[-1].room(), 0)
            more_fp, more_bucket = layers[-1].add(fp[:n], bucket[:n])
            fp, bucket = np.concatenate((more_fp, fp[n:])), np.concatenate((more_bucket, bucket[n:]))
            if len(fp):
                layers.append(Cuckoo(buckets=len(layers[0].slots)))
    left = np.flatnonzero(sign < 0)
    for layer in layers:
        left = left[~layer.remove(k0[left], k1[left])]
    hit = seen & (sign == 1)
    filters = pd.DataFrame({"shard": shard, "layer": range(len(layers)), "slots": [c.slots.tobytes() for c in layers],
                            "k0": None, "k1": None})
    hits = pd.DataFrame({"shard": shard, "layer": -1, "slots": None, "k0": k0[hit], "k1": k1[hit]})
    return pd.concat([filters.astype({"k0": "Int64", "k1": "Int64"}), hits.astype({"k0": "Int64", "k1": "Int64"})])


class LineStore:
    """`path` is a folder that all machines share. `shards` is fixed for the life of a store: choose it so that
    a shard has a few hundred thousand lines; a shard is one task's memory."""

    def __init__(self, spark: SparkSession, path: str, shards: int, min_chars: int = MIN_CHARS):
        self.spark, self.path, self.shards, self.min_chars = spark, path.rstrip("/"), shards, min_chars
        self.steps = 0
        while self._done(self.steps):
            self.steps += 1

    def _done(self, step: int) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/step-{step}/probed/_SUCCESS")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _read(self, part: str) -> list[str]:
        return [f"{self.path}/step-{i}/{part}" for i in range(self.steps)]

    def _refs(self) -> DataFrame | None:
        return self.spark.read.parquet(*self._read("refs")) if self.steps else None

    def references(self, docs: DataFrame) -> DataFrame:
        """(k0, k1, doc_id): the distinct long lines of each row that has an id."""
        least = self.min_chars

        def run(batches):
            for batch in batches:
                docs_, keys = [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                    own = {line_key(x, least) for x in (text.as_py() or b"").split(b"\n")} - {None}
                    keys.extend(own)
                    docs_.extend([doc] * len(own))
                pair = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(docs_, pa.int64())], names=["k0", "k1", "doc_id"])

        return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
            run, "k0 bigint, k1 bigint, doc_id bigint")

    FILTERS = "shard int, layer int, slots binary"

    def _filtered(self, keys: DataFrame, filters: DataFrame, path: str) -> DataFrame:
        keys = keys.withColumn("shard", F.pmod("k0", F.lit(self.shards)).cast("int"))
        made = keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(
            lambda k, r: _update(k, r), self.FILTERS + ", k0 bigint, k1 bigint")
        made.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(made.schema).parquet(path)

    def _step(self, docs: DataFrame, sign: int) -> None:
        at = f"{self.path}/step-{self.steps}"
        self.references(docs).withColumn("sign", F.lit(sign)).write.mode("overwrite").parquet(f"{at}/refs")
        mine = self.spark.read.parquet(f"{at}/refs")
        if sign > 0:
            keys = mine.groupBy("k0", "k1").agg(F.count("*").alias("n"))
            changed = keys.select("k0", "k1", F.lit(1).alias("sign"))
        else:  # only lines whose last document goes leave the filters
            before = self._refs().join(mine.select("k0", "k1").distinct(), ["k0", "k1"], "left_semi")
            keys = before.unionByName(mine).groupBy("k0", "k1").agg(F.sum("sign").alias("n"))
            changed = keys.where(F.col("n") <= 0).select("k0", "k1", F.lit(-1).alias("sign"))
        old = (self.spark.read.parquet(f"{self.path}/step-{self.steps - 1}/filters") if self.steps else
               self.spark.createDataFrame([], self.FILTERS))
        made = self._filtered(changed, old, f"{at}/probing")
        probed = made.where("layer < 0").select("k0", "k1")
        filters = made.where("layer >= 0").select("shard", "layer", "slots")
        if sign > 0 and self.steps:
            known = self._refs().join(probed, ["k0", "k1"], "left_semi").groupBy("k0", "k1").agg(F.sum("sign").alias("n")).where("n > 0")
            mistaken = probed.join(known, ["k0", "k1"], "left_anti").select("k0", "k1", F.lit(2).alias("sign"))
            filters = self._filtered(mistaken, filters, f"{at}/adding").where("layer >= 0").select("shard", "layer", "slots")
        filters.write.mode("overwrite").parquet(f"{at}/filters")
        if sign > 0:
            probed = probed.union(keys.where(F.col("n") > 1).select("k0", "k1"))
        probed.write.mode("overwrite").parquet(f"{at}/probed")
        self.steps += 1

    def insert(self, docs: DataFrame) -> None:
        """Add documents (doc_id, text). Rows without id are not stored. A repeated row counts again, so
        it has to be deleted as often; in results a document counts once."""
        self._step(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take out documents inserted before, with the texts they had."""
        if self.steps:
            self._step(docs, -1)

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(k0, k1, doc_id, keeper) for live documents of lines in at least two of them."""
        asked = self.spark.read.parquet(*self._read("probed")).distinct()
        live = self._refs().join(asked, ["k0", "k1"], "left_semi").groupBy("k0", "k1", "doc_id").agg(
            F.sum("sign").alias("n")).where("n > 0").select("k0", "k1", "doc_id")
        many = live.groupBy("k0", "k1").agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper")).where(
            F.col("n") >= min_docs).select("k0", "k1", "keeper")
        return live.join(many, ["k0", "k1"])

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped and the text without lines that an earlier document of the store keeps.

        Null and empty texts are one empty line; rows without id lose nothing. Other columns are not looked at."""
        least = self.min_chars
        drops = (self.repeated().where(F.col("doc_id") > F.col("keeper")) if self.steps else
                 self.spark.createDataFrame([], "k0 bigint, k1 bigint, doc_id bigint"))
        # As many pairs as the document has lines at most.
        drops = drops.groupBy("doc_id").agg(F.collect_list("k0").alias("d0"), F.collect_list("k1").alias("d1"))

        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                total, dropped, kept = [], [], []
                for text, d0, d1 in zip(batch.column(1).cast(pa.binary()), batch.column(2), batch.column(3)):
                    text = text.as_py() or b""
                    total.append(text.count(b"\n") + 1)
                    if not d0.is_valid:
                        kept.append(text)
                        dropped.append(0)
                        continue
                    pairs = np.stack([d0.values.to_numpy(), d1.values.to_numpy()], axis=1).tobytes()
                    bad = {pairs[i:i + 16] for i in range(0, len(pairs), 16)}
                    lines = text.split(b"\n")
                    stay = [x for x in lines if line_key(x, least) not in bad]
                    kept.append(b"\n".join(stay))
                    dropped.append(len(lines) - len(stay))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

        joined = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(drops, "doc_id", "left")
        return joined.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")
