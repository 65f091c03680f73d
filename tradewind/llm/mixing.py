"""Mixing sources to target weights with fixed-length blocks of words.

Each source is one stream of words, its documents in a pseudorandom order; the stream is cut into blocks of
`block` words. Output shards have a fixed number of slots. A shard draws how many slots each source gets:
the whole part of the expected number, and the rest by a multinomial draw seeded by the shard, so sums stay
close to the targets. The j-th slot of a source takes block perm(j): rounds of a keyed Feistel permutation
over the source's block numbers, another one each time round. Nothing is shuffled but block numbers, and
slots meet the parts of documents by (source, block).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm import wordhash
from tradewind.llm.common import durable, null_safe, prefix_sums, row_hash

BLOCK, SLOTS, SEED = 128, 1 << 16, 11
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
MAX_SOURCES = 100_000  # the list of sources is configuration; a longer one is refused, not cut
RUN, SLOTS_PER_TASK, MOST_TASKS = 4096, 1 << 16, 10_000  # how the filling of slots is dealt to tasks
KEY = ["doc_id", "_row"]
_U = np.uint64


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, _row, source, size (words) of each row."""
    def run(frames):
        for frame in frames:
            import pyarrow as pa

            n = [np.bincount(b.doc, minlength=b.n) for b in wordhash.blocks(pa.array(frame["text"], pa.string()))
                 if b.words() is None]
            frame["size"] = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield frame[["doc_id", "_row", "source", "size"]]

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_hash(F.col("text")).alias("_row"),
                       F.col("source").cast("string").alias("source"), "text").mapInPandas(
        run, "doc_id bigint, _row bigint, source string, size bigint")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_no, source_size, target: shares by weight, none above `most` times its source.

    With sources in the order of most * size / weight, those before some place are at their limit and the
    others get their weight's part of what is left. There is one row per source, so windows over all are small."""
    listed = W.orderBy(F.col("source").asc_nulls_last())
    by_limit = W.orderBy("ratio", "source_no")
    before, rest = by_limit.rowsBetween(W.unboundedPreceding, -1), by_limit.rowsBetween(W.currentRow, W.unboundedFollowing)
    t = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("source_no", F.row_number().over(listed) - 1)
    t = t.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights)))
    t = t.withColumn("limit", most * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    total = F.sum("source_size").over(W.partitionBy()) * share
    t = t.withColumn("rate", (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    fair = F.max(F.when(F.col("ratio") >= F.col("rate"), F.col("rate"))).over(W.partitionBy())
    return t.select("source", "source_no", "source_size",
                    F.least(F.col("limit"), F.coalesce(fair * F.col("weight"), F.col("limit"))).alias("target"))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each (index, size, key) the place of the index under the key's permutation of 0..size-1."""
    half = (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2
    half = half.astype(_U)
    low = (_U(1) << half) - _U(1)
    out, open_ = i.astype(_U), np.arange(len(i))
    while len(open_):  # walks on while the place lies outside; the domain is less than 8 times too large
        left, right = out[open_] >> half[open_], out[open_] & low[open_]
        for turn in range(4):
            f = wordhash.mixed(right ^ wordhash.mixed(key[open_].astype(_U) * _U(8) + _U(turn)))
            left, right = right, (left ^ f) & low[open_]
        out[open_] = left << half[open_] | right
        open_ = open_[out[open_] >= n[open_].astype(_U)]
    return out.astype(np.int64)


def slots(sources: DataFrame, block: int = BLOCK, slots_per_shard: int = SLOTS, seed: int = SEED) -> DataFrame:
    """shard, slot, source_no, round, block: which block of which source each slot of the mix takes."""
    spark = sources.sparkSession
    rows = sources.orderBy("source_no").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    size = np.array([r["source_size"] for r in rows], float)
    count = np.ceil(size / block).astype(np.int64)
    wanted = np.array([r["target"] for r in rows], float) * np.divide(count, size, out=np.zeros_like(size), where=size > 0)
    total = int(round(wanted.sum()))
    part = wanted / wanted.sum() if total else wanted
    numbers = np.array([r["source_no"] for r in rows], np.int64)

    def draw(frames):
        for frame in frames:
            for shard in frame["id"]:
                mean = part * min(slots_per_shard, total - shard * slots_per_shard)
                n = np.floor(mean + 1e-9).astype(np.int64)
                rest = np.maximum(mean - n, 0)
                if round(rest.sum()):
                    n += np.random.Generator(np.random.PCG64([seed, int(shard)])).multinomial(
                        int(round(rest.sum())), rest / rest.sum())
                yield pd.DataFrame({"shard": shard, "source_no": numbers, "n": n, "blocks": count})[n > 0]

    shards = spark.range(-(-total // slots_per_shard))
    drawn = shards.mapInPandas(draw, "shard bigint, source_no bigint, n bigint, blocks bigint")
    earlier = (W.unboundedPreceding, -1)
    begun = drawn.withColumn("begin", F.coalesce(F.sum("n").over(
        W.partitionBy("source_no").orderBy("shard").rowsBetween(*earlier)), F.lit(0))).withColumn(
        "slot", F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("source_no").rowsBetween(*earlier)), F.lit(0)))

    # A few hundred bytes of counts grow to all slots: they are cut into runs and dealt to as many tasks as the slots need.
    # Runs are numbers, so a task's memory is one run, however many it has.
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(RUN).cast("bigint"))).alias("_at")
    runs = begun.select("*", at).select("shard", "source_no", "blocks", *[(F.col(c) + F.col("_at")).alias(c) for c in ("begin", "slot")],
                                        F.least(F.col("n") - F.col("_at"), F.lit(RUN)).alias("n"))
    dealt = runs.repartition(min(MOST_TASKS, 1 + total // SLOTS_PER_TASK), "shard", "source_no", "begin")

    def fill(frames):
        for frame in frames:
            for r in frame.itertuples():
                j = np.arange(r.begin, r.begin + r.n)
                turn = j // r.blocks
                key = ((seed * 1_000_003 + r.source_no) * 64 + turn).astype(np.int64)
                yield pd.DataFrame({"shard": r.shard, "slot": r.slot + np.arange(r.n), "source_no": r.source_no,
                                    "round": turn, "block": permuted(j % r.blocks, np.full(r.n, r.blocks), key)})

    return dealt.mapInPandas(fill, "shard bigint, slot bigint, source_no bigint, round bigint, block bigint").where(
        F.col("round") < MOST)


def mix(docs: DataFrame, block: int = BLOCK, slots_per_shard: int = SLOTS, seed: int = SEED, weights=WEIGHTS,
        share: float = SHARE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, taken) for documents (doc_id, text, source).

    rows: doc_id, _row, source, size, _id of every row; sources: as `targets`; taken: shard, slot, round,
    doc_id, _row, _id and the words begin..end of the document that the slot takes.

    Null texts and texts without words have size 0 and are never taken. Null is a source of its own, the
    last. Repeated rows are rows of their own. An empty table gives empty results. A block is taken
    twice at most, so no document gives more than twice its words."""
    sized = sizes(docs).withColumn("_order", F.xxhash64("doc_id", "_row", F.lit(seed)))
    rows = prefix_sums(sized, ["source"], ["_order", "doc_id", "_row"], "size", "word-streams")
    sources = durable(targets(rows, weights, share), "sources")
    chosen = slots(sources, block, slots_per_shard, seed)
    numbered = null_safe(rows, sources.select("source", "source_no"), ["source"], "inner").where(F.col("size") > 0)
    first, last = F.floor(F.col("_before") / block), F.floor((F.col("_before") + F.col("size") - 1) / block)
    parts = numbered.select(*KEY, "_id", "_before", "size", F.col("source_no").cast("bigint").alias("source_no"),
                            F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * block - F.col("_before"), F.lit(0))
    end = F.least((F.col("block") + 1) * block - F.col("_before"), F.col("size"))
    parts = parts.select(*KEY, "_id", "source_no", "block", begin.alias("begin"), end.alias("end"))
    # Slots are as many as the corpus has blocks, which the planner can't see: it would broadcast them.
    return rows, sources, parts.join(chosen.hint("merge"), ["source_no", "block"])


def totals(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of `docs`."""
    rows, sources, taken = mix(docs, **how)
    words = taken.groupBy("_id").agg(F.sum(F.col("end") - F.col("begin")).alias("taken"))
    known = null_safe(rows, sources.select("source", "source_size", "target"), ["source"], "inner")
    return known.join(words, "_id", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """What the mix takes, with the columns of `docs`: a row for each run of words taken from a document in one
    round, `text` the piece of its text. A document taken whole twice gives two whole rows. Rows of one id and
    text are taken as one document."""
    _, _, taken = mix(docs, **how)
    # At most two rounds over the document's own blocks.
    pieces = taken.groupBy(*KEY).agg(F.collect_list(F.struct("round", "begin", "end", "_id")).alias("_pieces"))
    whole = docs.select("doc_id", row_hash(F.col("text")).alias("_row"), F.struct("*").alias("_doc")).dropDuplicates(KEY)

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, pieces: pd.Series) -> pd.Series:
        import re

        out = []
        for text, own in zip(texts, pieces):
            at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            runs = []
            for p in sorted(own, key=lambda p: (p["round"], p["_id"], p["begin"])):
                if runs and runs[-1][:2] == [p["round"], p["_id"]] and runs[-1][3] == p["begin"]:
                    runs[-1][3] = p["end"]
                else:
                    runs.append([p["round"], p["_id"], p["begin"], p["end"]])
            out.append([text if e - b == len(at) else text[at[b][0]:at[e - 1][1]] for _, _, b, e in runs])
        return pd.Series(out)

    joined = null_safe(whole, pieces, KEY, "inner").select("_doc", F.explode(cut("_doc.text", "_pieces")).alias("_piece"))
    return joined.select(*[F.col("_piece").alias("text") if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns])
