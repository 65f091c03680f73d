"""Benchmark decontamination as a prefix-filtered set join over word shingles, in native operations.

Every benchmark item gives windows of `window` consecutive words (a shorter item is one window). A
window is a set of 5-word shingles, and a text contains it only if it contains all of them, so one
shingle is a sufficient join prefix. Shingles are ordered by how often the corpus holds them; the
rarest of each window is joined, the place of the hit in the text gives the place of the window, the
text's length bounds it, and the window counts if all its shingles stand at their places there.
Shingles are compared by a 64-bit hash of their words; overlapping shingles pin down every word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import ascii_lower, durable, null_safe, row_hash

WINDOW, SHINGLE = 13, 5
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_SHINGLES = 2_000_000  # 16 bytes each; larger vocabularies are joined by a shuffle
KEY = ["doc_id", "_row"]


def words(text: Column) -> Column:
    """Runs of digits, lower-case letters and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def shingles(hashes: Column, n: int) -> Column:
    """Hash of the n words from each place on."""
    def at(i):
        return F.xxhash64(*[F.get(hashes, i + k) for k in range(n)], F.lit(n))

    return F.when(F.size(hashes) >= n, F.transform(F.sequence(F.lit(0), F.size(hashes) - n), at)).otherwise(
        F.array().cast("array<bigint>"))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, wid, length, size, offset, token): the shingles of every distinct window of every item."""
    found = items.select("item_id", word_hashes(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    cut = found.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("w"))
    by_size = F.when(F.size("w") >= shingle, shingles(F.col("w"), shingle))
    for n in range(1, shingle):
        by_size = by_size.when(F.size("w") == n, shingles(F.col("w"), n))
    return cut.select("item_id", F.xxhash64("w").alias("wid"), F.size("w").alias("length"),
                      F.least(F.size("w"), F.lit(shingle)).alias("size"),
                      F.posexplode(by_size).alias("offset", "token")).distinct()


def shingle_hits(docs: DataFrame, vocabulary: DataFrame, sizes: list[int], broadcast_limit: int) -> DataFrame:
    """(doc_id, _row, n_words, pos, token) of each shingle that the benchmark has too, and for each
    row of `docs` one row without token. Texts are read once."""
    hashed = docs.select("doc_id", row_hash(F.col("text")).alias("_row"), word_hashes(F.col("text")).alias("w"))
    every = F.concat(*[shingles(F.col("w"), n) for n in sizes], F.array(F.lit(None).cast("bigint")))
    rows = hashed.select(*KEY, F.size("w").alias("n_words"), F.posexplode(every).alias("i", "token"))
    pos, begin = F.lit(None).cast("int"), F.lit(0)
    for n in sizes:
        end = begin + F.greatest(F.col("n_words") - n + 1, F.lit(0))
        pos = F.coalesce(pos, F.when(F.col("i") < end, F.col("i") - begin))
        begin = end
    known = vocabulary.select(F.col("token").alias("_known")).distinct()
    if vocabulary.count() <= broadcast_limit:
        known = F.broadcast(known)
    rows = rows.join(known, F.col("token") == F.col("_known"), "left").where(
        F.col("_known").isNotNull() | F.col("token").isNull())
    return rows.select(*KEY, "n_words", pos.alias("pos"), "token")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  broadcast_limit: int = BROADCAST_SHINGLES) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, _row (hash of the text), n_words, n_hit, items (sorted ids as text).

    Texts that are null or without words have no hits, items without words no windows; an item
    without id hits words but is in no list. Repeated rows give repeated results. Columns other
    than ids and texts are not looked at."""
    sets = durable(windows(items, window, shingle), "windows")
    sizes = sorted({r[0] for r in sets.select("size").distinct().collect()}) or [shingle]  # 1..shingle
    hits = durable(shingle_hits(docs, sets.select("token").distinct(), sizes, broadcast_limit), "shingle-hits")
    found = hits.where(F.col("token").isNotNull())

    parts = sets.select("wid", "length", "offset", "token").distinct()
    counts = found.groupBy("token").agg(F.count("*").alias("_n"))
    # A window with a shingle that no text has cannot occur; of the others the rarest shingle is joined.
    ordered = parts.join(counts, "token", "left").groupBy("wid", "length").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "token", "offset")).alias("p"),
        F.count("*").alias("need"))
    prefix = ordered.where(F.col("p.n") > 0).select("wid", "length", "need", F.col("p.token").alias("token"),
                                                     F.col("p.offset").alias("shift"))
    begin = F.col("pos") - F.col("shift")
    candidates = found.join(prefix, "token").where((begin >= 0) & (begin + F.col("length") <= F.col("n_words"))).select(
        *KEY, begin.alias("begin"), "wid", "length", "need").distinct()
    wanted = candidates.join(parts.select("wid", "offset", "token"), "wid").withColumn("pos", F.col("begin") + F.col("offset"))
    present = null_safe(wanted, found.select(*KEY, "pos", "token").distinct(), [*KEY, "pos", "token"], "inner")
    whole = durable(present.groupBy(*KEY, "begin", "wid", "length", "need").agg(F.count("*").alias("_n")).where(
        F.col("_n") == F.col("need")).select(*KEY, "begin", "wid", (F.col("begin") + F.col("length")).alias("end")), "spans")

    before = F.max("end").over(W.partitionBy(*KEY).orderBy("begin", "end").rowsBetween(W.unboundedPreceding, -1))
    covered = whole.select(*KEY, "begin", "end").distinct().withColumn("_before", F.coalesce(before, F.lit(0))).groupBy(*KEY).agg(
        F.sum(F.greatest(F.col("end") - F.greatest("begin", "_before"), F.lit(0))).alias("n_hit"))
    of = sets.select("wid", F.col("item_id").cast("string").alias("item")).distinct()
    listed = whole.select(*KEY, "wid").distinct().join(of, "wid").groupBy(*KEY).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    result = hits.where(F.col("token").isNull()).select(*KEY, F.col("n_words").cast("long").alias("n_words"))
    result = null_safe(result, covered, KEY, "left")
    result = null_safe(result, listed, KEY, "left")
    return result.select(*KEY, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated() -> Column:
    """The rule: at least a twentieth of the words, and at least one, is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` that the rule leaves."""
    bad = contamination(docs.select("doc_id", "text"), items).where(contaminated()).select(
        F.col("doc_id").alias("_bad_id"), F.col("_row").alias("_bad_row"))
    kept = docs.select(F.struct("*").alias("_doc")).join(
        bad, F.col("_doc.doc_id").eqNullSafe(F.col("_bad_id")) & (row_hash(F.col("_doc.text")) == F.col("_bad_row")), "left_anti")
    return kept.select("_doc.*")
