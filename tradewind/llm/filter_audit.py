"""Interaction of filters: what each of five filters removes in every one of their 120 orders.

A document is known by its mask, the set of filters that it fails. All orders with the same first letters stand
together in lexicographic order, so they are an interval of Lehmer ranks. A mask is removed at step s by
exactly the orders whose first s letters end in their first failed filter: a few intervals. Documents
are counted by (part, mask); each count is added where an interval begins and taken away behind its end, and a prefix
sum over the 120 ranks gives the totals of every order. Nothing is replayed order by order, and nothing larger than
the 32 masks of a part meets the intervals.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import durable

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
SPACES = "[\\x20\\x09-\\x0D]+"
COUNTS = ["docs", "good", "toxic"]


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int, int]]:
    """(mask, step, late, begin, stop): the longest runs of ranks begin..stop-1 whose orders remove documents of the mask
    at that step, or (late 1) have there a filter that they fail behind another one that they fail."""
    n = len(filters)
    found: list[list[int]] = []
    for mask in range(1 << n):
        for late in (0, 1):
            for step in range(1, n + 1):
                run, open_ = factorial(n - step), None
                # Prefixes in lexicographic order hold equal runs of ranks, one after another.
                for place, prefix in enumerate(permutations(range(n), step)):
                    if not mask >> prefix[-1] & 1 or any(mask >> f & 1 for f in prefix[:-1]) != bool(late):
                        continue
                    if open_ and open_[-1] == place * run:
                        open_[-1] += run
                    else:
                        open_ = [mask, step, late, place * run, (place + 1) * run]
                        found.append(open_)
    return [tuple(x) for x in found]


def failures(text: Column) -> list[Column]:
    """Conditions A to D on a text that is not null."""
    words = F.array_remove(F.split(text, SPACES), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [n < 200, 100 * distinct < 50 * n, 100 * capitals > 2 * F.char_length(text), text.rlike("[#$%&*|]")]


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (bit i: fails filter i), n for the rows of `docs` (doc_id, text, source); repeated rows are counted.

    A text's smallest id is kept by E; it is looked up by (text, id), so copies of one text do not meet in one task. Rows
    without an id are larger than all others: they fail E if a row with an id has their text."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((c.cast("int") * (1 << i) for i, c in enumerate(failures(text))), F.lit(0))
    seen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       bits.alias("_bits"), F.sha2(text, 256).alias("_text"))
    seen = seen.groupBy("doc_id", "part", "_bits", "_text").agg(F.count("*").alias("n"))
    first = seen.where("doc_id IS NOT NULL").groupBy("_text").agg(F.min("doc_id").alias("_keeper"))
    e = F.lit(1 << FILTERS.index("E"))
    named = seen.where("doc_id IS NOT NULL").join(
        first.select("_text", F.col("_keeper").alias("doc_id"), F.lit(True).alias("_kept")), ["doc_id", "_text"], "left").withColumn(
        "mask", F.col("_bits") + F.when(F.col("_kept"), 0).otherwise(e))
    bare = seen.where("doc_id IS NULL").join(first, "_text", "left").withColumn(
        "mask", F.col("_bits") + F.when(F.col("_keeper").isNull(), 0).otherwise(e))
    columns = ["doc_id", "part", "mask", "n"]
    return named.select(*columns).unionByName(bare.select(*columns))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic: rows of each part by the filters that they fail."""
    marks = labels.where("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic"))
    known = masked(docs).join(marks, "doc_id", "left")
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.coalesce(F.sum(F.when(F.col("_good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("_toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    `docs` (doc_id, text, source) and `labels` (doc_id, quality, toxic); other columns are not looked at. A null
    source is the part '', a null text is empty; empty texts are copies of one another. Repeated rows count as often
    as they stand there, none fails E for its own repetition. A document is good (toxic) if any of its labels says so;
    labels without an id belong to none. An empty table gives no rows."""
    spark = docs.sparkSession
    counted = durable(cells(docs, labels), "filter-cells")
    runs = spark.createDataFrame(intervals(), "mask int, step int, late int, begin int, stop int")
    ends = F.explode(F.array(F.struct(F.col("begin").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign"))))
    # The intervals are a fixed table: 2,674 rows, always; a part has at most 32 masks.
    marks = counted.join(F.broadcast(runs.select("mask", "step", "late", ends.alias("_end"))), "mask").where(
        F.col("_end.rank") < ORDERS)
    delta = marks.groupBy("part", "step", F.col("_end.rank").alias("rank")).agg(*[
        F.sum(F.when(F.col("late") == late, F.col("_end.sign") * F.col(c)).otherwise(0)).alias(name)
        for name, c, late in (("removed", "docs", 0), ("good_lost", "good", 0), ("toxic_lost", "toxic", 0), ("redundant", "docs", 1))])

    own = counted.groupBy("part").agg(F.sum("docs").alias("_docs"), F.map_from_entries(F.array(*[
        F.struct(F.lit(f), F.coalesce(F.sum(F.when(F.col("mask") == 1 << i, F.col("docs"))), F.lit(0)))
        for i, f in enumerate(FILTERS)])).alias("_alone"))
    ranks = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank")
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    order = F.element_at(F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)]), F.col("rank") + 1)
    rows = own.select("*", ranks).withColumn("step", steps).withColumn("filter_order", order).withColumn(
        "filter", F.substr("filter_order", "step", F.lit(1))).join(delta, ["part", "step", "rank"], "left")
    upto = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    totals = rows.withColumns({c: F.sum(F.coalesce(c, F.lit(0))).over(upto)
                               for c in ("removed", "good_lost", "toxic_lost", "redundant")})
    before = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return totals.select(
        "part", "filter_order", "step", "filter", (F.col("_docs") - F.sum("removed").over(before)).alias("kept"), "removed",
        "redundant", F.element_at("_alone", F.col("filter")).alias("unique_fails"), "good_lost", "toxic_lost",
        F.sum("removed").over(W.partitionBy("part", "filter")).alias("shapley"))
