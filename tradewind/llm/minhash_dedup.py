"""Near-duplicate groups: b-bit MinHash signatures and a multi-index Hamming join.

A text is the set of its 3-word shingles. Its signature keeps one byte of each of 64 minima, so
two texts differ in about 64 (1 - similarity) symbols. Links of similarity 0.85 stay below a
distance of 22 but for about one in ten thousand at that very limit. The signature is cut into 11
chunks; a pair within distance 21 has a chunk with at most one error (pigeonhole). All one-error
neighbours of a chunk are listed by leaving each symbol out in turn: 64 keys a text, and every pair
within the distance shares a key. Other thresholds and shingles have the distance and chunks that `reach` gives.

Copies are folded into classes first. Then pairs are found without listing a group's pairs:
1. in each key all others meet its smallest member; links that the full sets confirm give components;
2. in keys that still hold several components, one member of each meets one of another, drawn by
   hash, for a few rounds: this joins large components of one group at the cost of one pair a key;
3. texts that still have a neighbour within the distance in another component are joined by their rare
   shingles: two sets that are alike enough share one of the first (1 - similarity) n + 1 shingles
   in any one order, early enough in both; shingles held by few components come first, so texts that
   nothing links meet next to nobody.
Every pair within the distance is therefore confirmed, refuted by its sets, or already in one component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm import wordhash
from tradewind.llm.common import durable, row_hash

SYMBOLS = 64
SHINGLE, ALIKE, OF = 3, 85, 100
MISSED = 1e-4  # most of the pairs at the very limit that a distance may leave out
ROUNDS = 1  # of step 2; more change no result
BROADCAST_IDS = 2_000_000  # 16 bytes each; more ids meet their texts by a shuffle
SIG = [f"s{i}" for i in range(SYMBOLS // 8)]
_rng = np.random.Generator(np.random.PCG64(77))
_A = _rng.integers(0, 1 << 31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)
_U = np.uint64


def reach(alike: int, of: int) -> tuple[int, int]:
    """(distance, chunks): the fewest chunks whose distance leaves out no more than MISSED of the pairs just alike enough."""
    p = (1 - alike / of) * (1 - 1 / 256)
    for chunks in range(1, SYMBOLS // 2 + 1):
        radius = 2 * chunks - 1
        if sum(math.comb(SYMBOLS, k) * p**k * (1 - p)**(SYMBOLS - k) for k in range(radius + 1, SYMBOLS + 1)) <= MISSED:
            return radius, chunks
    raise ValueError(f"{alike} of {of} is too little for signatures of {SYMBOLS} symbols")


RADIUS, CHUNKS = reach(ALIKE, OF)


def _sets(texts: pa.Array, shingles: tuple[int, ...]) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """(first row, for each length of shingle the sorted distinct shingles of each row) a block at a time."""
    for block in wordhash.blocks(texts):
        block.words()
        words, found = block.hashes(fold=True), []
        for shingle in shingles:
            h, doc = wordhash.shingles(words, block.doc, shingle)
            cut = np.searchsorted(doc, np.arange(block.n + 1))
            found.append([np.unique(h[cut[i]:cut[i + 1]]) for i in range(block.n)])
        yield block.first, found


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """One byte of each minimum, for sets that are not empty."""
    flat = (np.concatenate(sets) >> _U(32)).astype(np.uint32)
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SYMBOLS), np.uint8)
    for k in range(SYMBOLS):
        low = np.minimum.reduceat(flat * _A[k] + _B[k], begins)
        out[:, k] = (low * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def signatures(docs: DataFrame, shingles: tuple[int, ...] = (SHINGLE,)) -> DataFrame:
    """doc_id, _row (hash of the text), rule (place of the shingle's length), n_shingles, two halves of the set's digest, and the
    signature in 8 longs (null for empty sets): a row for each text and rule. A text is read and cut into words once."""
    schema = f"doc_id bigint, _row bigint, rule int, n_shingles bigint, d0 bigint, d1 bigint, {', '.join(f'{s} bigint' for s in SIG)}"

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, found in _sets(batch.column(1), shingles):
                for rule, sets in enumerate(found):
                    full = [i for i, s in enumerate(sets) if len(s)]
                    rows = np.zeros((len(sets), 2 + len(SIG)), np.int64)
                    for i in full:
                        rows[i, :2] = np.frombuffer(hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), np.int64)
                    if full:
                        rows[full, 2:] = _minima([sets[i] for i in full]).view(np.int64)
                    empty = np.ones(len(sets), bool)
                    empty[full] = False
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(sets)), batch.column(2).slice(first, len(sets)), pa.array(np.full(len(sets), rule, np.int32)),
                         pa.array([len(s) for s in sets], pa.int64()),
                         *[pa.array(rows[:, c], pa.int64(), mask=empty) for c in range(rows.shape[1])]],
                        names=["doc_id", "_row", "rule", "n_shingles", "d0", "d1", *SIG])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_hash(F.col("text")).alias("_row")).mapInArrow(
        run, schema)


def chunk_keys(classes: DataFrame, carried: tuple[str, ...] = (), chunks: int = CHUNKS) -> DataFrame:
    """(key, id, carried...): 64 keys each. A key names the symbol left out and holds the others of its chunk."""
    parts = np.array_split(np.arange(SYMBOLS), chunks)
    kinds = dict(classes.dtypes)
    schema = ", ".join(["key bigint", *[f"{c} {kinds[c]}" for c in ("id", *carried)]])

    def run(batches):
        for batch in batches:
            symbols = np.stack([batch.column(s).to_numpy(zero_copy_only=False) for s in SIG], axis=1)
            symbols = np.ascontiguousarray(symbols, np.int64).view(np.uint8).astype(np.int64)
            keys = np.empty((len(symbols), SYMBOLS), np.int64)
            for part in parts:
                for left_out in part:
                    key = np.full(len(symbols), left_out, np.int64)
                    for i in part:
                        if i != left_out:
                            key = key << 8 | symbols[:, i]
                    keys[:, left_out] = key
            rows = pa.array(np.repeat(np.arange(len(symbols)), SYMBOLS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), *[batch.column(c).take(rows) for c in ("id", *carried)]],
                names=["key", "id", *carried])

    return classes.select("id", *SIG, *[c for c in carried if c not in SIG]).mapInArrow(run, schema)


def distance(a: str, b: str) -> Column:
    """Symbols in which two signatures differ."""
    total = F.lit(0)
    for s in SIG:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def sets_of(docs: DataFrame, wanted: DataFrame, shingles: tuple[int, ...], repeats: bool) -> DataFrame:
    """(id, set) of the classes `wanted` (id, rule, doc_id, _row): the text of each is read once for all its rules. `repeats`
    says that rows may be there twice."""
    def run(batches):
        for batch in batches:
            asked = batch.column(1).to_pylist()
            for first, found in _sets(batch.column(0), shingles):
                picked = [(a["id"], found[a["rule"]][i]) for i in range(len(found[0])) for a in asked[first + i]]
                ends = np.cumsum([0] + [len(s) for _, s in picked])
                flat = np.concatenate([s for _, s in picked]).view(np.int64) if picked else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in picked], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))], names=["id", "set"])

    rows = durable(wanted.groupBy("doc_id", "_row").agg(F.collect_list(F.struct("id", "rule")).alias("_asked")), "wanted")  # one a rule
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows
    once = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_hash(F.col("text")).alias("_row")).join(
        rows, ["doc_id", "_row"])
    if repeats:
        once = once.groupBy("doc_id", "_row").agg(F.first("text").alias("text"), F.first("_asked").alias("_asked"))
    return durable(once.select("text", "_asked").mapInArrow(run, "id bigint, set array<bigint>"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, limit: Column) -> DataFrame:
    """The pairs (a, b, rule) whose whole sets are alike enough: `limit` gets sizes x, y and what they share."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    sized = both.select("a", "b", "rule", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("shared"))
    return sized.where(limit).select("a", "b").distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of an edge: smallest reachable id, by label spreading with shortcuts."""
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = durable(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("component").alias("near"))
        best = labels.join(near, "id").select("id", F.least("component", "near").alias("up"), F.col("component").alias("was"))
        jump = labels.select(F.col("id").alias("up"), F.col("component").alias("far"))
        after = durable(best.join(jump, "up").select("id", F.least("up", "far").alias("component"),
                                                     (F.least("up", "far") < F.col("was")).alias("moved")), "labels")
        labels = after.select("id", "component")
        if not after.where("moved").limit(1).count():
            return labels


def _merged(owned: DataFrame, links: DataFrame) -> DataFrame:
    """`owned` (id, component, ...) after links (a, b) between ids."""
    at = lambda end: owned.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    between = links.join(at("a"), "a").join(at("b"), "b").where(F.col("ca") != F.col("cb")).select(
        F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = components(between).select(F.col("id").alias("component"), F.col("component").alias("_to"))
    return durable(owned.join(joined, "component", "left").withColumn("component", F.coalesce("_to", "component")).select(
        *owned.columns), "owned")


def groups(docs: DataFrame, shingle: int = SHINGLE, alike: int = ALIKE, of: int = OF, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text).

    A-Z count as a-z. A text with fewer words than a shingle is one shingle; null, empty and blank
    texts have none and stay alone. Repeated rows are copies, so rows with the kept id are all
    kept. Rows without an id join the group of their copies that have one, else their component is null
    and they stay. Other columns are not looked at."""
    return _judged(docs, ((shingle, alike, of),), rounds).select("doc_id", "n_shingles", "component_id", "kept")


def _by_rule(values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + 1) if len(values) > 1 else F.lit(values[0])


def _judged(docs: DataFrame, rules: tuple[tuple[int, int, int], ...], rounds: int = ROUNDS) -> DataFrame:
    """Rows of `groups` for each rule, with _row (hash of the text), rule, and the set's digest d0, d1.

    All rules are worked off together. A node is a class of texts of one set under one rule; the classes that a text has
    under different rules are linked to begin with, so a pair that one rule has joined is no work for another."""
    shingles, reached = tuple(r[0] for r in rules), [reach(*r[1:]) for r in rules]
    alike, of, radius = _by_rule([r[1] for r in rules]), _by_rule([r[2] for r in rules]), _by_rule([r[0] for r in reached])
    marked = durable(signatures(docs, shingles), "signatures")
    named = marked.where(F.col("d0").isNotNull() & F.col("doc_id").isNotNull())
    repeats = bool(named.where("rule = 0").groupBy("doc_id", "_row").count().where("count > 1").limit(1).count())
    # Numbers follow the documents' ids: a key's smallest node is then its oldest text, which copies are most alike to.
    classes = durable(named.groupBy("rule", "d0", "d1").agg(
        F.min(F.struct("doc_id", "_row")).alias("_first"), F.first("n_shingles").alias("n"), *[F.first(s).alias(s) for s in SIG]).orderBy(
        "_first", "rule").select(F.monotonically_increasing_id().alias("id"), "rule", "d0", "d1", "_first.*", "n", *SIG), "classes")
    sigs = classes.select("id", "rule", "n", *SIG)
    close = (of * F.col("x.n") >= alike * F.col("y.n")) & (of * F.col("y.n") >= alike * F.col("x.n")) & (distance("x", "y") <= radius)
    enough = of * F.col("shared") >= alike * (F.col("nx") + F.col("ny") - F.col("shared"))

    def near(pairs: DataFrame) -> DataFrame:
        x, y = sigs.withColumnRenamed("rule", "_x").alias("x"), sigs.alias("y")
        return durable(pairs.join(x, F.col("a") == F.col("x.id")).join(y, (F.col("b") == F.col("y.id")) & close).select(
            "a", "b", "rule").distinct(), "pairs")

    sets: DataFrame | None = None

    def known(ids: DataFrame) -> DataFrame:
        """Sets of at least these ids; each text is read for it once."""
        nonlocal sets
        asked = ids if sets is None else ids.join(sets, "id", "left_anti")
        new = sets_of(docs, asked.join(classes.select("id", "rule", "doc_id", "_row"), "id"), shingles, repeats)
        sets = new if sets is None else sets.unionByName(new)
        return sets

    def links(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, known(_ends(pairs)), enough)

    def tied() -> DataFrame:
        """Links between the classes of a text under the rules."""
        of_text = named.select("doc_id", "_row", "rule", "d0", "d1").join(classes.select("rule", "d0", "d1", "id"), ["rule", "d0", "d1"])
        ends = of_text.groupBy("doc_id", "_row").agg(F.collect_set("id").alias("_ids"), F.min("id").alias("a"))  # one a rule
        return ends.select("a", F.explode("_ids").alias("b")).where("a <> b").distinct()

    keys = None
    for rule, (_, chunks) in enumerate(reached):
        own = chunk_keys(sigs.where(F.col("rule") == rule), chunks=chunks).withColumn("key", F.col("key") * len(rules) + rule)
        keys = own if keys is None else keys.unionByName(own)
    heads = keys.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    shared = durable(keys.join(heads.select("key", "a"), "key"), "shared-keys")
    met = shared.where(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")).distinct()
    first = links(near(met))
    owned = _merged(sigs.select("id", F.col("id").alias("component")), first.union(tied()) if len(rules) > 1 else first)

    open_ = shared.select("key", "id")
    for turn in range(rounds):
        placed = open_.join(owned, "id")
        several = placed.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"),
                                            F.min_by("component", F.xxhash64("id", F.lit(turn))).alias("ca"),
                                            F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("a")).where(F.col("_lo") < F.col("_hi"))
        open_ = durable(placed.join(several.select("key", "ca", "a"), "key"), "open-keys")
        one = open_.where(F.col("component") != F.col("ca")).groupBy("key", "a", "component").agg(
            F.min_by("id", F.xxhash64("id", "key", F.lit(turn))).alias("b"))
        owned = _merged(owned, links(near(one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())))
        open_ = open_.select("key", "id")

    placed = open_.join(owned, "id")
    several = placed.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where(
        F.col("_lo") < F.col("_hi")).select("key")
    signed = placed.join(several, "key", "left_semi").join(sigs, "id")
    x, y = signed.withColumnRenamed("rule", "_x").alias("x"), signed.alias("y")
    waiting = durable(y.join(x, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & close,
                             "left_semi").select("id", "rule", "component", "n", *SIG).distinct(), "waiting")
    tokens = waiting.select("id", "rule", "component").join(known(waiting.select("id")), "id").select(
        "id", "rule", "component", F.size("set").alias("n"), F.explode("set").alias("token"))
    spread = tokens.groupBy("rule", "token").agg(F.count_distinct("component").alias("held"))
    place = F.row_number().over(W.partitionBy("id").orderBy("held", "token"))
    prefix = tokens.join(spread, ["rule", "token"]).withColumn("_at", place).where(
        (F.col("_at") <= F.col("n") - F.ceil(F.col("n") * alike / of) + 1) & (F.col("held") > 1)).select("id", "token", F.col("_at").alias("at"))
    rare = durable(prefix.join(waiting, "id"), "rare-shingles")
    x, y = rare.withColumnRenamed("rule", "_x").alias("x"), rare.alias("y")
    # The first shared shingle bounds the overlap: what comes before it in either order is not shared.
    able = (of + alike) * (1 + F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))) >= alike * (
        F.col("x.n") + F.col("y.n"))
    across = durable(x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("_x") == F.col("rule"))
                            & (F.col("x.component") < F.col("y.component")) & able & close).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"), "rule").distinct(), "pairs")
    owned = _merged(owned, confirmed(across, sets, enough))

    placed = classes.select("rule", "d0", "d1", "id", F.col("doc_id").alias("_doc")).join(owned, "id")
    least = placed.groupBy("component").agg(F.min("_doc").alias("component_id"))
    final = placed.join(least, "component").select("rule", "d0", "d1", "component_id")
    return marked.select("doc_id", "_row", "rule", "n_shingles", "d0", "d1").join(final, ["rule", "d0", "d1"], "left").select(
        "doc_id", "_row", "rule", "d0", "d1", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.col("component_id").isNull()).alias("kept"))


def deduplicated(docs: DataFrame, rules: tuple[tuple[int, int, int], ...] = ((SHINGLE, ALIKE, OF),)) -> DataFrame:
    """The rows of `docs` that stay: one document of each group.

    `rules` are (shingle, alike, of); texts that are alike by any of them are linked, and groups are what all links join.
    Of rows without an id, copies of a row that has one go, and one of each class of copies without any stays; blank
    texts stay. Rows that repeat the id that is kept all stay, as in `groups`."""
    judged = _judged(docs.select("doc_id", "text"), rules)
    gone = judged.where(F.col("doc_id").isNotNull() & ~F.col("kept") & (F.col("rule") == 0)).select("doc_id").distinct()
    bare = F.col("doc_id").isNull()
    if not docs.where(bare).limit(1).count():
        return docs.join(gone, "doc_id", "left_anti")

    # Rows without an id are told apart by the hash of their text; the smallest of a class without any id stays.
    idless = durable(judged.where(bare & F.col("d0").isNotNull()).select("_row", "rule", "d0", "d1", "component_id").distinct(), "idless")
    least = idless.groupBy("rule", "d0", "d1").agg(F.min("_row").alias("_least"))
    copies = idless.join(least, ["rule", "d0", "d1"]).where(
        F.col("component_id").isNotNull() | (F.col("_row") != F.col("_least"))).select("_row").distinct()
    rows = docs.where(bare).select(row_hash(F.col("text")).alias("_row"), F.struct("*").alias("_doc"))
    rows = rows.join(copies, "_row", "left_anti")
    once = rows.join(idless.select("_row").distinct(), "_row", "left_semi").dropDuplicates(["_row"])
    blank = rows.join(idless.select("_row").distinct(), "_row", "left_anti")
    named = docs.where(~bare).join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    return named.union(once.union(blank).select("_doc.*"))
