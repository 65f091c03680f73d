"""Secret scan over a trigram inverted index, in native operations.

From each rule's pattern follows a Boolean trigram query: what a text must contain, in lower case,
for the pattern to match. The index holds, for every trigram that some rule asks for, the rows that
contain it. Intersecting postings gives the candidates of each rule, and only these are searched with the
pattern. A rule without mandatory trigrams is searched in every text.

Match places come from cutting the text at the matches: lengths of pieces and matches, summed up.
"""

from __future__ import annotations

import itertools
import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import durable, null_safe, row_hash

KEY = ["doc_id", "_row"]
MOST_STRINGS, MOST_CLASS, MASK_BITS = 256, 8, 62


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of `pattern`; those whose `group` has fewer than `least` characters fail afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # The runs of 24 or more are the leftmost matches of [0-9a-f]+ that do not fail.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\s/:@]+:[^\s/:@]+@"),
)


# ---- trigram queries --------------------------------------------------------------------

def _strings(token) -> set[str] | None:
    """All strings a part of a pattern can match, if these are few."""
    kind, value = token
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        chars = set()
        for k, v in value:
            if k is op.LITERAL:
                chars.add(chr(v).lower())
            elif k is op.RANGE and v[1] - v[0] < MOST_CLASS:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return chars if len(chars) <= MOST_CLASS else None
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        each = [_sequence(x) for x in value[1]]
        return None if None in each else set().union(*each)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] != op.MAXREPEAT and value[1] <= 2:
        one = _sequence(value[2])
        return None if one is None else {"".join(p) for n in range(value[0], value[1] + 1) for p in itertools.product(one, repeat=n)}
    return None


def _sequence(tokens) -> set[str] | None:
    out = {""}
    for t in tokens:
        some = _strings(t)
        if some is None or len(out) * len(some) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in some}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams that all must occur; a single empty set demands nothing."""
    runs, run = [], {""}
    for token in parser.parse(pattern):
        some = _strings(token)
        if some is not None and len(run) * len(some) <= MOST_STRINGS:
            run = {a + b for a in run for b in some}
        else:
            runs.append(run)
            run = {""} if some is None else some
    runs.append(run)
    demands = []
    for run in runs:
        if all(len(s) >= 3 for s in run):
            demands.append({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run})
    options = {frozenset()}
    for demand in demands:
        if len(options) * len(demand) <= MOST_STRINGS:
            options = {a | b for a in options for b in demand}
    # An option that contains another adds nothing.
    return sorted((o for o in options if not any(p < o for p in options)), key=sorted)


def vocabulary(rules) -> list[str]:
    return sorted({t for r in rules for o in trigram_query(r.pattern) for t in o})


# ---- the index --------------------------------------------------------------------------

def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id, _row): every row whose text holds the trigram, upper and lower case alike."""
    low = docs.select("doc_id", row_hash(F.col("text")).alias("_row"), F.lower("text").alias("_low"))
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(held).alias("trigram"), *KEY)


def candidates(index: DataFrame, rules, trigrams: list[str]) -> DataFrame:
    """(doc_id, _row, kinds): rows whose postings meet the query of at least one rule that has a query."""
    place = {t: i for i, t in enumerate(trigrams)}
    number = F.create_map(*[F.lit(x) for t, i in place.items() for x in (t, i)])[F.col("trigram")]
    words = range(0, len(trigrams), MASK_BITS)
    bit = lambda lo: F.when(number.between(lo, lo + MASK_BITS - 1), F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), (number - lo).cast("int"))).otherwise(F.lit(0).cast("bigint"))
    masks = index.groupBy(*KEY).agg(*[F.bit_or(bit(lo)).alias(f"_m{lo}") for lo in words])

    def met(rule: Rule) -> Column:
        ok = F.lit(False)
        for option in trigram_query(rule.pattern):
            every = F.lit(True)
            for lo in words:
                need = sum(1 << (place[t] - lo) for t in option if lo <= place[t] < lo + MASK_BITS)
                if need:
                    every = every & (F.col(f"_m{lo}").bitwiseAND(F.lit(need)) == need)
            ok = ok | every
        return ok

    kinds = F.array_compact(F.array(*[F.when(met(r), F.lit(r.kind)) for r in rules]))
    return masks.select(*KEY, kinds.alias("kinds")).where(F.size("kinds") > 0)


# ---- matches ----------------------------------------------------------------------------

def _lengths(rule: Rule) -> Column:
    """Array of (gap before the match, its length, length of its group)."""
    gaps, found = F.split("text", rule.pattern, -1), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    size = lambda a: F.transform(a, lambda x: F.char_length(x))
    return F.arrays_zip(size(F.slice(gaps, F.lit(1), F.size(found))).alias("gap"), size(found).alias("len"), size(group).alias("group"))


def matches(texts: DataFrame, rules, asked: Column | None) -> DataFrame:
    """(doc_id, _row, kind, _lengths) for rows with a match; `asked` lists the kinds to search a row for."""
    found = []
    for r in rules:
        wanted = F.col("text").rlike(r.pattern)
        found.append(F.when(wanted if asked is None else F.array_contains(asked, r.kind) & wanted,
                            F.struct(F.lit(r.kind).alias("kind"), _lengths(r).alias("lengths"))))
    rows = texts.select(*KEY, F.explode(F.array_compact(F.array(*found))).alias("m"))
    return rows.select(*KEY, "m.kind", "m.lengths")


def spans(docs: DataFrame, rules=BASE + MORE) -> DataFrame:
    """(doc_id, _row, kind, start, end) of every secret; code points, end exclusive.

    Null texts are empty. Repeated rows (same id and text) are searched alike and listed once. Other columns
    than doc_id and text are not looked at; an empty table has no spans."""
    indexed = [r for r in rules if all(trigram_query(r.pattern))]
    scanned = [r for r in rules if r not in indexed]
    texts = docs.select("doc_id", row_hash(F.col("text")).alias("_row"), "text")
    parts = []
    if indexed:
        trigrams = vocabulary(indexed)
        index = durable(postings(docs, trigrams), "trigram-index")
        found = candidates(index, indexed, trigrams)
        parts.append(matches(null_safe(texts, found, KEY, "inner"), indexed, F.col("kinds")))
    if scanned:
        parts.append(matches(texts, scanned, None))
    rows = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    # One list of matches per row and rule, then one line per match.
    once = rows.groupBy(*KEY, "kind").agg(F.first("lengths").alias("lengths"))
    lines = once.select(*KEY, "kind", F.posexplode("lengths").alias("i", "m"))
    upto = W.partitionBy(*KEY, "kind").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    ended = lines.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(upto))
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])[F.col("kind")]
    return ended.where(F.col("m.group") >= least).select(*KEY, "kind", (F.col("end") - F.col("m.len")).alias("start"), "end")


def findings(docs: DataFrame, rules=BASE + MORE, base=BASE) -> DataFrame:
    """Per row of `docs`: doc_id, number of spans of each base kind, `base` and `spans` as sorted text lists."""
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])[F.col("kind")]
    # As many spans as the text has matches at most.
    lists = spans(docs, rules).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("all"))
    kinds = [r.kind for r in base]
    line = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda *k: F.filter("all", lambda s: s["kind"].isin(*k))
    every = docs.select("doc_id", row_hash(F.col("text")).alias("_row"))
    counted = null_safe(every, lists, KEY, "left").withColumn("all", F.coalesce("all", F.array().cast(
        "array<struct<start:bigint,rank:int,kind:string,end:bigint>>")))
    return counted.select(
        "doc_id", *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds],
        line(of_kind(*kinds)).alias("base"), line(F.col("all")).alias("spans"))
