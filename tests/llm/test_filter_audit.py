"""Filter audit: intervals against replayed orders, and documents with odd rows against plain Python."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

from tradewind.llm import filter_audit

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def test_intervals_replay_every_order():
    runs = filter_audit.intervals()
    for mask in range(32):
        marks = Counter()
        for m, step, late, begin, stop in runs:
            if m == mask:
                marks.update((rank, step, late) for rank in range(begin, stop))
        want = Counter()
        for rank, order in enumerate(ORDERS):
            late = 0
            for step, f in enumerate(order, 1):
                if mask >> "ABCDE".index(f) & 1:
                    want[rank, step, late] += 1
                    late = 1
        assert marks == want


def replayed(docs, labels):
    """{(part, order, step): counts} by walking through every order for every document."""
    good = {d for d, q, t in labels if d is not None and q == 1}
    toxic = {d for d, q, t in labels if d is not None and t == 1}
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    found = {}
    for d, text, source in docs:
        text, part = text or "", source or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search("[#$%&*|]", text), text in least and (d is None or d > least[text]))) if bad}
        for order in ORDERS:
            removed = False
            for step, f in enumerate(order, 1):
                c = found.setdefault((part, order, step), Counter())
                if f in fails:
                    c["redundant" if removed else "removed"] += 1
                    if not removed:
                        c["good_lost"] += d in good
                        c["toxic_lost"] += d in toxic
                    c["unique_fails"] += fails == {f}
                    removed = True
                c["kept"] += not removed
    shapley = Counter()
    for (part, order, step), c in found.items():
        shapley[part, order[step - 1]] += c["removed"]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {k: (*[c[n] for n in names], shapley[k[0], k[1][k[2] - 1]]) for k, c in found.items()}


def test_odd_documents_against_plain_python(spark):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(1, "short", "a"), (2, "short", "b"), (2, "short", "b"), (3, None, None), (4, "", ""), (5, " \t\n", "a"),
            (6, long, "a"), (7, long, "a"), (8, long + " #", "b"), (9, "same " * 400, "b"), (10, "LOUD " * 250, None),
            (None, long, "a"), (None, "nobody else", "b"), (11, long.upper() + "|" * 100_000, "é"), (12, "one\x1ctwo three", "a")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (6, 1, None), (7, 1, 1), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "'x' AS part", "1 AS mask", "2 AS docs", "3 AS rank", "4 AS n", "5 AS step")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'y' AS part", "0 AS n")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in filter_audit.audit(docs, marks).collect()}
    assert got == replayed(rows, labels)
    # In every order a part's removed documents are those that fail anything.
    assert all(sum(got[p, o, s][1] for s in range(1, 6)) == got[p, o, 1][0] + got[p, o, 1][1] - got[p, o, 5][0]
               for p in ("a", "b") for o in ORDERS)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert filter_audit.audit(docs, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_documents_meet_constant_tables_only(spark, root):
    from tradewind.llm.common import read
    docs, labels = read(spark, root, "documents"), read(spark, root, "labels")
    counted = filter_audit.cells(docs, labels)
    per_part = counted.groupBy("part").count().agg({"count": "max"}).collect()[0][0]
    assert per_part <= 32
    plan = filter_audit.audit(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
