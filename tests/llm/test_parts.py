"""Parts of the operators against brute force."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradewind.llm import (chat_windows, decontaminate, hash_ring, line_crf, minhash_dedup, mixing, page_diff, quality_gam,
                           secret_index, wordhash)
from tradewind.llm.textstats import Stats


def test_words_of_blocks():
    texts = ["a b", "", None, "\n x\ty ", "long" * 50, "é b", "a b"]
    seen = {}
    for limit in (1, 8, 1 << 20):
        found = []
        for block in wordhash.blocks(pa.array(texts), limit):
            block.words()
            h = block.hashes(fold=False)
            for i in range(block.n):
                found.append([(bytes(block.data[a:b]), x) for a, b, d, x in zip(block.start, block.end, block.doc, h) if d == i])
        assert [[w for w, _ in f] for f in found] == [(t or "").encode().split() for t in texts]
        for f in found:
            for w, x in f:
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_distance_bound_and_keys(spark):
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 256, (40, 64), dtype=np.uint8)
    for i in range(1, 40, 2):  # neighbours at distances up to the radius
        rows[i] = rows[i - 1]
        at = rng.choice(64, 1 + i % minhash_dedup.RADIUS, replace=False)
        rows[i, at] ^= rng.integers(1, 256, len(at), dtype=np.uint8)
    frame = spark.createDataFrame([(i, *map(int, r.view(np.int64))) for i, r in enumerate(rows)],
                                  "id long, " + ", ".join(f"{s} long" for s in minhash_dedup.SIG))
    keys = {}
    for r in minhash_dedup.chunk_keys(frame).collect():
        keys.setdefault(r.id, set()).add(r.key)
    assert all(len(k) == 64 for k in keys.values())
    x, y = frame.alias("x"), frame.alias("y")
    got = {(r.a, r.b): r.d for r in x.join(y, F.col("x.id") <= F.col("y.id")).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"), minhash_dedup.distance("x", "y").alias("d")).collect()}
    for (a, b), d in got.items():
        assert d == int((rows[a] != rows[b]).sum())
        if d <= minhash_dedup.RADIUS:
            assert keys[a] & keys[b]


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def groups_by_hand(docs):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        sets[i] = {tuple(w[k:k + 3]) for k in range(max(len(w) - 2, 1))} if w else set()
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


@pytest.mark.parametrize("rounds", [0, 1])
def test_near_duplicates(spark, rounds):
    rng = random.Random(5)
    texts = family(rng, 150, 120, 12) + family(rng, 30, 40, 3) + family(rng, 20, 400, 40) + ["one", "ONE", "one two", "a b c", "a B c ", "", None, " \n"]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.groups(frame, rounds=rounds).collect()}
    assert got == groups_by_hand(docs)


def test_crf_decodes_the_best_labelling():
    rng = np.random.default_rng(2)
    for n in range(1, 8):
        field = line_crf.Field(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
        e = rng.normal(size=n).tolist()

        def value(labels):
            return field.start[labels[0]] + sum(x * y for x, y in zip(labels, e)) + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert abs(value(field.decode(e)) - value(best)) < 1e-9


def test_crf_learns_and_defaults():
    block = next(wordhash.blocks(pa.array(["x"])))
    assert line_crf.describe(Stats(block)).shape == (1, len(line_crf.SIZES))
    model = line_crf.train([], np.zeros(0, int))
    assert model.decode([0.0, 0.0]) == [line_crf.CONTENT] * 2
    good, bad = np.zeros((6, len(line_crf.SIZES)), int), np.zeros((6, len(line_crf.SIZES)), int)
    bad[:, 2] = 3
    model = line_crf.train([good, bad] * 20, np.array([0, 1] * 20))
    mixed = np.concatenate([good[:3], bad[:3]])
    assert model.decode(model.emissions(mixed).tolist()) == [0, 0, 0, 1, 1, 1]


def test_lcs():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
        found = sorted(page_diff.shared(a, b))
        rest = iter(b)
        assert len(found) == d[-1][-1] and all(any(a[i] == y for y in rest) for i in found)


def test_page_markup():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a>Menu</a></nav>"
            "<div class='cookie-notice'>We use <b>cookies</b></div><main><article><header><h1>Head &amp; line</h1></header><p>One<br>two"
            "<p>a &lt;b&gt; c<script>var x='</p>';</script><div class=\"ad\">Buy<div>now</div></div><ul><li>x</li><li>y</ul>"
            "<section id=comments><p>First!</p></section><form>Name<input></form></article><aside>Side</aside></main><!-- c > d -->"
            "<footer>&copy;</footer>")
    lines, marks = page_diff.lines_of(page)
    assert lines == ["Head & line", "One", "two", "a <b> c", "x", "y"] and set(marks) == {page_diff.ARTICLE}
    assert page_diff.lines_of("just text") == (["just text"], [page_diff.OPEN])
    assert page_diff.lines_of("") == ([], []) and page_diff.lines_of("<p>" * 50_000 + "x")[0] == ["x"]


def test_differences_decide_without_an_article(spark):
    pages = [(i, f"http://h/a/{i}", f"<div>Template top</div><p>Own text {i}</p><div>Template end</div>") for i in range(6)]
    pages += [(10, "http://other/x", "<div>Template top</div><p>Alone</p>"), (11, None, "<p>No address</p>"), (12, "http://h/a/9", None),
              (13, "http://[bad", "<p>z</p>"), (13, "http://[bad", "<p>z</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.page_id, r.text) for r in page_diff.extract(frame).collect()}
    assert got == {(i, f"Own text {i}") for i in range(6)} | {(10, "Template top Alone"), (11, "No address"), (12, ""), (13, "z")}


def test_trigram_queries_miss_nothing():
    rng = random.Random(4)
    rules = secret_index.BASE + secret_index.MORE
    samples = ["password = 'abcdef'", "Api_Key:abcdefgh", "APIKEY=abcdefgh", "toKEN=123456", "AKIA" + "A1" * 10, "ghp_" + "a" * 36,
               "xoxb-1234567890-abc", "eyJabcdefghi.eyJabcdefghi.abcdefghi", "https://u:p@host/", "-----BEGIN RSA PRIVATE KEY-----"]
    for rule in rules:
        options = secret_index.trigram_query(rule.pattern)
        hit = 0
        for s in samples + ["".join(rng.choice("akiAKIpasword=:'\"_- ") for _ in range(60)) for _ in range(2000)]:
            if re.search(rule.pattern, s):
                hit += 1
                assert any(all(t in s.lower() for t in o) for o in options)
        assert hit or rule.kind == "hex"
    assert secret_index.trigram_query("[0-9a-f]{24,}") == [frozenset()]


def test_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        i = np.arange(n)
        for key in (0, 5):
            assert sorted(mixing.permuted(i, np.full(n, n), np.full(n, key))) == list(range(n))
    assert (mixing.permuted(np.arange(1000), np.full(1000, 1000), np.zeros(1000, int)) != np.arange(1000)).mean() > 0.95


def test_ring_moves_little():
    rng = random.Random(0)
    counts = {}
    for _ in range(20_000):
        c = rng.randrange(hash_ring.CELLS)
        counts[c] = counts.get(c, 0) + 1

    def places(shards):
        return {(c, r): s for c, a, b, s, _ in hash_ring.lay_out(counts, shards, hash_ring.CELLS, hash_ring.NODES) for r in range(a, b)}

    before, after = places(40), places(41)
    assert len(before) == len(after) == 20_000
    assert sum(before[k] != after[k] for k in before) < 0.1 * 20_000
    assert hash_ring.lay_out({}, 40, 64, 4) == []
    assert sorted((a, b, s) for _, a, b, s, _ in hash_ring.lay_out({5: 7}, 3, 64, 4))[-1][1] == 7


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.train(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9
    assert quality_gam.train(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


@pytest.mark.parametrize("budget, history, stretch", [(30, 0, 1), (30, 10, 1), (40, 15, 3), (2000, 100, 32)])
def test_windows_keep_budgets_and_turns(spark, budget, history, stretch):
    rng = random.Random(budget + stretch)
    talks = {}
    for c in range(12):
        turns = [("system", "be nice")] if c % 2 else []
        for _ in range(rng.randrange(0, 40)):
            turns.append((rng.choice(["user", "assistant"]), " ".join(["w"] * rng.choice([0, 1, 3, 9, 60]))))
        if turns:
            talks[c] = turns
    rows = [(c, i, r, t) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    made = chat_windows.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget, history, stretch)
    made = made.toPandas().sort_values(["conv_id", "begin"])
    for c, turns in talks.items():
        own = made[made.conv_id == c]
        read, learned = [], []
        for w in own.itertuples():
            shown = chat_windows.read_turns(w.text)
            assert w.n_tokens == sum(len(t.split()) + chat_windows.FRAME_TOKENS for _, t in shown)
            fresh = shown[w.n_repeated:]
            assert w.over_budget == (w.n_tokens > budget) and (not w.over_budget or sum(r != "system" for r, _ in fresh) == 1)
            if turns[0][0] == "system":
                assert shown[0] == turns[0]
            old = shown[turns[0][0] == "system" and w.n_repeated > 0:w.n_repeated]
            assert sum(len(t.split()) + chat_windows.FRAME_TOKENS for _, t in old) <= history
            assert old == read[len(read) - len(old):]
            read += fresh
            learned += [chat_windows.unescape(w.text[a:b]) for a, b in zip(w.loss_from, w.loss_to)]
        assert read == turns and learned == [t for r, t in turns if r == "assistant"]


def test_template_escapes():
    rng = random.Random(9)
    for _ in range(300):
        turns = [("".join(rng.choice("<|\\n\na") for _ in range(rng.randrange(6))), "".join(rng.choice(
            ["<", "|", "\\", "im_end|>", "<|im_start|>", "\n", "x"]) for _ in range(rng.randrange(12)))) for _ in range(3)]
        assert chat_windows.read_turns("".join(chat_windows.format_turn(r, t)[0] for r, t in turns)) == turns


def test_decontamination_by_shuffle(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{root}/benchmark.parquet").select("item_id", "text")
    few = [(1, "alpha"), (2, "beta gamma"), (3, ""), (4, None), (None, "alpha delta")]
    items = items.union(spark.createDataFrame(few, "item_id long, text string"))
    docs = docs.union(spark.createDataFrame([(9001, "Alpha, delta! beta-gamma"), (9002, "beta x gamma")], "doc_id long, text string"))
    a, b = (sorted(map(str, decontaminate.contamination(docs, items, broadcast_limit=n).collect())) for n in (10**6, 0))
    assert a == b
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, items).where("doc_id > 9000").collect()}
    assert got == {9001: (4, 4, ["1", "2"]), 9002: (3, 0, [])}
