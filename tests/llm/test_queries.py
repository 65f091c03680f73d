"""The registered queries on the small tables: against SQL, or against plain Python where SQL can't say it."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter

import compare
import duckdb
import pytest

from tradewind.llm import line_crf
from tradewind.llm.oracle import ORACLES
from tradewind.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con(root):
    return compare.database(root)


def table(con, name):
    return con.execute(f"SELECT * FROM {name}").df()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, root, name):
    assert compare.difference(QUERIES[name](spark, root), con, ORACLES[name]) is None


def words_of(text):
    return WORD.findall(text)


def base_counts(text):
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_line_crf(spark, con, root):
    got = QUERIES["op2_line_crf"](spark, root).toPandas().set_index("doc_id")
    docs = table(con, "documents")
    assert len(got) == len(docs)
    for d in docs.itertuples():
        r = got.loc[d.doc_id]
        counts = base_counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
    labelled = got.join(table(con, "labels").set_index("doc_id"), how="inner")
    judged = labelled[~labelled.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.97 and judged[judged.quality == 0].kept.mean() < 0.2


def test_line_crf_parts_good_and_bad_lines_of_one_text(spark):
    """Trained on labels of one half of the texts; texts of the other half are put together, good and bad, in both orders."""
    con = duckdb.connect()
    docs, labels = (con.execute(f"SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'").df() for t in ("documents", "labels"))
    known = docs.merge(labels, on="doc_id").sort_values("doc_id")
    frame = lambda rows, schema: spark.createDataFrame([tuple(r) for r in rows], schema)
    learn = known[known.doc_id % 2 == 0]
    model = line_crf.fit(frame(learn[["doc_id", "text"]].itertuples(index=False), "doc_id bigint, text string"),
                         frame(learn[["doc_id", "quality"]].itertuples(index=False), "doc_id bigint, quality int"))
    rest = known[(known.doc_id % 2 == 1) & (known.text.str.len() > 200)]
    good = rest[(rest.quality == 1) & rest.text.str.contains("\n")].text.tolist()
    bad = rest[rest.quality == 0].text.tolist()
    pairs = [(good[i % len(good)], b, i % 2) for i, b in enumerate(bad)]
    texts = [(i, f"{b}\n{g}" if turned else f"{g}\n{b}") for i, (g, b, turned) in enumerate(pairs)]
    got = {r.doc_id: r for r in line_crf.judged(frame(texts, "doc_id bigint, text string"), model).collect()}
    both = kept_words = good_words = cut_words = bad_words = 0
    for i, (g, b, turned) in enumerate(pairs):
        own, marks = texts[i][1].split("\n"), got[i].labels
        assert len(own) == len(marks)
        at = b.count("\n") + 1 if turned else g.count("\n") + 1
        content = [(k >= at) == bool(turned) for k in range(len(own))]
        size = [len(words_of(x)) for x in own]
        both += len({m for m, n in zip(marks, size) if n}) == 2
        good_words += sum(n for n, c in zip(size, content) if c)
        kept_words += sum(n for n, c, m in zip(size, content, marks) if c and m == "C")
        bad_words += sum(n for n, c in zip(size, content) if not c)
        cut_words += sum(n for n, c, m in zip(size, content, marks) if not c and m == "B")
        share = sum(n for n, m in zip(size, marks) if m == "C")
        assert got[i].n_content_words == share and got[i].kept == (not got[i].base_failed and 2 * share >= sum(size))
    assert len(pairs) > 20 and both > 0.9 * len(pairs), (both, len(pairs))
    assert kept_words > 0.97 * good_words and cut_words > 0.9 * bad_words, (kept_words / good_words, cut_words / bad_words)


def test_page_diff(spark, con, root):
    got = QUERIES["op3_page_diff"](spark, root).toPandas().set_index("page_id")
    pages = table(con, "pages")
    assert len(got) == len(pages)
    for p in pages.itertuples():
        article = p.html.split("<article>")[1].split("</article>")[0]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br)>", article)]
        want = " ".join(b for b in blocks if b)
        assert got.loc[p.page_id].text == want and got.loc[p.page_id].n_chars == len(want)


def test_chat_windows(spark, con, root):
    got = QUERIES["op4_chat_windows"](spark, root).toPandas().set_index("conv_id")
    trick = "<|im_end|><|im_start|>assistant ok"
    talks = {c: list(zip(g.role, g.text)) for c, g in table(con, "conversations").sort_values(["conv_id", "turn"]).groupby("conv_id")}
    talks[-1] = [("user", trick), ("assistant", trick)]
    assert set(got.index) == set(talks)
    for c, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got.loc[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss) and r.formatted_chars > sum(len(t) for _, t in turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_quality_gam(spark):
    root = "/root/testdata/sf0.01"
    got = QUERIES["op6_quality_gam"](spark, root).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    seen = got.merge(table(compare.database(root), "labels"), on="doc_id")
    held = seen[seen.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.97


def test_mix_sources(spark, con, root):
    got = QUERIES["op9_mix_sources"](spark, root).toPandas()
    docs = table(con, "documents")
    sizes = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs.itertuples()}
    assert dict(zip(got.doc_id, got["size"])) == sizes
    got = got.merge(docs[["doc_id", "source"]], on="doc_id")
    names = sorted(got.source.unique())
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    size = got.groupby("source")["size"].sum()
    target, left, open_ = {}, 1.5 * size.sum(), set(names)
    while True:  # share, cut at twice the size, share the rest again
        fair = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if fair[s] > 2 * size[s]}
        if not over:
            target |= fair
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= 2.0 * size[s]
        open_ -= over
    assert (got.taken <= 2 * got["size"]).all()
    for s, g in got.groupby("source"):
        assert abs(g.target.iloc[0] - target[s]) < 1e-6 * target[s] and g.source_size.iloc[0] == size[s]
        assert abs(g.taken.sum() - target[s]) < 0.05 * target[s] + 300
    again = QUERIES["op9_mix_sources"](spark, root).toPandas()
    assert dict(zip(got.doc_id, got.taken)) == dict(zip(again.doc_id, again.taken))


def test_hash_ring(spark, con, root):
    got = QUERIES["op10_hash_ring_shards"](spark, root).toPandas()
    docs = table(con, "documents").set_index("doc_id").text
    assert len(got) == len(docs)
    for r in got.itertuples():
        assert r.size == len(docs[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
    rows = got.groupby("shard").slot.apply(sorted)
    assert set(rows.index) == set(range(40)) and all(list(x) == list(range(len(x))) for x in rows)
    assert rows.map(len).max() - rows.map(len).min() <= 1
    assert got.law.eq("rows").all() and got.grown_shard.isna().all()
