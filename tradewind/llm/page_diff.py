"""Main text of web pages: structure, and differences to the page with the nearest URL.

A page becomes a list of text lines, one per block. Pages of a host are ordered by URL path; each is
paired with the neighbour that shares the longer start of its path. The lines of both are aligned by their longest
common subsequence, and shared lines are template: they go, unless they stand in the page's article. What
stands in menus, headers, footers, sidebars, notices, adverts, forms and comments goes in any case.

Differencing alone would be wrong in both directions: neighbours may have different menus, and articles may
share passages. So it decides about the lines that the markup leaves open.

Only hashes of lines travel to the partner. Ranks within a host come from a sort over all partitions, so a host with
most of the pages is spread like the others.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import null_safe, prefix_sums, row_hash

KEY = ["page_id", "_row"]
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                   r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
BLANKS = re.compile(r"\s+")

# Elements by what they do to the text.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas"}
SKIPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
MAIN = {"article", "main"}
# Words in class or id names, and roles, of parts that are no content.
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
         "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "related", "replies", "respond", "share",
         "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
OPEN, ARTICLE = 0, 1


def _unwanted(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in SKIPPED or tag == "header" and not in_main:
        return True
    if tag in INLINE or tag in MAIN or tag in ("body", "html") or not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" and m.start() and not m[2] and not m[3] and not m[4]:
            return True
        if name == "role" and value in ROLES or name in ("class", "id") and NAMES & set(re.split(r"[\s_-]+", value)):
            return True
    return False


def lines_of(page: str) -> tuple[list[str], list[int]]:
    """Text lines outside unwanted parts in page order, and whether each stands in the article."""
    lines, marks, text = [], [], []
    stack: list[tuple[str, bool, bool]] = []  # open elements that matter: (tag, unwanted, main)
    unwanted = main = 0
    low = None
    end, size = 0, len(page)

    def flush():
        if text:
            line = BLANKS.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if line:
                lines.append(line)
                marks.append(ARTICLE if main else OPEN)

    while end < size:
        m = TOKEN.search(page, end)
        if not unwanted and (m.start() if m else size) > end:
            text.append(page[end:m.start() if m else size])
        if not m:
            break
        end = m.end()
        if m[2] is None:
            if not unwanted and m[0].startswith("<![CDATA["):
                text.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                low = low or page.lower()
                close = low.find(f"</{tag}", end) if len(low) == size else page.find(f"</{tag}", end)
                end = close if close >= 0 else (size if tag != "title" else end)
            continue
        if tag not in INLINE and not unwanted:
            flush()
        if tag in VOID or m[3].rstrip().endswith("/") and tag in SKIPPED:
            continue
        if closing:
            # Closes the innermost element of this name, with what was left open inside; a stray end is nothing.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    for _, u, mm in stack[i:]:
                        unwanted -= u
                        main -= mm
                    del stack[i:]
                    break
                if stack[i][0] in MAIN and tag not in MAIN | {"body", "html"}:
                    break
        elif tag in MAIN or tag in SKIPPED or tag not in INLINE and tag not in ("p", "li", "dt", "dd", "tr", "td", "th", "option", "br"):
            u, mm = _unwanted(tag, m[3], main > 0), tag in MAIN
            stack.append((tag, u, mm))
            unwanted += u
            main += mm
        elif _unwanted(tag, m[3], main > 0):
            stack.append((tag, True, False))
            unwanted += 1
    if not unwanted:
        flush()
    return lines, marks


def shared(a: list[int], b: list[int]) -> set[int]:
    """Places in `a` of a longest common subsequence with `b`; bit-parallel rows over what both hold."""
    common = set(a) & set(b)
    at = [i for i, x in enumerate(a) if x in common]
    a, b = [a[i] for i in at], [x for x in b if x in common]
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = set(at[:head]) | set(at[len(at) - tail:])
    a, at, b = a[head:len(a) - tail], at[head:len(at) - tail], b[head:len(b) - tail]
    if not a or not b:
        return out
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full, rows = (1 << len(b)) - 1, []
    row = full
    for x in a:
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.add(at[i])
            i, j = i - 1, j - 1
    return out


def _hashes(lines: list[str]) -> list[int]:
    import zlib

    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) - (1 << 31) for x in lines]


def addresses(pages: DataFrame) -> DataFrame:
    """page_id, _row, host, path and the line hashes of each page; host is null for pages without usable URL."""
    def run(frames):
        for frame in frames:
            hosts, paths, hashes = [], [], []
            for url, page in zip(frame["url"], frame["html"]):
                try:
                    parts = urlsplit(url or "")
                    hosts.append(parts.netloc.lower() or None)
                    paths.append(parts.path)
                except ValueError:
                    hosts.append(None)
                    paths.append("")
                hashes.append(_hashes(lines_of(page or "")[0]))
            yield pd.DataFrame({"page_id": frame["page_id"], "_row": frame["_row"], "host": hosts, "path": paths, "hashes": hashes})

    return pages.select("page_id", row_hash(F.col("url"), F.col("html")).alias("_row"), "url", "html").mapInPandas(
        run, "page_id bigint, _row bigint, host string, path string, hashes array<int>")


def template_lines(pages: DataFrame) -> DataFrame:
    """(page_id, _row, drop): places of the lines each page shares with its nearest page. Pages alone on a host have none."""
    known = addresses(pages).where(F.col("host").isNotNull()).distinct().withColumn("one", F.lit(1).cast("bigint"))
    ranked = prefix_sums(known, ["host"], ["path", "page_id", "_row"], "one", "page-order").select(
        "host", F.col("_before").alias("rank"), *KEY, "path", "hashes")

    def beside(step: int, name: str) -> DataFrame:
        return ranked.select("host", (F.col("rank") - step).alias("rank"), F.struct("path", "hashes").alias(name))

    # A place in the order is taken once, so these joins are even, whatever the host.
    both = ranked.join(beside(-1, "before"), ["host", "rank"], "left").join(beside(1, "after"), ["host", "rank"], "left")

    def run(frames):
        import os.path

        for frame in frames:
            out = []
            for path, own, before, after in zip(frame["path"], frame["hashes"], frame["before"], frame["after"]):
                near = [x for x in (before, after) if x is not None]
                mate = max(near, key=lambda x: len(os.path.commonprefix([path, x["path"]])), default=None)
                out.append([] if mate is None else sorted(shared(list(own), list(mate["hashes"]))))
            yield pd.DataFrame({"page_id": frame["page_id"], "_row": frame["_row"], "drop": out})

    return both.select(*KEY, "path", "hashes", "before", "after").mapInPandas(run, "page_id bigint, _row bigint, drop array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and `text` of every row of `pages` (page_id, url, html).

    If a page has text in an article or main element, that is its text. Otherwise it is all wanted lines that
    the nearest page doesn't share; if it shares all of them (a copy), they all stay. Null and empty pages have empty
    texts. Repeated rows are treated alike; pages without URL are not paired; other columns are not looked at."""
    drops = template_lines(pages).where(F.size("drop") > 0)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), row_hash(F.col("url"), F.col("html")).alias("_row"), "url", "html")

    def run(frames):
        for frame in frames:
            out = []
            for page, drop in zip(frame["html"], frame["drop"]):
                lines, marks = lines_of(page or "")
                gone = set() if drop is None else set(np.asarray(drop).tolist())
                # Shared lines go, but for those of the article; an article also rules out what stands beside it.
                stay = [x for i, x in enumerate(lines) if marks[i] == ARTICLE or i not in gone]
                if ARTICLE in marks:
                    stay = [x for x, m in zip(lines, marks) if m == ARTICLE]
                out.append(" ".join(stay or lines))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": out})

    return null_safe(rows, drops, KEY, "left").mapInPandas(run, "page_id bigint, url string, text string")
