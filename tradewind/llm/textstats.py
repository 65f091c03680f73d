"""Counts of texts and of their lines, for whole blocks of texts at a time."""

from __future__ import annotations

import numpy as np

from tradewind.llm.wordhash import Block, mixed

_BYTES = np.arange(256)
SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128)
UPPER = LETTER & (_BYTES < 97)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
POINT = np.isin(_BYTES, list(b".,;:?"))
BANG, PIPE = _BYTES == 33, _BYTES == 124
BEGINS = (_BYTES & 0xC0) != 0x80  # bytes that begin a code point
_U = np.uint64
WINDOW = 5


def _sums(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def _within(flags: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner[flags], minlength=n)


def firsts(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where the owner has this hash for the first time."""
    first = np.zeros(len(hashes), bool)
    first[np.unique(hashes ^ mixed(owner.astype(_U) + _U(1)), return_index=True)[1]] = True
    return first


def repeated_words(hashes: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """True for words in windows of `window` words that their text holds twice or more."""
    n = len(hashes)
    covered = np.zeros(n + 1, np.int64)
    runs = n - window + 1
    if runs > 0:
        at = np.flatnonzero(doc[:runs] == doc[window - 1:])
        h = mixed(doc[at].astype(_U) + _U(1))
        for k in range(window):
            h = mixed(h * _U(0x9E3779B97F4A7C15) + hashes[at + k])
        _, which, count = np.unique(h, return_inverse=True, return_counts=True)
        twice = at[count[which] > 1]
        covered[twice] += 1
        np.add.at(covered, twice + window, -1)
    return np.cumsum(covered)[:n] > 0


class Stats:
    """Counts of a block's texts (attributes with one entry per text) and lines (names with `line_`)."""

    def __init__(self, block: Block):
        block.words()
        n, data, at = block.n, block.data, block.at
        self.n = n
        h = block.hashes(fold=False)
        doc = block.doc
        repeated = repeated_words(h, doc)
        begins = _sums(BEGINS[data])
        word_chars = begins[block.end] - begins[block.start]
        sums = {name: _sums(table[data]) for name, table in (
            ("symbols", SYMBOL), ("letters", LETTER), ("upper", UPPER), ("digits", DIGIT), ("points", POINT),
            ("bangs", BANG), ("pipes", PIPE))}
        per_text = lambda s: s[at[1:]] - s[at[:-1]]
        self.n_words = np.bincount(doc, minlength=n)
        self.word_chars = np.bincount(doc, word_chars, n).astype(np.int64)
        self.n_repeat_words = _within(repeated, doc, n)
        self.counts = {name: per_text(s) for name, s in sums.items()}
        self.n_symbols = self.counts["symbols"]
        self.n_distinct = _within(firsts(h, doc), doc, n)
        echo = np.zeros(len(h), bool)
        if len(h):
            echo[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        self.n_echo = _within(echo, doc, n)
        self.n_long = _within(word_chars > 12, doc, n)
        self.n_short = _within(word_chars < 4, doc, n)

        breaks = np.flatnonzero(data == 10)
        line_doc = np.concatenate((np.arange(n), np.searchsorted(at, breaks, "right") - 1))
        start = np.concatenate((at[:-1], breaks + 1))
        order = np.lexsort((start, line_doc))
        self.line_doc, start = line_doc[order], start[order]
        last = np.append(self.line_doc[1:] != self.line_doc[:-1], True) if n else np.zeros(0, bool)
        end = np.append(start[1:] - 1, 0) if n else start
        end[last] = at[self.line_doc[last] + 1]
        # Words do not cross line breaks, which are white space.
        word_line = np.searchsorted(start, block.start, "right") - 1
        lines = len(start)
        self.line_words = np.bincount(word_line, minlength=lines)
        self.line_chars = begins[end] - begins[start]
        self.line_counts = {name: s[end] - s[start] for name, s in sums.items()}
        self.line_repeat = np.bincount(word_line[repeated | echo], minlength=lines)
        self.line_stop = np.isin(data[np.maximum(end - 1, 0)], list(b".!?")) & (end > start) if len(data) else np.zeros(lines, bool)
        again = ~firsts(block.spans(start, end), self.line_doc) & (self.line_words > 0)
        self.line_again = again
        self.line_last = last
        self.n_lines = np.bincount(self.line_doc, minlength=n)
        self.n_dup_lines = _within(again, self.line_doc, n)
