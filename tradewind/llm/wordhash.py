"""Words of many texts at once: numpy over the bytes of an Arrow column, a bounded block at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18  # a worker holds some 200 bytes for each
_U = np.uint64
_BASE = 0x9E3779B97F4A7C13 | 3  # odd, so that powers can be undone
_rng = np.random.Generator(np.random.PCG64(20240607))
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTES = np.arange(256)
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
# Powers of the base and of its inverse, made longer when a longer block comes.
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        for k, base in enumerate((_BASE % 2**64, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all others."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class Block:
    """Texts first..last of a column: their bytes, and where each begins (one more entry than texts)."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray):
        self.first, self.data, self.at = first, data, at
        self.n = len(at) - 1

    def words(self) -> None:
        """Sets start, end (bytes) and doc of every word; words part at the six ASCII white-space bytes."""
        inside = ~SPACE[self.data]
        before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
        after = np.concatenate((inside[1:], [False])) if len(inside) else inside
        begins = self.at[:-1][self.at[:-1] < len(inside)]
        before[begins] = False
        after[begins[begins > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(self.at, self.start, "right") - 1

    def spans(self, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of every span of bytes; `fold` takes A-Z as lower case."""
        up, down = _power_tables(len(self.data) + 1)
        values = _VALUES[_FOLD] if fold else _VALUES
        total = np.zeros(len(self.data) + 1, _U)
        np.cumsum(values[self.data] * up[:len(self.data)], out=total[1:])
        length = (end - start).astype(_U)
        return mixed((total[end] - total[start]) * down[start] + length * _U(0xD6E8FEB86659FD93))

    def hashes(self, fold: bool) -> np.ndarray:
        """A hash of every word."""
        return self.spans(self.start, self.end, fold)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column in blocks of about `limit` bytes; a longer text is a block of its own, whole. Null is empty."""
    if not len(column):
        return
    flat = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = flat.buffers()
    at = np.frombuffer(offsets, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(flat):
        last = max(int(np.searchsorted(at, at[first] + limit, "right")) - 1, first + 1)
        last = min(last, len(flat))
        yield Block(first, data[at[first]:at[last]], at[first:last + 1] - at[first])
        first = last


def shingles(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of every run of n words in one text, and of the whole of a text with fewer."""
    odd = [_U(int(x) | 1) for x in np.random.Generator(np.random.PCG64(n)).integers(1 << 62, 1 << 63, n + 1)]
    total = len(hashes)
    if not total:
        return hashes, doc
    made = []
    runs = max(total - n + 1, 0)
    whole = np.flatnonzero(doc[:runs] == doc[n - 1:]) if runs else np.zeros(0, np.int64)
    h = np.zeros(len(whole), _U)
    for k in range(n):
        h += hashes[whole + k] * odd[k]
    made.append((mixed(h), doc[whole]))
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    count = np.diff(np.concatenate((first, [total])))
    for size in range(1, n):
        at = first[count == size]
        if len(at):
            h = np.full(len(at), size, _U) * odd[n]
            for k in range(size):
                h += hashes[at + k] * odd[k]
            made.append((mixed(h), doc[at]))
    h, d = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
    if len(made) > 1:
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    return h, d
