"""Words and windows of many texts at once, as arrays over their UTF-8 bytes.

Texts are taken in slices of about 256 KB, so memory doesn't depend on the size
of a batch; a longer text makes a slice of its own."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Bytes that end a word: space and 9-13; for a word of benchmark text, all ASCII but a-z and 0-9.
BLANKS = np.ones(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = _powers[int(base)] = np.cumprod(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BASE, n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(INVERSE, n + 1)[:n - width + 1])


def slid(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum (``best``) of every ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.zeros(0, values.dtype)
    pad = -n % width
    fill = NONE if best is np.minimum else np.uint64(0)
    rows = np.concatenate([values, np.full(pad, fill, values.dtype)]).reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    behind = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n - width + 1], ahead[width - 1:n])


def owned(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of ``width`` grams with the same least gram (the first of
    equals): the gram's place, the run's first window and the one after its last.

    ``valid`` marks windows (by first gram) that lie in one text.  Each window is
    in one run, and equal windows have the same least gram at the same distance."""
    n = len(grams) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none
    places = np.arange(len(grams), dtype=np.uint64)
    least = slid(grams >> np.uint64(32) << np.uint64(32) | places, width, np.minimum)
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    place[~valid[:n]] = -1
    first = np.flatnonzero(np.diff(place, prepend=-2))
    end = np.append(first[1:], n)
    real = place[first] >= 0
    return place[first][real], first[real], end[real]


def span_hash(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values first .. end - 1, of running sums as in rolling()."""
    return mix((sums[end] - sums[first]) * powers(INVERSE, len(sums))[first] + (end - first).astype(np.uint64) * BASE)


def running(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return sums


class Slice:
    """Rows ``first`` .. ``last`` of a batch: bytes, and where each text begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.rows = len(offsets) - 1

    def words(self, inside: np.ndarray, lower: bool) -> "Words":
        return Words(self, inside, lower)


class Words:
    """start, end (bytes), doc (row in the slice) and hash of each word; a row's
    words are ``bounds[row]`` to ``bounds[row + 1]``."""

    def __init__(self, part: Slice, inside: np.ndarray, lower: bool):
        data = ASCII_LOWER[part.data] if lower else part.data
        self.data, n = data, len(data)
        mask = inside[data]
        starts, ends = mask.copy(), mask.copy()
        starts[1:] &= ~mask[:-1]
        ends[:-1] &= ~mask[1:]
        off = part.offsets
        full = np.flatnonzero(off[1:] > off[:-1])
        starts[off[full]] = mask[off[full]]
        ends[off[full + 1] - 1] = mask[off[full + 1] - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, off)
        self.count = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(part.rows), self.count)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * powers(INVERSE, n + 1)[self.start])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each ``width`` words, and whether they lie in one text."""
        h = rolling(self.hash, width)
        return h, self.doc[:len(h)] == self.doc[width - 1:width - 1 + len(h)]

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def slices(column: pa.Array) -> Iterator[Slice]:
    """A text column (null: empty) in slices."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        last = min(last, n)
        yield Slice(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def covered(firsts: np.ndarray, widths, size: int) -> np.ndarray:
    """Which of ``size`` places lie in some [first, first + width)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, firsts + widths, -1)
    return np.cumsum(change[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each maximal run of true."""
    change = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)
