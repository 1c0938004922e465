"""Periodic runs of words, by seeds on diagonals that are extended.

A run of period q and length L matches itself, shifted by q, on L - q >= q words:
on the diagonal of lag q it is one maximal stretch of equal words.  For lags from
``k`` to ``2k`` that stretch is at least ``k`` words long, so it holds a whole gram
of ``k / 2`` words that begins at a multiple of ``k / 2``.  These grams are the
seeds.  Each meets only the occurrences of the same gram that lie ``k`` to ``2k``
words further on in its document: at most 2n pairs for each doubling of k, even in
a document of one word repeated, so nothing needs a cap."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsops.functions.text import let

LEAST = 12
SLICE_WORDS = 1 << 16
BLOCK_PAIRS = 1 << 22
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Grams:
    """Names of the grams of one length: equal names for equal grams.  A gram
    that occurs once has a name of its own, at or above the number of words."""

    def __init__(self, names: np.ndarray, width: int, total: int):
        self.width = width
        some, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
        self.name = inverse.astype(np.int64)
        alone = np.flatnonzero(counts[inverse] == 1)
        self.name[alone] = total + alone
        self.repeated = np.flatnonzero(counts[inverse] > 1)

    def then(self, after: "Grams", total: int) -> "Grams":
        """Names of these grams, each followed by one of ``after``."""
        n = len(after.name) - self.width
        if n <= 0:
            return Grams(np.zeros(0, np.int64), self.width + after.width, total)
        return Grams(self.name[:n] * (2 * total) + after.name[self.width:self.width + n], self.width + after.width, total)


def levels(ids: np.ndarray, width: int) -> list[Grams]:
    """Grams of 1 and of ``width`` words."""
    one = Grams(ids, 1, len(ids))
    grown = one
    for _ in range(width - 1):
        grown = grown.then(one, len(ids))
    return [one, grown]


def seeds(grams: Grams, first_lag: int, end_lag: int, ends: np.ndarray):
    """Blocks of (lag, place): grams that begin at a multiple of their width and
    occur again at that lag in the same document."""
    n, w = len(ends), grams.width
    at = grams.repeated
    if not len(at):
        return
    key = grams.name[at] * (n + 1) + at
    key.sort()
    anchors = at[at % w == 0]
    anchors = anchors[anchors + w <= ends[anchors]]
    base = grams.name[anchors] * (n + 1)
    lo = np.searchsorted(key, base + anchors + first_lag)
    last = np.minimum(anchors + end_lag, ends[anchors] - w + 1)
    hi = np.searchsorted(key, base + np.maximum(last, anchors + first_lag))
    found = np.flatnonzero(hi > lo)
    anchors, lo, count, base = anchors[found], lo[found], (hi - lo)[found], base[found]
    total = np.cumsum(count)
    first = 0
    while first < len(anchors):
        end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + BLOCK_PAIRS, "right")))
        c = count[first:end]
        place = np.repeat(anchors[first:end], c)
        skip = np.arange(len(place)) - np.repeat(np.cumsum(c) - c, c)
        other = key[np.repeat(lo[first:end], c) + skip] - np.repeat(base[first:end], c)
        yield other - place, place
        first = end


def covered(lag: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each lag has covered: pieces of one diagonal that touch become one, so
    a stretch is extended once, not once for each of its seeds."""
    order = np.lexsort((first, lag))
    lag, first, end = lag[order], first[order], end[order]
    head = np.ones(len(lag), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (first[1:] > end[:-1])
    tail = np.append(head[1:], True) if len(head) else head
    return lag[head], first[head], end[tail]


def extended(steps: list[Grams], lag: np.ndarray, first: np.ndarray, end: np.ndarray,
             begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each covered piece grown to the whole stretch.  It lacks less than one seed
    on either side, so each shorter gram is tried once, then single words."""
    start, stop, low, high = first.copy(), end.copy(), begins[first], ends[first]
    for g in steps:
        w, n = g.width, len(g.name)
        ok = start - w >= low
        i = np.where(ok, start - w, 0)
        start -= w * (ok & (g.name[i] == g.name[np.minimum(i + lag, n - 1)]))
        ok = stop + lag + w <= high
        i = np.where(ok, stop, 0)
        stop += w * (ok & (g.name[i] == g.name[np.minimum(i + lag, n - 1)]))
    return start, stop


def find(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run in documents that lie one after the
    other in ``ids`` (document d from bounds[d] to bounds[d + 1]), by start, period."""
    counts = np.diff(bounds)
    begins, ends = np.repeat(bounds[:-1], counts), np.repeat(bounds[1:], counts)
    longest, total = int(counts.max(initial=0)), len(ids)
    share = max(2, -(-least // 2))  # words that a run and its shifted self have in common at least
    known, found = levels(ids, share // 2) if longest >= 2 else [], []
    first_lag, end_lag = 1, 2 * share
    while known and 2 * first_lag <= longest and len(known[-1].repeated):
        w, pieces = known[-1].width, []
        for lag, place in seeds(known[-1], first_lag, end_lag, ends):
            pieces.append(covered(lag, place, place + w))
        if pieces:
            lag, a, b = covered(*(np.concatenate(x) for x in zip(*pieces)))
            a, b = extended(known[-2:0:-1] + [known[0]] * (known[1].width - 1), lag, a, b, begins, ends)
            real = b - a >= np.maximum(least - lag, lag)
            found.append((a[real], (b - a + lag)[real], lag[real]))
        known.append(known[-1].then(known[-1], total))
        first_lag, end_lag = end_lag, 2 * end_lag
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found))
    # A multiple of a run's period gives the same stretch of words again.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _slices(texts: list[str | None]):
    """Words of consecutive rows, at most SLICE_WORDS of them unless one text has
    more.  Bytes split at just the blanks that end a word here."""
    part, size = [], 0
    for t in texts:
        w = (t or "").encode().split()
        if part and size + len(w) > SLICE_WORDS:
            yield part
            part, size = [], 0
        part.append(w)
        size += len(w)
    if part:
        yield part


def _scan(least: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches):
        for batch in batches:
            n_words, runs, collapsed = [], [], []
            for part in _slices(batch.column(1).to_pylist()):
                counts = np.array([len(w) for w in part], np.int64)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                flat = pa.array([x for w in part for x in w], pa.large_binary())
                ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                start, length, period = find(ids, bounds, least)
                cut = np.searchsorted(start, bounds)
                for d, w in enumerate(part):
                    some = slice(cut[d], cut[d + 1])
                    first, size, q = start[some] - bounds[d], length[some], period[some]
                    if len(first):
                        change = np.zeros(len(w) + 1, np.int64)
                        np.add.at(change, first + q, 1)
                        np.add.at(change, first + size, -1)
                        w = [x for x, gone in zip(w, np.cumsum(change).tolist()) if not gone]
                    n_words.append(int(counts[d]))
                    runs.append([{"start": a, "length": b, "period": c} for a, b, c in zip(first.tolist(), size.tolist(), q.tolist())])
                    collapsed.append(b" ".join(w).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
    return scan


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text).

    Words end at ASCII blanks.  A run is a maximal stretch with smallest period q,
    at least 2q and ``least`` words long; runs come by start, then period.
    ``collapsed`` is the text without the words that lie in a run after its first q.

    Null, empty and blank texts have no words and no runs.  Rows are taken one by
    one: repeated rows, ties and a missing doc_id change nothing, an empty table
    gives no rows, other columns of ``docs`` are left out.  Nothing is shuffled.  A
    task holds 64 Ki words at a time or one longer text, some 200 bytes a word
    (more only where a long text repeats itself on many lengths)."""
    return docs.select("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        _scan(least), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column, every: int = 10) -> Column:
    """The text, but for one document in ``every`` (by CRC of its id) with a tail
    that repeats: words from ``a`` on start over after ``p`` of them."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / every)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        shape = F.struct(a.cast("int").alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p"))
        place = lambda s, i: F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"])
        return F.when(n > 0, let(shape, lambda s: F.array_join(
            F.transform(w, lambda x, i: F.element_at(w, place(s, i) + 1)), " "))).otherwise("")

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    return F.when(h % every == 0, let(words, repeated)).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """One narrow row per document: number of runs, the longest (of equals the
    first, then the one with the least period), and hashes of runs and remaining words."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
