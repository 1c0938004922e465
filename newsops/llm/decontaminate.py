"""Benchmark decontamination: a broadcast hash set of the test n-grams, a scan of
the documents' windows, and a check of each hit against the words themselves.

The documents are scanned where they lie; nothing of them is shuffled.  Test
items are broadcast in blocks of at most ``block_bytes`` of text.  More blocks
are more scans of the same rows in the same task, one after the other, so what
a worker holds doesn't grow with the number of items."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsops.llm import words as W

WIDTH = 10
BLOCK_BYTES = 16 << 20
HITS, ITEMS, COUNT = "_hits", "_items", "_words"


class Windows:
    """Windows of a block of items: hash to (item, words), per window width."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, dict]] = {}
        found: dict[int, dict[int, dict[bytes, set[str]]]] = {}
        for item, text in items:
            part = next(W.slices(pa.array([text])))
            w = part.words(W.ALNUM, True)
            n = len(w.start)
            if not n:
                continue
            wide = min(width, n)
            for i, h in enumerate(w.windows(wide)[0].tolist()):
                words = b" ".join(w.text(j) for j in range(i, i + wide))
                found.setdefault(wide, {}).setdefault(h, {}).setdefault(words, set()).add(item)
        for wide, table in found.items():
            keys = np.array(sorted(table), np.uint64)
            maybe = np.zeros(1 << 20, bool)
            maybe[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.by_width[wide] = keys, maybe, {h: [(x, sorted(y - {None})) for x, y in v.items()]
                                                for h, v in table.items()}


def scan_slice(part: W.Slice, windows: Windows) -> tuple[np.ndarray, np.ndarray, list[set[str]], W.Words]:
    """Hit mask over the slice's words, and the items that occur in each row."""
    w = part.words(W.ALNUM, True)
    hit = np.zeros(len(w.start), bool)
    items: list[set[str]] = [set() for _ in range(part.rows)]
    for wide, (keys, maybe, table) in windows.by_width.items():
        h, valid = w.windows(wide)
        some = np.flatnonzero(valid & maybe[(h >> np.uint64(44)).astype(np.int64)])
        for i in some[np.isin(h[some], keys)].tolist():
            words = b" ".join(w.text(j) for j in range(i, i + wide))
            for known, whose in table[int(h[i])]:
                if known == words:  # the hash alone doesn't decide
                    hit[i:i + wide] = True
                    items[int(w.doc[i])].update(whose)
    return hit, w.bounds, items, w


def blocks(benchmark: DataFrame, block_bytes: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 + int(size) // block_bytes


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with _words (number of words), _hits (array of [first, end) word
    spans inside occurrences of test windows) and _items (sorted items that occur).

    ``benchmark`` has item_id and text.  Words are runs of a-z, 0-9 and
    non-ASCII after lower-casing A-Z.  An item with fewer than ``width`` words is
    one window.  Null and empty texts have no words; an item without words never
    occurs; repeated items count once; words of an item without an id are hit, but
    it isn't listed.  Further columns pass through; older columns of these three
    names are replaced."""
    return _scanned(docs, benchmark, width, block_bytes).withColumn(HITS, F.transform(
        _pairs(HITS), lambda i: F.struct(F.get(HITS, i).alias("first"), F.get(HITS, i + 1).alias("end"))))


def cleaned(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """cut() of decontaminate()'s rows but those that are nothing but hits.  One Python
    worker a task does both: a function after another would have a worker of its own."""
    return _scanned(docs, benchmark, width, block_bytes, cut_too=True)


def _scanned(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int, cut_too: bool = False) -> DataFrame:
    """decontaminate()'s rows with flat spans, or cleaned()'s."""
    docs = docs.drop(COUNT, HITS, ITEMS)
    sc = docs.sparkSession.sparkContext
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        "text is not null").distinct()
    n = blocks(texts, block_bytes)
    out = docs.withColumns({COUNT: F.lit(0).cast("long"), HITS: F.array().cast("array<bigint>"),
                            ITEMS: F.array().cast("array<string>")})
    schema = out.schema
    for b in range(n):
        mine = texts if n == 1 else texts.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b)
        known = sc.broadcast(Windows([tuple(r) for r in mine.toLocalIterator()], width))
        text_at = docs.columns.index("text")
        if cut_too and b == n - 1:
            return out.mapInArrow(cleaner(known, text_at, docs.columns), docs.schema)
        out = out.mapInArrow(scanner(known, text_at), schema)
    return out


def _pairs(spans: str):
    """Indexes of the first of each two."""
    return F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.size(spans) - 2, F.lit(2))).otherwise(
        F.array().cast("array<int>"))


def scanner(known, text_at: int):
    def scan(batches):
        windows = known.value
        for batch in batches:
            counts, hits, items = [], [], []
            before = batch.column(batch.num_columns - 2).to_pylist()
            had = batch.column(batch.num_columns - 1).to_pylist()
            for part in W.slices(batch.column(text_at)):
                hit, bounds, whose, _ = scan_slice(part, windows)
                touched = {int(d) for d in np.searchsorted(bounds, np.flatnonzero(hit), "right") - 1}
                for r in range(part.rows):
                    row = part.first + r
                    counts.append(int(bounds[r + 1] - bounds[r]))
                    if r in touched or before[row]:
                        mask = hit[bounds[r]:bounds[r + 1]].copy()
                        for a, b in zip(before[row][::2], before[row][1::2]):
                            mask[a:b] = True
                        hits.append(np.stack(W.runs(mask), 1).ravel().tolist())
                    else:
                        hits.append([])
                    items.append(sorted(whose[r].union(had[row])) if whose[r] or had[row] else [])
            new = [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int64())),
                   pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(batch.columns[:-3] + new, names=batch.schema.names)
    return scan


def cleaner(known, text_at: int, names: list[str]):
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def left(batches):
        for batch in scanner(known, text_at)(batches):
            counts, flat = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            spans = [[{"first": a, "end": b} for a, b in zip(s[::2], s[1::2])] for s in flat]
            stay = [not s or sum(x["end"] - x["first"] for x in s) < n for s, n in zip(spans, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(spans, spans_type)], names=[*names, HITS]).filter(
                pa.array(stay, pa.bool_()))

    return lambda batches: cutter(text_at, len(names), names)(left(batches))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of decontaminate()'s rows."""
    return found.select(
        "doc_id", F.col(COUNT).alias("n_words"),
        F.aggregate(HITS, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"]).alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"), F.sha2(F.array_join(ITEMS, ","), 256).alias("items_sha256"),
        (F.size(HITS) > 0).alias("contaminated"))


def cut(found: DataFrame) -> DataFrame:
    """Documents without the hit words: the text between the first and the last
    byte of each hit span goes, other characters stay as they are.  A document
    with nothing but hits keeps an empty text; null texts stay null."""
    names = [c for c in found.columns if c not in (COUNT, HITS, ITEMS)]
    return found.mapInArrow(cutter(found.columns.index("text"), found.columns.index(HITS), names),
                            found.select(*names).schema)


def cutter(text_at: int, hits_at: int, names: list[str]):
    def remove(batches):
        for batch in batches:
            texts, spans = batch.column(text_at).to_pylist(), batch.column(hits_at).to_pylist()
            for i, found in enumerate(spans):
                if found:
                    texts[i] = without(texts[i], found)
            cols = [pa.array(texts, batch.column(text_at).type) if n == "text" else batch.column(batch.schema.get_field_index(n))
                    for n in names]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return remove


def without(text: str, found: list[dict]) -> str:
    part = next(W.slices(pa.array([text])))
    w, raw, kept, at = part.words(W.ALNUM, True), text.encode(), [], 0
    for s in found:
        kept.append(raw[at:w.start[s["first"]]])
        at = int(w.end[s["end"] - 1])
    return b"".join([*kept, raw[at:]]).decode()
