"""Substring deduplication by Rabin-Karp hashes of every fixed-length window of
words: counted in Spark, repeated windows merge into maximal removal intervals.

A word goes if a window that covers it also starts in a document with a smaller
doc_id.  Only windows in runs that may repeat (see runs.py) are counted."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsops.llm import runs as R, words as W
from newsops.session import materialise

WINDOW = 50
GRAM = 10


def _facts(window: int, gram: int):
    def scan(batches):
        """Row's number of words, hash of its words, and runs of windows."""
        for batch in batches:
            counts, shas, found = [], [], []
            for part in W.slices(batch.column(2)):
                w = part.words(W.BLANKS, False)
                grams, _ = w.windows(gram)
                _, valid = w.windows(window)
                sums = W.running(w.hash)
                place, first, end = W.owned(grams, valid, window - gram + 1)
                a = grams[place].view(np.int64)
                r = W.span_hash(sums, first, end + window - 1).view(np.int64)
                row = w.doc[first] if len(first) else first
                cut = np.searchsorted(row, np.arange(part.rows + 1))
                local = first - w.bounds[row] if len(first) else first
                n = end - first
                for i in range(part.rows):
                    counts.append(int(w.count[i]))
                    shas.append(kept_hash(w, i, None))
                    x = slice(cut[i], cut[i + 1])
                    found.append([{"a": p, "r": q, "first": f, "n": m} for p, q, f, m in
                                  zip(a[x].tolist(), r[x].tolist(), local[x].tolist(), n[x].tolist())])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
                pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("r", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])))],
                names=["doc", "rid", "n_words", "sha", "runs"])
    return scan


def kept_hash(w: W.Words, row: int, gone: np.ndarray | None) -> str:
    """sha256 of the row's words, those of ``gone`` left out, joined by a space."""
    a, b = w.bounds[row], w.bounds[row + 1]
    at = np.arange(a, b) if gone is None else a + np.flatnonzero(~gone)
    return hashlib.sha256(kept_bytes(w, at)).hexdigest()


def kept_bytes(w: W.Words, at: np.ndarray) -> bytes:
    if not len(at):
        return b""
    # Each word with the byte after it made a space; the last space goes.
    size = w.end[at] - w.start[at] + 1
    begin = np.cumsum(size) - size
    source = np.repeat(w.start[at] - begin, size) + np.arange(int(size.sum()))
    out = np.append(w.data, np.uint8(32))[source]
    out[begin + size - 1] = 32
    return out[:-1].tobytes()


def _windows(window: int):
    def scan(batches):
        """Windows (hash, place) of the runs to compare, beside the text."""
        for batch in batches:
            spots, found = batch.column(3).to_pylist(), []
            for part in W.slices(batch.column(2)):
                w = part.words(W.BLANKS, False)
                h, _ = w.windows(window)
                for i in range(part.rows):
                    base = w.bounds[i]
                    at = [np.arange(s["first"], s["first"] + s["n"]) for s in spots[part.first + i] if s["compare"]]
                    at = np.concatenate(at) if at else np.zeros(0, np.int64)
                    found.append([{"h": x, "at": p} for x, p in zip(h[base + at].view(np.int64).tolist(), at.tolist())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))],
                names=["doc", "rid", "text", "spots", "windows"])
    return scan


def _remove(window: int):
    def scan(batches):
        """Rows' removed words (spans) and what is left."""
        for batch in batches:
            spots, hits = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            removed, shas, texts, spans = [], [], [], []
            for part in W.slices(batch.column(2)):
                w = part.words(W.BLANKS, False)
                for i in range(part.rows):
                    row = part.first + i
                    whole = [s for s in spots[row] if s["gone"]]
                    first = np.array([s["first"] for s in whole] + (hits[row] or []), np.int64)
                    wide = np.array([s["n"] + window - 1 for s in whole] + [window] * len(hits[row] or []), np.int64)
                    gone = W.covered(first, wide, int(w.count[i]))
                    removed.append(int(gone.sum()))
                    shas.append(kept_hash(w, i, gone))
                    a, b = W.runs(gone)
                    spans.append([{"first": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
                    texts.append(kept_bytes(w, w.bounds[i] + np.flatnonzero(~gone)).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas), pa.array(texts),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
                names=["doc", "rid", "n_removed", "sha", "kept", "spans"])
    return scan


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans, kept) of every row of
    ``docs`` (doc_id, text): spans are the removed intervals of words, kept the
    remaining words joined by a space (null where nothing goes: the text stays;
    without ``with_text`` always null).

    Null and empty texts have no words.  Rows without doc_id lose nothing and
    take nothing from others; rows that share a doc_id don't count against each
    other.  Windows are judged on the input."""
    rows = R.keyed(docs)
    facts = materialise(rows.select("doc", "rid", "text").mapInArrow(
        _facts(window, gram), f"doc long, rid long, n_words long, sha string, runs {R.RUN}"), "passages-facts")
    occ = R.occurrences(facts.where(F.col("doc") > R.NO_ID))
    live = R.shared(occ).where("least_doc < most_doc").select(
        "a", "r", F.col("doc").alias("class_doc"), "least_doc", (F.col("classes") > 1).alias("several"))
    live = materialise(live, "passages-classes")
    gone = F.col("class_doc") < F.col("doc")
    spots = (occ.join(live, ["a", "r"])
             .withColumns({"gone": gone, "compare": F.col("several") & ~gone}).where("gone or compare")
             .groupBy("doc", "rid").agg(F.collect_set(F.struct("first", "n", "gone", "compare")).alias("spots")))
    marked = materialise(rows.select("doc", "rid", "text").join(spots, ["doc", "rid"]).mapInArrow(
        _windows(window), "doc long, rid long, text string, spots array<struct<first:int,n:int,gone:boolean,compare:boolean>>, "
                          "windows array<struct<h:bigint,at:int>>"), "passages-windows")
    windows = marked.select("doc", "rid", F.explode("windows").alias("w")).select("doc", "rid", "w.h", "w.at")
    repeated = materialise(windows.groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most"), "passages-repeated")
    hits = windows.join(repeated.select("h", "least"), "h").where("doc > least").groupBy("doc", "rid").agg(F.collect_set("at").alias("hits"))
    done = marked.drop("windows").join(hits, ["doc", "rid"], "left").mapInArrow(
        _remove(window), "doc long, rid long, n_removed long, sha string, kept string, spans array<struct<first:bigint,end:bigint>>")
    done = done.where("n_removed > 0")
    if not with_text:
        done = done.withColumn("kept", F.lit(None).cast("string"))
    done = done.withColumnRenamed("sha", "new").dropDuplicates(["doc", "rid"])
    return facts.drop("runs").join(done, ["doc", "rid"], "left").select(
        F.when(F.col("doc") > R.NO_ID, F.col("doc")).alias("doc_id"), "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("new", "sha").alias("kept_sha256"), "spans", "kept")
