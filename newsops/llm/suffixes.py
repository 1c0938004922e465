"""Suffix-array deduplication of byte strings.

Runs of windows that may repeat (see runs.py), each with the bytes its windows
cover, are dealt to shards by their least gram, so that equal strings meet.  Each
shard sorts its suffixes by Larsson-Sadakane refinement, finds common prefixes
by Kasai's method, and groups the places that share ``window`` bytes.  A gram with
more text than a shard takes is dealt to several; those shards' sorted lists of
distinct strings are merged by binary search."""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsops.llm import runs as R, words as W
from newsops.session import materialise

WINDOW = 400
GRAM = 64
SHARD_BYTES = 1 << 20
#: A split gram's lists of strings are cut into so many ranges for each of its shards.
RANGES = 16
LANES = 4096


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, zeros past the end."""
    x = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for i in range(8):
        x = x << np.uint64(8) | padded[i:i + len(data)]
    return x


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes that begin there.

    Groups of equal prefixes are refined by the rank of what follows, and the
    prefix doubles; places alone in their group are settled and left out."""
    n = len(data)
    key = eights(data)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if n else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    size = np.diff(np.append(head, n))
    rank[order] = np.repeat(head, size)
    todo = np.flatnonzero(np.repeat(size > 1, size))
    h = 8
    while len(todo):
        place = order[todo]
        follow = place + h
        nxt = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        group = rank[place]
        by = np.argsort(group * (n + 1) + nxt)
        place, group, nxt = place[by], group[by], nxt[by]
        order[todo] = place
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(todo)))
        rank[place] = np.repeat(todo[first], size)
        todo = todo[np.repeat(size > 1, size)]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int, lanes: int = LANES) -> np.ndarray:
    """Length (up to ``depth``) of what each suffix in order shares with the one
    before it.  Kasai's walk through the text, which keeps all but one byte of the
    length from a place to the next, goes in many lanes at once."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    block = -(-n // lanes) if n else 0
    at = np.arange(0, n, block) if n else np.zeros(0, np.int64)
    end = np.minimum(at + block, n)
    h = np.zeros(len(at), np.int64)
    key = eights(data)
    while len(at):
        other = before[at]
        x, y = at + h, other + h
        inside = (other >= 0) & (h < depth) & (x < n) & (y < n)
        same = np.zeros(len(at), np.int64)
        i = np.flatnonzero(inside)
        diff = key[x[i]] ^ key[y[i]]
        # Equal leading bytes of two eights, never past the text's end.
        equal = (diff == 0).astype(np.int64)
        for k in range(8, 64, 8):
            equal += diff < np.uint64(1 << k)
        same[i] = np.minimum(np.minimum(equal, n - np.maximum(x[i], y[i])), depth - h[i])
        h += same
        done = same < 8
        d = np.flatnonzero(done)
        shared[at[d]] = h[d]
        at[d] += 1
        h[d] = np.maximum(h[d] - 1, 0)
        left = at < end
        if not left.all():
            at, end, h = at[left], end[left], h[left]
    return shared[order]


def repeated_starts(texts: list[bytes], starts: list[int], window: int):
    """(place's text, its offset, group) of the first ``starts`` places of each text
    in sorted order; places of a group share ``window`` bytes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0] + [len(t) for t in texts])
    order = suffix_array(data)
    shared = common_prefixes(data, order, window)
    group = np.cumsum(shared < window)
    whose = np.searchsorted(begin, order, "right") - 1
    offset = order - begin[whose]
    real = offset < np.asarray(starts)[whose]
    return whose[real], offset[real], group[real]


def _facts(window: int, gram: int):
    def scan(batches):
        for batch in batches:
            sizes, shas, found = [], [], []
            for part in W.slices(batch.column(2)):
                data, off = part.data, part.offsets
                grams = W.rolling(data.astype(np.uint64) + np.uint64(1), gram)
                n = max(len(data) - window + 1, 0)
                row_of = np.repeat(np.arange(part.rows), np.diff(off))
                valid = row_of[:n] == row_of[window - 1:] if n else np.zeros(0, bool)
                place, first, end = W.owned(grams, valid, window - gram + 1)
                a = grams[place].view(np.int64)
                r = W.span_hash(W.running(data.astype(np.uint64) + np.uint64(1)), first, end + window - 1).view(np.int64)
                row = row_of[first]
                cut = np.searchsorted(row, np.arange(part.rows + 1))
                local, n = first - off[row], end - first
                for i in range(part.rows):
                    sizes.append(int(off[i + 1] - off[i]))
                    shas.append(hashlib.sha256(data[off[i]:off[i + 1]].tobytes()).hexdigest())
                    x = slice(cut[i], cut[i + 1])
                    found.append([{"a": p, "r": q, "first": f, "n": m} for p, q, f, m in
                                  zip(a[x].tolist(), r[x].tolist(), local[x].tolist(), n[x].tolist())])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("r", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])))],
                names=["doc", "rid", "n_bytes", "sha", "runs"])
    return scan


def _pieces(window: int):
    def scan(batches):
        """Bytes of the runs to compare."""
        for batch in batches:
            raw = batch.column(2).cast(pa.large_binary()).to_pylist()
            rows = [(s["a"], s["r"], s["n"], s["n_rows"], text[s["first"]:s["first"] + s["n"] + window - 1])
                    for text, spots in zip(raw, batch.column(3).to_pylist()) for s in spots if s["compare"]]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                names=["a", "r", "n", "n_rows", "piece"])
    return scan


def _sort(window: int):
    def work(shard: pd.DataFrame) -> pd.DataFrame:
        """Repeated places of the shard's pieces, as spans; for a gram that has other
        shards too, also sorted lists of its distinct strings' keys, by range, each
        with one place."""
        shard = shard.drop_duplicates(["a", "r"]).reset_index(drop=True)
        a, r, pieces = shard["a"].to_numpy(), shard["r"].to_numpy(), shard["piece"].tolist()
        whose, offset, group = repeated_starts(pieces, shard["n"].tolist(), window)
        lead = np.diff(group, prepend=-1) != 0
        which = np.cumsum(lead) - 1
        often = np.bincount(which, shard["n_rows"].to_numpy()[whose])[which] > 1
        begin = np.cumsum([0] + [len(p) for p in pieces])
        mask = np.zeros(begin[-1], bool)
        mask[(begin[whose] + offset)[often]] = True
        first, end = W.runs(mask)  # a piece ends with places that start no window
        at = np.searchsorted(begin, first, "right") - 1
        spans = pd.DataFrame({"shard": shard["shard"][0], "a": a[at], "r": r[at], "first": first - begin[at], "n": end - first})
        lists = []
        for gram, parts in shard[shard["parts"] > 1].groupby("a")["parts"].first().items():
            j = np.flatnonzero(lead & (a[whose] == gram))
            keys = np.array([hashlib.md5(pieces[w][o:o + window]).digest() for w, o in zip(whose[j].tolist(), offset[j].tolist())], "S16")
            by = np.argsort(keys)
            j, keys = j[by], keys[by]
            where = ranges(keys, RANGES * parts)
            for x, y in zip(*_groups(where)):
                lists.append((shard["shard"][0], gram, int(where[x]), keys[x:y].tobytes(), r[whose[j[x:y]]].tolist(), offset[j[x:y]].tolist()))
        lists = pd.DataFrame(lists, columns=["shard", "a", "range", "keys", "rs", "firsts"])
        out = pd.concat([x.astype(object) for x in (spans, lists) if len(x)] or [spans.astype(object)]).reindex(
            columns=["shard", "a", "r", "first", "n", "range", "keys", "rs", "firsts"]).astype(object)
        return out.where(out.notna(), None)
    return work


def _groups(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where each run of equal values begins and ends."""
    first = np.flatnonzero(np.diff(values, prepend=-1)).tolist()
    return first, [*first[1:], len(values)]


def ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of keys each key lies in."""
    head = np.frombuffer(keys.tobytes(), ">u4")[::4].astype(np.int64)
    return head * parts >> 32


def _merge(lists: pd.DataFrame) -> pd.DataFrame:
    """Strings that several shards have: each shard's sorted list is looked up in
    all the lists together, by binary search."""
    every = [np.frombuffer(k, "S16") for k in lists["keys"]]
    both = np.sort(np.concatenate(every))
    out = []
    for keys, rs, firsts in zip(every, lists["rs"], lists["firsts"]):
        met = np.searchsorted(both, keys, "right") - np.searchsorted(both, keys, "left") > 1
        out.append(pd.DataFrame({"a": lists["a"].iloc[0], "r": np.asarray(rs)[met], "first": np.asarray(firsts)[met], "n": 1}))
    return pd.concat(out)


def _remove(window: int):
    def scan(batches):
        for batch in batches:
            spots = batch.column(3).to_pylist()
            removed, spans, shas, kept = [], [], [], []
            for part in W.slices(batch.column(2)):
                for i in range(part.rows):
                    data = part.data[part.offsets[i]:part.offsets[i + 1]]
                    mine = spots[part.first + i]
                    gone = W.covered(np.array([x["first"] for x in mine], np.int64),
                                     np.array([x["n"] + window - 1 for x in mine], np.int64), len(data))
                    a, b = W.runs(gone)
                    rest = data[~gone].tobytes()
                    removed.append(int(gone.sum()))
                    spans.append([{"first": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
                    shas.append(hashlib.sha256(rest).hexdigest())
                    kept.append(rest)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["doc", "rid", "n_removed", "new", "spans", "kept"])
    return scan


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, kept_sha256, spans, kept) of every row of
    ``docs`` (doc_id, text): spans are the removed byte intervals, kept the
    remaining bytes (null where nothing goes, or without ``with_text``).

    A byte goes if a string of ``window`` bytes over it also starts elsewhere, in
    any row or the same.  Null texts are empty.  Repeated rows repeat their whole
    text if it has ``window`` bytes; doc_id may be null or repeated."""
    rows = R.keyed(docs)
    facts = materialise(rows.select("doc", "rid", "text").mapInArrow(
        _facts(window, gram), f"doc long, rid long, n_bytes long, sha string, runs {R.RUN}"), "suffix-facts")
    occ = R.occurrences(facts)
    live = materialise(R.shared(occ).select("a", "r", "n_rows", "rep", (F.col("classes") > 1).alias("several")), "suffix-classes")
    compare = F.col("several") & (F.struct("doc", "rid", "first") == F.col("rep"))
    met = materialise(occ.join(live, ["a", "r"]).withColumn("compare", compare).drop("rep", "several"), "suffix-runs")
    spots = met.where("compare or n_rows > 1").groupBy("doc", "rid").agg(
        F.collect_set(F.struct("a", "r", "first", "n", "n_rows", "compare")).alias("spots"))
    spot = "array<struct<a:bigint,r:bigint,first:int,n:int,n_rows:bigint,compare:boolean>>"
    marked = materialise(rows.select("doc", "rid", "text").join(spots, ["doc", "rid"]).withColumn("spots", F.col("spots").cast(spot)), "suffix-texts")
    pieces = marked.select("doc", "rid", "text", "spots").mapInArrow(_pieces(window), "a long, r long, n int, n_rows long, piece binary")
    sizes = materialise(met.where("compare").groupBy("a").agg(F.sum(F.col("n") + window - 1).alias("bytes")), "suffix-sizes")
    shards = 1 + (sizes.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes
    large = sizes.where(F.col("bytes") > shard_bytes).select("a", F.ceil(F.col("bytes") / shard_bytes).alias("parts"))
    dealt = pieces.join(large, "a", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "shard", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("a"), F.lit(shards))).otherwise(
            F.xxhash64("a", F.pmod(F.xxhash64("r"), "parts"))))
    found = materialise(dealt.groupBy("shard").applyInPandas(
        _sort(window), "shard long, a long, r long, first int, n int, range int, keys binary, rs array<bigint>, firsts array<int>"), "suffix-found")
    apart = found.where("range is not null").groupBy("a", "range").applyInPandas(
        _merge, "a long, r long, first int, n int")
    repeated = found.where("range is null").select("a", "r", "first", "n").unionAll(apart).groupBy("a", "r").agg(
        F.collect_set(F.struct("first", "n")).alias("found"))
    # A class with several rows repeats whole; of a single one, what its shard found.
    whole = met.where("n_rows > 1").select("doc", "rid", "first", "n")
    part = met.where("n_rows = 1").select("a", "r", "doc", "rid", F.col("first").alias("base")).join(
        repeated, ["a", "r"]).select("doc", "rid", "base", F.explode("found").alias("x")).select(
        "doc", "rid", (F.col("base") + F.col("x.first")).alias("first"), "x.n")
    gone = whole.unionAll(part).groupBy("doc", "rid").agg(F.collect_set(F.struct("first", "n")).alias("gone"))
    done = marked.select("doc", "rid", "text").join(gone, ["doc", "rid"]).mapInArrow(
        _remove(window), "doc long, rid long, n_removed long, new string, spans array<struct<first:bigint,end:bigint>>, kept binary")
    if not with_text:
        done = done.withColumn("kept", F.lit(None).cast("binary"))
    done = done.dropDuplicates(["doc", "rid"])
    return facts.drop("runs").join(done, ["doc", "rid"], "left").select(
        F.when(F.col("doc") > R.NO_ID, F.col("doc")).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("new", "sha").alias("kept_sha256"), "spans", "kept")
