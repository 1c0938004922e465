"""Approximate nearest neighbours by cross-polytope hashing.

Fast pseudo-rotations (random signs, then a Hadamard transform, three times)
assign each unit vector to its nearest signed axis; several independent tables
and several probes a table collect candidates, which are ranked by their exact
cosine.

A given query set meets all rows, in blocks of ``BLOCK`` queries that are
broadcast.  Each task hashes its own rows, marks the pairs that share a bucket in
any table as bits, scores those that may be among the best and keeps the best few
per query, so no vector is shuffled and a bucket with a third of all rows is
spread over all tasks.  Work still grows with queries times rows: without
clusters in the data no shorter list of candidates holds nine tenths of the best."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

K = 5
TABLES, PROBES = 16, 5
BLOCK = 4096
PAIRS = 1 << 14
#: Rows of a task that meet a block of queries at once.
ROWS = 512
#: More than rounding can part two ways to the same cosine.
SLACK = 1e-9
#: Squares of shorter vectors lose digits: no product rules them out.
TINY = 1e-140
SEED = 29


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


class Rotations:
    """Signs of ``tables`` pseudo-rotations of ``dim`` (a power of two) axes."""

    def __init__(self, dim: int, tables: int, seed: int = SEED):
        self.dim, self.tables = dim, tables
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, dim))

    def axes(self, unit: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
        """The ``probes`` nearest signed axes of each row: 2 * axis + (1 if negative)."""
        x = unit
        for signs in self.signs[table]:
            x = hadamard(x * signs)
        nearest = np.abs(x).argmax(1)[:, None] if probes == 1 else np.argsort(-np.abs(x), 1, kind="stable")[:, :probes]
        return nearest * 2 + (np.take_along_axis(x, nearest, 1) < 0)


def unit(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that count, vectors padded with zeros, their lengths); null, zero and
    non-finite vectors and those with a null don't count."""
    n = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    x = np.zeros((len(n), dim))
    # A null becomes NaN.
    x[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = vectors.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(all="ignore"):
        size = np.sqrt(np.einsum("ij,ij->i", x, x))
        good = np.isfinite(x).all(1) & (size > 0) & np.isfinite(size)
    return np.flatnonzero(good), x[good], size[good]


class Queries:
    def __init__(self, rows: list, dim: int, rotations: Rotations, probes: int):
        keep, self.x, self.size = unit(pa.array([r[1] for r in rows], pa.list_(pa.float64())), dim)
        self.ids = np.array([rows[i][0] for i in keep], np.int64)
        self.probed = []
        for t in range(rotations.tables):
            code = rotations.axes(self.x / self.size[:, None], t, min(probes, rotations.dim))
            order = np.argsort(code.ravel(), kind="stable")
            first = np.searchsorted(code.ravel()[order], np.arange(2 * rotations.dim + 1))
            self.probed.append((first, order // code.shape[1]))

    def asked(self, table: int) -> np.ndarray:
        """Per bucket of the table one bit for each query: whether it probes there."""
        first, whose = self.probed[table]
        asked = np.zeros((len(first) - 1, len(self.ids)), bool)
        asked[np.repeat(np.arange(len(first) - 1), np.diff(first)), whose] = True
        return np.packbits(asked, 1)


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indexes of each query's ``k`` best, ties to the smaller id."""
    order = np.lexsort((vec, -score, query))
    q, v, s = query[order], vec[order], score[order]
    again = np.zeros(len(q), bool)  # repeated rows
    again[1:] = (q[1:] == q[:-1]) & (v[1:] == v[:-1]) & (s[1:] == s[:-1])
    order, q = order[~again], q[~again]
    start = np.flatnonzero(np.diff(q, prepend=q[0] - 1 if len(q) else 0))
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


def searcher(block, rotations: Rotations, k: int):
    def search(batches):
        qs: Queries = block.value
        asked = [qs.asked(t) for t in range(rotations.tables)]
        q, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least = np.full(len(qs.ids), -np.inf)  # score of each query's k-th best so far
        aim = qs.x / qs.size[:, None]
        for batch in batches:
            keep, x, size = unit(batch.column(1), rotations.dim)
            ids = batch.column(0).to_numpy(zero_copy_only=False)[keep].astype(np.int64)
            for i in range(0, len(ids), ROWS):
                own, part, length = ids[i:i + ROWS], x[i:i + ROWS], size[i:i + ROWS]
                direction = part / length[:, None]
                shared = np.zeros((len(own), asked[0].shape[1]), np.uint8)
                for t in range(rotations.tables):
                    shared |= asked[t][rotations.axes(direction, t)[:, 0]]
                # All products of a block cost less than its candidates' one by one;
                # a candidate that may be among the best is then scored as it is.
                close = direction @ aim.T >= least - SLACK
                close[length < TINY] = True
                close[:, qs.size < TINY] = True
                close &= np.unpackbits(shared, 1, len(qs.ids)).view(bool)
                close &= own[:, None] != qs.ids
                row, query = np.nonzero(close)
                scores = [np.einsum("ij,ij->i", part[row[j:j + PAIRS]], qs.x[query[j:j + PAIRS]])
                          / (length[row[j:j + PAIRS]] * qs.size[query[j:j + PAIRS]]) for j in range(0, len(row), PAIRS)]
                q, v, s = (np.concatenate(p) for p in ((q, query), (v, own[row]), (s, *scores)))
                some = best(q, v, s, k)
                q, v, s = q[some], v[some], s[some]
                first = np.flatnonzero(np.diff(q, prepend=-1))
                full = np.diff(np.append(first, len(q))) == k
                least[q[first[full]]] = s[first[full] + k - 1]
        yield pa.RecordBatch.from_arrays([pa.array(qs.ids[q]), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])
    return search


def search(vectors: DataFrame, queries: DataFrame, k: int = K, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest by cosine of each query.

    Both frames are (vec_id, embedding).  Vectors that are null, zero or hold
    null or non-finite components take no part, nor do rows without an id; a
    query doesn't meet rows of its own id; repeated rows count once.  Vectors of
    different lengths are padded with zeros.  Empty tables give no rows."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    queries = queries.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    asked = queries.where("vec_id is not null and embedding is not null").distinct()
    widest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    dim = 1 << max(0, int(widest - 1).bit_length())
    rotations = Rotations(dim, tables)
    blocks = 1 + queries.count() // BLOCK
    rows = vectors.where("vec_id is not null and embedding is not null")
    found = None
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        block = spark.sparkContext.broadcast(Queries([tuple(r) for r in mine.toLocalIterator()], dim, rotations, probes))
        part = rows.mapInArrow(searcher(block, rotations, k), "query_id long, vec_id long, score double")
        found = part if found is None else found.unionAll(part)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn(
        "rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
