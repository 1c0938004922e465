"""Records of quoted CSV files and of JSON arrays, cut by many tasks per file.

Where a record ends depends on all the bytes before it: a line break in a quoted
cell ends nothing, nor does a brace within a JSON string.  Yet what a block of
bytes does to the reader's state is a small map, from the two states it may be
entered in (outside or inside quotes) to the state it is left in, with the
records or the depth it adds for each.  One pass gives every block's map, a
running composition over the table of blocks (one narrow row for each split)
every block's true state at entry, and a second pass cuts the records there.
What lies across the border of blocks is put together by file and chain."""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from newsops.session import materialise

FLUSH_BYTES = 1 << 22
SLICE_BYTES = 1 << 22
WHOLE, TAIL, MIDDLE, HEAD = range(4)


class Csv:
    """Lines as pieces; a record starts at a line that isn't blank and ends at a
    line's end outside quotes.  A quote opens a cell only at the cell's beginning."""

    separator, closing = "\n", ""

    def __init__(self, delimiter: str = ","):
        self.delimiter = delimiter

    def scan(self, piece: str, inside: bool) -> tuple[bool, int]:
        """State after the piece, and the delimiters outside quotes."""
        if '"' not in piece:
            return inside, 0 if inside else piece.count(self.delimiter)
        at, cells = 0, 0
        while True:
            if inside:
                k = piece.find('"', at)
                if k < 0:
                    return True, cells
                doubled = piece.startswith('"', k + 1)
                at = k + 2 if doubled else k + 1
                if doubled:
                    continue
                inside = False
            elif piece.startswith('"', at):
                inside, at = True, at + 1
                continue
            k = piece.find(self.delimiter, at)
            if k < 0:
                return False, cells
            at, cells = k + len(self.delimiter), cells + 1

    def adds(self, piece: str, inside: bool) -> tuple[bool, int]:
        """What a piece does to the state, and the records that start in it."""
        return self.scan(piece, inside)[0], 0 if inside or not piece.rstrip("\r") else 1

    def open_at(self, inside: bool, depth: int) -> bool:
        return inside

    def start(self, piece: str, depth: int) -> int | None:
        return 0 if piece.rstrip("\r") else None

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside


class Json:
    """What lies between closing braces as pieces; a record is an object that
    starts at depth 1, in the file's array."""

    separator, closing = "}", "}"
    string_end = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
    bracket = re.compile(r"[\[\]{]")

    def outside(self, piece: str, inside: bool) -> tuple[list[tuple[int, int]], bool]:
        """Parts of the piece outside strings, and the state after it."""
        parts, at = [], 0
        while True:
            if inside:
                end = self.string_end.match(piece, at)
                if not end:
                    return parts, True
                at, inside = end.end(), False
            k = piece.find('"', at)
            parts.append((at, len(piece) if k < 0 else k))
            if k < 0:
                return parts, False
            at, inside = k + 1, True

    def adds(self, piece: str, inside: bool) -> tuple[bool, int]:
        """What a piece and the brace after it do to the state and the depth."""
        parts, inside = self.outside(piece, inside)
        depth = sum(piece.count("{", a, b) + piece.count("[", a, b) - piece.count("]", a, b) for a, b in parts)
        return inside, depth - (not inside)

    scan = adds

    def open_at(self, inside: bool, depth: int) -> bool:
        return inside or depth > 1

    def start(self, piece: str, depth: int) -> int | None:
        for a, b in self.outside(piece, False)[0]:
            for m in self.bracket.finditer(piece, a, b):
                if m[0] == "{" and depth == 1:
                    return m.start()
                depth += -1 if m[0] == "]" else 1
        return None

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside and depth == 1


def _pieces(spark: SparkSession, path, separator: str) -> DataFrame:
    """(file, block, value): a block is one split of a file, its pieces in order."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _slices(batch: pa.RecordBatch):
    """The batch in slices of about SLICE_BYTES of text: Python's strings are a
    copy, of which one slice is held at a time, however long its rows are."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(first, end - first)
        first = end


def _by_block(batches):
    """((file, block), pieces) of consecutive rows, at most a slice of a batch at once."""
    for batch in (part for whole in batches for part in _slices(whole)):
        files, blocks, values = (c.to_pylist() for c in batch.columns)
        first = 0
        for k in range(1, len(values) + 1):
            if k == len(values) or blocks[k] != blocks[first] or files[k] != files[first]:
                yield (files[first], blocks[first]), values[first:k]
                first = k


def _maps(dialect):
    def scan(batches):
        key, state = None, None

        def told():
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (*key, int(state[0][0]), int(state[1][0]), state[0][1], state[1][1])],
                names=["file", "block", "exit0", "exit1", "sum0", "sum1"])
        for at, pieces in _by_block(batches):
            if at != key:
                if key:
                    yield told()
                key, state = at, [(False, 0), (True, 0)]
            for piece in pieces:
                found = {s: dialect.adds(piece, s) for s in {state[0][0], state[1][0]}}
                state = [(found[s][0], n + found[s][1]) for s, n in state]
        if key:
            yield told()
    return scan


def blocks(spark: SparkSession, path, dialect) -> DataFrame:
    """(file, block, inside, before, left_inside, after): whether each block is
    entered inside quotes, the records or the depth before it, and both after it."""
    maps = materialise(_pieces(spark, path, dialect.separator).mapInArrow(
        _maps(dialect), "file string, block long, exit0 long, exit1 long, sum0 long, sum1 long"), "block-maps")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # A map keeps the state, swaps it or sets it: what counts is the last one that
    # sets it, and whether an odd number of swaps follows.
    swaps = maps.withColumn("swaps", F.sum(F.when((F.col("exit0") == 1) & (F.col("exit1") == 0), 1).otherwise(0)).over(order))
    last = F.last(F.when(F.col("exit0") == F.col("exit1"), F.struct("exit0", "swaps")), ignorenulls=True).over(before)
    odd = swaps.withColumn("set", last).withColumn("before_swaps", F.coalesce(F.lag("swaps").over(order), F.lit(0))).withColumn(
        "inside", (F.coalesce("set.exit0", F.lit(0)) + F.col("before_swaps") - F.coalesce("set.swaps", F.lit(0))) % 2 == 1)
    own = F.when(F.col("inside"), F.col("sum1")).otherwise(F.col("sum0"))
    return odd.withColumn("own", own).select(
        "file", "block", "inside", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"),
        (F.when(F.col("inside"), F.col("exit1")).otherwise(F.col("exit0")) == 1).alias("left_inside"), F.sum("own").over(order).alias("after"))


class Entries:
    """State at each block's entry, but for first blocks: 9 bytes a block and the name of each file."""

    def __init__(self, rows):
        self.files = {r["file"]: (np.array(r["block"], np.int64), np.array(r["inside"], bool), np.array(r["before"], np.int64)) for r in rows}

    def get(self, file: str, block: int) -> tuple[bool, int]:
        if block == 0:
            return False, 0
        starts, inside, before = self.files.get(file, (np.zeros(0, np.int64),) * 3)
        k = int(np.searchsorted(starts, block))
        if k == len(starts) or starts[k] != block:
            raise ValueError(f"{file}: no block starts at {block}; the files were split anew between two scans")
        return bool(inside[k]), int(before[k])


def _cut(dialect, entries):
    csv = isinstance(dialect, Csv)

    def scan(batches):
        out, size, key = [], 0, None
        inside, depth, number, held, cells, kind = False, 0, 0, None, 0, WHOLE

        def told():
            columns = list(zip(*out)) or [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["file", "block", "kind", "number", "cells", "raw"])
        for at, pieces in _by_block(batches):
            if at != key:
                if held is not None:
                    out.append((*key, MIDDLE if kind == HEAD else TAIL, number, cells, dialect.separator.join(held)))
                key, cells = at, 0
                inside, before = entries.value.get(*at)
                depth, number = (0, before) if csv else (before, 0)
                held, kind = ([], HEAD) if dialect.open_at(inside, depth) else (None, WHOLE)
            for piece in pieces:
                if held is None:
                    first = dialect.start(piece, depth)
                    if first is not None:
                        held, kind, cells, number = [], WHOLE, 0, number + 1
                else:
                    first = 0
                inside, n = dialect.scan(piece, inside)
                depth, cells = depth if csv else depth + n, cells + n
                if held is None:
                    continue
                held.append(piece[first:])
                if dialect.ends(inside, depth):
                    raw = dialect.separator.join(held) + dialect.closing
                    out.append((*key, kind, number, cells, raw))
                    size += len(raw)
                    held, kind = None, WHOLE
                    if size > FLUSH_BYTES:
                        yield told()
                        out, size = [], 0
        if held is not None:
            out.append((*key, MIDDLE if kind == HEAD else TAIL, number, cells, dialect.separator.join(held)))
        yield told()
    return scan


def cut(spark: SparkSession, path, dialect) -> tuple[DataFrame, DataFrame]:
    """Records (file, number, cells, raw) and files (file, unclosed) of a path.

    ``number`` counts a CSV file's records from 1, blank lines aside; ``cells`` is
    the number of its cells.  JSON records have neither.  A file is unclosed when it
    ends inside quotes or, JSON, inside an array or object; its last record is then
    no record.  An empty file has no records and is in neither table.

    A file of n splits is read by n tasks, twice.  The table of blocks goes through
    the driver: one row for each split of the input after a file's first (for 100 TB
    in splits of 128 MB some 800,000 rows of 17 bytes)."""
    table = materialise(blocks(spark, path, dialect), "blocks")
    csv = isinstance(dialect, Csv)
    states = table.where("block > 0").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "inside", "before"))).alias("x")).select(
        "file", *[F.col(f"x.{c}").alias(c) for c in ("block", "inside", "before")]).collect()
    entries = spark.sparkContext.broadcast(Entries(states))
    crossing = any(dialect.open_at(i, 0 if csv else b) for r in states for i, b in zip(r["inside"], r["before"]))
    parts = _pieces(spark, path, dialect.separator).mapInArrow(
        _cut(dialect, entries), "file string, block long, kind long, number long, cells long, raw string")
    whole = parts.where(F.col("kind") == WHOLE).select("file", "number", "cells", "raw")
    if crossing:
        # A tail begins a chain, middles go on with it, a head ends it.
        order = Window.partitionBy("file").orderBy("block", F.col("kind") == TAIL)
        chained = parts.where(F.col("kind") != WHOLE).withColumn(
            "chain", F.last(F.when(F.col("kind") == TAIL, F.col("block")), ignorenulls=True).over(order))
        stitched = chained.groupBy("file", "chain").agg(
            F.max(F.when(F.col("kind") == TAIL, F.col("number"))).alias("number"), F.sum("cells").alias("cells"), F.max("kind").alias("last"),
            F.array_sort(F.collect_list(F.struct("block", "raw"))).alias("parts")).where(F.col("last") == HEAD)
        whole = whole.unionByName(stitched.select("file", "number", "cells", F.array_join("parts.raw", dialect.separator).alias("raw")))
    records = whole.withColumns({"number": F.col("number") if csv else F.lit(None).cast("long"),
                                 "cells": F.col("cells") + 1 if csv else F.lit(None).cast("long")})
    # A JSON file's last piece counts a brace that isn't there.
    end = F.max_by(F.col("left_inside") if csv else F.col("left_inside") | (F.col("after") != -1), F.col("block"))
    return records, table.groupBy("file").agg(end.alias("unclosed"))
