"""Seen hashes, stored by prefix with a manifest that tells which files to read.

A store is a folder ``data``, one subfolder for each prefix of a hash, and a folder
``manifest`` with a row per file: its range of hashes and a Bloom filter over them.
A run looks its hashes up by prefix and range, tests the filters, and opens only
the files that may hold one of them: a store of any size costs a small run the
manifest's ranges, the filters its hashes fall into and a few files."""
from __future__ import annotations

import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsops.session import materialise
from newsops.sources.files import path_exists

PREFIX = 2
FILE_ROWS = 1_000_000
#: Bits and probes for each hash: one unseen hash in a hundred passes.
BITS, PROBES = 10, 7
MANIFEST = "file string, run string, prefix string, low string, high string, n long, bits binary"


def _places(hashes: pd.Series, size: int) -> np.ndarray:
    """Where a filter of ``size`` bits has each hash, PROBES places a row."""
    h = pd.util.hash_array(hashes.to_numpy(object), categorize=False).astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    probe = np.arange(PROBES, dtype=np.uint64)
    return ((h[:, None] + probe * step[:, None]) % np.uint64(size)).astype(np.int64)


def bloom(hashes: pd.Series) -> bytes:
    """Filter over a file's hashes: at most FILE_ROWS of them, so 1.25 MB."""
    bits = np.zeros(max(64, BITS * len(hashes) + 7 >> 3 << 3), np.uint8)
    bits[_places(hashes, len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def passes(filter_: bytes, hashes: pd.Series) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(filter_, np.uint8))
    return bits[_places(hashes, len(bits))].all(axis=1)


def by_file(df: DataFrame, column: str) -> DataFrame:
    """Rows of a file in one task, files dealt over all cores: hashes are small, so
    that Spark would else put hundreds of files into one task, one after the other."""
    spark = df.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(width, column)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of the store; none where it is absent."""
    where = os.path.join(path, "manifest")
    if not path_exists(spark, where):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(where)


def _summary(pdf: pd.DataFrame) -> pd.DataFrame:
    h = pdf["hash"]
    return pd.DataFrame({"file": [pdf["file"].iloc[0]], "run": [pdf["run"].iloc[0]], "prefix": [h.iloc[0][:PREFIX]], "low": [h.min()],
                         "high": [h.max()], "n": [len(h)], "bits": [bloom(h)]})


def candidates(hashes: DataFrame, path: str, without: str | None = None) -> DataFrame:
    """(file) that may hold one of ``hashes`` (hash): by prefix and range, then by
    filter.  Files of the run ``without`` don't count."""
    files = manifest(hashes.sparkSession, path)
    if without is not None:
        files = files.where(F.col("run") != without)
    mine = hashes.select("hash").where("hash is not null").distinct().withColumn("prefix", F.substring("hash", 1, PREFIX))
    ranges = files.select("file", "prefix", "low", "high")
    filters = files.select(F.col("file").alias("of"), "bits")
    pairs = mine.join(ranges, "prefix").where(F.col("hash").between(F.col("low"), F.col("high"))).select("file", "hash")

    def tested(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        hit = len(left) and len(right) and passes(right["bits"].iloc[0], left["hash"]).any()
        return pd.DataFrame({"file": [right["of"].iloc[0]] if hit else []}, dtype=object)
    return by_file(pairs, "file").groupBy("file").cogroup(by_file(filters, "of").groupBy("of")).applyInPandas(tested, "file string")


def seen_among(hashes: DataFrame, path: str, without: str | None = None) -> DataFrame:
    """(hash): those of ``hashes`` that the store has, each once.  The names of the
    files to read go through the driver."""
    spark = hashes.sparkSession
    files = [r["file"] for r in candidates(hashes, path, without).collect()]
    if not files:
        return spark.createDataFrame([], "hash string")
    stored = spark.read.schema("hash string").parquet(*files)
    return stored.join(hashes.select("hash").distinct(), "hash", "left_semi").distinct()


def drop_seen(df: DataFrame, path: str, key: str = "hash", without: str | None = None) -> DataFrame:
    """Rows whose ``key`` the store lacks (a null key is never seen).  The seen ones
    are written first: where they are few, Spark broadcasts them and no row moves."""
    known = materialise(seen_among(df.select(F.col(key).alias("hash")), path, without), "seen-among")
    return df.join(known.withColumnRenamed("hash", key), key, "left_anti").select(*df.columns)


def append(hashes: DataFrame, path: str, run: str | None = None, file_rows: int = FILE_ROWS, fresh: bool = False) -> int:
    """Add the hashes that the store lacks; returns how many.  The manifest is
    written last and files without a row in it are never read, so a run that dies
    halfway adds nothing; one with the ``run`` id of an earlier run neither.
    ``fresh``: the store is known to lack them (``drop_seen`` told), so it isn't asked again."""
    spark, run = hashes.sparkSession, run or uuid.uuid4().hex
    if not manifest(spark, path).where(F.col("run") == run).isEmpty():
        return 0
    mine = hashes.select("hash").where("hash is not null").distinct()
    if not fresh:
        mine = materialise(mine, "seen-new")
        mine = mine.join(seen_among(mine, path), "hash", "left_anti")
    new = mine.withColumn("prefix", F.substring("hash", 1, PREFIX))
    # Ranges of hashes: a prefix goes to one task, or to several where it is large.
    where = os.path.join(path, "data", f"run={run}-{uuid.uuid4().hex}")
    (new.repartitionByRange("hash").sortWithinPartitions("prefix", "hash")
     .write.option("maxRecordsPerFile", file_rows).partitionBy("prefix").parquet(where))
    if not path_exists(spark, os.path.join(where, "prefix=*")):
        return 0
    written = spark.read.schema("hash string").parquet(where).select("hash", F.col("_metadata.file_path").alias("file"), F.lit(run).alias("run"))
    rows = materialise(by_file(written, "file").groupBy("file").applyInPandas(_summary, MANIFEST), "seen-manifest")
    rows.write.mode("append").parquet(os.path.join(path, "manifest"))
    return rows.agg(F.sum("n")).first()[0]
