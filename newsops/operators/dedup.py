"""Deduplication, seen-state and collection quotas."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from newsops.functions.text import article_hash, min_content
from newsops.operators.ranking import first_n
from newsops.session import materialise

# Lines of duplicate groups are joined per span of this many lines; the rows are the same for any span.
LINE_SPAN = 10_000


def dedup_first(df: DataFrame, key: str, seq: str, by=()) -> DataFrame:
    """Keep the row with the lowest ``seq`` per exact ``key`` value.

    The 64-bit hash leads the partition key so that sorting compares integers;
    the value itself follows, so a collision merges nothing.  Spark keeps one
    row per key and task before the shuffle (window group limit), so a value
    shared by a third of all rows does not land in one task."""
    w = Window.partitionBy(*by, F.xxhash64(key), key).orderBy(seq)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def drop_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose fingerprint is not in the seen table (anti join; Spark
    broadcasts the seen side only when its size allows)."""
    return df.join(seen.select(F.col(key)).distinct(), key, "left_anti")


def quotas(limits: dict[str, int], count: int) -> dict[str, int]:
    """Scale per-source limits to the requested count; sources below 1 drop out."""
    scaled = {s: int(limit * (count / 100)) for s, limit in limits.items()}
    return {s: n for s, n in scaled.items() if n >= 1}


def accept(df: DataFrame, seen: DataFrame | None, quota: dict[str, int], seq: str,
           source: str = "source_type", title: str = "title", content: str = "content",
           use_cache: bool = True) -> tuple[DataFrame, DataFrame]:
    """Collection acceptance.  Sources are taken in the order of ``quota``; a
    source yields its first ``n`` articles by ``seq`` (unique) that have enough
    content and whose title fingerprint is neither seen nor accepted before.
    Returns (accepted rows with ``hash``, new hashes for the seen table).

    The articles are read twice: once to write (seq, source, hash) of the
    eligible ones, once to fetch the accepted rows.  Everything between works on
    that narrow table, and each source adds at most its quota."""
    spark = df.sparkSession
    eligible = df.filter(min_content(title, content) & F.col(source).isin(*quota)).select(
        F.col(seq).alias("_seq"), F.col(source).alias("_source"), article_hash(title).alias("hash"))
    if use_cache:
        # First of every fingerprint per source: a hot title is gone before the
        # anti join sees it.
        eligible = dedup_first(eligible, "hash", "_seq", ["_source"])
        if seen is not None:
            eligible = drop_seen(eligible, seen, "hash")
    eligible = materialise(eligible, "eligible")
    accepted = spark.createDataFrame([], eligible.schema)
    for i, (name, n) in enumerate(quota.items()):
        mine = eligible.filter(F.col("_source") == name)
        if use_cache and i:
            mine = mine.join(accepted.select("hash"), "hash", "left_anti")
        mine = materialise(first_n(mine, [], "_seq", n).select(*eligible.columns), "accepted")
        accepted = mine if i == 0 else accepted.unionByName(mine)
    chosen = accepted.select("_seq", "hash")
    rows = df.join(chosen, F.col(seq) == F.col("_seq")).drop("_seq")
    return rows, accepted.select("hash").distinct()


def duplicate_counts(df: DataFrame, by=(), text: str = "text", key: str | None = None) -> DataFrame:
    """Non-null rows minus distinct texts, per group: exact, and pre-aggregated
    on a fingerprint before the shuffle."""
    by = [by] if isinstance(by, str) else list(by)
    finger = F.md5(text) if key is None else F.col(key)
    per_text = (df.filter(finger.isNotNull())
                .groupBy(*by, finger.alias("_t")).agg(F.count(F.lit(1)).alias("_n")))
    return per_text.groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("duplicates"))


def duplicate_lines(df: DataFrame, by: str, line: str = "line_number", text: str = "text") -> DataFrame:
    """Long form of the duplicate groups: every line of every text that occurs
    more than once in its file, with the group's size and first line.  Only
    fingerprints and line numbers are shuffled, and they are joined per span of
    lines, so a text that fills a file is spread over the file's spans."""
    keyed = df.filter(F.col(text).isNotNull()).select(
        by, F.md5(text).alias("text_key"), F.col(line).cast("bigint").alias("line_number"),
        F.floor(F.col(line) / LINE_SPAN).alias("_span"))
    spans = keyed.groupBy(by, "text_key", "_span").agg(
        F.count(F.lit(1)).alias("_n"), F.min("line_number").alias("_min"))
    groups = spans.groupBy(by, "text_key").agg(
        F.sum("_n").alias("group_size"), F.min("_min").alias("first_line")).filter("group_size > 1")
    wanted = spans.select(by, "text_key", "_span").join(groups, [by, "text_key"])
    return keyed.join(wanted, [by, "text_key", "_span"]).drop("_span")


def union_prioritised(*dfs: DataFrame) -> DataFrame:
    """Union with a ``priority`` column: earlier inputs win later deduplication."""
    out = None
    for i, df in enumerate(dfs):
        df = df.withColumn("priority", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def set_diff(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` in ``a`` and not in ``b``."""
    return a.select(column).distinct().join(b.select(column).distinct(), column, "left_anti")
