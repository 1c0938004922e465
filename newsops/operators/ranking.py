"""Exact ranks, top-n and samples that hold no whole group in one task.

``rank_in_group`` splits every group into buckets that follow the order, counts
the buckets (a small aggregate), turns the counts into offsets, and ranks only
within a bucket.  A group with a third of all rows is therefore spread over as
many tasks as it has buckets."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from newsops.functions.text import col

# Spark prunes row_number() <= n before the shuffle up to this n.
PRUNED_LIMIT = 1000
SEQ_BUCKET = 1 << 17
HEX_DIGITS = 4
# Strata tables up to this many rows are broadcast; larger ones are joined.
MAX_STRATA = 10_000


def names(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def _integer(df: DataFrame, seq: str) -> None:
    kind = df.schema[seq].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{seq} must be an integer column, not {kind.simpleString()}")


def rank_in_group(df: DataFrame, by, seq: str, out: str = "rank",
                  bucket: Column | None = None, width: int = SEQ_BUCKET) -> DataFrame:
    """1-based rank by ``seq`` within ``by``; null keys are a group, a null ``seq``
    comes first.  Without an own ``bucket`` ``seq`` must be an integer, unique per
    group: a bucket then holds at most ``width`` rows."""
    by = names(by)
    if bucket is None:
        _integer(df, seq)
        bucket = F.floor(F.col(seq) / F.lit(width))
    keyed = df.withColumn("_bucket", bucket)
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = Window.partitionBy(*by, "_bucket").orderBy(seq)
    shifts = offsets.select(*[F.col(k).alias(f"_r_{k}") for k in (*by, "_bucket")], "_before")
    on = F.lit(True)
    for k in (*by, "_bucket"):
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return (keyed.withColumn("_rn", F.row_number().over(local)).join(shifts, on)
            .select(*df.columns, (F.col("_before") + F.col("_rn")).alias(out)))


def first_n(df: DataFrame, by, seq: str, n: int) -> DataFrame:
    """The first ``n`` rows of every group by ``seq``, an integer unique per group;
    null keys are a group, a null ``seq`` comes first.  Small n: a window that
    Spark prunes before the shuffle.  Larger n: the bucketed rank, same rows."""
    by = names(by)
    _integer(df, seq)
    if n > PRUNED_LIMIT:
        return rank_in_group(df, by, seq, "_rank").filter(F.col("_rank") <= n).drop("_rank")
    if not by:
        return df.orderBy(seq).limit(n)
    w = Window.partitionBy(*by).orderBy(seq)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_n(df: DataFrame, score: str, n: int, seq: str) -> DataFrame:
    """Best ``n`` rows, ties in input order: a report-sized result, so a
    TakeOrderedAndProject (each task keeps n rows)."""
    return df.orderBy(F.desc(score), F.asc(seq)).limit(n)


def sample_hash(key: Column | str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), col(key).cast("string")))


def over_strata(order=None):
    """Window over the table of strata (one row each)."""
    w = Window.partitionBy(F.lit(0))
    return w if order is None else w.orderBy(*order)


def _join_strata(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Null-safe broadcast join to a table of at most MAX_STRATA rows."""
    if not by:
        return left.crossJoin(F.broadcast(right))
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in by],
                           *[c for c in right.columns if c not in by])
    on = F.lit(True)
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(F.broadcast(renamed), on, "left").drop(*[f"_r_{k}" for k in by])


def _edges(keys: DataFrame, by: list[str], sizes: Column) -> DataFrame:
    """Per stratum: its size to take, the bucket in which that count is reached
    and how many rows of that bucket belong to the sample."""
    counts = keys.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        *by, "_bucket", F.sum("_n").over(group).alias("_total"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    takes = (placed.select(*by, "_total").distinct()
             .withColumn("_take", sizes.cast("bigint"))
             .select(*[F.col(k).alias(f"_r_{k}") for k in by], "_take"))
    cond = F.lit(True)
    for k in by:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    both = placed.join(takes, cond) if by else placed.crossJoin(takes)
    reached = F.when(F.col("_before") < F.col("_take"), F.col("_bucket"))
    return both.groupBy(*by).agg(
        F.max(reached).alias("_edge"),
        F.max_by(F.col("_take") - F.col("_before"), reached).alias("_left"))


def flag_sample(df: DataFrame, strata, key, sizes: int | Column, seed: int = 42,
                out: str = "taken", where: Column | None = None) -> DataFrame:
    """Adds a boolean that is true for exactly ``sizes`` rows per stratum: those
    with the lowest ``md5(seed|key)``, so the same rows under any partitioning.
    ``sizes`` is an int or an expression over the stratum columns and ``_total``
    (window functions over the strata table allowed).  ``where`` restricts the
    rows that may be drawn.  ``key`` must be unique per row.

    Two passes over the key columns find, per stratum, the last hash that still
    belongs to the sample; the result itself is then one projection against that
    table, without shuffling any row.  ``df`` is read three times: materialise an
    expensive input first."""
    by = names(strata)
    size = sizes if isinstance(sizes, Column) else F.lit(sizes)
    pool = df if where is None else df.filter(where)
    keys = pool.select(
        *by, sample_hash(key, seed).alias("_h"), col(key).cast("string").alias("_k"),
    ).withColumn("_bucket", F.conv(F.left("_h", F.lit(HEX_DIGITS)), 16, 10).cast("int"))

    edges = _edges(keys, by, size)
    found = edges.limit(MAX_STRATA + 1).collect()
    if len(found) > MAX_STRATA:
        return _flag_many(df, keys, by, key, edges, seed, out, where)
    spark = df.sparkSession
    edge_table = spark.createDataFrame(found, edges.schema)
    bucket_rows = _join_strata(keys, edge_table, by).filter("_bucket = _edge")
    w = Window.partitionBy(*by, "_bucket").orderBy("_h", "_k")
    cuts = (bucket_rows.withColumn("_rn", F.row_number().over(w))
            .filter("_rn <= _left").groupBy(*by)
            .agg(F.max(F.struct("_h", "_k")).alias("_cut")))
    cut_rows = cuts.collect()  # one row per stratum, bounded above
    hashed = df.withColumn("_h", sample_hash(key, seed))
    marked = _join_strata(hashed, spark.createDataFrame(cut_rows, cuts.schema), by) if cut_rows \
        else hashed.withColumn("_cut", F.lit(None).cast(cuts.schema["_cut"].dataType))
    mine = F.struct(F.col("_h"), col(key).cast("string").alias("_k"))
    flag = F.coalesce(mine <= F.col("_cut"), F.lit(False))
    if where is not None:
        flag = flag & F.coalesce(where, F.lit(False))
    return marked.select(*df.columns, flag.alias(out))


def _flag_many(df, keys, by, key, edges, seed, out, where) -> DataFrame:
    """More strata than may be broadcast: shuffle by (stratum, hash bucket), so
    that even a dominant stratum is spread evenly."""
    pool = df if where is None else df.filter(where)
    hashed = pool.withColumn("_h", sample_hash(key, seed)).withColumn(
        "_k", col(key).cast("string")).withColumn(
        "_bucket", F.conv(F.left("_h", F.lit(HEX_DIGITS)), 16, 10).cast("int"))
    groups = edges.select(*[F.col(k).alias(f"_r_{k}") for k in by], "_edge", "_left")
    per_bucket = keys.select(*by, "_bucket").distinct()
    on = F.lit(True)
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    cuts = per_bucket.join(groups, on).select(
        *[F.col(k).alias(f"_c_{k}") for k in by], F.col("_bucket").alias("_c_bucket"),
        "_edge", "_left")
    on = F.col("_bucket") == F.col("_c_bucket")
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    w = Window.partitionBy(*by, "_bucket").orderBy("_h", "_k")
    ranked = hashed.join(cuts, on, "left").withColumn("_rn", F.row_number().over(w))
    flag = F.coalesce(
        (F.col("_bucket") < F.col("_edge"))
        | ((F.col("_bucket") == F.col("_edge")) & (F.col("_rn") <= F.col("_left"))), F.lit(False))
    drawn = ranked.select(*df.columns, flag.alias(out))
    if where is None:
        return drawn
    others = df.filter(~F.coalesce(where, F.lit(False))).select("*", F.lit(False).alias(out))
    return drawn.unionByName(others)


def exact_sample(df: DataFrame, strata, key, sizes: int | Column, seed: int = 42) -> DataFrame:
    """Exactly ``sizes`` rows per stratum without replacement (all when fewer)."""
    return flag_sample(df, strata, key, sizes, seed, "_taken").filter("_taken").drop("_taken")
