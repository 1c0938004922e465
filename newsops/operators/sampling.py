"""Balancing, replay caps and train/validation/test splits.

Membership is decided by ``md5(seed|key)``, so it is the same on any cluster;
class counts are exact."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsops.functions.text import non_empty
from newsops.operators.metrics import positive_counts
from newsops.operators.ranking import exact_sample, flag_sample, over_strata


def balance(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Down-sample every class to the size of the smallest one.  Rows without a
    label drop out, unless no row has one: then the input is returned."""
    labelled = df.filter(non_empty(label).isNotNull())
    if labelled.select(label).isEmpty():
        return df
    return exact_sample(labelled, label, key, F.min("_total").over(over_strata()), seed)


def cap(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Uniform sample of ``n`` rows (all rows when there are fewer)."""
    return exact_sample(df, [], key, n, seed)


def balanced_fixture(df: DataFrame, label: str, key: str, count: int, seed: int = 42,
                     classes=("positive", "negative", "neutral")) -> DataFrame:
    """``count // 3`` rows per class, the remainder from the last class."""
    share, rest = divmod(count, 3)
    take = F.when(F.col(label) == classes[-1], share + rest).otherwise(share)
    return exact_sample(df.filter(F.col(label).isin(*classes)), label, key, take, seed)


def _share_size(fraction: float, label: str | None) -> Column:
    """ceil(fraction * n) rows, shared out over the classes by largest remainder
    (integer arithmetic; ties go to the smaller label)."""
    if label is None:
        return F.ceil(F.lit(fraction) * F.col("_total"))
    everything = F.sum("_total").over(over_strata())
    wanted = F.ceil(F.lit(fraction) * everything)
    # Decimals: the product of two counts may pass 64 bits.
    product = F.col("_total").cast("decimal(19,0)") * wanted.cast("decimal(19,0)")
    rest = product % everything.cast("decimal(19,0)")
    base = ((product - rest) / everything.cast("decimal(19,0)")).cast("long")
    order = F.row_number().over(over_strata([rest.desc(), F.asc(label)]))
    return base + F.when(order <= wanted - F.sum(base).over(over_strata()), 1).otherwise(0)


def split(df: DataFrame, label: str | None, key: str, mode: str = "classic", seed: int = 42,
          fractions: tuple[float, float] | None = None) -> DataFrame:
    """Adds ``split``.  ``classic``: 20 % validation, stratified by ``label``.
    ``incremental``: 10 % test, then 25 % of the rest for validation.
    ``random``: 20 % test without strata.  Tiny datasets: ``split_small``."""
    strata = [] if label is None else [label]
    if mode in ("classic", "random"):
        share = (fractions or (0.2,))[0]
        name = "validation" if mode == "classic" else "test"
        flagged = flag_sample(df, strata, key, _share_size(share, label), seed, "_first")
        return flagged.withColumn(
            "split", F.when(F.col("_first"), name).otherwise("train")).drop("_first")
    test, validation = fractions or (0.1, 0.25)
    flagged = flag_sample(df, strata, key, _share_size(test, label), seed, "_first")
    flagged = flag_sample(flagged, strata, key, _share_size(validation, label), seed + 1,
                          "_second", where=~F.col("_first"))
    return flagged.withColumn(
        "split", F.when(F.col("_first"), "test").when(F.col("_second"), "validation")
        .otherwise("train")).drop("_first", "_second")


def can_stratify(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    """One row: the row count, and whether it reaches ``min_rows`` with at least
    two rows in every class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce((F.sum("n") >= min_rows) & (F.min("n") >= 2), F.lit(False)).alias("stratify"))


def auto_split(df: DataFrame, label: str, key: str, seq: str, mode: str = "classic",
               seed: int = 42) -> DataFrame:
    """The stratified split where the data allows it, else the ordered one."""
    guard = can_stratify(df, label, 10 if mode == "incremental" else 4).first()
    if guard["stratify"]:
        return split(df, label, key, mode, seed)
    return split_small(df, seq, mode, guard["rows"])


def split_small(df: DataFrame, seq: str, mode: str = "classic", rows: int | None = None) -> DataFrame:
    """Ordered split for tiny or unbalanced datasets.  ``classic``: the first
    max(1, int(.8 n)) rows train, the rest validate.  ``incremental``: from 5
    rows on the first row tests and the last validates; below 5 all train.
    Only the boundary value of ``seq`` (unique) is looked up, by a bounded top-k
    or the bucketed rank, so that size does not matter."""
    from newsops.operators.ranking import rank_in_group

    n = df.count() if rows is None else rows
    if mode == "incremental":
        ends = df.agg(F.min(seq).alias("_lo"), F.max(seq).alias("_hi"))
        name = (F.when((F.lit(n) >= 5) & (F.col(seq) == F.col("_lo")), "test")
                .when((F.lit(n) >= 5) & (F.col(seq) == F.col("_hi")), "validation")
                .otherwise("train"))
        return df.crossJoin(F.broadcast(ends)).select(*df.columns, name.alias("split"))
    ranked = rank_in_group(df, [], seq, "_rank")
    name = F.when(F.col("_rank") <= max(1, int(n * 0.8)), "train").otherwise("validation")
    return ranked.withColumn("split", name).drop("_rank")


def validation_or_train(df: DataFrame) -> DataFrame:
    """Rows to validate on: the validation part, or the train part if it is empty."""
    part = df.filter("split = 'validation'")
    return df.filter("split = 'train'") if part.isEmpty() else part


def rarest_code(df: DataFrame, hot: str) -> DataFrame:
    """Adds ``stratum``: the index of the row's rarest positive code (-1 if it
    has none).  The counts, one per code, join as a single row."""
    freq = positive_counts(df, hot).agg(F.array_sort(F.collect_list(
        F.struct("code", "positives"))).alias("_freq"))
    positive = F.filter(
        F.zip_with(hot, "_freq", lambda v, e: F.when(
            v > 0, F.struct(e["positives"].alias("f"), e["code"].alias("i")))),
        lambda e: e.isNotNull())
    return df.crossJoin(F.broadcast(freq)).withColumn(
        "stratum", F.coalesce(F.array_min(positive)["i"], F.lit(-1))).drop("_freq")


def split_multilabel(df: DataFrame, hot: str, key: str, mode: str = "classic",
                     seed: int = 42) -> DataFrame:
    """Multi-label split, stratified by each row's rarest code: 20 % validation,
    or 10 % test then 22 % of the rest (``incremental``)."""
    return split(rarest_code(df, hot), "stratum", key, mode, seed,
                 (0.1, 0.22) if mode == "incremental" else (0.2,))
