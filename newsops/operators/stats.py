"""Distributions, coverage, audits and roll-ups."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsops import vocab
from newsops.functions.codes import each_code
from newsops.functions.text import non_empty, strip
from newsops.operators.ranking import names
from newsops.session import materialise


def _count() -> Column:
    return F.count(F.lit(1))


def distribution(df: DataFrame, column: str, by=()) -> DataFrame:
    """Count and percentage of every value, per group.  The totals come from the
    aggregated rows, not from a second pass."""
    by = names(by)
    counts = df.groupBy(*by, column).agg(_count().alias("n"))
    if by:
        rows = counts.withColumn("_all", F.sum("n").over(Window.partitionBy(*by)))
    else:
        rows = counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("_all"))))
    return rows.withColumn("pct", F.round(F.col("n") * 100.0 / F.col("_all"), 6)).drop("_all")


def code_stats(df: DataFrame, codes: str = "correlations", top: int = 20) -> DataFrame:
    """Most frequent codes, ties by code."""
    return (each_code(df, codes).groupBy("code").agg(_count().alias("n"))
            .orderBy(F.desc("n"), "code").limit(top))


def code_totals(df: DataFrame, codes: str = "correlations") -> DataFrame:
    """Total and distinct codes."""
    per_code = each_code(df, codes).groupBy("code").agg(_count().alias("n"))
    return per_code.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_correlations"),
                        _count().alias("unique_correlations"))


def coverage(df: DataFrame, codes: str = "correlations") -> DataFrame:
    """Articles with at least one code, and their percentage."""
    has = F.count_if(F.coalesce(F.size(codes), F.lit(0)) > 0)
    return df.agg(_count().alias("articles"), has.alias("with_codes"),
                  F.round(has * 100.0 / _count(), 6).alias("pct"))


def review_counts(df: DataFrame, flag: str = "needs_review") -> DataFrame:
    review = F.count_if(F.coalesce(F.col(flag), F.lit(False)))
    return df.agg(review.alias("needs_review_articles"),
                  (_count() - review).alias("high_confidence_articles"))


def length_stats(df: DataFrame, by=(), text: str = "text") -> DataFrame:
    """Average, minimum and maximum length over non-null texts; 0 without any."""
    n = F.length(text)
    return df.groupBy(*names(by)).agg(
        F.coalesce(F.round(F.avg(n), 6), F.lit(0.0)).alias("avg_text_length"),
        F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias("max_text_length"),
        F.coalesce(F.min(n), F.lit(0)).cast("bigint").alias("min_text_length"))


def run_metadata(df: DataFrame, filename: str, created_at: str, source: str,
                 cache_size: int | None = None, threshold: float | None = None,
                 models: dict[str, str] | None = None, dedup: bool = True) -> DataFrame:
    """One row describing a labelled dataset.  The labels are written once as a
    narrow table; distributions are aggregated to their few values before they
    become maps."""
    rows = materialise(df.select("label", "importance", "correlations", "needs_review"), "labels")

    def as_map(counts: DataFrame, key: str, name: str) -> DataFrame:
        return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias(name))

    def counted(column):
        return rows.filter(F.col(column).isNotNull()).groupBy(column).agg(_count().alias("n"))

    row = rows.agg(_count().alias("article_count")).crossJoin(review_counts(rows))
    row = row.crossJoin(as_map(counted("label"), "label", "label_distribution"))
    row = row.crossJoin(as_map(counted("importance"), "importance", "importance_distribution"))
    row = row.crossJoin(as_map(code_stats(rows, top=20), "code", "correlation_distribution"))
    row = row.crossJoin(code_totals(rows))
    models = models or {}
    constants = {
        "filename": filename, "created_at": created_at, "source": source,
        "deduplication_enabled": dedup, "cache_size": cache_size,
        "confidence_threshold": threshold,
        **{f"{k}_model": v for k, v in models.items()},
    }
    return row.select(*[F.lit(v).alias(k) for k, v in constants.items()], "*")


def label_audit(df: DataFrame, mapping: dict[str, int], label: str = "label",
                text: str = "text") -> DataFrame:
    """Long form (kind, value, n): raw and lowered counts, labels outside the
    mapping, labels of the mapping never seen, usable rows."""
    low = F.lower(F.coalesce(F.col(label), F.lit("")))
    cleaned = strip(low)
    usable = F.coalesce(non_empty(text).isNotNull() & cleaned.isin(*mapping), F.lit(False))
    # One aggregate over the raw values feeds every part.
    per = (df.groupBy(F.col(label).alias("raw"))
           .agg(_count().alias("n"), F.count_if(usable).alias("ok"))
           .withColumn("lowered", F.lower("raw"))
           .withColumn("clean", strip(F.lower("raw"))))
    parts = [
        per.filter("raw is not null").select(F.lit("raw").alias("kind"), F.col("raw").alias("value"), "n"),
        per.filter("raw is not null").groupBy("lowered").agg(F.sum("n").alias("n"))
           .select(F.lit("lowered"), "lowered", "n"),
        per.filter(F.col("clean").isNotNull() & ~F.col("clean").isin(*mapping))
           .groupBy("clean").agg(F.sum("n").alias("n")).select(F.lit("unexpected"), "clean", "n"),
        df.sparkSession.createDataFrame([(k,) for k in mapping], "value string")
          .join(per.select("clean").distinct(), F.col("value") == F.col("clean"), "left_anti")
          .select(F.lit("absent"), "value", F.lit(0)),
        per.agg(F.coalesce(F.sum("ok"), F.lit(0)).alias("n"))
           .select(F.lit("usable"), F.lit("rows"), "n"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select("kind", "value", F.col("n").cast("bigint").alias("n"))


def group_summary(df: DataFrame, by: str, label: str, confidence: str, seq: str) -> DataFrame:
    """Per group: majority label (ties go to the label seen first), average
    confidence, distribution as text, total.  Rows collapse to (group, label)
    before anything is compared, so a hot group costs no more than a small one."""
    per = df.groupBy(by, label).agg(
        _count().alias("n"), F.min(seq).alias("first"), F.sum(confidence).alias("conf"))
    entry = F.concat_ws("=", F.col(label), F.col("n"))
    return per.groupBy(by).agg(
        F.max_by(label, F.struct("n", -F.col("first"))).alias("overall_sentiment"),
        (F.sum("conf").cast("double") / F.sum("n")).alias("avg_confidence"),
        F.array_join(F.array_sort(F.collect_list(entry)), ";").alias("distribution"),
        F.sum("n").alias("total_analyzed"))


def status(catalog: DataFrame, seen: DataFrame | None = None, newest: int = 5) -> DataFrame:
    """One row: number of datasets, the newest names, size of the seen table."""
    names_row = (catalog.orderBy(F.desc("name")).limit(newest)
                 .agg(F.sort_array(F.collect_list("name"), asc=False).alias("newest")))
    row = catalog.agg(_count().alias("datasets")).crossJoin(names_row)
    if seen is None:
        return row.withColumn("seen_hashes", F.lit(0).cast("bigint"))
    return row.crossJoin(seen.agg(_count().alias("seen_hashes")))


def repair_report(df: DataFrame, by=(), max_length: int = 512) -> DataFrame:
    """Long texts, labels and importances outside the vocabulary, duplicates.  A
    column that the dataset lacks has no finding (its lengths are 0): the oldest
    files have texts and labels only."""
    by, have = names(by), set(df.columns)

    def outside(column, allowed):
        bad = ~F.coalesce(F.col(column).isin(*allowed), F.lit(False)) if column in have else F.lit(False)
        return F.count_if(bad)

    length = F.length("text") if "text" in have else F.lit(None).cast("int")
    main = df.groupBy(*by).agg(
        F.count_if(length > max_length).alias("long_texts"),
        outside("label", vocab.SENTIMENTS).alias("invalid_labels"),
        outside("importance", vocab.IMPORTANCE_IDS).alias("invalid_importances"),
        F.coalesce(F.round(F.avg(length), 6), F.lit(0.0)).alias("text_length_avg"),
        F.coalesce(F.max(length), F.lit(0)).cast("bigint").alias("text_length_max"),
        F.coalesce(F.min(length), F.lit(0)).cast("bigint").alias("text_length_min"))
    if "text" in have:
        per_text = df.groupBy(*by, F.md5("text").alias("_t")).agg(_count().alias("_n"))
        dup = per_text.groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("duplicates"))
        both = main.join(dup, by, "left") if by else main.crossJoin(dup)
    else:
        both = main.withColumn("duplicates", F.lit(0).cast("bigint"))
    valid = ((F.col("long_texts") == 0) & (F.col("invalid_labels") == 0)
             & (F.col("invalid_importances") == 0) & (F.col("duplicates") == 0))
    return both.withColumn("duplicates", F.coalesce("duplicates", F.lit(0))).withColumn(
        "is_valid", valid)


def invalid_values(df: DataFrame, column: str, allowed) -> DataFrame:
    """Distinct values outside the allowed set, with counts."""
    bad = ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.filter(bad).groupBy(column).agg(_count().alias("n"))


def training_targets(df: DataFrame) -> DataFrame:
    """Targets worth training: correlations only when some row has any."""
    has = (F.bool_or(F.col("correlations").isNotNull())
           if "correlations" in df.columns else F.lit(False))
    base = F.array(F.lit("label"), F.lit("importance"))
    return df.agg(F.coalesce(has, F.lit(False)).alias("_has")).select(F.explode(
        F.when(F.col("_has"), F.array_append(base, F.lit("correlations"))).otherwise(base)
    ).alias("target"))


def preview(df: DataFrame, seq: str, rows: int = 5) -> DataFrame:
    """The first rows by ``seq`` together with the total row count."""
    return df.orderBy(seq).limit(rows).crossJoin(df.agg(_count().alias("row_count")))

