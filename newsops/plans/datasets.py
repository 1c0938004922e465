"""Composite jobs over datasets: label, collect, validate, repair, convert,
replay, standardise."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from newsops import vocab
from newsops.functions import codes as C, labels as L, lexicon as X, text as T
from newsops.operators import correlate, dedup, model, ranking, sampling, validate as V
from newsops.session import materialise
from newsops.sources import files, records

RULES = "rule_based"


@dataclass(frozen=True)
class Labelling:
    """Lexicons, dictionaries, thresholds and models of one labelling run."""

    positive: list[str] = field(default_factory=lambda: vocab.POSITIVE_WORDS)
    negative: list[str] = field(default_factory=lambda: vocab.NEGATIVE_WORDS)
    high: list[str] = field(default_factory=lambda: vocab.HIGH_TERMS)
    medium: list[str] = field(default_factory=lambda: vocab.MEDIUM_TERMS)
    premium: list[str] = field(default_factory=lambda: vocab.PREMIUM_SOURCES)
    countries: dict[str, str] = field(default_factory=lambda: vocab.COUNTRY_NAMES)
    exports: list[tuple] = field(default_factory=lambda: vocab.COUNTRY_EXPORTS)
    products: dict[str, list[str]] = field(default_factory=lambda: vocab.PRODUCT_KEYWORDS)
    company: list[str] = field(default_factory=lambda: vocab.COMPANY_TERMS)
    macro: list[str] = field(default_factory=lambda: vocab.MACRO_TERMS)
    codes: list[str] = field(default_factory=lambda: vocab.COMMODITY_CODES)
    confidence_threshold: float = 0.75
    publisher: str = "FMP"
    sentiment_model: str | None = None
    importance_model: str | None = None
    correlation_model: str | None = None

    def rules(self, c) -> Column:
        return X.rule_codes(c, self.countries, self.exports, self.products, self.company, self.macro)


def raw_article(df: DataFrame, publisher: str = "FMP") -> DataFrame:
    """Normalised columns of a raw feed row: content and publisher fallbacks,
    composed text, summary; rows without title or content drop out."""
    have = set(df.columns)

    def get(name):
        return F.col(name) if name in have else F.lit(None).cast("string")

    content = T.first_non_empty(get("text"), get("content"), default="")
    rows = df.withColumn("_content", content).filter((F.col("title") != "") & (F.col("_content") != ""))
    keep = [c for c in ("seq", "source_type", "sentiment_scores", "importance_scores",
                        "correlation_scores", "hash") if c in have]
    return rows.select(
        *keep, T.compose("title", "_content").alias("text"), "title",
        T.summary("_content").alias("summary"),
        T.first_non_empty(get("site"), get("publisher"), default=publisher).alias("source"),
        F.coalesce(get("url"), F.lit("")).alias("url"),
        F.coalesce(get("published_date"), get("publishedDate"), F.lit("")).alias("published_date"))


def enrich(df: DataFrame, cfg: Labelling = Labelling(), collected_at: str | None = None,
           counts: DataFrame | None = None) -> DataFrame:
    """Raw articles to labelled articles.  Labels come from score-vector columns
    where present (``sentiment_scores``, ``importance_scores``,
    ``correlation_scores``) and from the rules otherwise; then confidences,
    review flag, provenance and quality score.  Per-row work only, except that
    ``counts`` (one row per code) is broadcast for the rarity shift."""
    rows = raw_article(df, cfg.publisher)
    have = set(rows.columns)
    scored = "sentiment_scores" in have or "importance_scores" in have
    null = F.lit(None).cast("double")
    rows = rows.withColumn("collected_at", F.lit(collected_at).cast("string"))
    if "sentiment_scores" in have:
        best = model.sentiment_or_rules(
            F.col("sentiment_scores"), "text", positive=cfg.positive, negative=cfg.negative)
        rows = rows.withColumn("_s", best).select("*", F.col("_s.label").alias("label"),
                                                  F.col("_s.confidence").alias("sentiment_confidence"))
    else:
        rows = rows.select("*", X.sentiment("text", cfg.positive, cfg.negative).alias("label"),
                           (F.lit(0.5) if scored else null).alias("sentiment_confidence"))
    if "importance_scores" in have:
        best = model.importance_or_rules(
            F.col("importance_scores"), "text", high=cfg.high, medium=cfg.medium)
        rows = rows.withColumn("_i", best).select("*", F.col("_i.label").alias("importance"),
                                                  F.col("_i.confidence").alias("importance_confidence"))
    else:
        rows = rows.select("*", X.importance("text", cfg.high, cfg.medium).alias("importance"),
                           (F.lit(0.5) if scored else null).alias("importance_confidence"))
    rules = cfg.rules("text")
    if "correlation_scores" in have:
        rows = correlate.pick_labels(rows, cfg.codes, "correlation_scores", "_picked", counts=counts)
        rows = rows.withColumn("correlations", correlate.choose_codes("_picked", rules))
    else:
        rows = rows.withColumn("correlations", rules)
    rows = provenance(rows, cfg, scored)
    rows = rows.withColumn("quality_score", X.quality_score(
        "title", "text", "source", "correlations", "sentiment_confidence", "importance_confidence",
        cfg.premium, cfg.high))
    return rows.drop("_s", "_i", "_picked", "sentiment_scores", "importance_scores",
                     "correlation_scores")


def provenance(df: DataFrame, cfg: Labelling, scored: bool) -> DataFrame:
    """Review flag and labelling provenance."""
    if scored:
        flag = L.needs_review("sentiment_confidence", "importance_confidence",
                              threshold=cfg.confidence_threshold)
    else:
        flag = F.lit(False)
    return df.select(
        "*", flag.alias("needs_review"),
        F.lit(cfg.sentiment_model or RULES).alias("sentiment_model"),
        F.lit(cfg.importance_model or RULES).alias("importance_model"),
        F.lit(cfg.correlation_model or "commodity_correlator").alias("correlation_model"),
        F.lit("triple_ml_produit" if scored else "rule_based_triple").alias("labeling_method"))


def collect(df: DataFrame, seen: DataFrame | None, count: int = 40, cfg: Labelling = Labelling(),
            limits: dict[str, int] = vocab.FEED_LIMITS, seq: str = "seq",
            use_cache: bool = True, collected_at: str | None = None):
    """One collection run: scaled quotas, acceptance in source order, labelling,
    best ``count`` by quality.  Returns (dataset, new hashes): the seen table
    gets every accepted article, also those the final cut drops."""
    have = set(df.columns)
    content = T.first_non_empty(
        *[F.col(c) if c in have else F.lit(None).cast("string") for c in ("text", "content")], default="")
    rows = df.withColumn("_c", content)
    accepted, new_hashes = dedup.accept(
        rows, seen, dedup.quotas(limits, count), seq, content="_c", use_cache=use_cache)
    labelled = enrich(accepted.drop("_c"), cfg, collected_at)
    return ranking.top_n(labelled, "quality_score", count, seq), new_hashes


def in_period(df: DataFrame, column: str, end, days: int, slice_days: int = 7) -> DataFrame:
    """Rows dated from ``end - days`` to ``end``, with the index of their slice."""
    end = F.lit(end).cast("date")
    start = F.date_sub(end, days)
    day = F.to_date(column)
    return df.filter((day >= start) & (day <= end)).withColumn(
        "slice", F.floor(F.date_diff(day, start) / slice_days))


def published_on(column, run_date) -> Column:
    """Published on the run date, or not dated at all."""
    day = F.to_date(T.col(column))
    return day.isNull() | (day == F.lit(run_date).cast("date"))


def standardise(df: DataFrame, target: str = "label", keep_unlabelled: bool = False,
                codes=vocab.COMMODITY_CODES, rejected: bool = False) -> DataFrame:
    """Training rows (text, label id) or, for correlations, (text, multi-hot
    labels).  Unknown labels and rows without text or label drop out;
    ``rejected`` returns the unknown labels instead, counted.
    ``keep_unlabelled`` keeps null correlations as all-zero vectors."""
    have = set(df.columns)

    def get(name):
        return F.col(name) if name in have else F.lit(None).cast("string")

    text = F.coalesce(T.non_empty(get("text")), T.compose(get("title"), get("content"), "plain"))
    extra = [c for c in ("seq", "doc_id", "key") if c in have]
    if target == "correlations":
        ok = F.col("_c").isNotNull() & (F.col("_c") != "")
        if keep_unlabelled:
            ok = F.col("_c").isNull() | ok
        rows = df.select(*extra, text.alias("text"), get("correlations").alias("_c"))
        return rows.filter(ok & (F.col("text") != "")).select(
            *extra, "text", C.multi_hot(C.parse_codes("_c"), codes).alias("labels"))
    if target == "importance":
        raw, mapping = F.coalesce(get("importance"), F.lit("")), vocab.IMPORTANCE_IDS
    else:
        raw, mapping = L.label_fallback(get("label"), get("sentiment"), get("impact")), vocab.SENTIMENT_IDS
    rows = df.select(*extra, text.alias("text"), F.lower(T.strip(raw)).alias("_l"))
    rows = rows.withColumn("label", L.encode("_l", mapping))
    if rejected:
        return rows.filter((F.col("_l") != "") & F.col("label").isNull()).groupBy(
            F.col("_l").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return rows.filter((F.col("text") != "") & F.col("label").isNotNull()).drop("_l")


def validate(df: DataFrame, by: str = "file", max_length: int = 512, min_samples: int = 10,
             datasets: DataFrame | None = None, columns=None):
    """Issue table and per-file report.  ``df`` needs ``line_number``.  The texts
    are read once, into a narrow table of facts; all rules work on that.  Facts
    and issues are written to the shared folder."""
    found = list(columns or df.columns)
    facts = materialise(V.facts(df, by), "facts")
    issues = V.structure_issues(facts, by, datasets, min_samples, found)
    if "text" in found:
        issues = issues.unionByName(V.row_issues(facts, by, max_length))
        if "label" in found:
            issues = issues.unionByName(V.duplicate_issues(facts, by))
    if "label" in found:
        issues = issues.unionByName(V.class_balance_issues(facts, by, datasets))
    issues = materialise(issues, "issues")
    return issues, V.report(facts, issues, by, datasets)


def validate_file(spark, path: str, max_length: int = 512, min_samples: int = 10):
    """Validate one CSV file, or the issue of its absence."""
    name = path.rsplit("/", 1)[-1]
    listed = spark.range(1).select(F.lit(name).alias("file"))
    if not files.path_exists(spark, path):
        issues = V.file_issue(spark, "file", path).withColumn("file", F.lit(name))
        empty = spark.createDataFrame([], "file string, line_number bigint")
        return issues, V.report(empty, issues, "file", listed)
    bad = csv_problems(spark, path).first()
    if bad:
        issues = V.file_issue(spark, "file", path, "csv_parse_error", bad["bad_rows"] + bad["unclosed"]).withColumn("file", F.lit(name))
        empty = spark.createDataFrame([], "file string, line_number bigint")
        return issues, V.report(empty, issues, "file", listed)
    rows, header = files.read_csv_as_is(spark, path)
    return validate(rows, "file", max_length, min_samples, listed, header)


def csv_problems(spark, path) -> DataFrame:
    """(file, bad_rows, unclosed) of the files that don't parse: records with more
    cells than their file's header, or quotes that are still open at its end."""
    rows, ends = records.cut(spark, path, records.Csv())
    # Bad rows are counted by number of cells: one short row for each width.
    widths = rows.groupBy("file", "cells").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first"))
    most = widths.groupBy("file").agg(F.min_by("cells", "first").alias("header"))
    bad = widths.join(most, "file").where("cells > header").groupBy("file").agg(F.sum("n").alias("bad_rows"))
    return ends.join(bad, "file", "left").where("unclosed or bad_rows > 0").select(
        "file", F.coalesce("bad_rows", F.lit(0)).cast("long").alias("bad_rows"), "unclosed")


def repair(df: DataFrame, seq: str, max_length: int = 512, by=()) -> DataFrame:
    """Clean texts, normalise labels, keep the first row per text, drop blanks."""
    # A text is blank after cleaning only if it was before, so the blank rows go
    # first, and the costly cleaning is not repeated in a filter.
    rows = df.filter(T.not_blank("text")).withColumn("text", T.clean_text("text", max_length))
    if "label" in df.columns:
        rows = rows.withColumn("label", L.normalise_sentiment("label"))
    if "importance" in df.columns:
        rows = rows.withColumn("importance", L.normalise_importance("importance"))
    return dedup.dedup_first(rows, "text", seq, by)


def to_daily(df: DataFrame, run_date, file: str = "file", high=None, medium=None) -> DataFrame:
    """Daily rows: valid rows with rule importance and the file's date.  One job
    converts any number of files; files that share a date are united."""
    rows = df.filter(L.valid_daily("text", "label"))
    extra = [c for c in ("url", "title", "source", "published_at", "seq") if c in df.columns]
    text = T.strip("text")
    return rows.select(
        text.alias("text"), F.lower("label").alias("label_sentiment"),
        X.importance(text, high, medium, "daily").alias("label_importance"), *extra,
        files.daily_date(file, run_date).alias("date"))


def replay_buffer(today: DataFrame, history: DataFrame, key: str, size: int = 800,
                  balance: bool = True, label: str = "label_sentiment", seed: int = 42) -> DataFrame:
    """Today's rows before the history, first of each non-empty text, classes
    balanced, at most ``size`` rows.  ``key`` is unique over both inputs."""
    both = dedup.union_prioritised(today, history)
    both = both.filter(T.non_empty("text").isNotNull()).withColumn(
        "_order", F.struct("priority", key))
    # The samples below look at the rows several times: keep the shuffled result.
    unique = materialise(dedup.dedup_first(both, "text", "_order").drop("_order"), "replay")
    if balance:
        if "label" in unique.columns:
            unique = unique.withColumn("_label", F.coalesce(T.non_empty(label), T.non_empty("label")))
        else:
            unique = unique.withColumn("_label", T.non_empty(label))
        unique = sampling.balance(unique, "_label", key, seed).drop("_label")
    return sampling.cap(unique, size, key, seed)
