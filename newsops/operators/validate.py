"""Dataset validation: row rules, group rules, table rules, report.

Everything is per dataset file: ``by`` names the file column."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsops import vocab
from newsops.functions.labels import lookup, valid_sentiment
from newsops.functions.text import has_suspicious, is_blank, is_upper, strip
from newsops.operators.dedup import duplicate_counts

ISSUE_FIELDS = ["type", "message", "line_number", "field", "severity"]


def _issue(kind: str, message: Column | str, line: Column | None = None,
           field: str | None = None, severity: str = "error") -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(
        F.lit(kind).alias("type"), message.alias("message"),
        (F.lit(None) if line is None else line).cast("bigint").alias("line_number"),
        F.lit(field).cast("string").alias("field"), F.lit(severity).alias("severity"))


def facts(df: DataFrame, by: str | None = None, line: str = "line_number") -> DataFrame:
    """What the rules need to know about a row, without its text: label, lengths,
    flags, text fingerprint and the first characters for messages."""
    out = [by] if by else []
    if line in df.columns:
        out.append(F.col(line).cast("bigint").alias("line_number"))
    if "label" in df.columns:
        out.append(F.col("label"))
    if "text" in df.columns:
        text = F.col("text")
        out += [
            F.length(text).alias("_len"), F.length(strip(text)).alias("_stripped"),
            has_suspicious(text).alias("_odd"), is_upper(text).alias("_caps"),
            F.md5(text).alias("_key"), F.left(text, F.lit(50)).alias("_head")]
    return df.select(*out)


def _facts(df: DataFrame, by: str | None, line: str = "line_number") -> DataFrame:
    return df if "text" not in df.columns else facts(df, by, line)


def row_issues(df: DataFrame, by: str | None = None, max_length: int = 512,
               line: str = "line_number") -> DataFrame:
    """Rules that look at one row (of a dataset or of its facts).  One projection
    builds the row's issues as an array and unfolds it: no shuffle, one scan."""
    df = _facts(df, by, line)
    at, length = F.col("line_number"), F.col("_len")
    rules: list[Column] = []
    if {"_len", "label"} <= set(df.columns):
        label = F.col("label")
        no_label = is_blank(label)
        bad_label = ~no_label & ~F.coalesce(strip(F.lower(label)).isin(*vocab.SENTIMENTS), F.lit(False))
        rules += [
            F.when(no_label, _issue("missing_label", vocab.MSG_MISSING_LABEL, at, "label")),
            F.when(bad_label, _issue(
                "invalid_label", F.format_string(vocab.MSG_INVALID_LABEL, label), at, "label")),
            F.when(length.isNull() & ~no_label & ~bad_label,
                   _issue("missing_text", vocab.MSG_MISSING_TEXT, at, "text")),
            F.when(F.col("_stripped") == 0, _issue("empty_text", vocab.MSG_EMPTY_TEXT, at, "text")),
        ]
    if "_len" in df.columns:
        def warn(cond, kind, message):
            return F.when((length > 0) & cond, _issue(kind, message, at, "text", "warning"))

        rules += [
            warn(F.col("_stripped") < 10, "very_short_text", F.format_string(vocab.MSG_VERY_SHORT, length)),
            warn(length > max_length, "text_too_long",
                 F.format_string(vocab.MSG_TOO_LONG, length, F.lit(max_length))),
            warn(F.col("_odd"), "suspicious_characters", vocab.MSG_SUSPICIOUS),
            warn((length > 20) & F.col("_caps"), "all_caps_text", vocab.MSG_ALL_CAPS),
        ]
    keep = [by] if by else []
    if not rules:
        return df.limit(0).select(*keep, F.inline(F.array(_issue("", ""))))
    return df.select(*keep, F.inline(F.array_compact(F.array(*rules))))


def duplicate_issues(df: DataFrame, by: str, line: str = "line_number") -> DataFrame:
    """One warning per duplicated text and file, at every size: how many lines
    hold it, and the first.  All the lines are in the long table of
    ``dedup.duplicate_lines``.  Partial sums leave one row per text and task."""
    groups = _facts(df, by, line).filter(F.col("_key").isNotNull()).groupBy(by, "_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("line_number").alias("_first"), F.min("_head").alias("_head"))
    issue = _issue("duplicate_text", F.format_string(vocab.MSG_DUPLICATE, "_n", "_first", "_head"), severity="warning")
    return groups.filter("_n > 1").select(by, F.inline(F.array(issue)))


def _percent(x: Column) -> Column:
    return F.format_number(x * 100, 1)


def class_balance_issues(df: DataFrame, by: str, datasets: DataFrame | None = None,
                         low: float = 0.1, high: float = 0.7) -> DataFrame:
    """Per file and class: absent, below ``low``, or at least ``high`` of the
    valid labels.  Validity ignores case but does not strip; a class is counted
    by its exact lower-case name.  One aggregate per file."""
    valid = valid_sentiment("label")
    stats = df.groupBy(by).agg(
        F.count_if(valid).alias("_valid"),
        *[F.count_if(F.col("label") == c).alias(c) for c in vocab.SENTIMENTS])
    if datasets is not None:
        stats = datasets.select(by).join(stats, by, "left").fillna(0)
    rules = [F.when(F.col("_valid") == 0, _issue("no_valid_labels", vocab.MSG_NO_VALID_LABELS))]
    for c in ["positive", "negative", "neutral"]:
        n, share = F.col(c), F.col(c) / F.col("_valid")
        text = [F.lit(c), n, _percent(share)]
        rules.append(F.when(F.col("_valid") > 0, F.when(
            n == 0, _issue("missing_class", F.format_string(vocab.MSG_MISSING_CLASS, F.lit(c)),
                           severity="warning"))
            .when(share < low, _issue("underrepresented_class", F.format_string(
                vocab.MSG_UNDER_CLASS, *text), severity="warning"))
            .when(share >= high, _issue("overrepresented_class", F.format_string(
                vocab.MSG_OVER_CLASS, *text), severity="warning"))))
    return stats.select(by, F.inline(F.array_compact(F.array(*rules))))


def structure_issues(df: DataFrame, by: str, datasets: DataFrame | None = None,
                     min_samples: int = 10, columns=None) -> DataFrame:
    """Missing and extra columns, empty files, too few samples.  ``datasets``
    lists the expected files, so that an empty one is noticed; ``columns`` are
    the columns found in the files (default: those of ``df``)."""
    found = [c for c in (columns or df.columns) if c not in (by, "line_number")]
    missing = [c for c in ("label", "text") if c not in found]
    extra = sorted(c for c in found if c not in ("label", "text"))
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    if datasets is not None:
        counts = datasets.select(by).join(counts, by, "left").fillna(0)
    rules = [
        F.when(F.col("_n") == 0, _issue("empty_dataset", vocab.MSG_EMPTY_DATASET))
        .when(F.col("_n") < min_samples, _issue(
            "insufficient_samples",
            F.format_string(vocab.MSG_FEW_SAMPLES, F.col("_n"), F.lit(min_samples)),
            severity="warning"))]
    if extra:
        shown = "{" + ", ".join(f"'{c}'" for c in extra) + "}"
        rules.insert(0, _issue("extra_columns", vocab.MSG_EXTRA_COLUMNS % shown, severity="warning"))
    if missing:
        shown = "{" + ", ".join(f"'{c}'" for c in missing) + "}"
        rules.insert(0, _issue("missing_columns", vocab.MSG_MISSING_COLUMNS % shown))
    return counts.select(by, F.inline(F.array_compact(F.array(*rules))))


def file_issue(spark, by: str, path: str, kind: str = "file_not_found", bad_rows: int = 0) -> DataFrame:
    """The single issue of a file that cannot be read."""
    message = (vocab.MSG_NO_FILE % path) if kind == "file_not_found" else (vocab.MSG_CSV_ERROR % bad_rows)
    return spark.range(1).select(F.lit(path).alias(by), F.inline(F.array(_issue(kind, message))))


def missing_files(expected: DataFrame, present: DataFrame, by: str = "name") -> DataFrame:
    """``file_not_found`` for every expected name that the catalogue lacks."""
    lost = expected.select(by).distinct().join(present.select(by).distinct(), by, "left_anti")
    message = F.format_string(vocab.MSG_NO_FILE, by)
    return lost.select(by, F.inline(F.array(_issue("file_not_found", message))))


def report(df: DataFrame, issues: DataFrame, by: str, datasets: DataFrame | None = None) -> DataFrame:
    """One row per file: success, issue counts and, for a successful non-empty
    file, its statistics.  ``df`` is the dataset or its facts."""
    counted = issues.groupBy(by).agg(
        F.count_if(F.col("severity") == "error").alias("error_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"))
    df = _facts(df, by)
    cols = set(df.columns)
    length = F.col("_len") if "_len" in cols else F.lit(None).cast("int")
    label = F.col("label") if "label" in cols else F.lit(None).cast("string")
    stats = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_samples"), F.count_if(valid_sentiment(label)).alias("valid_samples"),
        F.coalesce(F.round(F.avg(length), 6), F.lit(0.0)).alias("avg_text_length"),
        F.coalesce(F.max(length), F.lit(0)).cast("bigint").alias("max_text_length"),
        F.coalesce(F.min(length), F.lit(0)).cast("bigint").alias("min_text_length"))
    if "label" in cols:
        # Valid labels in any case: at most a few spellings per file.
        per_label = (df.filter(valid_sentiment(label)).groupBy(by, "label")
                     .agg(F.count(F.lit(1)).alias("n")))
        dist = per_label.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(
            F.concat_ws("=", "label", "n"))), ";").alias("label_distribution"))
        stats = stats.join(dist, by, "left")
    else:
        stats = stats.withColumn("label_distribution", F.lit(None).cast("string"))
    if "_key" in cols:
        stats = stats.join(duplicate_counts(df, by, key="_key"), by, "left")
    else:
        stats = stats.withColumn("duplicates", F.lit(0).cast("bigint"))
    if datasets is None:
        files = df.select(by).union(issues.select(by)).distinct()
    else:
        files = datasets.select(by).distinct()
    out = files.join(counted, by, "left").join(stats, by, "left")
    errors = F.coalesce("error_count", F.lit(0)).cast("bigint")
    ok = (errors == 0) & F.col("total_samples").isNotNull()
    stat_cols = ["total_samples", "valid_samples", "avg_text_length", "max_text_length",
                 "min_text_length", "label_distribution", "duplicates"]
    filled = {"label_distribution": F.coalesce("label_distribution", F.lit("")),
              "duplicates": F.coalesce("duplicates", F.lit(0)).cast("bigint")}
    return out.select(
        by, (errors == 0).alias("validation_success"), errors.alias("error_count"),
        F.coalesce("warning_count", F.lit(0)).cast("bigint").alias("warning_count"),
        *[F.when(ok, filled.get(c, F.col(c))).alias(c) for c in stat_cols])


def total_report(reports: DataFrame) -> DataFrame:
    """Roll-up over all files."""
    return reports.agg(
        F.count(F.lit(1)).alias("files"), F.count_if("validation_success").alias("files_ok"),
        F.sum("error_count").alias("error_count"), F.sum("warning_count").alias("warning_count"),
        F.sum("total_samples").alias("total_samples"), F.sum("valid_samples").alias("valid_samples"))


def auto_approve(reports: DataFrame) -> DataFrame:
    """No error and fewer than three warnings."""
    return reports.withColumn(
        "auto_approved", (F.col("error_count") == 0) & (F.col("warning_count") < 3))


# Order of the rule groups in a report.
PHASES = {
    "file_not_found": 0, "csv_parse_error": 0,
    "missing_columns": 1, "extra_columns": 1, "empty_dataset": 1, "insufficient_samples": 1,
    "missing_label": 2, "invalid_label": 2, "missing_text": 2, "empty_text": 2,
    "duplicate_text": 3,
    "no_valid_labels": 4, "missing_class": 4, "underrepresented_class": 4,
    "overrepresented_class": 4,
    "very_short_text": 5, "text_too_long": 5, "suspicious_characters": 5, "all_caps_text": 5,
}


def issue_lines(issues: DataFrame, by: str) -> DataFrame:
    """Text lines of the review comment with their sort keys (section, pos,
    phase, line_number): errors, warnings, advice.  A file without issues has
    no lines."""
    section = F.when(F.col("severity") == "error", 1).otherwise(2)

    def rows(df, section, pos, line, phase=F.lit(0), at=F.lit(0)):
        return df.select(by, section.alias("section"), F.lit(pos).alias("pos"),
                         phase.alias("phase"), at.cast("bigint").alias("line_number"),
                         line.alias("line"))

    suffix = F.when(F.col("line_number") > 0, F.format_string(" (ligne %d)", "line_number")).otherwise("")
    body = rows(issues, section, 2, F.concat(F.lit("• "), F.col("message"), suffix),
                lookup(F.col("type"), PHASES), F.coalesce("line_number", F.lit(0)))
    counts = issues.groupBy(by, "severity").agg(F.count(F.lit(1)).alias("n"))
    title = (F.when(F.col("severity") == "error", F.format_string(vocab.LINE_ERRORS, "n"))
             .otherwise(F.format_string(vocab.LINE_WARNINGS, "n")))
    head = rows(counts, section, 0, title)
    blanks = rows(counts, section, 1, F.lit("")).unionByName(rows(counts, section, 3, F.lit("")))
    advice = rows(issues.select(by).distinct(), F.lit(3), 0, F.lit(vocab.LINE_ADVICE))
    return head.unionByName(blanks).unionByName(body).unionByName(advice)
