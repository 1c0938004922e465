"""Promotion and quality gates over metric rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsops import vocab


def _fixed(x: Column) -> Column:
    # format_number rounds the exact binary value, as Python's formatting does.
    return F.format_number(x, 3)


def baseline_default(df_new: DataFrame, multi_label: bool) -> DataFrame:
    """The baseline used when there is no test set to measure one."""
    names = ["accuracy", "f1", "f1_macro", "precision", "recall"]
    names += ["f1_micro", "hamming_score"] if multi_label else []
    return df_new.sparkSession.range(1).select(*[F.lit(0.5).alias(n) for n in names])


def compare(baseline: DataFrame, candidate: DataFrame, on=()) -> DataFrame:
    """Metric rows side by side (``old_*`` and ``new_*``): joined on the task
    columns, or one row with one row."""
    on = list(on)
    old = baseline.select(*on, *[F.col(c).alias(f"old_{c}") for c in baseline.columns if c not in on])
    new = candidate.select(*on, *[F.col(c).alias(f"new_{c}") for c in candidate.columns if c not in on])
    return new.join(old, on) if on else new.crossJoin(old)


def should_promote(pairs: DataFrame, multi_label: bool = False, min_improvement: float | None = None,
                   force: bool = False, limits=vocab.PROMOTION) -> DataFrame:
    """Adds ``promote`` and ``reason``.  Checks in order: minimum quality, then
    a gain in either metric.  A minimum improvement of 0 means the default."""
    gain = min_improvement or limits["improvement"]
    new = lambda c: F.coalesce(F.col(f"new_{c}"), F.lit(0.0))
    old = lambda c: F.coalesce(F.col(f"old_{c}"), F.lit(0.0))
    if multi_label:
        main, floor, side = "f1_micro", limits["min_f1_micro"], "hamming_score"
        first_bad = new(side) < limits["min_hamming"]
        first = F.concat(F.lit("Hamming score insuffisant: "), _fixed(new(side)),
                         F.lit(f" < {limits['min_hamming']}"))
        gained = lambda d_main, d_side: F.concat(
            F.lit(f"Amélioration détectée - {main}: +"), _fixed(d_main),
            F.lit(", Hamming: +"), _fixed(d_side))
    else:
        main, floor, side = "f1_macro", limits["min_f1"], "accuracy"
        first_bad = new(side) < limits["min_accuracy"]
        first = F.concat(F.lit("Précision insuffisante: "), _fixed(new(side)),
                         F.lit(f" < {limits['min_accuracy']}"))
        gained = lambda d_main, d_side: F.concat(
            F.lit("Amélioration détectée - Accuracy: +"), _fixed(d_side),
            F.lit(f", {main}: +"), _fixed(d_main))
    d_main, d_side = new(main) - old(main), new(side) - old(side)
    better = (d_main >= gain) | (d_side >= gain)
    weak = F.concat(F.lit(f"{main} insuffisant: "), _fixed(new(main)), F.lit(f" < {floor}"))
    ok = ~first_bad & (new(main) >= floor) & better
    reason = (F.when(first_bad, first).when(new(main) < floor, weak)
              .when(better, gained(d_main, d_side))
              .otherwise(F.lit(f"Amélioration insuffisante (min: {gain})")))
    if force:
        reason = F.when(ok, reason).otherwise(
            F.concat(F.lit("Mise à jour forcée (--force-update). "), reason))
        ok = F.lit(True)
    return pairs.withColumn("promote", ok).withColumn("reason", reason)


def last_metric(history: DataFrame) -> DataFrame:
    """(task, previous): the newest stored value per task."""
    return history.groupBy("task").agg(F.max_by("f1_macro", "ts").alias("previous"))


def metrics_gate(history: DataFrame, current: DataFrame, drop: float = 0.01) -> DataFrame:
    """Adds ``previous`` and ``passed`` to the current (task, f1_macro) rows: a
    first run passes; else the value may fall by ``drop``.  The caller appends
    the current rows to the history whether they pass or not."""
    previous = F.coalesce("previous", F.lit(0.0))
    return current.join(last_metric(history), "task", "left").withColumn(
        "previous", previous).withColumn(
        "passed", (F.col("previous") == 0) | (F.col("previous") - F.col("f1_macro") <= drop))


def meets_thresholds(metrics: DataFrame, limits=vocab.PERFORMANCE) -> DataFrame:
    return metrics.withColumn(
        "meets", (F.col("accuracy") >= limits["min_accuracy"]) & (F.col("f1") >= limits["min_f1"])
        & (F.col("avg_confidence") >= limits["min_confidence"]))


def training_report(metrics: DataFrame, decision: DataFrame | None = None, **params) -> DataFrame:
    """One row: run parameters, metrics as a struct, and the decision."""
    row = metrics.select(
        *[F.lit(v).alias(k) for k, v in params.items()],
        F.struct(*metrics.columns).alias("validation_metrics"))
    if decision is None:
        return row
    return row.crossJoin(decision.select(F.col("promote").alias("model_updated"),
                                         F.col("reason").alias("update_reason")))
