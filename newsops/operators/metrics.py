"""Class weights, losses and evaluation metrics.

Rows are reduced to a confusion table (labels x labels) or to per-code sums in
one pass; everything after that works on those few numbers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsops.functions.text import col


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _f1(tp: Column, predicted: Column, actual: Column) -> Column:
    return _ratio(2.0 * tp, predicted + actual)


def multiclass_metrics(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    """Accuracy and weighted / macro precision, recall, F1 over the classes seen
    in truth or prediction; a zero division counts as 0."""
    by = [by] if isinstance(by, str) else list(by)
    confusion = df.groupBy(*by, label, pred).agg(F.count(F.lit(1)).alias("n"))
    same = F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0)
    sides = confusion.select(*by, F.inline(F.array(
        F.struct(F.col(label).alias("cls"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("predicted"), same.cast("bigint").alias("tp")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")))))
    per = sides.groupBy(*by, "cls").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    tp, predicted, actual = F.col("tp"), F.col("predicted"), F.col("actual")
    per = per.withColumns({
        "p": _ratio(tp, predicted), "r": _ratio(tp, actual), "f": _f1(tp, predicted, actual)})

    def weighted(x):
        return F.sum(F.col(x) * actual) / F.sum(actual)

    return per.groupBy(*by).agg(
        F.sum(actual).alias("rows"), (F.sum(tp) / F.sum(actual)).alias("accuracy"),
        weighted("p").alias("precision"), weighted("r").alias("recall"), weighted("f").alias("f1"),
        F.avg("p").alias("precision_macro"), F.avg("r").alias("recall_macro"),
        F.avg("f").alias("f1_macro"))


def per_code_counts(df: DataFrame, labels: str, preds: str) -> DataFrame:
    """(code index, rows, exact, tp, predicted, actual).  Rows unfold to one entry
    per code inside the scan and fold again in the partial aggregate, so only one
    entry per code and task is shuffled.  (A generated sum per code in one wide
    aggregate measured five times slower: it outgrows a compiled method.)"""
    exact = (F.col(labels) == F.col(preds)).cast("int")
    entries = df.select(exact.alias("exact"), F.posexplode(F.arrays_zip(
        F.col(labels).alias("y"), F.col(preds).alias("p"))).alias("code", "e"))
    y, p = F.col("e.y"), F.col("e.p")
    return entries.groupBy("code").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("exact").alias("exact"), F.sum(y * p).alias("tp"),
        F.sum(p).alias("predicted"), F.sum(y).alias("actual"))


def multilabel_metrics(df: DataFrame, labels: str, preds: str, k: int) -> DataFrame:
    """Micro / macro precision, recall, F1 over all k codes, Hamming score and
    loss, subset accuracy."""
    tp, predicted, actual = F.col("tp"), F.col("predicted"), F.col("actual")
    wrong = predicted + actual - 2 * tp
    rows = F.max("rows")
    stp, sp, sa = F.sum(tp), F.sum(predicted), F.sum(actual)
    loss = F.sum(wrong) / (rows * F.lit(k))
    return per_code_counts(df, labels, preds).agg(
        rows.alias("rows"), _f1(stp, sp, sa).alias("f1_micro"),
        _ratio(stp, sp).alias("precision_micro"), _ratio(stp, sa).alias("recall_micro"),
        F.avg(_f1(tp, predicted, actual)).alias("f1_macro"),
        F.avg(_ratio(tp, predicted)).alias("precision_macro"),
        F.avg(_ratio(tp, actual)).alias("recall_macro"),
        (1 - loss).alias("hamming_score"), loss.alias("hamming_loss"),
        (F.max("exact") / rows).alias("subset_accuracy"))


def class_weights(df: DataFrame, label: str, k: int = 3) -> DataFrame:
    """(class id 0..k-1, weight): n / (classes present * class count); a class
    that is absent weighs 1."""
    sums = [F.count_if(F.col(label) == i) for i in range(k)]
    row = df.agg(F.array(*sums).alias("n"))
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x)
    present = F.size(F.filter("n", lambda x: x > 0))
    weights = F.transform("n", lambda x: F.when(x > 0, total / (present * x)).otherwise(F.lit(1.0)))
    return row.select(F.posexplode(weights).alias("class", "weight"))


def with_class_weight(df: DataFrame, label: str, k: int = 3, out: str = "weight") -> DataFrame:
    """Weight column for training; the k-row table is broadcast."""
    weights = class_weights(df, label, k).select(F.col("class").alias(label), F.col("weight").alias(out))
    return df.join(F.broadcast(weights), label, "left")


def positive_counts(df: DataFrame, labels: str) -> DataFrame:
    """(code index, rows, positives): one entry per code."""
    return df.select(F.posexplode(labels).alias("code", "y")).groupBy("code").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y").alias("positives"))


def positive_weights(df: DataFrame, labels: str, low: float = 1.0, high: float = 50.0) -> DataFrame:
    """(code index, positives, weight): negatives / max(positives, 1), clipped."""
    weight = (F.col("rows") - F.col("positives")) / F.greatest("positives", F.lit(1.0))
    return positive_counts(df, labels).select(
        "code", "positives", F.least(F.lit(high), F.greatest(F.lit(low), weight)).alias("weight"))


def label_density(df: DataFrame, labels: str) -> DataFrame:
    """Rows, total positives, active codes, codes without any positive."""
    positives = F.col("positives")
    return positive_counts(df, labels).agg(
        F.max("rows").alias("rows"), F.sum(positives).alias("positives"),
        F.count_if(positives > 0).alias("active_codes"), F.count_if(positives == 0).alias("empty_codes"))


def softmax_ce(logits, label) -> Column:
    """Cross entropy of one row: log-sum-exp of the logits minus the true one."""
    x = F.transform(col(logits), lambda v: v.cast("double"))
    top = F.array_max(x)
    total = F.aggregate(F.transform(x, lambda v: F.exp(v - top)), F.lit(0.0), lambda a, v: a + v)
    return F.log(total) + top - F.element_at(x, (col(label) + 1).cast("int"))


def loss(df: DataFrame, kind: str, logits: str, labels: str, weights=None, gamma: float = 2.0) -> DataFrame:
    """Mean evaluation loss.  ``ce``: class-weighted cross entropy, normalised by
    the weights.  ``focal``: alpha * (1 - p)^gamma * ce.  ``bce``: binary cross
    entropy over the codes with positive weights.  ``weights`` is a short list."""
    table = None if weights is None else F.array(*[F.lit(float(w)) for w in weights])
    if kind == "bce":
        def one(y, x, w):
            # log(1 + exp(-x)) without overflow
            soft = F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))
            return w * y * soft + (1 - y) * (x + soft)

        x = F.transform(logits, lambda v: v.cast("double"))
        if table is None:
            terms = F.zip_with(labels, x, lambda y, v: one(y, v, F.lit(1.0)))
        else:
            terms = F.zip_with(labels, F.arrays_zip(x.alias("x"), table.alias("w")),
                               lambda y, e: one(y, e["x"], e["w"]))
        row = F.aggregate(terms, F.lit(0.0), lambda a, v: a + v) / F.size(terms)
        return df.agg(F.avg(row).alias("loss"))
    ce = df.select(softmax_ce(logits, labels).alias("ce"),
                   (F.lit(1.0) if table is None
                    else F.element_at(table, (F.col(labels) + 1).cast("int"))).alias("w"))
    if kind == "focal":
        term = F.col("w") * F.pow(1 - F.exp(-F.col("ce")), F.lit(gamma)) * F.col("ce")
        return ce.agg(F.avg(term).alias("loss"))
    return ce.agg((F.sum(F.col("w") * F.col("ce")) / F.sum("w")).alias("loss"))
