"""Per-row decisions over score vectors: no shuffle, no Python worker."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsops.functions.codes import whitelist
from newsops.functions.text import col, let


def adaptive_threshold(scores, p: float = 0.97, low: float = 0.22, high: float = 0.55) -> Column:
    """Linear ``p`` quantile of the row's scores, clamped; empty gives ``high``."""
    def quantile(s):
        k = F.lit(p) * (F.size(s) - 1)
        lower = F.element_at(s, (F.floor(k) + 1).cast("int"))
        upper = F.element_at(s, (F.ceil(k) + 1).cast("int"))
        return lower + (k - F.floor(k)) * (upper - lower)

    s = F.coalesce(col(scores), F.array().cast("array<double>"))
    q = let(F.array_sort(s), lambda x: F.when(F.size(x) > 0, quantile(x)).otherwise(F.lit(high)))
    return F.least(F.lit(high), F.greatest(F.lit(low), q))


def argmax_label(scores) -> Column:
    """struct(label, score) of the best entry; the first wins a tie.  Null without
    any score."""
    keyed = F.transform(col(scores), lambda e, i: F.struct(
        e["score"].alias("score"), (-i).alias("rank"), e["label"].alias("label")))
    return let(F.array_max(keyed), lambda b: F.when(b.isNotNull(), F.struct(
        b["label"].alias("label"), b["score"].alias("score"))))


def sigmoid(logits) -> Column:
    return F.transform(col(logits), lambda x: 1 / (1 + F.exp(-x.cast("double"))))


def predict_multilabel(probs, threshold: float = 0.25, top: int = 1) -> Column:
    """Strictly above the threshold; a row without any takes its ``top`` best
    (the highest index wins a tie)."""
    def fallback(p):
        order = F.slice(F.reverse(F.array_sort(F.transform(
            p, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))), 1, top)
        best = F.transform(order, lambda e: e["i"])
        return F.transform(p, lambda x, i: F.array_contains(best, i).cast("double"))

    return let(col(probs), lambda p: F.when(
        F.exists(p, lambda x: x > threshold),
        F.transform(p, lambda x: (x > threshold).cast("double"))).otherwise(fallback(p)))


def rarity_shift(count: Column) -> Column:
    """Frequent codes get a higher bar, rare codes a lower one."""
    return F.when(count >= 10, 0.02).when(count <= 1, -0.02).otherwise(0.0)


def pick_codes(scores, codes=None, max_labels: int = 3, top1: float = 0.40,
               shift=None, p=0.97, low=0.22, high=0.55) -> Column:
    """Codes at or above the row's threshold (plus ``shift(label)``), best first;
    the top one when nothing passes but it reaches ``top1``; then cut to
    ``max_labels``; then the whitelist."""
    shift = shift or (lambda label: F.lit(0.0))
    keyed = F.transform(col(scores), lambda e, i: F.struct(
        (-e["score"]).alias("s"), i.alias("i"), e["label"].alias("label"),
        shift(e["label"]).alias("shift")))
    threshold = adaptive_threshold(F.transform(col(scores), lambda e: e["score"]), p, low, high)

    def choose(both):
        order, t = both["order"], both["t"]
        passing = F.filter(order, lambda e: -e["s"] >= t + e["shift"])
        first = F.filter(F.slice(order, 1, 1), lambda e: -e["s"] >= top1)
        return F.transform(
            F.slice(F.when(F.size(passing) > 0, passing).otherwise(first), 1, max_labels),
            lambda e: e["label"])

    picked = let(F.struct(F.array_sort(keyed).alias("order"), threshold.alias("t")), choose)
    return whitelist(picked, codes)


def count_limits(scores, p=0.97, low=0.22, high=0.55) -> Column:
    """Candidates best first, as (label, score, under): a label passes the row's
    threshold, with the shift of its rarity, while its count is below ``under``."""
    keyed = F.transform(F.coalesce(col(scores), F.array().cast("array<struct<label:string,score:double>>")),
                        lambda e, i: F.struct((-e["score"]).alias("s"), i.alias("i"), e["label"].alias("label")))
    threshold = adaptive_threshold(F.transform(col(scores), lambda e: e["score"]), p, low, high)

    def limited(both):
        passes = lambda e, n: -e["s"] >= both["t"] + rarity_shift(F.lit(n))
        return F.transform(both["order"], lambda e: F.struct(
            e["label"].alias("label"), (-e["s"]).alias("score"),
            F.when(passes(e, 10), F.lit((1 << 31) - 1)).when(passes(e, 2), 10).when(passes(e, 0), 2).otherwise(0).alias("under")))

    return let(F.struct(F.array_sort(keyed).alias("order"), threshold.alias("t")), limited)
