"""One day's training: targets, split, fit, evaluate, decide."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsops import vocab
from newsops.functions.scores import predict_multilabel
from newsops.operators import gate, metrics, model, sampling, stats
from newsops.plans.datasets import standardise
from newsops.session import materialise


def evaluate(classifier: model.TextClassifier, df: DataFrame, label: str = "label") -> DataFrame:
    predicted = classifier.predict(df)
    row = metrics.multiclass_metrics(predicted, label, "prediction")
    return row.crossJoin(predicted.agg(F.avg("confidence").alias("avg_confidence")))


def train_target(df: DataFrame, target: str, key: str = "doc_id", baseline=None, seed: int = 42,
                 min_improvement: float = 0.02, force: bool = False,
                 iterations: int = model.UNTIL_CONVERGED) -> DataFrame:
    """Train and judge one target on a labelled dataset.  ``baseline`` is the
    classifier in use (evaluated on the same test rows); without one the fixed
    baseline applies.  Models are trained until they converge.  Returns one report row."""
    rows = materialise(standardise(df, target), f"train-{target}")
    if target == "correlations":
        k = len(vocab.COMMODITY_CODES)
        parts = materialise(sampling.split_multilabel(rows, "labels", key, "incremental", seed),
                            "split-correlations")
        fitted = model.fit_multilabel(parts.filter("split = 'train'"), vocab.COMMODITY_CODES,
                                      iterations=iterations)

        def measure(m):
            scored = m.predict(parts.filter("split = 'test'")).withColumn(
                "preds", predict_multilabel("probabilities"))
            return metrics.multilabel_metrics(scored, "labels", "preds", k)
    else:
        parts = materialise(sampling.split(rows, "label", key, "incremental", seed), f"split-{target}")
        fitted = model.fit_classifier(parts.filter("split = 'train'"), "label", iterations=iterations)

        def measure(m):
            return evaluate(m, parts.filter("split = 'test'"))
    multi = target == "correlations"
    new = materialise(measure(fitted), f"metrics-{target}")
    old = measure(baseline) if baseline is not None else gate.baseline_default(new, multi)
    verdict = gate.should_promote(gate.compare(old, new), multi, min_improvement, force)
    return gate.training_report(new, verdict, target_column=target, is_multi_label=multi,
                                mode="incremental").withColumn(
        "validation_metrics", F.to_json("validation_metrics"))


def daily_run(df: DataFrame, key: str = "doc_id", baselines=None, **options) -> DataFrame:
    """Every target the dataset supports (correlations only when present).  The
    dataset is written once: a target neither derives nor joins it anew."""
    df = materialise(df, "daily-dataset")
    targets = [r["target"] for r in stats.training_targets(df).collect()]  # at most three
    out = None
    for target in targets:
        row = train_target(df, target, key, (baselines or {}).get(target), **options)
        out = row if out is None else out.unionByName(row)
    return out


def incremental_update(today: DataFrame, history: DataFrame, key: str, label: str = "label_id",
                       size: int = 800, seed: int = 42, iterations: int = 20) -> model.TextClassifier:
    """Incremental update: refit on the replay buffer."""
    from newsops.functions.labels import encode
    from newsops.plans.datasets import replay_buffer

    buffer = replay_buffer(today, history, key, size, seed=seed)
    rows = buffer.withColumn(label, encode("label_sentiment", vocab.SENTIMENT_IDS, 0))
    return model.fit_classifier(materialise(rows, "replay"), label, iterations=iterations)
