"""Plugged-in scoring models and classifiers trained with MLlib."""
from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from newsops import vocab
from newsops.functions import labels as L, lexicon as X, scores as S
from newsops.functions.text import model_input
from newsops.operators.metrics import positive_weights, with_class_weight

SCORES = "array<struct<label:string,score:double>>"


def score(df: DataFrame, loader: Callable[[], Callable], text: str = "text", out: str = "scores",
          size: int = 512) -> DataFrame:
    """Adds the score vectors of a model.  ``loader`` runs once per worker and
    returns a callable from a Series of texts to a list of [(label, score)]
    lists.  A text that fails has null scores, which the labelling below replaces by
    the rules: a failing batch is halved until the failing texts are alone, so
    the others keep their scores whatever the batch size.  A ``loader`` that
    fails is told in the worker's log, and all its texts go by the rules.  The only Python worker in the library's labelling:
    filter and deduplicate before it."""
    @F.pandas_udf(SCORES)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            model = loader()
        except Exception:
            traceback.print_exc()
            model = None

        def scored(texts: pd.Series) -> list:
            if model is None:
                return [None] * len(texts)
            try:
                return [[{"label": a, "score": float(b)} for a, b in r] for r in model(texts)]
            except Exception:
                if len(texts) == 1:
                    return [None]
                half = len(texts) // 2
                return scored(texts.iloc[:half]) + scored(texts.iloc[half:])

        for texts in batches:
            yield pd.Series(scored(texts) if len(texts) else [], index=texts.index, dtype=object)

    return df.withColumn(out, predict(model_input(text, size)))


def sentiment_or_rules(scores, text, **lexicon) -> Column:
    """struct(label, confidence): the model's best label, or the lexicon's with
    confidence 0.5 where the model gave nothing."""
    best = S.argmax_label(scores)
    return F.when(best.isNotNull(), F.struct(
        L.model_label(best["label"], vocab.MODEL_SENTIMENT, "neutral").alias("label"),
        best["score"].alias("confidence"))).otherwise(F.struct(
            X.sentiment(text, **lexicon).alias("label"), F.lit(0.5).alias("confidence")))


def importance_or_rules(scores, text, **tiers) -> Column:
    best = S.argmax_label(scores)
    return F.when(best.isNotNull(), F.struct(
        L.model_label(best["label"], vocab.MODEL_IMPORTANCE, "générale").alias("label"),
        best["score"].alias("confidence"))).otherwise(F.struct(
            X.importance(text, **tiers).alias("label"), F.lit(0.5).alias("confidence")))


def featuriser(text: str = "text", features: int = 1 << 16) -> PipelineModel:
    """Words and their hashed counts (``_tf``); nothing in it is learnt."""
    return PipelineModel([
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)])


class TextClassifier:
    """Fitted features and logistic regression."""

    def __init__(self, features, model):
        self.features, self.model = features, model

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Adds the predicted class id, its probability and all probabilities."""
        rows = self.model.transform(self.features.transform(df))
        probs = vector_to_array("probability")
        return rows.select(*df.columns, F.col("prediction").cast("int").alias(out),
                           F.array_max(probs).alias("confidence"), probs.alias("probabilities"))


# More steps than the optimiser takes: it stops once its objective stands still.
UNTIL_CONVERGED = 2**31 - 1


def few_parts(df: DataFrame, most: int = 8) -> DataFrame:
    """At least as many partitions as there are cores, where ``df`` has them, each
    made of about ``most`` at most: every step of the optimiser sends a dense
    gradient for each of them, however few its rows are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.coalesce(max(cores, splits // most))


def fit_classifier(df: DataFrame, label: str = "label_id", text: str = "text", balanced: bool = True,
                   classes: int = 3, features: int = 1 << 16, iterations: int = 20) -> TextClassifier:
    """Text classifier with optional balanced class weights.  The optimiser
    aggregates gradients in a tree over the partitions; only the words' counts are
    cached, and they spill: texts are read and cut once."""
    rows = with_class_weight(df, label, classes, "_weight") if balanced else df
    words = featuriser(text, features)
    cols = [label, "_weight"] if balanced else [label]
    counts = words.transform(rows).select("_tf", *[F.col(c).cast("double").alias(c) for c in cols]).persist()
    try:
        idf = IDF(inputCol="_tf", outputCol="features").fit(counts)
        train = few_parts(idf.transform(counts).drop("_tf"))
        estimator = LogisticRegression(labelCol=label, maxIter=iterations, regParam=0.01,
                                       family="multinomial")
        if balanced:
            estimator = estimator.setWeightCol("_weight")
        return TextClassifier(PipelineModel([words, idf]), estimator.fit(train))
    finally:
        counts.unpersist()


class MultiLabelClassifier:
    """One binary model per code that has positives."""

    def __init__(self, features, models: dict[int, object], k: int):
        self.features, self.models, self.k = features, models, k

    def predict(self, df: DataFrame, out: str = "probabilities") -> DataFrame:
        """Adds k probabilities; a code without a model scores 0."""
        rows = self.features.transform(df)
        for i, m in self.models.items():
            m = m.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("")
            rows = m.transform(rows)
        probs = [F.element_at(vector_to_array(f"_p{i}"), 2) if i in self.models else F.lit(0.0)
                 for i in range(self.k)]
        return rows.select(*df.columns, F.array(*probs).alias(out))


def fit_multilabel(df: DataFrame, codes, labels: str = "labels", text: str = "text",
                   features: int = 1 << 14, iterations: int = 10) -> MultiLabelClassifier:
    """Weighted binary models over shared, cached features; positive weights as
    clipped negative/positive ratios.  The loop runs over codes, not rows."""
    k = len(codes)
    weights = [(r["code"], r["positives"], r["weight"])
               for r in positive_weights(df, labels).collect()]  # k rows
    words = featuriser(text, features)
    counts = words.transform(df).select("_tf", labels).persist()
    models = {}
    try:
        idf = IDF(inputCol="_tf", outputCol="features").fit(counts)
        train = few_parts(idf.transform(counts).select("features", labels))
        for i, positives, weight in weights:
            if positives <= 0:
                continue
            y = F.element_at(labels, i + 1)
            rows = train.select("features", y.alias("label"),
                                F.when(y > 0, F.lit(float(weight))).otherwise(1.0).alias("w"))
            models[i] = LogisticRegression(
                labelCol="label", weightCol="w", maxIter=iterations, regParam=0.01,
                family="binomial").fit(rows)
    finally:
        counts.unpersist()
    return MultiLabelClassifier(PipelineModel([words, idf]), models, k)
