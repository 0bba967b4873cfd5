"""Multinomial naive Bayes over TF-IDF weights (additive smoothing, learned class prior).

Fit: one aggregate of weights per (class, term) and one count per class; the
K x V log-probability table is the model. Predict/score: a per-row fold over the
document's weights (no join, no shuffle). Spark ML's NaiveBayes also smooths the
class prior, which differs from the unsmoothed prior used here.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.functions.text import let
from reviewlab.operators.features import TfidfModel, literal

SCORE_DIGITS = 9   # log-scores are rounded before arg-max so ties resolve the same everywhere


@dataclass(frozen=True)
class NaiveBayesModel:
    classes: tuple[int, ...]               # class ids seen in training, ascending
    terms: tuple[str, ...]
    log_prob: tuple[tuple[float, ...], ...]  # [class][term]
    log_prior: tuple[float, ...]

    def joint_log_likelihood(self, weights: Column) -> Column:
        """array<double> of per-class scores, in ``classes`` order; an entry's table row is read by its code."""
        k = len(self.classes)
        table = literal([[self.log_prob[c][j] for c in range(k)] for j in range(len(self.terms))], "array<array<double>>")
        zero = F.array(*[F.lit(0.0) for _ in range(k)])
        dot = F.aggregate(weights, zero, lambda acc, x: F.zip_with(
            acc, F.element_at(table, x["code"] + 1), lambda a, b: a + x["weight"] * b))
        prior = F.array(*[F.lit(p) for p in self.log_prior])
        return F.zip_with(dot, prior, lambda a, b: a + b)

    def predict(self, weights: Column) -> Column:
        """Class id with the highest rounded score (smallest id on ties)."""
        r = F.transform(self.joint_log_likelihood(weights), lambda x: F.round(x, SCORE_DIGITS))
        ids = F.array(*[F.lit(c) for c in self.classes])
        return let(r, lambda v: F.element_at(ids, F.array_position(v, F.array_max(v)).cast("int"))).cast("bigint")

    def probabilities(self, weights: Column) -> Column:
        """Softmax of the joint log-likelihood -> array<double> in ``classes`` order."""
        def softmax(jll):
            e = F.transform(jll, lambda x: F.exp(x - F.array_max(jll)))
            return let(e, lambda ev: let(F.aggregate(ev, F.lit(0.0), lambda a, b: a + b),
                                         lambda tot: F.transform(ev, lambda x: x / tot)))
        return let(self.joint_log_likelihood(weights), softmax)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(int(c), t, float(self.log_prob[i][j]), float(self.log_prior[i]))
                for i, c in enumerate(self.classes) for j, t in enumerate(self.terms)]
        return spark.createDataFrame(rows, "label_id bigint, term string, log_prob double, log_prior double")


def fit_naive_bayes(train: DataFrame, label_id: str, weights: str, tfidf: TfidfModel,
                    alpha: float = 4.0) -> NaiveBayesModel:
    """Fit from rows (label_id, weights array). Two small aggregates are collected:
    class counts (K rows) and per-(class, term) weight sums (<= K x V rows)."""
    counts = {r[0]: r[1] for r in train.groupBy(label_id).count().collect()}
    sums = (train.select(label_id, F.inline(weights))
            .groupBy(label_id, "term").agg(F.sum("weight").alias("s")).collect())
    classes = tuple(sorted(counts))
    terms = tfidf.terms
    idx = {t: j for j, t in enumerate(terms)}
    fc = {c: [0.0] * len(terms) for c in classes}
    for r in sums:
        fc[r[0]][idx[r["term"]]] = float(r["s"])
    log_prob = []
    for c in classes:
        smoothed = [v + alpha for v in fc[c]]
        denom = math.log(sum(smoothed))
        log_prob.append(tuple(math.log(v) - denom for v in smoothed))
    total = sum(counts.values())
    log_prior = tuple(math.log(counts[c]) - math.log(total) for c in classes)
    return NaiveBayesModel(classes, terms, tuple(log_prob), log_prior)
