"""Registered training/feature/model queries (prepare, split, TF-IDF, naive Bayes, metrics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import evaluate as ev
from reviewlab.operators.features import doc_terms, label_map_frame
from reviewlab.functions import text as tx
from reviewlab.plans.common import rounded
from reviewlab.plans.training import FEATURES, LABEL_ID, SPLIT, fit_text_classifier, prepare
from reviewlab.schema import DEFAULT as C
from reviewlab.sources import tables as tb

_FITTED: dict = {}


def _prepared(spark, sf_dir):
    """Prepared training rows, persisted once per session and input."""
    key = ("prepared", spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = prepare(tb.reviews(spark, sf_dir))
    return _FITTED[key]


def _classifier(spark, sf_dir):
    """The fitted model is a small driver-side object; reuse it within one session."""
    key = ("classifier", spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = fit_text_classifier(_prepared(spark, sf_dir))
    return _FITTED[key]


def label_encode(spark, sf_dir):
    return _prepared(spark, sf_dir).frame.select(C.id, C.label, LABEL_ID)


def label_map(spark, sf_dir):
    return label_map_frame(_prepared(spark, sf_dir).frame, C.label)


def stratified_split(spark, sf_dir):
    return _prepared(spark, sf_dir).frame.select(C.id, C.label, SPLIT)


def union_train_val(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return p.train().select(C.id, SPLIT).unionByName(p.val().select(C.id, SPLIT))


def ngrams(spark, sf_dir):
    r = tb.review_texts(spark, sf_dir).filter(F.col(C.text).isNotNull())
    x = r.select(C.id, F.explode(tx.term_counts(doc_terms(F.col(C.text)))).alias("x"))
    return x.select(C.id, F.col("x.term").alias("term"), F.col("x.tf").alias("tf"))


def tfidf_vocabulary(spark, sf_dir):
    return rounded(_classifier(spark, sf_dir).tfidf.vocabulary_frame(spark))


def tfidf_weights(spark, sf_dir):
    clf = _classifier(spark, sf_dir)
    f = clf.features(_prepared(spark, sf_dir).frame, C.text, already_clean=True)
    return rounded(f.select(C.id, SPLIT, F.inline(FEATURES)).drop("code"))


def nb_model(spark, sf_dir):
    return rounded(_classifier(spark, sf_dir).nb.to_frame(spark))


def _val_predictions(spark, sf_dir):
    clf = _classifier(spark, sf_dir)
    val = _prepared(spark, sf_dir).val()
    return clf.predict(val, C.text, already_clean=True)


def nb_predict(spark, sf_dir):
    return _val_predictions(spark, sf_dir).select(C.id, LABEL_ID, "pred_id")


def decode_labels(spark, sf_dir):
    return _val_predictions(spark, sf_dir).select(C.id, "pred_id", "prediction")


def batch_predict(spark, sf_dir):
    clf = _classifier(spark, sf_dir)
    r = tb.review_texts(spark, sf_dir).filter(F.col(C.text).isNotNull())
    return clf.predict(r, C.text).select(C.id, "prediction")


def batch_predict_raw(spark, sf_dir):
    """Scoring the raw text (no training clean first), as the original service did."""
    from dataclasses import replace
    clf = replace(_classifier(spark, sf_dir), clean=False)
    r = tb.review_texts(spark, sf_dir).filter(F.col(C.text).isNotNull())
    return clf.predict(r, C.text).select(C.id, "prediction")


def predict_proba(spark, sf_dir):
    clf = _classifier(spark, sf_dir)
    val = _prepared(spark, sf_dir).val().select(C.id, C.text)
    p = clf.predict_proba(val, C.text, already_clean=True)
    return rounded(p.select(C.id, F.explode("probability").alias("label", "probability"), "confidence"))


def nb_eval_metrics(spark, sf_dir):
    """Hold-out metrics of the naive Bayes model (true vs predicted label on the val split)."""
    v = _val_predictions(spark, sf_dir).select(F.col(C.label).alias("y_true"), F.col("prediction").alias("y_pred"))
    return rounded(ev.eval_metrics(v))


def eval_metrics(spark, sf_dir):
    return rounded(ev.eval_metrics(tb.predictions(spark, sf_dir)))


def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(tb.predictions(spark, sf_dir))


def classification_report(spark, sf_dir):
    return rounded(ev.classification_report(tb.predictions(spark, sf_dir)))


def _tree_scores(spark, sf_dir, key):
    from reviewlab.plans.experiment import train_candidates
    prep = _prepared(spark, sf_dir)
    out = train_candidates(prep, models=(key,))
    p = out["predictions"][key]
    from reviewlab.operators.trees import class_probabilities
    probs = class_probabilities(p)
    return p.select(C.id, prep.labels.decode(F.col("pred_id")).alias("prediction"),
                    F.array_max(probs).alias("confidence"),
                    F.aggregate(probs, F.lit(0.0), lambda a, b: a + b).alias("probability_sum"))


def rf_predict(spark, sf_dir):
    """Random forest predictions on the validation split with confidence."""
    return rounded(_tree_scores(spark, sf_dir, "rf"))


def gbt_predict(spark, sf_dir):
    """Softmax-boosted tree predictions on the validation split with confidence."""
    from reviewlab.plans.training import BoostedTextClassifier
    prep, clf = _prepared(spark, sf_dir), _classifier(spark, sf_dir)
    scored = BoostedTextClassifier(clf.tfidf, _boosted(spark, sf_dir), prep.labels).predict_proba(prep.val(), C.text, already_clean=True)
    return rounded(scored.select(C.id, "prediction", "confidence", F.aggregate(
        F.map_values("probability"), F.lit(0.0), lambda a, b: a + b).alias("probability_sum")))


def _boosted(spark, sf_dir):
    from reviewlab.operators.softmax_boost import fit_softmax_boost
    key = ("boosted", spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        clf = _classifier(spark, sf_dir)
        train = clf.features(_prepared(spark, sf_dir).train(), C.text, already_clean=True)
        _FITTED[key] = fit_softmax_boost(train.select(C.id, LABEL_ID, FEATURES), C.id, LABEL_ID, FEATURES)
    return _FITTED[key]


def gbt_training_loss(spark, sf_dir):
    """Mean log loss of the training rows before the first and after every boosting round."""
    losses = _boosted(spark, sf_dir).training_loss
    return rounded(spark.createDataFrame([(r, float(x)) for r, x in enumerate(losses)], "round bigint, log_loss double"))


def gbt_root_histogram(spark, sf_dir):
    """Gradient sums of the first round's roots per class, term and bin."""
    from reviewlab.operators import softmax_boost as sb
    hist, terms, _ = _root_histogram(spark, sf_dir)
    named = hist.withColumn("term", F.element_at(terms, F.col("f") + 1))
    return rounded(named.select(F.col("k").cast("bigint").alias("label_id"), "term", F.col("b").cast("bigint").alias("bin"),
                                (F.col("g") / sb.SCALE).alias("sum_g"), (F.col("h") / sb.SCALE).alias("sum_h")))


def _root_histogram(spark, sf_dir):
    from reviewlab.operators import softmax_boost as sb
    from reviewlab.operators.features import literal
    clf, p = _classifier(spark, sf_dir), sb.BoostParams()
    train = clf.features(_prepared(spark, sf_dir).train(), C.text, already_clean=True)
    classes = tuple(range(len(clf.labels.labels)))
    rows = sb.start_rows(train, C.id, LABEL_ID, FEATURES, classes, p).where(sb.drawn(F.col("id"), 1, p))
    hist = sb.histogram(rows, [sb.Tree(0) for _ in classes], 0)
    return hist, literal(clf.tfidf.terms, "array<string>"), rows


def gbt_root_split(spark, sf_dir):
    """Best first split of each class's first tree: term, bin and gain."""
    from reviewlab.operators import softmax_boost as sb
    hist, terms, rows = _root_histogram(spark, sf_dir)
    k = len(_classifier(spark, sf_dir).labels.labels)
    sums = rows.withColumn("used", F.lit(True)).agg(*sb.root_sums(k)).first()
    best = sb.best_splits(hist, {(c, 0): (sums[f"g{c}"], sums[f"h{c}"]) for c in range(k)}, sb.BoostParams())
    return rounded(best.select(F.col("k").cast("bigint").alias("label_id"), F.element_at(terms, F.col("f") + 1).alias("term"),
                               F.col("b").cast("bigint").alias("bin"), "gain"))


def model_comparison(spark, sf_dir):
    from reviewlab.plans.experiment import model_comparison as compare
    return rounded(compare(_prepared(spark, sf_dir)))


def experiment_runs(spark, sf_dir):
    """Train all candidates and register them; the recorded metrics, one row each."""
    from reviewlab.operators.registry import run_metrics
    from reviewlab.plans.experiment import record_runs
    from reviewlab.session import scratch_path
    registry = record_runs(_prepared(spark, sf_dir), scratch_path(spark, "registry"))
    return rounded(run_metrics(registry.runs()).select("model_name", "metric", "value"))


def train_promote_score(spark, sf_dir):
    """The whole chain with one candidate: train and register naive Bayes, promote it, load the production model
    through the registry, and score every review text with it."""
    from reviewlab.plans.experiment import record_runs
    from reviewlab.plans.scoring import score_batch
    from reviewlab.session import scratch_path
    registry = record_runs(_prepared(spark, sf_dir), scratch_path(spark, "registry"), models=("nb",))
    plan = registry.promote().select("promoted", "model_name", "version", "reason").first()
    r = tb.reviews(spark, sf_dir).filter(F.col(C.text).isNotNull()).select(C.id, C.text)
    scored = score_batch(r, registry.classifier())
    return scored.select(C.id, C.label, F.lit(plan["promoted"]).alias("promoted"), F.lit(plan["model_name"]).alias("model_name"),
                         F.lit(plan["version"]).cast("bigint").alias("version"), F.lit(plan["reason"]).alias("reason"))


def svd_projection(spark, sf_dir):
    from reviewlab.operators.svd import fit_projection
    clf = _classifier(spark, sf_dir)
    f = clf.features(_prepared(spark, sf_dir).frame, C.text, already_clean=True)
    x, y = fit_projection(f, clf.tfidf, FEATURES).apply(F.col(FEATURES))
    return rounded(f.select(C.id, C.label, x.alias("x"), y.alias("y")))


def svd_gram_product(spark, sf_dir):
    """X'Xq of the TF-IDF rows for two fixed vectors, all ones and the terms' lengths: the product that the SVD repeats."""
    import numpy as np

    from reviewlab.operators.features import literal
    from reviewlab.operators.svd import gram_product, sparse_rows
    clf = _classifier(spark, sf_dir)
    f = clf.features(_prepared(spark, sf_dir).frame, C.text, already_clean=True)
    q = np.array([[1.0, len(t)] for t in clf.tfidf.terms]).reshape(-1, 2)
    term = F.element_at(literal(clf.tfidf.terms, "array<string>"), F.col("code") + 1)
    return rounded(gram_product(sparse_rows(f, FEATURES), q).select(term.alias("term"), F.col("q0").alias("by_ones"), F.col("q1").alias("by_length")))


QUERIES = {name: fn for name, fn in dict(globals()).items()
           if callable(fn) and not name.startswith("_") and getattr(fn, "__module__", None) == __name__}
