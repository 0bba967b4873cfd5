"""Registered drift and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import drift as dr
from reviewlab.operators import registry as rg
from reviewlab.plans.common import rounded
from reviewlab.plans.training import SPLIT
from reviewlab.schema import DEFAULT as C
from reviewlab.sources import tables as tb

NUMERIC_COLUMNS = ["n_chars"]
CATEGORICAL_COLUMNS = ["lang"]


def _drift_frame(spark, sf_dir):
    return tb.drift_frame(spark, sf_dir)


def drift_ks(spark, sf_dir):
    d = dr.numeric_drift(_drift_frame(spark, sf_dir), "side", NUMERIC_COLUMNS)
    return rounded(d.select("column", "n_ref", "n_cur", "ks", "ks_pvalue"))


def drift_wasserstein(spark, sf_dir):
    d = dr.numeric_drift(_drift_frame(spark, sf_dir), "side", NUMERIC_COLUMNS)
    return rounded(d.select("column", "wasserstein", "wasserstein_norm", "drifted"))


def drift_js(spark, sf_dir):
    d = dr.categorical_drift(_drift_frame(spark, sf_dir), "side", CATEGORICAL_COLUMNS)
    return rounded(d.select("column", "n_ref", "n_cur", "categories", "js_distance", "drifted"))


def drift_chi2(spark, sf_dir):
    d = dr.categorical_drift(_drift_frame(spark, sf_dir), "side", CATEGORICAL_COLUMNS)
    return rounded(d.select("column", "chi2", "dof"))


def target_drift(spark, sf_dir):
    """Label distribution drift between the training and the validation split."""
    from reviewlab.plans import model_queries as mq
    p = mq._prepared(spark, sf_dir).frame
    d = dr.categorical_drift(p, SPLIT, [C.label], reference="train", current="val")
    return rounded(d.select("column", "n_ref", "n_cur", "js_distance", "drifted"))


def _columns(spark, sf_dir):
    return dr.drift_table(_drift_frame(spark, sf_dir), "side", NUMERIC_COLUMNS, CATEGORICAL_COLUMNS)


def drift_columns(spark, sf_dir):
    return rounded(_columns(spark, sf_dir))


def drift_share(spark, sf_dir):
    return rounded(dr.drift_share(_columns(spark, sf_dir)))


def drift_text_auc(spark, sf_dir):
    d = dr.text_drift_auc(_drift_frame(spark, sf_dir), "side", C.text, C.id)
    return rounded(d)


def retrain_gate(spark, sf_dir):
    share = dr.drift_share(_columns(spark, sf_dir))
    return rounded(dr.retrain_gate(tb.aliases(spark, sf_dir), share))


def run_metrics(spark, sf_dir):
    return rounded(rg.run_metrics(tb.runs(spark, sf_dir)))


def best_run(spark, sf_dir):
    return rounded(rg.best_run(tb.runs(spark, sf_dir)))


def _plan(spark, sf_dir):
    return rg.promotion_plan(tb.runs(spark, sf_dir), tb.model_versions(spark, sf_dir), tb.aliases(spark, sf_dir))


def promotion_plan(spark, sf_dir):
    return rounded(_plan(spark, sf_dir))


def aliases_after_promotion(spark, sf_dir):
    return rg.apply_promotion(tb.aliases(spark, sf_dir), _plan(spark, sf_dir))


def production_model(spark, sf_dir):
    return rounded(rg.production_model(tb.runs(spark, sf_dir), tb.model_versions(spark, sf_dir),
                                       tb.aliases(spark, sf_dir)))


def production_metrics(spark, sf_dir):
    return rounded(rg.production_metrics(tb.runs(spark, sf_dir), tb.model_versions(spark, sf_dir),
                                         tb.aliases(spark, sf_dir)))


def prediction_drift(spark, sf_dir):
    """Drift of the model's predicted labels between the training and the validation split."""
    from reviewlab.plans import model_queries as mq
    clf = mq._classifier(spark, sf_dir)
    p = clf.predict(mq._prepared(spark, sf_dir).frame, C.text, already_clean=True)
    d = dr.categorical_drift(p, SPLIT, ["prediction"], reference="train", current="val")
    return rounded(d.select("column", "n_ref", "n_cur", "js_distance", "drifted"))


def feature_drift(spark, sf_dir):
    """Drift of every TF-IDF feature column between the training and the validation split."""
    from reviewlab.plans import model_queries as mq
    from reviewlab.plans.training import FEATURES
    clf = mq._classifier(spark, sf_dir)
    f = clf.features(mq._prepared(spark, sf_dir).frame, C.text, already_clean=True)
    d = dr.sparse_feature_drift(f, SPLIT, FEATURES, list(clf.tfidf.terms), reference="train", current="val")
    return rounded(d.select("column", "n_ref", "n_cur", "ks", "ks_pvalue", "wasserstein_norm", "drifted"))


def _model_columns(spark, sf_dir):
    """Drift of the validation rows against the training rows over the target, the prediction and every TF-IDF column."""
    from reviewlab.plans import model_queries as mq
    from reviewlab.plans.training import FEATURES
    clf = mq._classifier(spark, sf_dir)
    f = clf.features(mq._prepared(spark, sf_dir).frame, C.text, already_clean=True)
    f = f.withColumn("prediction", clf.labels.decode(clf.nb.predict(F.col(FEATURES)))).select(C.id, SPLIT, C.label, "prediction", FEATURES)
    return dr.drift_table(f, SPLIT, categorical=[C.label, "prediction"], features=FEATURES, terms=clf.tfidf.terms,
                          reference="train", current="val")


def model_drift_columns(spark, sf_dir):
    return rounded(_model_columns(spark, sf_dir))


def model_drift_share(spark, sf_dir):
    """Share of drifted columns over target, prediction and TF-IDF columns."""
    return rounded(dr.drift_share(_model_columns(spark, sf_dir)))


def model_retrain_gate(spark, sf_dir):
    """The retrain decision from that share."""
    return rounded(dr.retrain_gate(tb.aliases(spark, sf_dir), dr.drift_share(_model_columns(spark, sf_dir))))


def retrain_promotion(spark, sf_dir):
    """Promotion after a retrain batch (here: every tracked run is the batch)."""
    runs = tb.runs(spark, sf_dir)
    return rounded(rg.retrain_promotion(runs, runs, tb.model_versions(spark, sf_dir), tb.aliases(spark, sf_dir)))


def latest_snapshot(spark, sf_dir):
    """Rows of the newest snapshot day (max over the partition key, then a filter)."""
    s = tb.snapshots(spark, sf_dir)
    newest = s.agg(F.max("snapshot_day").alias("_d"))
    return rounded(s.join(newest, s.snapshot_day == newest._d).drop("_d"))


QUERIES = {name: fn for name, fn in dict(globals()).items()
           if callable(fn) and not name.startswith("_") and getattr(fn, "__module__", None) == __name__}
