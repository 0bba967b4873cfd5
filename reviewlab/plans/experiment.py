"""Train every candidate model on one prepared, checkpointed feature table and
tabulate hold-out metrics (the daily training job).

prepare (checkpointed) -> TF-IDF fit on train -> features for all rows (persisted)
-> naive Bayes, random forest, softmax-boosted trees -> validation metrics.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators import drift as dr
from reviewlab.operators import evaluate as ev
from reviewlab.operators import trees
from reviewlab.operators.features import fit_tfidf
from reviewlab.operators.naive_bayes import fit_naive_bayes
from reviewlab.operators.softmax_boost import BoostParams, fit_softmax_boost
from reviewlab.plans.training import (FEATURES, LABEL_ID, SPLIT, BoostedTextClassifier, Prepared, TextClassifier,
                                      VectorTextClassifier)
from reviewlab.schema import Cols
from reviewlab.session import ensure_checkpoint_dir
from reviewlab.sources.commit_log import CommitLog, State

MODEL_NAMES = {"nb": "NaiveBayes", "rf": "RandomForest", "xgb": "XGBoost"}


def train_candidates(prep: Prepared, max_features: int = 100, min_df: int = 2, alpha: float = 4.0,
                     models=("nb", "rf", "xgb"), boost: BoostParams = BoostParams()) -> dict:
    """Returns {"tfidf", "features" (persisted), "predictions": {key: DataFrame of the validation rows}, "scored": the same of
    all rows, "models": {...}}."""
    c: Cols = prep.cols
    train = prep.train()
    tfidf = fit_tfidf(train, c.text, max_features, min_df, id_col=c.id)
    tokens = tx.vectorizer_tokens(F.col(c.text))
    feats = prep.frame.withColumn(FEATURES, tfidf.weights_from_tokens(tokens))
    if "rf" in models:
        feats = trees.vectors(feats, tfidf, tokens, LABEL_ID)
    feats = feats.persist()
    ftrain = feats.filter(F.col(SPLIT) == "train")
    scored: dict[str, DataFrame] = {}
    fitted: dict = {}
    if "nb" in models:
        nb = fit_naive_bayes(ftrain, LABEL_ID, FEATURES, tfidf, alpha)
        fitted["nb"] = TextClassifier(tfidf, nb, prep.labels)
        scored["nb"] = feats.withColumn("pred_id", nb.predict(F.col(FEATURES)))
    if "rf" in models:
        m = trees.random_forest().fit(ftrain)
        fitted["rf"] = VectorTextClassifier(tfidf, m, prep.labels)
        scored["rf"] = m.transform(feats).withColumn("pred_id", F.col("prediction").cast("bigint")).drop("prediction")
    if "xgb" in models:
        boosted = fit_softmax_boost(ftrain, c.id, LABEL_ID, FEATURES, boost)
        fitted["xgb"] = BoostedTextClassifier(tfidf, boosted, prep.labels)
        scored["xgb"] = (feats.withColumn("probability", boosted.probabilities(F.col(FEATURES)))
                         .withColumn("pred_id", boosted.predict(F.col(FEATURES))))
    preds = {key: p.filter(F.col(SPLIT) == "val") for key, p in scored.items()}
    return {"tfidf": tfidf, "features": feats, "predictions": preds, "scored": scored, "models": fitted}


def model_comparison(prep: Prepared, **kw) -> DataFrame:
    """One row of validation metrics per candidate model; the features are released, the rows are read from a checkpoint."""
    ensure_checkpoint_dir(prep.frame.sparkSession)
    out = train_candidates(prep, **kw)
    rows = None
    for key, p in out["predictions"].items():
        pairs = p.select(F.col(prep.cols.label).alias("y_true"),
                         prep.labels.decode(F.col("pred_id")).alias("y_pred"))
        m = ev.eval_metrics(pairs).select(F.lit(MODEL_NAMES[key]).alias("model_name"), "*")
        rows = m if rows is None else rows.unionByName(m)
    rows = rows.checkpoint(eager=True)
    out["features"].unpersist()
    return rows


RUN_SCHEMA = ("run_id string, experiment string, start_seq bigint, model_name string, accuracy double, macro_f1 double, "
              "micro_f1 double, weighted_f1 double, macro_precision double, macro_recall double, settings string, started_at timestamp, "
              "drift_share double")
VERSION_SCHEMA = "name string, version bigint, run_id string"
ALIAS_SCHEMA = "seq bigint, name string, alias string, version bigint"
PLAN_SCHEMA = ("promoted boolean, best_run_id string, best_macro_f1 double, model_name string, version bigint, "
               "demoted_version bigint, reason string")
PARAMS = {"nb": {"alpha": 4.0}, "rf": {"num_trees": 10, "max_depth": 3, "feature_subset": "sqrt"},
          "xgb": {"step": 0.01, "rounds": 10, "max_depth": 6, "subsample": 0.5, "objective": "softmax"}}


class Registry:
    """The tables of one experiment's registry under a shared folder: runs, model_versions, aliases (each promotion
    appends a snapshot; the newest counts) and the model artifacts, one folder per run. Writers may run at the same time:
    every change is one commit of a log, built again when another writer was first."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, self.root)

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.log.state().table(name, schema)

    def _append(self, name: str, rows: DataFrame) -> None:
        self.log.commit(lambda state: {name: rows})

    def runs(self) -> DataFrame:
        return self._read("runs", RUN_SCHEMA)

    def versions(self) -> DataFrame:
        return self._read("model_versions", VERSION_SCHEMA)

    def aliases(self) -> DataFrame:
        return _newest_aliases(self.log.state())

    def drift_share(self, alias: str = "Production") -> DataFrame:
        """One row: the share that the run of the model carrying ``alias`` stored (null when there is none)."""
        from reviewlab.operators.registry import production_model
        run = production_model(self.runs(), self.versions(), self.aliases(), alias).select("run_id")
        return self.runs().join(run, "run_id", "left_semi").agg(F.max("drift_share").alias("share"))

    def models(self) -> str:
        return f"{self.root}/models"

    def classifier(self, alias: str = "Production"):
        """The classifier of the model that carries ``alias`` (None when there is none)."""
        from reviewlab.plans.scoring import production_classifier
        return production_classifier(self.runs(), self.versions(), self.aliases(), self.models(), alias)

    def add_run(self, experiment: str, run_id: str, name: str, values: dict) -> int:
        """Record a run and the next version of its model in one commit; returns the version."""
        given = []

        def build(state: State) -> dict[str, DataFrame]:
            seq = (state.table("runs", RUN_SCHEMA).agg(F.max("start_seq")).first()[0] or 0) + 1
            held = state.table("model_versions", VERSION_SCHEMA).where(F.col("name") == F.lit(name)).agg(F.max("version")).first()[0]
            given.append((held or 0) + 1)
            row = {**values, "run_id": run_id, "experiment": experiment, "start_seq": seq, "model_name": name}
            runs = self.spark.createDataFrame([row], RUN_SCHEMA).withColumn("started_at", F.coalesce("started_at", F.current_timestamp()))
            return {"runs": runs, "model_versions": self.spark.createDataFrame([(name, given[-1], run_id)], VERSION_SCHEMA)}
        self.log.commit(build)
        return given[-1]

    def promote(self, alias: str = "Production") -> DataFrame:
        """Decide over all recorded runs, append the new alias snapshot, and return the decision (one row). Overtaken by
        another writer, the decision is taken again over what that one wrote."""
        from reviewlab.operators.registry import apply_promotion, promotion_plan
        plans = []

        def build(state: State) -> dict[str, DataFrame]:
            aliases = _newest_aliases(state)
            plan = promotion_plan(state.table("runs", RUN_SCHEMA), state.table("model_versions", VERSION_SCHEMA), aliases, alias)
            plans.append(self.spark.createDataFrame(plan.collect(), PLAN_SCHEMA))
            seq = F.lit(state.number + 1).cast("bigint").alias("seq")
            return {"aliases": apply_promotion(aliases, plans[-1], alias).select(seq, "name", "alias", "version")}
        self.log.commit(build)
        return plans[-1]


def _newest_aliases(state: State) -> DataFrame:
    rows = state.table("aliases", ALIAS_SCHEMA)
    last = rows.agg(F.max("seq")).first()[0]
    return rows.filter(F.col("seq") == F.lit(last)).select("name", "alias", "version")


def record_runs(prep: Prepared, root: str, experiment: str = "sentiment", max_features: int = 100,
                min_df: int = 2, test_size: float = 0.2, seed: int = 42, **kw) -> Registry:
    """Train every candidate and register it: a row in runs (metrics, settings, and the drift share of the validation
    rows against the training rows over text, target, prediction and TF-IDF columns), a model version, and the
    fitted model's artifacts under the run's id, where scoring looks for them."""
    import json

    from reviewlab.sources.sinks import save_text_classifier

    spark = prep.frame.sparkSession
    ensure_checkpoint_dir(spark)
    registry = Registry(spark, root)
    out = train_candidates(prep, max_features=max_features, min_df=min_df, **kw)
    c: Cols = prep.cols
    sides = {"reference": "train", "current": "val"}
    drifts = dr.drift_table(out["features"], SPLIT, categorical=[c.label], text=[c.text], id_col=c.id, features=FEATURES,
                            terms=out["tfidf"].terms, **sides).checkpoint(eager=True)    # the same for every candidate; a union loses sight of a cached one
    for key, p in out["predictions"].items():
        run_id = f"{experiment}-{uuid.uuid4().hex[:12]}"        # no other writer's, whatever number it gets
        settings = {**PARAMS[key], **({"alpha": kw["alpha"]} if key == "nb" and "alpha" in kw else {}), "max_features": max_features,
                    "min_df": min_df, "terms": len(out["tfidf"].terms), "classes": list(prep.labels.labels), "test_size": test_size, "seed": seed}
        pairs = p.select(F.col(prep.cols.label).alias("y_true"), prep.labels.decode(F.col("pred_id")).alias("y_pred"))
        predicted = out["scored"][key].select(SPLIT, prep.labels.decode(F.col("pred_id")).alias("prediction"))
        share = dr.drift_share(drifts.unionByName(dr.drift_table(predicted, SPLIT, categorical=["prediction"], **sides))).first()["share"]
        metrics = ev.eval_metrics(pairs).select("accuracy", "macro_f1", "micro_f1", "weighted_f1", "macro_precision", "macro_recall").first()
        save_text_classifier(out["models"][key], f"{registry.models()}/{run_id}", {"run_id": run_id})
        registry.add_run(experiment, run_id, MODEL_NAMES[key], {
            **metrics.asDict(), "settings": json.dumps(settings), "started_at": None, "drift_share": None if share is None else float(share)})
    out["features"].unpersist()
    return registry
