"""Run / model-version / alias tables: metrics, best run, promotion, production model.

Tables: runs(run_id, start_seq, model_name, <metric columns>), model_versions(name,
version, run_id), aliases(name, alias, version). Decisions are one-row DataFrames.
Ties: best score, then newest run (start_seq), then run id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "macro_f1", "micro_f1", "weighted_f1", "macro_precision", "macro_recall")
# Production card metrics and their display names.
CARD_METRICS = (("Accuracy", "accuracy"), ("Precision", "macro_precision"),
                ("Recall", "macro_recall"), ("F1 Score", "micro_f1"))
PRODUCTION, STAGING = "Production", "Staging"


def run_metrics(runs: DataFrame) -> DataFrame:
    """Long form (run_id, model_name, metric, value) of every non-null metric."""
    present = [m for m in METRICS if m in runs.columns]
    long = runs.unpivot(["run_id", "model_name"], present, "metric", "value")
    return long.filter(F.col("value").isNotNull())


def _best_struct(runs: DataFrame, missing: float, minimum: float | None) -> DataFrame:
    score = F.coalesce(F.col("macro_f1"), F.lit(missing))
    eligible = runs if minimum is None else runs.filter(score > minimum)
    key = F.struct(score.alias("s"), F.col("start_seq").alias("q"), F.col("run_id").alias("r"))
    # one global aggregate (partial per partition): always one row, null when no run qualifies
    return eligible.agg(F.max_by(F.struct("run_id", "model_name", score.alias("macro_f1"), "start_seq"), key).alias("b"))


def best_run(runs: DataFrame, missing: float = -1.0, minimum: float | None = -1.0) -> DataFrame:
    """Best run by macro_f1 (missing counts as ``missing``; must exceed ``minimum``).

    Experiment-wide: missing = -1, minimum = -1. Within one retrain batch:
    missing = 0, minimum = -1 (a run without the metric can still win).
    """
    b = _best_struct(runs, missing, minimum).filter(F.col("b").isNotNull())
    return b.select("b.run_id", "b.model_name", "b.macro_f1", "b.start_seq")


def promotion_plan(runs: DataFrame, versions: DataFrame, aliases: DataFrame,
                   alias: str = PRODUCTION) -> DataFrame:
    """Experiment-wide promotion decision (one row).

    best run -> its first registered version -> current holder of ``alias`` for
    that model name; promote unless the version already holds the alias; the
    previous holder is demoted to Staging. The best run is a one-row decision,
    collected and used as a literal filter on the version table.
    """
    best = best_run(runs).collect()
    spark = runs.sparkSession
    if not best:
        return spark.createDataFrame(
            [(False, None, None, None, None, None, "no runs with macro_f1")],
            "promoted boolean, best_run_id string, best_macro_f1 double, model_name string, "
            "version bigint, demoted_version bigint, reason string")
    b = best[0]
    v = versions.filter(F.col("run_id") == F.lit(b["run_id"]))
    first = v.agg(F.min_by(F.struct("name", "version"), F.col("version")).alias("v"))
    cur = aliases.filter(F.col("alias") == alias).select(F.col("name").alias("a_name"),
                                                         F.col("version").alias("a_version"))
    j = first.select(F.col("v.name").alias("model_name"), F.col("v.version").alias("version"))
    # current alias holder for the best model's name (aliases: one row per (name, alias))
    j = j.join(cur, j.model_name == cur.a_name, "left")
    has_v = F.col("version").isNotNull()
    same = F.col("a_version") == F.col("version")
    promoted = has_v & ~F.coalesce(same, F.lit(False))
    reason = (F.when(~has_v, "no registered version for best run")
              .when(F.coalesce(same, F.lit(False)), "already at alias")
              .otherwise("promote"))
    return j.select(promoted.alias("promoted"), F.lit(b["run_id"]).alias("best_run_id"),
                    F.lit(b["macro_f1"]).cast("double").alias("best_macro_f1"), "model_name",
                    F.col("version").cast("bigint").alias("version"),
                    F.when(promoted, F.col("a_version")).cast("bigint").alias("demoted_version"),
                    reason.alias("reason"))


def apply_promotion(aliases: DataFrame, plan: DataFrame, alias: str = PRODUCTION) -> DataFrame:
    """New aliases snapshot after a plan: best version takes ``alias``, the previous
    holder becomes Staging; unchanged when nothing is promoted."""
    p = plan.filter("promoted").select("model_name", "version", "demoted_version")
    touched = p.select(F.col("model_name").alias("t_name"))
    keep = aliases.join(touched, (aliases["name"] == touched["t_name"])
                        & aliases["alias"].isin(alias, STAGING), "left_anti")
    new_prod = p.select(F.col("model_name").alias("name"), F.lit(alias).alias("alias"), "version")
    demoted = (p.filter(F.col("demoted_version").isNotNull())
               .select(F.col("model_name").alias("name"), F.lit(STAGING).alias("alias"),
                       F.col("demoted_version").alias("version")))
    return keep.unionByName(new_prod).unionByName(demoted)


def production_model(runs: DataFrame, versions: DataFrame, aliases: DataFrame,
                     alias: str = PRODUCTION) -> DataFrame:
    """First model name (sorted) carrying ``alias``, with its version, run and metrics."""
    a = aliases.filter(F.col("alias") == alias).select("name", "version")
    first = a.agg(F.min_by(F.struct("name", "version"), F.col("name")).alias("a")).filter(F.col("a").isNotNull())
    first = first.select(F.col("a.name").alias("name"), F.col("a.version").alias("version"))
    mv = versions.select("name", "version", "run_id")
    j = first.join(mv, ["name", "version"]).join(runs, "run_id", "left")
    return j.select("name", "version", "run_id", "model_name", *[m for m in METRICS if m in runs.columns])


def production_metrics(runs: DataFrame, versions: DataFrame, aliases: DataFrame,
                       alias: str = PRODUCTION) -> DataFrame:
    """Metric cards: value as percent with two decimals, '-' when missing or zero."""
    pm = production_model(runs, versions, aliases, alias)
    arr = F.array(*[F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(label).alias("card"),
                             F.col(col).cast("double").alias("value"))
                    for i, (label, col) in enumerate(CARD_METRICS)])
    cards = pm.select(F.inline(arr))
    shown = F.when(F.coalesce(F.col("value"), F.lit(0.0)) == 0, F.lit("-")).otherwise(
        F.concat(F.format_string("%.2f", F.col("value") * 100), F.lit("%")))
    return cards.select("position", "card", F.round(F.col("value") * 100, 2).alias("pct"), shown.alias("display"))


def retrain_promotion(new_runs: DataFrame, runs: DataFrame, versions: DataFrame, aliases: DataFrame,
                      promote: bool = True, alias: str = PRODUCTION) -> DataFrame:
    """Promotion decision after a retrain batch (one row).

    Best new run by macro_f1 with missing = 0; current production score with
    missing = 0. With a production model: promote only when asked and strictly
    better (the old version becomes Staging). Without one: promote the best new
    run when asked and it has a registered version. The best run and the
    production model are one-row decisions; the version lookup is a filter.
    """
    b = best_run(new_runs, missing=0.0).collect()
    p = production_model(runs, versions, aliases, alias).collect()
    best_id = b[0]["run_id"] if b else None
    best_score = float(b[0]["macro_f1"]) if b else None
    prod = p[0] if p else None
    prod_score = float(prod["macro_f1"]) if prod is not None and prod["macro_f1"] is not None else 0.0
    v = versions.filter(F.col("run_id") == F.lit(best_id)).agg(
        F.min_by(F.struct("name", "version"), F.col("version")).alias("v"))
    has_v = F.col("v").isNotNull()
    if prod is not None:
        better = promote and best_score is not None and best_score > prod_score
        promoted = has_v if better else F.lit(False)
        reason = (F.when(has_v, "promoted over production").otherwise("no registered version for best run")
                  if better else F.lit("not requested or no improvement"))
    else:
        promoted = has_v & F.lit(promote)
        reason = (F.when(~F.lit(promote), "promotion not requested")
                  .when(has_v, "first production model").otherwise("no registered version for best run"))
    return v.select(
        F.lit(best_id).cast("string").alias("best_run_id"), F.lit(best_score).cast("double").alias("best_score"),
        F.lit(prod["name"] if prod is not None else None).cast("string").alias("production_name"),
        F.lit(prod["version"] if prod is not None else None).cast("bigint").alias("production_version"),
        F.lit(prod_score if prod is not None else None).cast("double").alias("production_score"),
        F.col("v.name").alias("new_name"), F.col("v.version").cast("bigint").alias("new_version"),
        promoted.alias("promoted"), reason.alias("reason"))
