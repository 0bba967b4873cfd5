"""End-to-end jobs: the daily profile, the daily training run, and the retrain check.

Plain functions over a SparkSession (scheduling is left to whatever runs them).
Paths are shared storage; the prepared training rows are checkpointed to
``spark.checkpoint.dir`` so a lost executor never forces the dedupe/split to
re-run from the raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators import drift as dr
from reviewlab.operators import profile as pf
from reviewlab.plans.experiment import Registry, record_runs
from reviewlab.plans.training import prepare
from reviewlab.schema import DEFAULT, Cols, ensure_columns, ensure_not_empty
from reviewlab.sources import sinks


def daily_profile(reviews: DataFrame, reports: str, c: Cols = DEFAULT) -> str:
    """Profile the whole input and write one timestamped JSON report; returns its path."""
    ensure_columns(reviews, [c.text, c.label])
    ensure_not_empty(reviews, "the profile")
    return sinks.write_report(pf.full_profile(reviews, c), reports, "eda_profile")


def daily_training(reviews: DataFrame, registry_root: str, c: Cols = DEFAULT,
                   max_features: int = 100, min_df: int = 2, **kw) -> tuple[Registry, DataFrame]:
    """prepare (checkpointed) -> train and register all candidates -> promote the best run.

    Returns the registry and the promotion decision; scoring loads ``registry.classifier()``.
    """
    ensure_columns(reviews, [c.text, c.label])
    prep = prepare(reviews, c, keep="checkpoint")
    registry = record_runs(prep, registry_root, max_features=max_features, min_df=min_df, **kw)
    return registry, registry.promote()


def retrain_check(reference: DataFrame, current: DataFrame, aliases: DataFrame,
                  numeric: list[str], categorical: list[str], side: str = "side", text: list[str] = (),
                  id_col: str | None = None, features: str | None = None, terms: list[str] = ()) -> DataFrame:
    """Drift of ``current`` against ``reference`` on the given columns, then the gate decision.

    Target and prediction columns go with ``categorical``; ``text`` columns need the row key ``id_col``;
    ``features`` is a sparse TF-IDF column whose ``terms`` are one column each."""
    both = (reference.withColumn(side, F.lit(dr.REFERENCE))
            .unionByName(current.withColumn(side, F.lit(dr.CURRENT))))
    share = dr.drift_share(dr.drift_table(both, side, numeric, categorical, text, id_col, features, terms))
    return dr.retrain_gate(aliases, share)


def production_check(registry: Registry, alias: str = "Production") -> DataFrame:
    """The gate decision on the drift share that the production model's own run stored."""
    return dr.retrain_gate(registry.aliases(), registry.drift_share(alias), alias)
