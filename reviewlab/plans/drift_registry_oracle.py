"""DuckDB SQL of the drift and registry queries."""

from __future__ import annotations

from reviewlab.plans.model_oracle import NB, PREP, VOCAB, chain, scores_ctes
from reviewlab.sources.fixture_sql import with_views

PI = "3.141592653589793"


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    en = f"sqrt(({n}) * ({m}) / (({n}) + ({m})))"
    lam = f"(({en} + 0.12 + 0.11 / {en}) * ({d}))"
    big = f"2 * list_sum(list_transform(range(1, 101), lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * {lam} * {lam})))"
    small = (f"1 - sqrt(2.0 * {PI}) / {lam} * list_sum(list_transform(range(1, 101), "
             f"lambda j: exp(-pow(2.0 * j - 1.0, 2) * ({PI} * {PI}) / (8.0 * {lam} * {lam}))))")
    return (f"CASE WHEN ({d}) <= 0 THEN 1.0 ELSE least(greatest(CASE WHEN {lam} < 1.18 THEN {small} "
            f"ELSE {big} END, 0.0), 1.0) END")


def numeric_ctes(source: str, side: str, column: str, ref: str = "reference", cur: str = "current"):
    return [
        ("nlg", f"SELECT {side} AS side, '{column}' AS \"column\", CAST({column} AS DOUBLE) AS value FROM {source} "
                f"WHERE {column} IS NOT NULL AND NOT isnan(CAST({column} AS DOUBLE))"),
        ("ncnt", f"SELECT \"column\", value, count(*) FILTER (WHERE side = '{ref}') AS r, "
                 f"count(*) FILTER (WHERE side = '{cur}') AS c FROM nlg GROUP BY \"column\", value"),
        ("ncdf", """
SELECT *, sum(r) OVER (PARTITION BY "column") AS nr, sum(c) OVER (PARTITION BY "column") AS nc,
       abs(sum(r) OVER w / sum(r) OVER (PARTITION BY "column") - sum(c) OVER w / sum(c) OVER (PARTITION BY "column")) AS gap,
       lead(value) OVER w - value AS width
FROM ncnt WINDOW w AS (PARTITION BY "column" ORDER BY value)"""),
        ("nstat", """
SELECT "column", CAST(first(nr) AS BIGINT) AS n_ref, CAST(first(nc) AS BIGINT) AS n_cur, max(gap) AS ks,
       coalesce(sum(gap * width), 0.0) AS wasserstein FROM ncdf GROUP BY "column" """),
        ("nstd", f"SELECT \"column\", stddev_pop(value) AS ref_std FROM nlg WHERE side = '{ref}' GROUP BY \"column\""),
        ("ndrift", f"""
SELECT s."column", n_ref, n_cur, ks, {ks_pvalue_sql('ks', 'CAST(n_ref AS DOUBLE)', 'CAST(n_cur AS DOUBLE)')} AS ks_pvalue,
       wasserstein, wasserstein / greatest(coalesce(ref_std, 0.0), 0.001) AS wasserstein_norm,
       wasserstein / greatest(coalesce(ref_std, 0.0), 0.001) >= 0.1 AS drifted
FROM nstat s LEFT JOIN nstd t ON s."column" = t."column" """),
    ]


def counts_drift_ctes(counts: str, ref_n: str = "n_ref", cur_n: str = "n_cur"):
    """Numeric drift per column from a counts CTE ("column", value, r, c)."""
    return [
        ("kcdf", f"""
SELECT *, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY "column") - sum(c) OVER w / sum(c) OVER (PARTITION BY "column")) AS gap,
       lead(value) OVER w - value AS width,
       sum(r) OVER (PARTITION BY "column") AS nr, sum(c) OVER (PARTITION BY "column") AS nc,
       sum(r * value) OVER (PARTITION BY "column") / sum(r) OVER (PARTITION BY "column") AS m
FROM {counts} WINDOW w AS (PARTITION BY "column" ORDER BY value)"""),
        ("kstat", """
SELECT "column", CAST(first(nr) AS BIGINT) AS n_ref, CAST(first(nc) AS BIGINT) AS n_cur, max(gap) AS ks,
       coalesce(sum(gap * width), 0.0) AS wasserstein, sqrt(sum(r * pow(value - m, 2)) / first(nr)) AS ref_std
FROM kcdf GROUP BY "column" """),
        ("kdrift", f"""
SELECT "column", n_ref, n_cur, ks, {ks_pvalue_sql('ks', 'CAST(n_ref AS DOUBLE)', 'CAST(n_cur AS DOUBLE)')} AS ks_pvalue,
       wasserstein, wasserstein / greatest(coalesce(ref_std, 0.0), 0.001) AS wasserstein_norm,
       wasserstein / greatest(coalesce(ref_std, 0.0), 0.001) >= 0.1 AS drifted
FROM kstat"""),
    ]


# TF-IDF feature columns, train vs validation: non-zero weights per (term, weight) and
# one zero mass per vocabulary term
FEATURE_COUNTS = [
    ("fnz", """
SELECT term AS "column", weight AS value, count(*) FILTER (WHERE split = 'train') AS r,
       count(*) FILTER (WHERE split = 'val') AS c FROM tfidf GROUP BY term, weight"""),
    ("fsides", "SELECT count(*) FILTER (WHERE split = 'train') AS n, count(*) FILTER (WHERE split = 'val') AS m FROM split"),
    ("fzero", """
SELECT v.term AS "column", CAST(0 AS DOUBLE) AS value, s.n - coalesce(z.r, 0) AS r, s.m - coalesce(z.c, 0) AS c
FROM vocab v CROSS JOIN fsides s
LEFT JOIN (SELECT "column", sum(r) AS r, sum(c) AS c FROM fnz GROUP BY "column") z ON z."column" = v.term"""),
    ("fcnt", """
SELECT "column", value, sum(r) AS r, sum(c) AS c FROM (
  SELECT "column", value, r, c FROM fnz UNION ALL SELECT "column", value, r, c FROM fzero WHERE r + c > 0)
GROUP BY "column", value"""),
]


def categorical_ctes(source: str, side: str, column: str, ref: str = "reference", cur: str = "current"):
    return [
        ("clg", f"SELECT {side} AS side, '{column}' AS \"column\", CAST({column} AS VARCHAR) AS value FROM {source} "
                f"WHERE {column} IS NOT NULL"),
        ("ccnt", f"SELECT \"column\", value, count(*) FILTER (WHERE side = '{ref}') AS r, "
                 f"count(*) FILTER (WHERE side = '{cur}') AS c FROM clg GROUP BY \"column\", value"),
        ("cshare", """
SELECT *, r / nr AS p, c / nc AS q, (r / nr + c / nc) / 2 AS m FROM (
  SELECT *, sum(r) OVER (PARTITION BY "column") AS nr, sum(c) OVER (PARTITION BY "column") AS nc FROM ccnt)"""),
        ("cdrift", """
SELECT "column", CAST(first(nr) AS BIGINT) AS n_ref, CAST(first(nc) AS BIGINT) AS n_cur, count(*) AS categories,
       sqrt(greatest(sum(0.5 * CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END
                         + 0.5 * CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END), 0)) AS js_distance,
       coalesce(sum(CASE WHEN p * nc > 0 THEN pow(c - p * nc, 2) / (p * nc) END), 0.0) AS chi2,
       CAST(count(*) FILTER (WHERE p * nc > 0) - 1 AS BIGINT) AS dof
FROM cshare GROUP BY "column" """),
    ]


def D(body: str, extra) -> str:
    return with_views(["drift_frame"], body, extra)


DRIFT_COLUMNS = """
SELECT "column", 'numeric' AS kind, round(wasserstein_norm, 6) AS score, drifted FROM ndrift
UNION ALL
SELECT "column", 'categorical', round(js_distance, 6), js_distance >= 0.1 FROM cdrift"""

ALL_DRIFT = numeric_ctes("drift_frame", "side", "n_chars") + categorical_ctes("drift_frame", "side", "lang") + [
    ("dcols", DRIFT_COLUMNS),
    ("dshare", """
SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
       coalesce(count(*) FILTER (WHERE drifted) / nullif(count(*), 0), 0.0) AS share FROM dcols"""),
]

BEST = ("best", """
SELECT run_id, macro_f1, start_seq FROM runs WHERE coalesce(macro_f1, -1) > -1
ORDER BY coalesce(macro_f1, -1) DESC, start_seq DESC, run_id DESC LIMIT 1""")
PLAN = [BEST,
        ("bv", "SELECT name, version FROM model_versions WHERE run_id = (SELECT run_id FROM best) "
               "ORDER BY version LIMIT 1"),
        ("plan", """
SELECT bv.version IS NOT NULL AND NOT coalesce(a.version = bv.version, false) AS promoted,
       b.run_id AS best_run_id, round(b.macro_f1, 6) AS best_macro_f1, bv.name AS model_name, bv.version AS version,
       CASE WHEN bv.version IS NOT NULL AND NOT coalesce(a.version = bv.version, false) THEN a.version END AS demoted_version,
       CASE WHEN bv.version IS NULL THEN 'no registered version for best run'
            WHEN coalesce(a.version = bv.version, false) THEN 'already at alias' ELSE 'promote' END AS reason
FROM best b LEFT JOIN bv ON true LEFT JOIN aliases a ON a.alias = 'Production' AND a.name = bv.name""")]
PROD = [("pa", "SELECT name, version FROM aliases WHERE alias = 'Production' ORDER BY name LIMIT 1"),
        ("pm", """
SELECT pa.name, pa.version, mv.run_id, r.model_name, round(r.accuracy, 6) AS accuracy, round(r.macro_f1, 6) AS macro_f1,
       round(r.micro_f1, 6) AS micro_f1, round(r.macro_precision, 6) AS macro_precision,
       round(r.macro_recall, 6) AS macro_recall
FROM pa JOIN model_versions mv ON mv.name = pa.name AND mv.version = pa.version
LEFT JOIN runs r ON r.run_id = mv.run_id""")]
REG = ["runs", "model_versions", "aliases"]

SQL: dict[str, str] = {
    "drift_ks": D("SELECT \"column\", n_ref, n_cur, round(ks, 6) AS ks, round(ks_pvalue, 6) AS ks_pvalue FROM ndrift",
                  numeric_ctes("drift_frame", "side", "n_chars")),
    "drift_wasserstein": D("SELECT \"column\", round(wasserstein, 6) AS wasserstein, "
                           "round(wasserstein_norm, 6) AS wasserstein_norm, drifted FROM ndrift",
                           numeric_ctes("drift_frame", "side", "n_chars")),
    "drift_js": D("SELECT \"column\", n_ref, n_cur, categories, round(js_distance, 6) AS js_distance, "
                  "js_distance >= 0.1 AS drifted FROM cdrift", categorical_ctes("drift_frame", "side", "lang")),
    "drift_chi2": D("SELECT \"column\", round(chi2, 6) AS chi2, dof FROM cdrift",
                    categorical_ctes("drift_frame", "side", "lang")),
    "target_drift": chain("SELECT \"column\", n_ref, n_cur, round(js_distance, 6) AS js_distance, "
                          "js_distance >= 0.1 AS drifted FROM cdrift",
                          PREP, categorical_ctes("split", "split", "sentiment", "train", "val")),
    "feature_drift": chain("SELECT \"column\", n_ref, n_cur, round(ks, 6) AS ks, round(ks_pvalue, 6) AS ks_pvalue, "
                           "round(wasserstein_norm, 6) AS wasserstein_norm, drifted FROM kdrift",
                           PREP, VOCAB, FEATURE_COUNTS, counts_drift_ctes("fcnt")),
    "drift_columns": D("SELECT * FROM dcols", ALL_DRIFT),
    "drift_share": D("SELECT n_columns, n_drifted, round(share, 6) AS share, share > 0.3 AS dataset_drift FROM dshare",
                     ALL_DRIFT),
    "retrain_gate": with_views(["drift_frame", "aliases"], """
SELECT h AS has_production, round(s, 6) AS drift_share,
       CASE WHEN NOT h THEN 'train' WHEN s > 0.3 THEN 'train' ELSE 'stop' END AS decision,
       CASE WHEN NOT h THEN 'no production model' WHEN s > 0.3 THEN 'drift above threshold'
            ELSE 'drift at or below threshold' END AS reason
FROM (SELECT (SELECT count(*) FROM aliases WHERE alias = 'Production') > 0 AS h,
             coalesce((SELECT share FROM dshare), 0.0) AS s)""", ALL_DRIFT),
    "run_metrics": with_views(["runs"], """
SELECT run_id, model_name, metric, round(value, 6) AS value FROM (
  SELECT run_id, model_name, 'accuracy' AS metric, accuracy AS value FROM runs
  UNION ALL SELECT run_id, model_name, 'macro_f1', macro_f1 FROM runs
  UNION ALL SELECT run_id, model_name, 'micro_f1', micro_f1 FROM runs
  UNION ALL SELECT run_id, model_name, 'macro_precision', macro_precision FROM runs
  UNION ALL SELECT run_id, model_name, 'macro_recall', macro_recall FROM runs) WHERE value IS NOT NULL"""),
    "best_run": with_views(["runs"], """
SELECT r.run_id, r.model_name, round(r.macro_f1, 6) AS macro_f1, r.start_seq FROM runs r JOIN best b ON r.run_id = b.run_id""",
                           [BEST]),
    "promotion_plan": with_views(REG, "SELECT * FROM plan", PLAN),
    "aliases_after_promotion": with_views(REG, """
SELECT name, alias, version FROM aliases a
WHERE NOT EXISTS (SELECT 1 FROM plan p WHERE p.promoted AND p.model_name = a.name AND a.alias IN ('Production', 'Staging'))
UNION ALL SELECT model_name, 'Production', version FROM plan WHERE promoted
UNION ALL SELECT model_name, 'Staging', demoted_version FROM plan WHERE promoted AND demoted_version IS NOT NULL""", PLAN),
    "production_model": with_views(REG, "SELECT * FROM pm", PROD),
    "production_metrics": with_views(REG, """
SELECT position, card, round(v * 100, 2) AS pct,
       CASE WHEN coalesce(v, 0) = 0 THEN '-' ELSE printf('%.2f', v * 100) || '%' END AS display
FROM (SELECT c.position, c.card, CASE c.col WHEN 'accuracy' THEN r.accuracy WHEN 'macro_precision' THEN r.macro_precision
                 WHEN 'macro_recall' THEN r.macro_recall ELSE r.micro_f1 END AS v
      FROM (VALUES (0, 'Accuracy', 'accuracy'), (1, 'Precision', 'macro_precision'), (2, 'Recall', 'macro_recall'),
                   (3, 'F1 Score', 'micro_f1')) AS c(position, card, col)
      CROSS JOIN (SELECT r.* FROM pa JOIN model_versions mv ON mv.name = pa.name AND mv.version = pa.version
                  LEFT JOIN runs r ON r.run_id = mv.run_id) r)""", PROD),
    "prediction_drift": chain("SELECT \"column\", n_ref, n_cur, round(js_distance, 6) AS js_distance, "
                              "js_distance >= 0.1 AS drifted FROM cdrift", PREP, VOCAB, NB,
                              scores_ctes("all_", "(SELECT review_id FROM split)", "tfidf"),
                              [("pd", "SELECT s.split, l.sentiment AS prediction FROM split s "
                                      "JOIN all_pred p ON s.review_id = p.review_id "
                                      "JOIN label_ids l ON p.pred_id = l.label_id")],
                              categorical_ctes("pd", "split", "prediction", "train", "val")),
    "retrain_promotion": with_views(REG, """
SELECT b.run_id AS best_run_id, round(b.s, 6) AS best_score, pm.name AS production_name,
       pm.version AS production_version, round(coalesce(pm.macro_f1, 0.0), 6) AS production_score,
       bv.name AS new_name, bv.version AS new_version,
       CASE WHEN pm.name IS NOT NULL THEN (b.s > coalesce(pm.macro_f1, 0.0) AND bv.version IS NOT NULL)
            ELSE bv.version IS NOT NULL END AS promoted,
       CASE WHEN pm.name IS NOT NULL THEN
              CASE WHEN b.s > coalesce(pm.macro_f1, 0.0) THEN
                     CASE WHEN bv.version IS NOT NULL THEN 'promoted over production'
                          ELSE 'no registered version for best run' END
                   ELSE 'not requested or no improvement' END
            WHEN bv.version IS NOT NULL THEN 'first production model'
            ELSE 'no registered version for best run' END AS reason
FROM bestn b LEFT JOIN bv ON true LEFT JOIN pm ON true""", PROD + [
        ("bestn", "SELECT run_id, coalesce(macro_f1, 0.0) AS s FROM runs "
                  "ORDER BY coalesce(macro_f1, 0.0) DESC, start_seq DESC, run_id DESC LIMIT 1"),
        ("bv", "SELECT name, version FROM model_versions WHERE run_id = (SELECT run_id FROM bestn) "
               "ORDER BY version LIMIT 1")]),
    "latest_snapshot": with_views(["snapshots"], """
SELECT snapshot_day, event_id, event_type, round(value, 6) AS value FROM snapshots
WHERE snapshot_day = (SELECT max(snapshot_day) FROM snapshots)"""),
}

MODEL_COLUMNS = f"""
SELECT "column", 'categorical' AS kind, js_distance AS score, drifted FROM ({SQL["target_drift"]})
UNION ALL SELECT "column", 'categorical', js_distance, drifted FROM ({SQL["prediction_drift"]})
UNION ALL SELECT 'tfidf:' || "column", 'tfidf', wasserstein_norm, drifted FROM ({SQL["feature_drift"]})"""
MODEL_SHARE = f"""
SELECT n_columns, n_drifted, coalesce(n_drifted::DOUBLE / nullif(n_columns, 0), 0.0) AS share
FROM (SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted FROM ({MODEL_COLUMNS}))"""

SQL.update({
    "model_drift_columns": MODEL_COLUMNS,
    "model_drift_share": f"SELECT n_columns, n_drifted, round(share, 6) AS share, share > 0.3 AS dataset_drift FROM ({MODEL_SHARE})",
    "model_retrain_gate": with_views(["aliases"], f"""
SELECT h AS has_production, round(s, 6) AS drift_share,
       CASE WHEN NOT h OR s > 0.3 THEN 'train' ELSE 'stop' END AS decision,
       CASE WHEN NOT h THEN 'no production model' WHEN s > 0.3 THEN 'drift above threshold'
            ELSE 'drift at or below threshold' END AS reason
FROM (SELECT (SELECT count(*) FROM aliases WHERE alias = 'Production') > 0 AS h, (SELECT share FROM ({MODEL_SHARE})) AS s)"""),
})
