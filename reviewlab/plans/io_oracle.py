"""DuckDB SQL of the source/sink queries that SQL can express."""

from __future__ import annotations

from reviewlab.plans.model_oracle import NB, PREP, SCORE_DOCS, VOCAB, chain
from reviewlab.plans.model_oracle import SQL as MODEL_SQL
from reviewlab.plans.drift_registry_oracle import SQL as REGISTRY_SQL
from reviewlab.plans.profile_oracle import SQL as PROFILE_SQL
from reviewlab.plans.profile_oracle import sql_list
from reviewlab.sources.csv import NA_TOKENS
from reviewlab.sources.fixture_sql import with_views

NA = sql_list(NA_TOKENS)


def na(col: str) -> str:
    return f"CASE WHEN list_contains({NA}, {col}) THEN NULL ELSE {col} END AS {col}"


SQL: dict[str, str] = {
    "csv_roundtrip": with_views(["reviews"], f"""
SELECT review_id, {na('review_text')}, {na('sentiment')}, {na('brand')}, {na('rating')} FROM reviews"""),
    "csv_by_name": with_views(["reviews"], f"""
SELECT review_id, {na('review_text')}, {na('sentiment')},
       CASE WHEN review_id % 2 = 1 THEN 'x' END AS extra FROM reviews"""),
    "score_without_model": with_views(["reviews", "aliases"], """
SELECT review_id, 'model_not_found' AS sentiment FROM reviews
WHERE review_text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM aliases WHERE alias = 'Shadow')"""),
    "result_page": with_views(["predictions"], "SELECT review_id, y_true, y_pred FROM predictions "
                                              "ORDER BY review_id LIMIT 10 OFFSET 10"),
    "saved_model_predict": MODEL_SQL["nb_predict"],
    "report_json": PROFILE_SQL["full_profile"],
    "latest_snapshot_file": REGISTRY_SQL["latest_snapshot"],
    "prediction_sink": chain(f"""
SELECT {na('review_text')}, l.sentiment AS sentiment, 'request0' AS request_id
FROM reviews r JOIN s_pred p ON r.review_id = p.review_id JOIN label_ids l ON p.pred_id = l.label_id""",
                             PREP, VOCAB, NB, SCORE_DOCS),
    "train_promote_score": chain("""
SELECT r.review_id, l.sentiment AS sentiment, true AS promoted, 'NaiveBayes' AS model_name,
       CAST(1 AS BIGINT) AS version, 'promote' AS reason
FROM reviews r JOIN s_pred p ON r.review_id = p.review_id JOIN label_ids l ON p.pred_id = l.label_id""",
                                 PREP, VOCAB, NB, SCORE_DOCS),
    "score_stream": chain(f"""
SELECT {na('review_text')}, l.sentiment AS sentiment
FROM reviews r JOIN s_pred p ON r.review_id = p.review_id JOIN label_ids l ON p.pred_id = l.label_id""",
                          PREP, VOCAB, NB, SCORE_DOCS),
}
