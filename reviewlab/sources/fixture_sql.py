"""SQL text of the review-shaped views (DuckDB dialect), used by the oracle queries.

Each view is a CTE body; ``with_views`` prefixes a query with the CTEs it names.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "reviews": """
SELECT d.doc_id AS review_id, d.text AS review_text,
       CASE WHEN l.toxic = 1 THEN 'Negative' WHEN l.quality = 1 THEN 'Positive'
            WHEN l.quality = 0 THEN 'Neutral' END AS sentiment,
       CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE d.source END AS brand,
       CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 17 = 0 THEN 'n/a'
            ELSE CAST(d.doc_id % 7 AS VARCHAR) END AS rating
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "predictions": """
SELECT review_id, sentiment AS y_true,
       CASE WHEN review_id % 5 = 0 THEN 'Neutral' WHEN review_id % 7 = 0 THEN 'Negative'
            ELSE sentiment END AS y_pred
FROM reviews WHERE sentiment IS NOT NULL""",
    "drift_frame": """
SELECT d.doc_id AS review_id, CASE WHEN l.doc_id IS NULL THEN 'current' ELSE 'reference' END AS side,
       d.text AS review_text, d.lang AS lang, d.n_chars AS n_chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "runs": """
SELECT concat('r', CAST(s_suppkey AS VARCHAR)) AS run_id, s_suppkey AS start_seq,
       CASE WHEN s_suppkey % 3 = 0 THEN 'NaiveBayes' WHEN s_suppkey % 3 = 1 THEN 'RandomForest'
            ELSE 'XGBoost' END AS model_name,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST((s_suppkey * 37) % 101 AS DOUBLE) / 101 END AS macro_f1,
       CAST((s_suppkey * 41) % 101 AS DOUBLE) / 101 AS micro_f1,
       CAST((s_suppkey * 43) % 101 AS DOUBLE) / 101 AS accuracy,
       CAST((s_suppkey * 47) % 101 AS DOUBLE) / 101 AS macro_precision,
       CAST((s_suppkey * 53) % 101 AS DOUBLE) / 101 AS macro_recall
FROM supplier""",
    "model_versions": """
SELECT concat('m', CAST(s_suppkey % 4 AS VARCHAR)) AS name, s_suppkey AS version,
       concat('r', CAST(s_suppkey AS VARCHAR)) AS run_id
FROM supplier WHERE s_suppkey % 7 <> 0""",
    "aliases": """
SELECT 'm1' AS name, 'Production' AS alias, CAST(1 AS BIGINT) AS version""",
    "snapshots": """
SELECT CAST(ts AS DATE) AS snapshot_day, event_id, event_type, value FROM events""",
}

# views that other views read
_DEPENDS = {"predictions": ["reviews"]}


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <views>, <extra ctes> <body>`` with dependencies placed first."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in order]
    ctes += [f"{n} AS ({q}\n)" for n, q in (extra or [])]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
