"""DuckDB SQL of the training chain: prepare -> split -> vocabulary -> TF-IDF -> naive Bayes."""

from __future__ import annotations

from reviewlab.functions import text as tx
from reviewlab.plans.profile_oracle import STOP, WS
from reviewlab.sources.fixture_sql import with_views


def clean_sql(expr: str) -> str:
    return (f"array_to_string(list_filter(string_split_regex(lower({expr}), '{WS}'), "
            f"lambda t: regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains({STOP}, t)), ' ')")


PREP = [
    ("prepared", f"""
SELECT review_id, {clean_sql('review_text')} AS text, sentiment FROM (
  SELECT review_id, review_text, sentiment,
         row_number() OVER (PARTITION BY review_text ORDER BY review_id) AS rn
  FROM reviews WHERE review_text IS NOT NULL AND sentiment IS NOT NULL) WHERE rn = 1"""),
    ("label_ids", """
SELECT sentiment, CAST(row_number() OVER (ORDER BY sentiment) - 1 AS BIGINT) AS label_id
FROM (SELECT DISTINCT sentiment FROM prepared)"""),
    ("split", """
SELECT p.review_id, p.text, p.sentiment, l.label_id,
       CASE WHEN row_number() OVER (PARTITION BY p.sentiment
                                    ORDER BY md5(CAST(p.review_id AS VARCHAR) || ':42'), p.review_id)
                 <= round(0.2 * count(*) OVER (PARTITION BY p.sentiment)) THEN 'val' ELSE 'train' END AS split
FROM prepared p JOIN label_ids l ON p.sentiment = l.sentiment"""),
]


def terms_ctes(prefix: str, source: str, cols: str) -> list[tuple[str, str]]:
    """Per-document uni/bigram counts of ``source`` (which has review_id, text, <cols>)."""
    return [
        (f"{prefix}toks", f"SELECT review_id, {cols}, regexp_extract_all(strip_accents(lower(text)), "
                          f"'{tx.WORD_PATTERN}') AS t FROM {source}"),
        (f"{prefix}grams", f"SELECT review_id, {cols}, list_concat(t, list_transform(range(1, len(t)), "
                           f"lambda i: t[i] || ' ' || t[i + 1])) AS g FROM {prefix}toks"),
        (f"{prefix}terms", f"SELECT review_id, {cols}, term, count(*) AS tf FROM "
                           f"(SELECT review_id, {cols}, unnest(g) AS term FROM {prefix}grams) "
                           f"GROUP BY ALL"),
    ]


def weights_ctes(prefix: str, cols: str) -> list[tuple[str, str]]:
    return [
        (f"{prefix}raw", f"SELECT d.review_id, {', '.join('d.' + c.strip() for c in cols.split(','))}, d.term, "
                         f"d.tf * i.idf AS w FROM {prefix}terms d JOIN idf i ON d.term = i.term"),
        (f"{prefix}tfidf", f"SELECT review_id, {cols}, term, "
                           f"w / sqrt(sum(w * w) OVER (PARTITION BY review_id)) AS weight FROM {prefix}raw"),
    ]


VOCAB = terms_ctes("", "split", "split, label_id") + [
    ("ntrain", "SELECT count(*) AS n FROM split WHERE split = 'train'"),
    ("vocab", """
SELECT term, df FROM (SELECT term, count(*) AS df, sum(tf) AS tfs FROM terms WHERE split = 'train' GROUP BY term)
WHERE df >= 2 ORDER BY tfs DESC, term LIMIT 100"""),
    ("idf", "SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocab CROSS JOIN ntrain"),
] + weights_ctes("", "split, label_id")

NB = [
    ("classes", "SELECT label_id, count(*) AS nc FROM split WHERE split = 'train' GROUP BY label_id"),
    ("fc", """
SELECT c.label_id, v.term, coalesce(sum(t.weight), 0) AS s
FROM classes c CROSS JOIN vocab v
LEFT JOIN tfidf t ON t.split = 'train' AND t.label_id = c.label_id AND t.term = v.term
GROUP BY c.label_id, v.term"""),
    ("flp", "SELECT label_id, term, ln(s + 4) - ln(sum(s + 4) OVER (PARTITION BY label_id)) AS lp FROM fc"),
    ("prior", "SELECT label_id, ln(nc) - ln(sum(nc) OVER ()) AS lp FROM classes"),
]


def scores_ctes(prefix: str, docs: str, weights: str) -> list[tuple[str, str]]:
    """Joint log-likelihood per (doc, class) and the arg-max class."""
    return [
        (f"{prefix}jll", f"""
SELECT d.review_id, p.label_id, coalesce(sum(w.weight * f.lp), 0) + p.lp AS score
FROM {docs} d CROSS JOIN prior p
LEFT JOIN {weights} w ON w.review_id = d.review_id
LEFT JOIN flp f ON f.label_id = p.label_id AND f.term = w.term
GROUP BY d.review_id, p.label_id, p.lp"""),
        (f"{prefix}pred", f"""
SELECT review_id, label_id AS pred_id FROM (
  SELECT review_id, label_id, row_number() OVER (PARTITION BY review_id ORDER BY round(score, 9) DESC, label_id) AS rn
  FROM {prefix}jll) WHERE rn = 1"""),
    ]


VAL_SCORES = scores_ctes("val_", "(SELECT review_id FROM split WHERE split = 'val')", "tfidf")

SCORE_DOCS = ([("sdocs", f"SELECT review_id, {clean_sql('review_text')} AS text, 0 AS z FROM reviews "
                         "WHERE review_text IS NOT NULL")]
              + terms_ctes("s", "sdocs", "z") + weights_ctes("s", "z")
              + scores_ctes("s_", "sdocs", "stfidf"))


RAW_SCORE_DOCS = ([("rdocs", "SELECT review_id, review_text AS text, 0 AS z FROM reviews "
                             "WHERE review_text IS NOT NULL")]
                  + terms_ctes("rs", "rdocs", "z") + weights_ctes("rs", "z")
                  + scores_ctes("rs_", "rdocs", "rstfidf"))


def chain(body: str, *parts) -> str:
    extra = []
    for p in parts:
        extra.extend(p)
    return with_views(["reviews"], body, extra)


SQL: dict[str, str] = {
    "label_encode": chain("SELECT review_id, sentiment, label_id FROM split", PREP),
    "label_map": chain("SELECT label_id, sentiment AS label FROM label_ids", PREP),
    "stratified_split": chain("SELECT review_id, sentiment, split FROM split", PREP),
    "union_train_val": chain("SELECT review_id, split FROM split WHERE split = 'train' "
                             "UNION ALL SELECT review_id, split FROM split WHERE split = 'val'", PREP),
    "ngrams": with_views(["reviews"], "SELECT review_id, term, tf FROM rterms",
                         [("rdocs", "SELECT review_id, review_text AS text, 0 AS z FROM reviews "
                                    "WHERE review_text IS NOT NULL")] + terms_ctes("r", "rdocs", "z")),
    "tfidf_vocabulary": chain("SELECT term, df AS doc_freq, round(idf, 6) AS idf FROM idf", PREP, VOCAB),
    "tfidf_weights": chain("SELECT review_id, split, term, round(weight, 6) AS weight FROM tfidf", PREP, VOCAB),
    "svd_gram_product": chain("""
SELECT t.term, round(sum(t.weight * r.ones), 6) AS by_ones, round(sum(t.weight * r.lengths), 6) AS by_length
FROM tfidf t JOIN (SELECT review_id, sum(weight) AS ones, sum(weight * length(term)) AS lengths FROM tfidf GROUP BY review_id) r
  ON t.review_id = r.review_id GROUP BY t.term""", PREP, VOCAB),
    "nb_model": chain("""
SELECT f.label_id, f.term, round(f.lp, 6) AS log_prob, round(p.lp, 6) AS log_prior
FROM flp f JOIN prior p ON f.label_id = p.label_id""", PREP, VOCAB, NB),
    "nb_predict": chain("""
SELECT s.review_id, s.label_id, p.pred_id FROM split s JOIN val_pred p ON s.review_id = p.review_id""",
                        PREP, VOCAB, NB, VAL_SCORES),
    "decode_labels": chain("""
SELECT p.review_id, p.pred_id, coalesce(l.sentiment, CAST(p.pred_id AS VARCHAR)) AS prediction
FROM val_pred p LEFT JOIN label_ids l ON p.pred_id = l.label_id""", PREP, VOCAB, NB, VAL_SCORES),
    "batch_predict": chain("""
SELECT p.review_id, l.sentiment AS prediction FROM s_pred p JOIN label_ids l ON p.pred_id = l.label_id""",
                           PREP, VOCAB, NB, SCORE_DOCS),
    "batch_predict_raw": chain("""
SELECT p.review_id, l.sentiment AS prediction FROM rs_pred p JOIN label_ids l ON p.pred_id = l.label_id""",
                               PREP, VOCAB, NB, RAW_SCORE_DOCS),
    "predict_proba": chain("""
SELECT review_id, label, round(p, 6) AS probability, round(max(p) OVER (PARTITION BY review_id), 6) AS confidence
FROM (SELECT review_id, label, e / sum(e) OVER (PARTITION BY review_id) AS p FROM (
        SELECT review_id, label, exp(score - m) AS e FROM (
          SELECT j.review_id, l.sentiment AS label, j.score, max(j.score) OVER (PARTITION BY j.review_id) AS m
          FROM val_jll j JOIN label_ids l ON j.label_id = l.label_id)))""", PREP, VOCAB, NB, VAL_SCORES),
}


# first boosting round: margins are 0, so every class has p = 1/K; sums of whole numbers of 2**-24; rows drawn by md5
BOOST = [
    ("k", "SELECT count(*)::DOUBLE AS k FROM label_ids"),
    ("drawn", "SELECT review_id, label_id FROM split WHERE split = 'train' "
              "AND substr(md5(CAST(review_id AS VARCHAR) || ':42:1'), 1, 8) < '80000000'"),
    ("gh", """
SELECT d.review_id, l.label_id, CAST(round((1 / k - CASE WHEN l.label_id = d.label_id THEN 1 ELSE 0 END) * 16777216) AS BIGINT) AS g,
       CAST(round(greatest(2 * (1 / k) * (1 - 1 / k), 1e-16) * 16777216) AS BIGINT) AS h
FROM drawn d CROSS JOIN label_ids l CROSS JOIN k"""),
    ("binned", "SELECT review_id, term, CAST(greatest(1, least(64, ceil(round(weight * 64, 9)))) AS BIGINT) AS bin FROM tfidf"),
    ("hist", "SELECT label_id, term, bin, sum(g)::DOUBLE AS g, sum(h)::DOUBLE AS h FROM gh JOIN binned USING (review_id) GROUP BY ALL"),
    ("total", "SELECT label_id, sum(g)::DOUBLE AS tg, sum(h)::DOUBLE AS th FROM gh GROUP BY label_id"),
    ("cand", """
SELECT label_id, term, bin, tg, th, tg - sum(g) OVER w + sum(g) OVER u AS lg, th - sum(h) OVER w + sum(h) OVER u AS lh
FROM (SELECT label_id, term, bin, g, h FROM hist UNION ALL SELECT DISTINCT label_id, term, 0, 0.0, 0.0 FROM hist) JOIN total USING (label_id)
WINDOW w AS (PARTITION BY label_id, term), u AS (PARTITION BY label_id, term ORDER BY bin)"""),
    ("gains", """
SELECT label_id, term, bin, round(pow(lg / 16777216, 2) / (lh / 16777216 + 1) + pow((tg - lg) / 16777216, 2) / ((th - lh) / 16777216 + 1)
                                  - pow(tg / 16777216, 2) / (th / 16777216 + 1), 9) AS gain
FROM cand WHERE lh >= 16777216 AND th - lh >= 16777216"""),
]

SQL.update({
    "gbt_root_histogram": chain("SELECT label_id, term, bin, round(g / 16777216, 6) AS sum_g, round(h / 16777216, 6) AS sum_h FROM hist",
                                PREP, VOCAB, BOOST),
    "gbt_root_split": chain("""
SELECT label_id, term, bin, round(gain, 6) AS gain FROM (
  SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY gain DESC, term, bin) AS rn FROM gains WHERE gain > 1e-6) WHERE rn = 1""",
                            PREP, VOCAB, BOOST),
})


def eval_ctes(source: str) -> list[tuple[str, str]]:
    return [
        ("cm", f"SELECT y_true, y_pred, count(*) AS n FROM {source} "
               "WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY y_true, y_pred"),
        ("pc", """
SELECT label, sum(tp) AS tp, sum(sup) AS support, sum(prd) AS predicted FROM (
  SELECT y_true AS label, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp, n AS sup, 0 AS prd FROM cm
  UNION ALL SELECT y_pred, 0, 0, n FROM cm) GROUP BY label"""),
        ("pcm", """
SELECT label, tp, support, predicted,
       coalesce(tp / nullif(predicted, 0), 0.0) AS precision,
       coalesce(tp / nullif(support, 0), 0.0) AS recall,
       coalesce(2 * tp / nullif(predicted + support, 0), 0.0) AS f1 FROM pc"""),
    ]


EVAL_BODY = """
SELECT round(coalesce(sum(tp) / nullif(sum(support), 0), 0.0), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
       round(coalesce(2 * sum(tp) / nullif(sum(predicted) + sum(support), 0), 0.0), 6) AS micro_f1,
       round(coalesce(sum(f1 * support) / nullif(sum(support), 0), 0.0), 6) AS weighted_f1,
       round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall FROM pcm"""

NB_VAL_PAIRS = [("nbpairs", """
SELECT s.sentiment AS y_true, coalesce(l.sentiment, CAST(p.pred_id AS VARCHAR)) AS y_pred
FROM split s JOIN val_pred p ON s.review_id = p.review_id LEFT JOIN label_ids l ON p.pred_id = l.label_id""")]

SQL.update({
    "eval_metrics": with_views(["predictions"], EVAL_BODY, eval_ctes("predictions")),
    "nb_eval_metrics": chain(EVAL_BODY, PREP, VOCAB, NB, VAL_SCORES, NB_VAL_PAIRS, eval_ctes("nbpairs")),
    "confusion_matrix": with_views(["predictions"], """
SELECT t.label AS y_true, p.label AS y_pred, coalesce(cm.n, 0) AS "count"
FROM (SELECT DISTINCT label FROM pc) t CROSS JOIN (SELECT DISTINCT label FROM pc) p
LEFT JOIN cm ON cm.y_true = t.label AND cm.y_pred = p.label""", eval_ctes("predictions")),
    "classification_report": with_views(["predictions"], """
SELECT label AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1_score,
       CAST(support AS BIGINT) AS support FROM pcm
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcm
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM pcm
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcm""", eval_ctes("predictions")),
})
