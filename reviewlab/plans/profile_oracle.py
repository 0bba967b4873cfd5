"""DuckDB SQL equivalents of the profile queries (the correctness oracle)."""

from __future__ import annotations

from reviewlab.functions import text as tx
from reviewlab.sources.fixture_sql import with_views


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = sql_list(tx.ENGLISH_STOPWORDS)
WS = tx.WHITESPACE_RUN
LEN = "length(coalesce(review_text, ''))"
RATING = ("CASE WHEN isnan(TRY_CAST(rating AS DOUBLE)) THEN NULL "
          "ELSE TRY_CAST(rating AS DOUBLE) END")


def tokenize_sql(expr: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({expr}), '[a-zA-Z0-9'']+'), "
            f"lambda t: NOT list_contains({STOP}, t))")


def pct_sql(part: str, whole: str) -> str:
    return f"coalesce(round(100 * CAST({part} AS DOUBLE) / nullif({whole}, 0), 2), 0.0)"


def R(body: str, extra=None) -> str:
    return with_views(["reviews"], body, extra)


def stats_sql(value: str, source: str, group: str | None) -> str:
    agg = (f"count(v) AS \"count\", round(min(v), 6) AS \"min\", round(max(v), 6) AS \"max\", "
           f"round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median, "
           f"round(stddev_samp(v), 6) AS std")
    if group is None:
        return f"SELECT {agg} FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source})"
    return (f"SELECT {group}, {agg} FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {source}) "
            f"WHERE {group} IS NOT NULL GROUP BY {group}")


def box_sql(value: str, source: str) -> str:
    extra = [
        ("base", f"SELECT sentiment, v FROM (SELECT sentiment, CAST({value} AS DOUBLE) AS v FROM {source}) "
                 "WHERE sentiment IS NOT NULL AND v IS NOT NULL"),
        ("q", "SELECT sentiment, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
              "quantile_cont(v, 0.75) AS q3 FROM base GROUP BY sentiment"),
        ("f", "SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q"),
    ]
    return R("""
SELECT b.sentiment, count(*) AS n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(f.q3 - f.q1, 6) AS iqr,
       round(coalesce(min(v) FILTER (WHERE v >= lo), f.q1), 6) AS whisker_low,
       round(coalesce(max(v) FILTER (WHERE v <= hi), f.q3), 6) AS whisker_high,
       count(*) FILTER (WHERE v < lo OR v > hi) AS outliers
FROM base b JOIN f ON b.sentiment = f.sentiment
GROUP BY b.sentiment, f.q1, f.median, f.q3, f.lo, f.hi""", extra)


NUMERIC = f"(SELECT review_id, sentiment, {RATING} AS rating FROM reviews) nr"

TOP_WORDS = f"""
SELECT label, rank, word, "count" FROM (
  SELECT label, word, "count", row_number() OVER (PARTITION BY label ORDER BY "count" DESC, word) AS rank
  FROM (SELECT label, word, count(*) AS "count" FROM (
          SELECT sentiment AS label, unnest({tokenize_sql('review_text')}) AS word
          FROM reviews WHERE review_text IS NOT NULL AND sentiment IS NOT NULL) GROUP BY label, word))
WHERE rank <= 20"""

TEXT_GROUPS = "(SELECT coalesce(review_text, 'nan') AS text, count(*) AS \"count\" FROM reviews GROUP BY 1)"

DUP_SUMMARY = f"""
SELECT total_rows, unique_value_count, duplicate_value_count, duplicate_rows, total_rows - duplicate_rows AS unique_rows
FROM (SELECT CAST(coalesce(sum("count"), 0) AS BIGINT) AS total_rows, count(*) AS unique_value_count,
             count(*) FILTER (WHERE "count" > 1) AS duplicate_value_count,
             CAST(coalesce(sum("count") FILTER (WHERE "count" > 1), 0) AS BIGINT) AS duplicate_rows
      FROM {TEXT_GROUPS})"""

BRAND_LABELS = "(VALUES ('Positive'), ('Negative'), ('Neutral')) AS lab(label)"

SQL: dict[str, str] = {
    "drop_missing": R("SELECT review_id, sentiment, brand, rating FROM reviews "
                      "WHERE review_text IS NOT NULL AND sentiment IS NOT NULL"),
    "dedupe_keep_first": R("""
SELECT review_id, sentiment FROM (
  SELECT review_id, sentiment, row_number() OVER (PARTITION BY review_text ORDER BY review_id) AS rn
  FROM reviews WHERE review_text IS NOT NULL AND sentiment IS NOT NULL) WHERE rn = 1"""),
    "text_length_column": R(f"SELECT review_id, {LEN} AS text_length_chars FROM reviews"),
    "rating_numeric": R(f"SELECT review_id, round(rating, 6) AS rating FROM {NUMERIC} WHERE rating IS NOT NULL"),
    "rating_outlier_rows": R(f"SELECT review_id, round(rating, 6) AS rating FROM {NUMERIC} "
                             "WHERE rating IS NOT NULL AND NOT (rating BETWEEN 1 AND 5)"),
    "rating_available": R(f"SELECT count(rating) > 0 AS rating_available, count(rating) AS numeric_ratings FROM {NUMERIC}"),
    "overview_shape": R("SELECT count(*) AS \"rows\", CAST(6 AS BIGINT) AS \"columns\", "
                        "'review_id:bigint,review_text:string,sentiment:string,brand:string,rating:string,text_length_chars:bigint' AS dtypes FROM reviews"),
    "label_summary": R("""
SELECT label, "count", row_number() OVER (ORDER BY "count" DESC, label) AS rank, count(*) OVER () AS num_classes
FROM (SELECT coalesce(sentiment, 'nan') AS label, count(*) AS "count" FROM reviews GROUP BY 1)"""),
    "missing_summary": R(f"""
SELECT 'review_text' AS "column", count(*) FILTER (WHERE review_text IS NULL) AS missing,
       {pct_sql("count(*) FILTER (WHERE review_text IS NULL)", "count(*)")} AS pct FROM reviews
UNION ALL
SELECT 'sentiment', count(*) FILTER (WHERE sentiment IS NULL),
       {pct_sql("count(*) FILTER (WHERE sentiment IS NULL)", "count(*)")} FROM reviews"""),
    "duplicate_full_rows": R(f"""
SELECT d AS duplicates, {pct_sql('d', 'n')} AS pct FROM (
  SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS d, CAST(coalesce(sum(c), 0) AS BIGINT) AS n
  FROM (SELECT count(*) AS c FROM reviews GROUP BY review_text, sentiment, brand, rating))"""),
    "duplicate_text_excess": R(f"""
SELECT d AS duplicates, {pct_sql('d', 'n')} AS pct FROM (
  SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS d, CAST(coalesce(sum(c), 0) AS BIGINT) AS n
  FROM (SELECT count(*) AS c FROM reviews GROUP BY review_text))"""),
    "rating_outliers": R(f"""
SELECT o AS outliers, {pct_sql('o', 'n')} AS pct, round(mn, 6) AS rating_min, round(mx, 6) AS rating_max,
       CAST(1 AS BIGINT) AS expected_low, CAST(5 AS BIGINT) AS expected_high
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE rating IS NOT NULL AND NOT (rating BETWEEN 1 AND 5)) AS o,
             min(rating) AS mn, max(rating) AS mx FROM {NUMERIC})"""),
    "label_distribution": R(f"""
SELECT CAST(row_number() OVER (ORDER BY "count" DESC, label) - 1 AS BIGINT) AS position, label, "count",
       {pct_sql('"count"', 'total')} AS pct
FROM (SELECT label, "count", sum("count") OVER () AS total
      FROM (SELECT coalesce(sentiment, 'nan') AS label, count(*) AS "count" FROM reviews GROUP BY 1))"""),
    "label_distribution_lang": R(f"""
SELECT CAST(row_number() OVER (ORDER BY "count" DESC, label) - 1 AS BIGINT) AS position, label, "count",
       {pct_sql('"count"', 'total')} AS pct
FROM (SELECT label, "count", sum("count") OVER () AS total
      FROM (SELECT coalesce(CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END, 'nan') AS label, count(*) AS "count"
            FROM documents GROUP BY 1))"""),
    "text_length_stats": R(stats_sql(LEN, "reviews", None)),
    "text_length_by_label": R(stats_sql(LEN, "reviews", "sentiment")),
    "rating_stats": R(stats_sql("rating", f"{NUMERIC} WHERE rating IS NOT NULL", None)),
    "rating_by_label": R(stats_sql("rating", f"{NUMERIC} WHERE rating IS NOT NULL", "sentiment")),
    "rating_label_counts": R(f"""
SELECT sentiment, round(rating, 6) AS rating, count(*) AS "count" FROM {NUMERIC}
WHERE rating IS NOT NULL AND sentiment IS NOT NULL GROUP BY sentiment, rating"""),
    "rating_mean_by_label": R(f"""
SELECT sentiment, round(avg(rating), 6) AS mean_rating FROM {NUMERIC}
WHERE rating IS NOT NULL AND sentiment IS NOT NULL GROUP BY sentiment"""),
    "text_length_box": box_sql(LEN, "reviews"),
    "rating_box": box_sql("rating", NUMERIC),
    "top_words_by_label": R(TOP_WORDS),
    "top_words_chart": R(f"SELECT *, regexp_replace(label, '[^a-zA-Z0-9]+', '_', 'g') AS label_slug "
                         f"FROM ({TOP_WORDS}) WHERE rank <= 10"),
    "wordcloud_weights": R(f"""
SELECT label, word, "count", round("count" / max("count") OVER (PARTITION BY label), 6) AS weight
FROM ({TOP_WORDS})"""),
    "corpus_term_weights": R(f"""
SELECT word, "count", round("count" / max("count") OVER (), 6) AS weight FROM (
  SELECT word, count(*) AS "count" FROM (
    SELECT unnest({tokenize_sql(f"trim(regexp_replace(lower(coalesce(review_text, '')), '{WS}', ' ', 'g'))")}) AS word
    FROM reviews) GROUP BY word ORDER BY "count" DESC, word LIMIT 200)"""),
    "duplicate_summary": R(DUP_SUMMARY),
    "duplicated_reviews": R(f"SELECT text, \"count\" FROM {TEXT_GROUPS} WHERE \"count\" > 1"),
    "duplicate_examples": R(f"SELECT text, \"count\" FROM {TEXT_GROUPS} WHERE \"count\" > 1 "
                            "ORDER BY \"count\" DESC, text LIMIT 5"),
    "unique_vs_duplicate": R(f"SELECT 'unique' AS type, unique_rows AS \"count\" FROM ({DUP_SUMMARY}) "
                             f"UNION ALL SELECT 'duplicate', duplicate_rows FROM ({DUP_SUMMARY})"),
    "brand_sentiment_counts": R("SELECT sentiment, brand, count(*) AS \"count\" FROM reviews "
                                "WHERE sentiment IS NOT NULL AND brand IS NOT NULL GROUP BY sentiment, brand"),
    "sentiment_cards": R("""
SELECT count(*) FILTER (WHERE lower(trim(sentiment)) = 'positive') AS positive,
       count(*) FILTER (WHERE lower(trim(sentiment)) = 'negative') AS negative,
       count(*) FILTER (WHERE lower(trim(sentiment)) = 'neutral') AS neutral,
       count(*) AS total FROM reviews"""),
    "brand_sentiment_grid": R(f"""
SELECT lab.label, b.brand, count(r.review_id) AS "count",
       (SELECT count(*) FROM reviews x WHERE x.sentiment = lab.label) > 0 AS has_chart
FROM (SELECT DISTINCT brand FROM reviews WHERE brand IS NOT NULL) b
CROSS JOIN {BRAND_LABELS}
LEFT JOIN reviews r ON r.brand = b.brand AND r.sentiment = lab.label
GROUP BY lab.label, b.brand"""),
    "brand_crosstab": R("""
SELECT brand, sentiment AS label, count(*) AS "count"
FROM reviews WHERE brand IS NOT NULL AND sentiment IS NOT NULL GROUP BY brand, sentiment"""),
    "brand_crosstab_pct": R("""
SELECT brand, label, round(CAST("count" AS DOUBLE) / sum("count") OVER (PARTITION BY brand), 6) AS pct
FROM (SELECT brand, sentiment AS label, count(*) AS "count"
      FROM reviews WHERE brand IS NOT NULL AND sentiment IS NOT NULL GROUP BY brand, sentiment)"""),
    "brand_crosstab_lang": R("""
SELECT source AS brand, lang AS label, count(*) AS "count"
FROM (SELECT source, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END AS lang FROM documents)
WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source, lang"""),
    "class_distribution": R("SELECT sentiment, count(*) AS \"count\" FROM reviews WHERE sentiment IS NOT NULL "
                            "GROUP BY sentiment ORDER BY sentiment"),
    "tokenize": R(f"""
SELECT review_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT review_id, {tokenize_sql('review_text')} AS t FROM reviews WHERE review_text IS NOT NULL)"""),
    "clean_text": R(f"""
SELECT review_id, array_to_string(list_filter(string_split_regex(lower(review_text), '{WS}'),
       lambda t: regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains({STOP}, t)), ' ') AS clean_text
FROM reviews"""),
    "normalize_space": R(f"SELECT review_id, trim(regexp_replace(lower(coalesce(review_text, '')), '{WS}', ' ', 'g')) "
                         "AS normalized FROM reviews"),
    "strip_accents": R("SELECT review_id, strip_accents(lower(review_text)) AS stripped FROM reviews"),
    "label_slug": R("SELECT label, regexp_replace(label, '[^a-zA-Z0-9]+', '_', 'g') AS slug "
                    "FROM (SELECT DISTINCT coalesce(sentiment, 'nan') AS label FROM reviews)"),
    "timestamp_tag": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS tag FROM events",
}


def _section(name: str, key: str, label: str, metrics: list[str]) -> str:
    src = SQL[key]
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS section, '{m}' AS metric, CAST({label} AS VARCHAR) AS label, "
        f"round(CAST(\"{m}\" AS DOUBLE), 6) AS value FROM ({src})" for m in metrics)


_STATS = ["count", "min", "max", "mean", "median", "std"]
_BOX = ["n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "outliers"]
FULL_PROFILE_SECTIONS = [
    ("label_distribution", "label_distribution", "label", ["count", "pct"]),
    ("class_distribution", "class_distribution", "sentiment", ["count"]),
    ("sentiment_cards", "sentiment_cards", "NULL", ["positive", "negative", "neutral", "total"]),
    ("text_length_box", "text_length_box", "sentiment", _BOX),
    ("rating_label_counts", "rating_label_counts", "sentiment || ':' || CAST(rating AS VARCHAR)", ["count"]),
    ("rating_mean", "rating_mean_by_label", "sentiment", ["mean_rating"]),
    ("rating_box", "rating_box", "sentiment", _BOX),
    ("top_words_chart", "top_words_chart", "label_slug || ':' || word", ["count"]),
    ("wordcloud", "wordcloud_weights", "label || ':' || word", ["weight"]),
    ("corpus_terms", "corpus_term_weights", "word", ["count", "weight"]),
    ("repeated_texts", "duplicated_reviews", "text", ["count"]),
    ("duplicate_examples", "duplicate_examples", "text", ["count"]),
    ("unique_vs_duplicate", "unique_vs_duplicate", "type", ["count"]),
    ("brand_grid", "brand_sentiment_grid", "label || ':' || brand", ["count", "has_chart"]),
    ("brand_crosstab", "brand_crosstab", "brand || ':' || label", ["count"]),
    ("brand_crosstab_pct", "brand_crosstab_pct", "brand || ':' || label", ["pct"]),
    ("shape", "overview_shape", "NULL", ["rows", "columns"]),
    ("label_summary", "label_summary", "label", ["count"]),
    ("missing", "missing_summary", "\"column\"", ["missing", "pct"]),
    ("duplicates_full_rows", "duplicate_full_rows", "NULL", ["duplicates", "pct"]),
    ("duplicates_text", "duplicate_text_excess", "NULL", ["duplicates", "pct"]),
    ("rating_outliers", "rating_outliers", "NULL", ["outliers", "pct", "rating_min", "rating_max"]),
    ("text_length", "text_length_stats", "NULL", _STATS),
    ("text_length", "text_length_by_label", "sentiment", _STATS),
    ("rating", "rating_stats", "NULL", _STATS),
    ("rating", "rating_by_label", "sentiment", _STATS),
    ("top_words", "top_words_by_label", "label || ':' || word", ["count"]),
    ("duplicate_summary", "duplicate_summary", "NULL",
     ["total_rows", "unique_value_count", "duplicate_value_count", "duplicate_rows", "unique_rows"]),
    ("brand_sentiment", "brand_sentiment_counts", "sentiment || ':' || brand", ["count"]),
]
SQL["full_profile"] = "\nUNION ALL\n".join(_section(*s) for s in FULL_PROFILE_SECTIONS)
