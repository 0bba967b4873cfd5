"""Registered profile queries over the ``reviews`` view (callables (spark, sf_dir) -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators import profile as pf
from reviewlab.plans.common import rounded
from reviewlab.schema import DEFAULT as C
from reviewlab.sources import tables as tb


def _reviews(spark, sf_dir):
    return tb.reviews(spark, sf_dir)


def drop_missing(spark, sf_dir):
    return pf.drop_missing(_reviews(spark, sf_dir)).select(C.id, C.label, C.brand, C.rating)


def dedupe_keep_first(spark, sf_dir):
    r = _reviews(spark, sf_dir).select(C.id, C.text, C.label)
    d = pf.dedupe_keep_first(pf.drop_missing(r), key=C.text, order=C.id)
    return d.select(C.id, C.label)


def text_length_column(spark, sf_dir):
    return pf.with_text_length(tb.review_texts(spark, sf_dir)).select(C.id, C.length)


def rating_numeric(spark, sf_dir):
    return rounded(pf.numeric_ratings(_reviews(spark, sf_dir)).select(C.id, C.rating))


def rating_outlier_rows(spark, sf_dir):
    return rounded(pf.rating_outlier_rows(_reviews(spark, sf_dir)).select(C.id, C.rating))


def rating_available(spark, sf_dir):
    return pf.rating_available(_reviews(spark, sf_dir))


def overview_shape(spark, sf_dir):
    return pf.overview_shape(_reviews(spark, sf_dir)).select("rows", "columns", "dtypes")


def label_summary(spark, sf_dir):
    return pf.label_summary(_reviews(spark, sf_dir))


def missing_summary(spark, sf_dir):
    return rounded(pf.missing_summary(_reviews(spark, sf_dir)))


def duplicate_full_rows(spark, sf_dir):
    return rounded(pf.duplicate_full_rows(_reviews(spark, sf_dir)))


def duplicate_text_excess(spark, sf_dir):
    return rounded(pf.duplicate_text_excess(tb.review_texts(spark, sf_dir)))


def rating_outliers(spark, sf_dir):
    return rounded(pf.rating_outliers(_reviews(spark, sf_dir)))


def label_distribution(spark, sf_dir):
    return rounded(pf.label_distribution(_reviews(spark, sf_dir)))


def text_length_stats(spark, sf_dir):
    s = pf.text_length_stats(_reviews(spark, sf_dir))
    return rounded(s.filter(F.col("scope") == "global").drop("scope", C.label))


def text_length_by_label(spark, sf_dir):
    s = pf.text_length_stats(_reviews(spark, sf_dir))
    return rounded(s.filter(F.col("scope") == "group").drop("scope"))


def rating_stats(spark, sf_dir):
    s = pf.rating_stats(_reviews(spark, sf_dir))
    return rounded(s.filter(F.col("scope") == "global").drop("scope", C.label))


def rating_by_label(spark, sf_dir):
    s = pf.rating_stats(_reviews(spark, sf_dir))
    return rounded(s.filter(F.col("scope") == "group").drop("scope"))


def rating_label_counts(spark, sf_dir):
    return rounded(pf.rating_label_counts(_reviews(spark, sf_dir)))


def rating_mean_by_label(spark, sf_dir):
    return rounded(pf.rating_mean_by_label(_reviews(spark, sf_dir)))


def text_length_box(spark, sf_dir):
    return rounded(pf.text_length_box(_reviews(spark, sf_dir)))


def rating_box(spark, sf_dir):
    return rounded(pf.rating_box(_reviews(spark, sf_dir)))


def top_words_by_label(spark, sf_dir):
    return pf.top_words_by_label(_reviews(spark, sf_dir), top_n=20)


def top_words_chart(spark, sf_dir):
    return pf.top_words_chart(pf.top_words_by_label(_reviews(spark, sf_dir), top_n=20), n=10)


def wordcloud_weights(spark, sf_dir):
    return pf.wordcloud_weights(pf.top_words_by_label(_reviews(spark, sf_dir), top_n=20))


def corpus_term_weights(spark, sf_dir):
    return pf.corpus_term_weights(tb.review_texts(spark, sf_dir), max_words=200)


def duplicate_summary(spark, sf_dir):
    return pf.duplicate_summary(tb.review_texts(spark, sf_dir))


def duplicated_reviews(spark, sf_dir):
    return pf.duplicated_reviews(tb.review_texts(spark, sf_dir))


def duplicate_examples(spark, sf_dir):
    return pf.duplicate_examples(tb.review_texts(spark, sf_dir), n=5)


def unique_vs_duplicate(spark, sf_dir):
    return pf.unique_vs_duplicate(tb.review_texts(spark, sf_dir))


def brand_sentiment_counts(spark, sf_dir):
    return pf.brand_sentiment_counts(_reviews(spark, sf_dir))


def sentiment_cards(spark, sf_dir):
    return pf.sentiment_cards(_reviews(spark, sf_dir))


def brand_sentiment_grid(spark, sf_dir):
    return pf.brand_sentiment_grid(_reviews(spark, sf_dir))


def brand_crosstab(spark, sf_dir):
    return pf.brand_crosstab(_reviews(spark, sf_dir))


def _by_language(spark, sf_dir):
    """The review view with the language as label (some null) and the source as brand."""
    d = tb.read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    label = F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("lang"))
    return d.select(label.alias(C.label), F.col("source").alias(C.brand))


def brand_crosstab_lang(spark, sf_dir):
    return pf.brand_crosstab(_by_language(spark, sf_dir))


def label_distribution_lang(spark, sf_dir):
    return rounded(pf.label_distribution(_by_language(spark, sf_dir)))


def brand_crosstab_pct(spark, sf_dir):
    return pf.brand_crosstab_pct(_reviews(spark, sf_dir))


def class_distribution(spark, sf_dir):
    return pf.class_distribution(_reviews(spark, sf_dir))


def full_profile(spark, sf_dir):
    return rounded(pf.full_profile(_reviews(spark, sf_dir)))


def tokenize(spark, sf_dir):
    r = tb.review_texts(spark, sf_dir).filter(F.col(C.text).isNotNull())
    toks = tx.tokenize(F.col(C.text))
    return r.select(C.id, F.size(toks).cast("bigint").alias("n_tokens"), F.array_join(toks, " ").alias("tokens"))


def clean_text(spark, sf_dir):
    r = tb.review_texts(spark, sf_dir)
    return r.select(C.id, tx.clean_text(F.col(C.text)).alias("clean_text"))


def normalize_space(spark, sf_dir):
    r = tb.review_texts(spark, sf_dir)
    return r.select(C.id, tx.normalize_space(F.col(C.text)).alias("normalized"))


def strip_accents(spark, sf_dir):
    r = tb.review_texts(spark, sf_dir)
    return r.select(C.id, tx.strip_accents(F.lower(F.col(C.text))).alias("stripped"))


def label_slug(spark, sf_dir):
    r = _reviews(spark, sf_dir)
    labels = r.select(F.coalesce(F.col(C.label), F.lit("nan")).alias("label")).distinct()
    return labels.select("label", tx.label_slug(F.col("label")).alias("slug"))


def timestamp_tag(spark, sf_dir):
    e = tb.read_table(spark, sf_dir, "events")
    return e.select("event_id", tx.timestamp_tag(F.col("ts")).alias("tag"))


QUERIES = {name: fn for name, fn in dict(globals()).items()
           if callable(fn) and not name.startswith("_") and getattr(fn, "__module__", None) == __name__}
