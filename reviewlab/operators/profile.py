"""Profiles of a review table: shape, labels, missing values, duplicates, text length,
ratings, word frequencies, brands. Every function returns a tidy DataFrame with
aliased columns; nothing is collected.

Null rules (they differ per report on purpose):
- label counts keep the null class (shown as 'nan');
- per-label statistics drop null labels;
- the duplicate profile treats null text as the string 'nan';
- null text has length 0;
- brand reports drop rows null in brand or label;
- unparseable ratings are dropped (try_cast, NaN removed), never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators.stats import box_stats, global_and_grouped_stats, top_k_per_group
from reviewlab.schema import DEFAULT, Cols, ensure_columns
from reviewlab.session import written

# The label order of the distribution chart and the brand chart.
SENTIMENT_ORDER = ("Positive", "Neutral", "Negative")
BRAND_CHART_LABELS = ("Positive", "Negative", "Neutral")
RATING_RANGE = (1, 5)


# ---------------------------------------------------------------- guards, filters
def drop_missing(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Rows with both text and label present."""
    return df.na.drop(subset=[c.text, c.label])


def dedupe_keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep, per distinct ``key``, the row with the smallest ``order`` (file order).

    Keys are grouped by their SHA-256, a fixed-width hash aggregate that combines
    map-side (a text holding a third of all rows is one row per map task), and the
    chosen rows come back by a semi join on digest and order (``order`` tells rows of one
    key apart). Null keys are one group.
    """
    d = df.withColumn("_digest", digest(F.col(key)))
    first = d.groupBy("_digest").agg(F.min(order).alias("_order"))
    kept = d.join(first, (d["_digest"] == first["_digest"]) & d[order].eqNullSafe(first["_order"]), "left_semi")
    return kept.select(*df.columns)


def digest(value: Column) -> Column:
    """SHA-256 of a value's text, told apart from null."""
    return F.sha2(F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("n")), 256)


def with_text_length(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Add the length column if it is absent (never mutates the caller's frame)."""
    if c.length in df.columns:
        return df
    return df.withColumn(c.length, tx.text_length(F.col(c.text)))


def rating_value(c: Cols = DEFAULT) -> Column:
    """Numeric rating: try_cast to double, NaN treated as missing."""
    r = F.col(c.rating).try_cast("double")
    return F.when(F.isnan(r), F.lit(None).cast("double")).otherwise(r)


def numeric_ratings(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Rows whose rating parses as a number, with the rating as double."""
    return df.withColumn(c.rating, rating_value(c)).filter(F.col(c.rating).isNotNull())


def rating_outlier_rows(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    lo, hi = RATING_RANGE
    r = rating_value(c)
    return df.withColumn(c.rating, r).filter(r.isNotNull() & ~r.between(lo, hi))


def rating_available(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """One row: whether any numeric rating exists (False when columns are absent)."""
    if c.rating not in df.columns or c.label not in df.columns:
        return df.sparkSession.range(1).select(F.lit(False).alias("rating_available"),
                                               F.lit(0).cast("bigint").alias("numeric_ratings"))
    n = F.count(rating_value(c))
    return df.agg((n > 0).alias("rating_available"), n.alias("numeric_ratings"))


# ---------------------------------------------------------------- overview
def overview_shape(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Rows and columns; the column count includes the derived length column."""
    d = with_text_length(df, c)
    dtypes = ",".join(f"{n}:{t}" for n, t in d.dtypes)
    return d.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(d.columns)).cast("bigint").alias("columns"),
                 F.lit(dtypes).alias("dtypes"))


def label_summary(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Classes by count (desc, then label), null class included as 'nan'."""
    counts = df.groupBy(F.coalesce(F.col(c.label), F.lit("nan")).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.orderBy(F.desc("count"), F.asc("label"))   # one row per class: small
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .withColumn("num_classes", F.count(F.lit(1)).over(Window.partitionBy()).cast("bigint")))


def missing_summary(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Missing count and percent of rows for the text and the label column (one pass)."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 F.count_if(F.col(c.text).isNull()).alias("_mt"),
                 F.count_if(F.col(c.label).isNull()).alias("_ml"))
    return agg.select(F.inline(F.array(
        F.struct(F.lit(c.text).alias("column"), F.col("_mt").alias("missing"), tx.pct(F.col("_mt"), F.col("_rows")).alias("pct")),
        F.struct(F.lit(c.label).alias("column"), F.col("_ml").alias("missing"), tx.pct(F.col("_ml"), F.col("_rows")).alias("pct")),
    )))


def _excess_duplicates(df: DataFrame, subset: list[str]) -> DataFrame:
    """Rows beyond the first of each group of equal ``subset`` values (nulls equal); the
    shuffle carries a digest of the values, not the values."""
    mark = F.sha2(F.concat_ws("|", *[digest(F.col(x)) for x in subset]), 256)
    g = df.groupBy(mark.alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"))


def duplicate_full_rows(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Full-row duplicates (id column excluded) beyond the first, with percent."""
    subset = [x for x in df.columns if x != c.id]
    d = _excess_duplicates(df, subset)
    return d.select("duplicates", tx.pct(F.col("duplicates"), F.col("rows")).alias("pct"))


def duplicate_text_excess(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    d = _excess_duplicates(df, [c.text])
    return d.select("duplicates", tx.pct(F.col("duplicates"), F.col("rows")).alias("pct"))


def rating_outliers(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Outlier count/percent (numeric, outside [1, 5]), min and max of numeric ratings."""
    lo, hi = RATING_RANGE
    r = rating_value(c)
    out = r.isNotNull() & ~r.between(lo, hi)
    a = df.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(out).alias("outliers"),
               F.min(r).alias("rating_min"), F.max(r).alias("rating_max"))
    return a.select("outliers", tx.pct(F.col("outliers"), F.col("_rows")).alias("pct"),
                    "rating_min", "rating_max",
                    F.lit(lo).cast("bigint").alias("expected_low"), F.lit(hi).cast("bigint").alias("expected_high"))


def label_distribution(df: DataFrame, c: Cols = DEFAULT, classes=None) -> DataFrame:
    """Counts and percents of every label present (null as 'nan'), ordered by count like
    the label summary, with percents over all rows.

    ``classes`` gives a fixed order instead: these labels first, 0 for absent ones, then
    every other label by count; percents are over all rows in either case.
    """
    s = label_summary(df, c)
    total = F.sum("count").over(Window.partitionBy())   # one row per class
    if classes is not None:
        spark = df.sparkSession
        order = spark.createDataFrame(list(enumerate(classes)), "fixed int, label string")
        s = s.join(order, "label", "full").withColumn("count", F.coalesce("count", F.lit(0)))
        s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.col("fixed").asc_nulls_last(), "rank")))
    return s.select((F.col("rank") - 1).cast("bigint").alias("position"), "label", "count", tx.pct(F.col("count"), total).alias("pct"))


# ---------------------------------------------------------------- text length, ratings
def text_length_stats(df: DataFrame, c: Cols = DEFAULT, approx: bool = False) -> DataFrame:
    """Global length summary plus one per non-null label (one ROLLUP pass).
    ``approx`` uses an approximate median (bounded memory for huge distinct counts)."""
    d = with_text_length(df, c).select(c.label, c.length)
    return global_and_grouped_stats(d, c.length, c.label, approx)


def rating_stats(df: DataFrame, c: Cols = DEFAULT, approx: bool = False) -> DataFrame:
    """Rating summary: global (any label) plus one per non-null label."""
    d = numeric_ratings(df.select(c.label, c.rating), c)
    return global_and_grouped_stats(d, c.rating, c.label, approx)


def rating_label_counts(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    d = numeric_ratings(df.select(c.label, c.rating), c).filter(F.col(c.label).isNotNull())
    return d.groupBy(c.label, c.rating).agg(F.count(F.lit(1)).alias("count"))


def rating_mean_by_label(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    d = numeric_ratings(df.select(c.label, c.rating), c).filter(F.col(c.label).isNotNull())
    return d.groupBy(c.label).agg(F.avg(c.rating).alias("mean_rating"))


def text_length_box(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    d = with_text_length(df, c).select(c.label, c.length)
    return box_stats(d, c.length, c.label)


def rating_box(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    d = numeric_ratings(df.select(c.label, c.rating), c)
    return box_stats(d, c.rating, c.label)


# ---------------------------------------------------------------- word frequencies
def word_counts_by_label(df: DataFrame, c: Cols = DEFAULT, stopwords=tx.ENGLISH_STOPWORDS) -> DataFrame:
    """(label, word, count) over non-null text and label; partial aggregation absorbs hot words."""
    d = df.filter(F.col(c.text).isNotNull() & F.col(c.label).isNotNull())
    words = d.select(F.col(c.label).alias("label"), F.explode(tx.tokenize(F.col(c.text), stopwords)).alias("word"))
    return words.groupBy("label", "word").agg(F.count(F.lit(1)).alias("count"))


def top_words_by_label(df: DataFrame, c: Cols = DEFAULT, top_n: int = 20,
                       stopwords=tx.ENGLISH_STOPWORDS) -> DataFrame:
    """Top-n words per label by count; ties by word. Salted two-stage top-k."""
    counts = word_counts_by_label(df, c, stopwords)
    top = top_k_per_group(counts, ["label"], [F.desc("count"), F.asc("word")], top_n, salt_key=F.col("word"))
    return top.select("label", F.col("rank").cast("bigint").alias("rank"), "word", "count")


def top_words_chart(top_words: DataFrame, n: int = 10) -> DataFrame:
    """Chart prefix of the top-words table, with a file-safe label slug."""
    return (top_words.filter(F.col("rank") <= n)
            .withColumn("label_slug", tx.label_slug(F.col("label"))))


def wordcloud_weights(top_words: DataFrame) -> DataFrame:
    """Relative weight of each top word inside its label (count / label max)."""
    w = Window.partitionBy("label")   # rows: top-n per label, small
    return top_words.select("label", "word", "count",
                            F.round(F.col("count") / F.max("count").over(w), 6).alias("weight"))


def corpus_term_weights(df: DataFrame, c: Cols = DEFAULT, max_words: int = 200,
                        stopwords=tx.ENGLISH_STOPWORDS) -> DataFrame:
    """Corpus-wide word weights on whitespace-normalised text, at most ``max_words``."""
    words = df.select(F.explode(tx.tokenize(tx.normalize_space(F.col(c.text)), stopwords)).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc("word")).limit(max_words)
    w = Window.partitionBy()   # at most max_words rows
    return top.select("word", "count", F.round(F.col("count") / F.max("count").over(w), 6).alias("weight"))


# ---------------------------------------------------------------- duplicates
def _text_groups(df: DataFrame, c: Cols) -> DataFrame:
    """(digest, count) of every different text (null counted as the value 'nan')."""
    return df.groupBy(digest(F.coalesce(F.col(c.text), F.lit("nan"))).alias("digest")).agg(F.count(F.lit(1)).alias("count"))


def duplicate_summary(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Totals of the duplicate profile (null text counted as the value 'nan')."""
    g = _text_groups(df, c)
    rep = F.col("count") > 1
    a = g.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("total_rows"),
              F.count(F.lit(1)).alias("unique_value_count"),
              F.count_if(rep).alias("duplicate_value_count"),
              F.coalesce(F.sum(F.when(rep, F.col("count"))), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    return a.withColumn("unique_rows", F.col("total_rows") - F.col("duplicate_rows"))


def duplicated_reviews(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Every repeated text with its count; texts are fetched for repeated digests only."""
    text = F.coalesce(F.col(c.text), F.lit("nan"))
    repeated = _text_groups(df, c).filter(F.col("count") > 1)
    texts = df.select(text.alias("text"), digest(text).alias("digest")).join(repeated, "digest")
    return texts.groupBy("digest").agg(F.any_value("text").alias("text"), F.any_value("count").alias("count")).select("text", "count")


def duplicate_examples(df: DataFrame, c: Cols = DEFAULT, n: int = 5) -> DataFrame:
    """Top-n repeated texts by count (ties by text)."""
    return duplicated_reviews(df, c).orderBy(F.desc("count"), F.asc("text")).limit(n)


def unique_vs_duplicate(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    s = duplicate_summary(df, c)
    return s.select(F.inline(F.array(
        F.struct(F.lit("unique").alias("type"), F.col("unique_rows").alias("count")),
        F.struct(F.lit("duplicate").alias("type"), F.col("duplicate_rows").alias("count")))))


# ---------------------------------------------------------------- brands and labels
def brand_sentiment_counts(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    d = df.select(c.label, c.brand).na.drop(subset=[c.label, c.brand])
    return d.groupBy(c.label, c.brand).agg(F.count(F.lit(1)).alias("count"))


def sentiment_cards(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Positive / negative / neutral counts with case- and space-insensitive match."""
    s = tx.norm_label(F.col(c.label))
    return df.agg(F.count_if(s == "positive").alias("positive"),
                  F.count_if(s == "negative").alias("negative"),
                  F.count_if(s == "neutral").alias("neutral"),
                  F.count(F.lit(1)).alias("total"))


def brand_sentiment_grid(df: DataFrame, c: Cols = DEFAULT, labels=BRAND_CHART_LABELS) -> DataFrame:
    """Brand x fixed label counts, zero filled, with a flag for labels that have rows.

    One aggregate per brand with a conditional count per label (no join); the flag
    sums the brand rows of a label, including the null-brand group. The label totals
    are a global aggregate over the per-brand rows (one row per label, broadcast), so
    no task ever holds all brands of a label.
    """
    per_brand = df.groupBy(F.col(c.brand).cast("string").alias("brand")).agg(
        *[F.count_if(F.col(c.label) == k).alias(f"_n{i}") for i, k in enumerate(labels)])
    # null brands yield no cells; dropping them inside the generator (not by a filter,
    # which the optimizer would push below this branch's aggregate only) keeps the two
    # branches' aggregates identical, so Spark runs that shuffle once
    grid = F.array(*[F.struct(F.lit(k).alias("label"), F.col(f"_n{i}").alias("count")) for i, k in enumerate(labels)])
    cells = per_brand.select("brand", F.inline(F.when(F.col("brand").isNotNull(), grid)))
    totals = per_brand.agg(*[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(labels))])
    flags = totals.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("label"), (F.coalesce(F.col(f"_n{i}"), F.lit(0)) > 0).alias("has_chart"))
        for i, k in enumerate(labels)])))
    return (cells.join(F.broadcast(flags), "label")   # len(labels) rows
            .select("label", "brand", "count", "has_chart"))


def brand_crosstab(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Brand x label crosstab as tidy rows (brand, label, count) over every label present;
    rows null in either are dropped, empty cells have no row."""
    d = df.select(F.col(c.brand).alias("brand"), F.col(c.label).alias("label")).na.drop()
    return d.groupBy("brand", "label").agg(F.count(F.lit(1)).alias("count"))


def brand_crosstab_pct(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    """Row-normalised crosstab: each cell's share of its brand's rows over all labels."""
    cells = brand_crosstab(df, c)
    totals = cells.groupBy("brand").agg(F.sum("count").alias("total"))
    return (cells.join(totals, "brand")
            .select("brand", "label", F.round(F.col("count").cast("double") / F.col("total"), 6).alias("pct")))


def wide_crosstab(cells: DataFrame, value: str = "count") -> DataFrame:
    """One column per label, 0 for empty cells (labels are read from the cells)."""
    return cells.groupBy("brand").pivot("label").agg(F.first(value)).na.fill(0)


def class_distribution(df: DataFrame, c: Cols = DEFAULT) -> DataFrame:
    return (df.filter(F.col(c.label).isNotNull()).groupBy(c.label).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(c.label))


# ---------------------------------------------------------------- all in one
def full_profile(df: DataFrame, c: Cols = DEFAULT, top_n: int = 20, cache: bool = False) -> DataFrame:
    """Every profile section as tidy rows (section, metric, label, value). Text and label are required;
    without a rating or brand column that column's sections are left out.

    The columns besides the text (label, rating, brand, text length) are read once and written to the shared folder as a
    narrow table, which most sections read; so are the top words per label. The word and duplicate sections read the texts
    themselves. ``cache=True`` persists the input once for these (the caller unpersists it); worth it only when the input is
    expensive to recompute and fits the cluster's storage.
    """
    ensure_columns(df, [c.text, c.label])
    base = with_text_length(df, c)
    if cache:
        base = base.persist()
    has_rating, has_brand = c.rating in df.columns, c.brand in df.columns
    narrow = written(base.select(c.label, c.length, *[x for x, has in ((c.rating, has_rating), (c.brand, has_brand)) if has]), "profile-columns")
    parts: list[DataFrame] = []

    def rows(section: str, d: DataFrame, label: Column | None, metrics: list[str]) -> None:
        lab = label if label is not None else F.lit(None).cast("string")
        arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        parts.append(d.select(F.lit(section).alias("section"), lab.alias("label"), F.inline(arr))
                     .select("section", "metric", "label", "value"))

    def pair(a: str, b: str) -> Column:
        return F.concat_ws(":", F.col(a).cast("string"), F.col(b).cast("string"))

    stat_metrics = ["count", "min", "max", "mean", "median", "std"]
    box_metrics = ["n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "outliers"]
    rows("shape", overview_shape(base, c), None, ["rows", "columns"])
    rows("label_summary", label_summary(narrow, c), F.col("label"), ["count"])
    rows("label_distribution", label_distribution(narrow, c), F.col("label"), ["count", "pct"])
    rows("class_distribution", class_distribution(narrow, c), F.col(c.label), ["count"])
    rows("sentiment_cards", sentiment_cards(narrow, c), None, ["positive", "negative", "neutral", "total"])
    rows("missing", missing_summary(base, c), F.col("column"), ["missing", "pct"])
    rows("duplicates_full_rows", duplicate_full_rows(base, c), None, ["duplicates", "pct"])
    rows("duplicates_text", duplicate_text_excess(base, c), None, ["duplicates", "pct"])
    rows("text_length", text_length_stats(narrow, c), F.col(c.label), stat_metrics)
    rows("text_length_box", text_length_box(narrow, c), F.col(c.label), box_metrics)
    if has_rating:
        rows("rating_outliers", rating_outliers(narrow, c), None, ["outliers", "pct", "rating_min", "rating_max"])
        rows("rating", rating_stats(narrow, c), F.col(c.label), stat_metrics)
        rows("rating_label_counts", rating_label_counts(narrow, c), pair(c.label, c.rating), ["count"])
        rows("rating_mean", rating_mean_by_label(narrow, c), F.col(c.label), ["mean_rating"])
        rows("rating_box", rating_box(narrow, c), F.col(c.label), box_metrics)
    tw = written(top_words_by_label(base, c, top_n), "profile-words")
    rows("top_words", tw, pair("label", "word"), ["count"])
    rows("top_words_chart", top_words_chart(tw), pair("label_slug", "word"), ["count"])
    rows("wordcloud", wordcloud_weights(tw), pair("label", "word"), ["weight"])
    rows("corpus_terms", corpus_term_weights(base, c), F.col("word"), ["count", "weight"])
    rows("duplicate_summary", duplicate_summary(base, c), None,
         ["total_rows", "unique_value_count", "duplicate_value_count", "duplicate_rows", "unique_rows"])
    rows("repeated_texts", duplicated_reviews(base, c), F.col("text"), ["count"])
    rows("duplicate_examples", duplicate_examples(base, c), F.col("text"), ["count"])
    rows("unique_vs_duplicate", unique_vs_duplicate(base, c), F.col("type"), ["count"])
    if has_brand:
        rows("brand_sentiment", brand_sentiment_counts(narrow, c), pair(c.label, c.brand), ["count"])
        rows("brand_grid", brand_sentiment_grid(narrow, c), pair("label", "brand"), ["count", "has_chart"])
        rows("brand_crosstab", brand_crosstab(narrow, c), pair("brand", "label"), ["count"])
        rows("brand_crosstab_pct", brand_crosstab_pct(narrow, c), pair("brand", "label"), ["pct"])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
