"""Hand-made frames for the null, duplicate, statistics, text, tie and label rules."""

import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators import evaluate as ev
from reviewlab.operators import profile as pf
from reviewlab.operators.features import LabelIndex
from reviewlab.schema import DEFAULT as C
from reviewlab.schema import ensure_columns, ensure_not_empty

SCHEMA = "review_id bigint, review_text string, sentiment string, brand string, rating string"


@pytest.fixture(scope="module")
def nulls(spark):
    rows = [(1, "good phone", "Positive", "A", "5"),
            (2, None, "Negative", "A", "1"),
            (3, "meh", None, "B", "3"),
            (4, "bad", "Negative", None, "nan"),
            (5, None, None, None, None),
            (6, "great", " POSITIVE ", "B", "9")]
    return spark.createDataFrame(rows, SCHEMA)


def test_label_summary_keeps_null_class(nulls):
    got = {r["label"]: r["count"] for r in pf.label_summary(nulls).collect()}
    assert got == {"Positive": 1, "Negative": 2, "nan": 2, " POSITIVE ": 1}


def test_missing_summary(nulls):
    got = {r["column"]: (r["missing"], r["pct"]) for r in pf.missing_summary(nulls).collect()}
    assert got == {"review_text": (2, 33.33), "sentiment": (2, 33.33)}


def test_null_text_has_length_zero(nulls):
    got = dict(pf.with_text_length(nulls).select("review_id", "text_length_chars").collect())
    assert got[2] == 0 and got[5] == 0 and got[1] == len("good phone")


def test_per_label_stats_drop_null_labels(nulls):
    s = pf.text_length_stats(nulls).collect()
    labels = {r["sentiment"] for r in s if r["scope"] == "group"}
    assert None not in labels
    glob = [r for r in s if r["scope"] == "global"][0]
    assert glob["count"] == 6


def test_nan_and_unparseable_ratings_dropped(nulls):
    got = sorted(r["rating"] for r in pf.numeric_ratings(nulls).collect())
    assert got == [1.0, 3.0, 5.0, 9.0]
    out = pf.rating_outliers(nulls).first()
    assert out["outliers"] == 1 and out["rating_max"] == 9.0


def test_brand_counts_drop_nulls(nulls):
    got = {(r["sentiment"], r["brand"]): r["count"] for r in pf.brand_sentiment_counts(nulls).collect()}
    assert got == {("Positive", "A"): 1, ("Negative", "A"): 1, (" POSITIVE ", "B"): 1}


def test_sentiment_cards_are_case_and_space_insensitive(nulls):
    r = pf.sentiment_cards(nulls).first()
    assert (r["positive"], r["negative"], r["neutral"]) == (2, 2, 0)


@pytest.fixture(scope="module")
def dups(spark):
    rows = [(1, "a", "Positive", "X", "5"), (2, "a", "Positive", "X", "5"),
            (3, "b", "Negative", "X", "1"), (4, "b", "Negative", "Y", "1"), (5, "b", "Neutral", "Y", "2"),
            (6, None, "Neutral", "Y", "2"), (7, None, "Neutral", "Y", "2"), (8, "c", "Positive", "X", "4")]
    return spark.createDataFrame(rows, SCHEMA)


def test_duplicate_profile(dups):
    s = pf.duplicate_summary(dups).first()
    # values: a x2, b x3, nan x2, c x1
    assert (s["total_rows"], s["unique_value_count"], s["duplicate_value_count"], s["duplicate_rows"],
            s["unique_rows"]) == (8, 4, 3, 7, 1)
    assert {r["text"]: r["count"] for r in pf.duplicated_reviews(dups).collect()} == {"a": 2, "b": 3, "nan": 2}
    ex = [r["text"] for r in pf.duplicate_examples(dups, n=2).collect()]
    assert ex == ["b", "a"]


def test_full_row_duplicates_treat_nulls_equal(dups):
    assert pf.duplicate_full_rows(dups).first()["duplicates"] == 2      # (a..) twin and the null-text twin
    assert pf.duplicate_text_excess(dups).first()["duplicates"] == 4    # a:1 + b:2 + null:1


def test_dedupe_keeps_first_in_file_order(dups):
    d = pf.dedupe_keep_first(pf.drop_missing(dups), key="review_text", order="review_id")
    assert sorted(r["review_id"] for r in d.collect()) == [1, 3, 8]


def test_numeric_stats_edge_groups(spark):
    df = spark.createDataFrame([("one", 5.0), ("nul", None), ("two", 1.0), ("two", 3.0)], "g string, v double")
    from reviewlab.operators.stats import global_and_grouped_stats
    rows = {r["g"]: r for r in global_and_grouped_stats(df, "v", "g").collect() if r["scope"] == "group"}
    assert rows["one"]["count"] == 1 and rows["one"]["std"] is None and rows["one"]["median"] == 5.0
    assert rows["nul"]["count"] == 0 and rows["nul"]["mean"] is None
    assert rows["two"]["median"] == 2.0 and math.isclose(rows["two"]["std"], math.sqrt(2))
    # no input rows -> no summary rows (reports refuse empty input before this point)
    assert global_and_grouped_stats(df.filter("false"), "v", "g").collect() == []


TEXTS = ["", "!!! ...", "phone.", "don't stop", "แบตอึดมาก", "Café crème", "so 😀 good", "line\nbreak\tand\ttabs  ",
         "ﬁne Ǆ", "Ünïcödé TEST 42 x_y"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")


def _py_clean(s, stop):
    return " ".join(w for w in s.lower().split() if w.isalpha() and w not in stop)


def _py_strip(s):
    n = unicodedata.normalize("NFKD", s)
    return "".join(c for c in n if not unicodedata.combining(c))


def test_text_functions_match_python(texts):
    stop = set(tx.ENGLISH_STOPWORDS)
    rows = texts.select("i", tx.clean_text(F.col("t")).alias("c"), tx.tokenize(F.col("t")).alias("k"),
                        tx.normalize_space(F.col("t")).alias("n"), tx.strip_accents(F.col("t")).alias("s"),
                        tx.vectorizer_tokens(F.col("t")).alias("v"), tx.text_length(F.col("t")).alias("l")).collect()
    for r in sorted(rows, key=lambda r: r["i"]):
        s = TEXTS[r["i"]]
        assert r["c"] == _py_clean(s, stop), s
        assert r["k"] == [w for w in re.findall(r"[a-zA-Z0-9']+", s.lower()) if w not in stop], s
        assert r["n"] == " ".join(s.replace("\n", " ").replace("\r", " ").lower().split()), s
        assert r["s"] == _py_strip(s), s
        assert r["v"] == re.findall(r"(?u)\b\w\w+\b", _py_strip(s.lower())), s
        assert r["l"] == len(s), s
    assert rows[2]["c"] == ""          # "phone." is dropped entirely by the training clean


def test_ngrams_and_term_counts(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b"],), (["x"],), ([],)], "t array<string>")
    got = df.select(tx.word_ngrams(F.col("t")).alias("g"), tx.term_counts(tx.word_ngrams(F.col("t"))).alias("c")).collect()
    assert got[0]["g"] == ["a", "b", "a", "b", "a b", "b a", "a b"]
    assert [(x["term"], x["tf"]) for x in got[0]["c"]] == [("a", 2), ("a b", 2), ("b", 2), ("b a", 1)]
    assert got[1]["g"] == ["x"] and got[2]["g"] == [] and got[2]["c"] == []


def test_top_words_ties_by_word(spark):
    df = spark.createDataFrame([(1, "zeta alpha", "P", None, None), (2, "alpha beta", "P", None, None)], SCHEMA)
    got = [(r["rank"], r["word"], r["count"]) for r in pf.top_words_by_label(df, top_n=2).collect()]
    assert sorted(got) == [(1, "alpha", 2), (2, "beta", 1)]


def test_label_decode_keeps_unmapped_ids(spark):
    li = LabelIndex(("Negative", "Neutral", "Positive"))
    df = spark.createDataFrame([(0,), (2,), (7,)], "p bigint")
    assert [r[0] for r in df.select(li.decode(F.col("p"))).collect()] == ["Negative", "Positive", "7"]
    enc = spark.createDataFrame([("Neutral",), ("Other",)], "l string").select(li.encode(F.col("l"))).collect()
    assert [r[0] for r in enc] == [1, None]


def test_metrics_with_class_absent_from_predictions(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a"), ("c", "c")], "y_true string, y_pred string")
    m = ev.eval_metrics(df).first()
    # per class: a p=2/3 r=1 f1=.8 ; b p=0 r=0 f1=0 ; c p=1 r=1 f1=1
    assert math.isclose(m["accuracy"], 0.75)
    assert math.isclose(m["macro_f1"], (0.8 + 0 + 1) / 3)
    assert math.isclose(m["macro_precision"], (2 / 3 + 0 + 1) / 3)
    assert math.isclose(m["weighted_f1"], (0.8 * 2 + 0 + 1) / 4)
    assert math.isclose(m["micro_f1"], 0.75)
    cm = {(r["y_true"], r["y_pred"]): r["count"] for r in ev.confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[("b", "a")] == 1 and cm[("b", "b")] == 0


def test_guards(spark, nulls):
    with pytest.raises(ValueError, match="missing"):
        ensure_columns(nulls, ["review_text", "nope"])
    with pytest.raises(ValueError, match="empty"):
        ensure_not_empty(nulls.filter("false"))
    r = pf.rating_available(nulls.drop("rating")).first()
    assert r["rating_available"] is False


def test_label_distribution_over_present_classes(nulls):
    got = {r["label"]: (r["count"], r["pct"]) for r in pf.label_distribution(nulls).collect()}
    assert got == {"Negative": (2, 33.33), "nan": (2, 33.33), "Positive": (1, 16.67), " POSITIVE ": (1, 16.67)}
    fixed = [(r["label"], r["count"]) for r in pf.label_distribution(nulls, classes=pf.SENTIMENT_ORDER).orderBy("position").collect()]
    assert fixed == [("Positive", 1), ("Neutral", 0), ("Negative", 2), ("nan", 2), (" POSITIVE ", 1)]


def test_full_profile_without_optional_columns(nulls):
    sections = lambda d: {r["section"] for r in pf.full_profile(d).select("section").distinct().collect()}
    whole = sections(nulls)
    assert sections(nulls.drop(C.rating)) == whole - {"rating", "rating_outliers", "rating_label_counts", "rating_mean", "rating_box"}
    assert sections(nulls.drop(C.brand)) == whole - {"brand_sentiment", "brand_grid", "brand_crosstab", "brand_crosstab_pct"}
