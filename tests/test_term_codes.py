"""Dictionary-coded terms: lookups, weights and vocabularies far larger than the report's 100 terms."""

import random
import time

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators import features as ft
from reviewlab.operators.features import TermCodes, TfidfModel, fit_vocabulary
from reviewlab.operators.naive_bayes import NaiveBayesModel


def test_codes_equal_a_dict(spark):
    terms = sorted({"", "a", "a b", "é", "日本 語", 'quote " and \\ back', "new\nline", "'", "😀", *[f"t{i}" for i in range(3000)]})
    codes = {t: i for i, t in enumerate(terms)}
    asked = [*terms, "missing", "A", "t3000", " a", None]
    df = spark.createDataFrame([(t,) for t in asked], "t string")
    got = df.select("t", TermCodes(terms).code(F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [codes.get(t) for t in asked]
    assert df.select(TermCodes([]).code(F.col("t")).alias("c")).where("c IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        TermCodes(range(ft.LOOKUP_TERMS + 1))


def documents(spark, words, rows=400, length=60, seed=2):
    rng = random.Random(seed)
    data = [(i, [words[min(int(rng.expovariate(3.0 / len(words))), len(words) - 1)] for _ in range(length)]) for i in range(rows)]
    return spark.createDataFrame([*data, (rows, []), (rows + 1, ["unknown"])], "id long, t array<string>")


def test_weights_by_lookup_and_by_join_agree(spark):
    docs = documents(spark, [f"w{i}" for i in range(200)])
    counts = docs.select(F.explode(F.array_distinct(tx.word_ngrams(F.col("t")))).alias("x")).groupBy("x").count().collect()
    terms = sorted(r.x for r in counts if r["count"] > 1 and r.x != "unknown")
    df_of = {r.x: r["count"] for r in counts}
    model = TfidfModel(tuple(terms), tuple(df_of[t] for t in terms), docs.count())
    by_row = {r.id: r.w for r in docs.select("id", model.weights_from_tokens(F.col("t")).alias("w")).collect()}
    by_join = {r.id: r.w for r in model.weights_by_join(docs, "id", "t", "w").collect()}
    assert by_row.keys() == by_join.keys() and by_row[401] == [] == by_join[401]
    for i, w in by_row.items():
        assert [(x.term, x.code) for x in w] == [(x.term, x.code) for x in by_join[i]]
        assert [x.weight for x in w] == pytest.approx([x.weight for x in by_join[i]])
        assert all(terms[x.code] == x.term for x in w) and [x.code for x in w] == sorted(x.code for x in w)


def test_vocabulary_is_the_same_by_lookup_by_join_and_unpruned(spark):
    docs = documents(spark, [f"w{i}" for i in range(15)], rows=150)
    want = ft._top(ft.term_doc_stats(docs, tx.word_ngrams(F.col("t"))), 40, 2).collect()
    for limit in (ft.LOOKUP_TERMS, 0):
        got = fit_vocabulary(docs, None, 40, 2, tokens="t", lookup_terms=limit)
        assert [(r.term, r.doc_freq, r.term_freq) for r in got] == [(r.term, r.doc_freq, r.term_freq) for r in want]
    assert any(" " in r.term for r in want)


def test_rare_bigrams_are_dropped_before_the_aggregate(spark):
    docs = documents(spark, [f"w{i}" for i in range(300)], rows=150)
    rows = docs.select(F.explode(ft._frequent_bigrams(F.col("t"), TermCodes(["w1", "w2", "w3"]))).alias("b")).distinct().collect()
    assert rows and all(set(r.b.split(" ")) <= {"w1", "w2", "w3"} for r in rows)


def test_a_row_costs_about_as_much_with_a_hundred_thousand_terms_as_with_a_hundred(spark):
    """Time per row, from the difference between few and many rows: the constant itself costs some seconds once a query."""
    small = [f"w{i:02d}" for i in range(100)]
    few = documents(spark, small, rows=2000).repartition(4).persist()
    many = few.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("again").persist()
    assert many.count() == 20 * few.count()
    per_row = {}
    for size in (100, 100_000):
        terms = tuple(sorted({*small, *[f"x{i}" for i in range(size - 100)]}))
        model = TfidfModel(terms, (2,) * len(terms), 3000)
        nb = NaiveBayesModel((0, 1), terms, tuple(tuple(-1.0 - (i + c) % 7 for i in range(len(terms))) for c in range(2)), (-0.5, -0.9))
        best = {}
        for name, docs in (("few", few), ("many", many), ("few", few), ("many", many)):
            start = time.time()
            docs.select("id", nb.predict(model.weights_from_tokens(F.col("t"))).alias("c")).write.format("noop").mode("overwrite").save()
            best[name] = min(best.get(name, 1e9), time.time() - start)
        per_row[size] = best["many"] - best["few"]
    few.unpersist()
    many.unpersist()
    assert per_row[100_000] < 2 * per_row[100], per_row
