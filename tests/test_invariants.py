"""Invariants of the model and skew-handling operators, checked against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from review_paths import MEDIUM, SMALL
from reviewlab.operators import registry as rg
from reviewlab.operators.features import fit_vocabulary, stratified_split, vocabulary_frame
from reviewlab.operators.stats import top_k_per_group
from reviewlab.plans import model_queries as mq
from reviewlab.plans.training import FEATURES
from reviewlab.schema import DEFAULT as C


def test_top_k_exact_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", f"w{rnd.randint(0, 400)}", rnd.randint(0, 30)) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, w string, n int")
    got = top_k_per_group(df, ["g"], [F.desc("n"), F.asc("w")], 5, salt_key=F.col("w"), salt_buckets=16)
    brute = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), F.asc("w"))))
    brute = brute.filter("r <= 5")
    assert sorted(map(tuple, got.select("g", "w", "n", "rank").collect())) == \
        sorted(map(tuple, brute.select("g", "w", "n", "r").collect()))


def test_top_k_salted_path_above_group_limit(spark):
    rnd = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", f"w{rnd.randint(0, 300)}", rnd.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, w string, n int")
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")   # force the salted two-stage rank
    try:
        got = top_k_per_group(df, ["g"], [F.desc("n"), F.asc("w")], 6, salt_key=F.col("w"), salt_buckets=8)
        got = sorted(map(tuple, got.select("g", "w", "n", "rank").collect()))
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
    brute = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), F.asc("w"))))
    assert got == sorted(map(tuple, brute.filter("r <= 6").select("g", "w", "n", "r").collect()))


def test_stratified_split_equals_ranked_window(spark):
    ids = spark.range(3000).select(F.col("id").alias("review_id"),
                                   F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("label"))
    got = stratified_split(ids, "review_id", "label", bucket_hex=2)
    h = F.md5(F.concat(F.col("review_id").cast("string"), F.lit(":42")))
    w = Window.partitionBy("label").orderBy(h, "review_id")
    n = F.count(F.lit(1)).over(Window.partitionBy("label"))
    brute = ids.withColumn("split", F.when(F.row_number().over(w) <= F.round(0.2 * n), "val").otherwise("train"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, brute.collect()))
    per = Counter((r["label"], r["split"]) for r in got.collect())
    assert per[("hot", "val")] == round(0.2 * 1000)


def test_pruned_vocabulary_equals_plain(spark):
    p = mq._prepared(spark, MEDIUM)
    plain = vocabulary_frame(p.train(), C.text).collect()
    pruned = fit_vocabulary(p.train(), C.text, id_col=C.id)
    unpruned = fit_vocabulary(p.train(), C.text)
    assert sorted(map(tuple, plain)) == sorted(map(tuple, pruned)) == sorted(map(tuple, unpruned))


def test_tfidf_and_nb_against_numpy(spark):
    import re
    import unicodedata
    clf = mq._classifier(spark, SMALL)
    p = mq._prepared(spark, SMALL)
    rows = p.frame.select(C.id, C.text, "label_id", "split").collect()

    def terms(s):
        s = unicodedata.normalize("NFKD", s.lower())
        s = "".join(c for c in s if not unicodedata.combining(c))
        t = re.findall(r"(?u)\b\w\w+\b", s)
        return t + [a + " " + b for a, b in zip(t, t[1:])]

    vocab = list(clf.tfidf.terms)
    index = {t: j for j, t in enumerate(vocab)}
    train = [r for r in rows if r["split"] == "train"]
    X = np.zeros((len(rows), len(vocab)))
    for i, r in enumerate(rows):
        for t, c in Counter(terms(r[C.text])).items():
            if t in index:
                X[i, index[t]] = c
    tr = np.array([r["split"] == "train" for r in rows])
    df = (X[tr] > 0).sum(axis=0)
    n = tr.sum()
    idf = np.log((1 + n) / (1 + df)) + 1
    W = X * idf
    norms = np.sqrt((W ** 2).sum(axis=1))
    W = np.divide(W, norms[:, None], out=np.zeros_like(W), where=norms[:, None] > 0)
    # the vocabulary itself: df >= 2 and the top terms by total count
    assert (df >= 2).all()
    assert np.allclose(idf, np.array(clf.tfidf.idf))
    y = np.array([r["label_id"] for r in rows])
    classes = sorted(set(y[tr]))
    fc = np.array([W[tr][y[tr] == c].sum(axis=0) for c in classes]) + 4.0
    flp = np.log(fc) - np.log(fc.sum(axis=1, keepdims=True))
    prior = np.log(np.array([(y[tr] == c).sum() for c in classes])) - math.log(n)
    assert np.allclose(flp, np.array(clf.nb.log_prob))
    assert np.allclose(prior, np.array(clf.nb.log_prior))
    jll = np.round(W @ flp.T + prior, 9)
    expect = {r[C.id]: classes[int(np.argmax(jll[i]))] for i, r in enumerate(rows)}
    got = clf.predict(p.frame, C.text, already_clean=True).select(C.id, "pred_id").collect()
    assert {r[0]: r[1] for r in got} == expect
    wrows = clf.features(p.frame, C.text, already_clean=True).select(C.id, F.inline(FEATURES)).collect()
    pos = {r[C.id]: i for i, r in enumerate(rows)}
    for r in wrows:
        assert math.isclose(r["weight"], W[pos[r[C.id]], index[r["term"]]], rel_tol=1e-9)


def test_probabilities_sum_to_one_and_labels_known(spark):
    df = mq.predict_proba(spark, SMALL)
    sums = df.groupBy(C.id).agg(F.sum("probability").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-5 for r in sums)
    labels = set(mq._prepared(spark, SMALL).labels.labels)
    assert {r["label"] for r in df.collect()} <= labels
    bp = mq.batch_predict(spark, SMALL)
    assert bp.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert {r["prediction"] for r in bp.collect()} <= labels


def test_same_result_with_one_or_many_shuffle_partitions(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out[parts] = {k: sorted(map(tuple, q[k](spark, SMALL).collect()))
                      for k in ("top_words_by_label", "dedupe_keep_first", "stratified_split", "drift_share")}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out["1"] == out["8"]


def test_registry_cases(spark):
    runs = spark.createDataFrame(
        [("r1", 1, "NB", 0.5), ("r2", 2, "RF", 0.7), ("r3", 3, "XGB", 0.7), ("r4", 4, "NB", None)],
        "run_id string, start_seq bigint, model_name string, macro_f1 double")
    versions = spark.createDataFrame([("m", 1, "r1"), ("m", 2, "r2")], "name string, version bigint, run_id string")
    no_alias = spark.createDataFrame([], "name string, alias string, version bigint")
    # tie on score: newest run (r3) wins, but it has no registered version
    assert rg.best_run(runs).first()["run_id"] == "r3"
    plan = rg.promotion_plan(runs, versions, no_alias).first()
    assert plan["promoted"] is False and plan["reason"] == "no registered version for best run"
    runs2 = runs.filter("run_id != 'r3'")
    plan = rg.promotion_plan(runs2, versions, no_alias).first()
    assert plan["promoted"] and plan["version"] == 2 and plan["demoted_version"] is None
    on_best = spark.createDataFrame([("m", "Production", 2)], "name string, alias string, version bigint")
    plan = rg.promotion_plan(runs2, versions, on_best).first()
    assert plan["promoted"] is False and plan["reason"] == "already at alias"
    old = spark.createDataFrame([("m", "Production", 1)], "name string, alias string, version bigint")
    p = rg.promotion_plan(runs2, versions, old)
    assert p.first()["demoted_version"] == 1
    new_aliases = {(r["alias"], r["version"]) for r in rg.apply_promotion(old, p).collect()}
    assert new_aliases == {("Production", 2), ("Staging", 1)}
    # within a retrain batch a run without the metric counts as 0 and can still win
    only_missing = runs.filter("run_id = 'r4'")
    assert rg.best_run(only_missing).count() == 0
    assert rg.best_run(only_missing, missing=0.0).first()["run_id"] == "r4"


def test_svd_projection_matches_numpy(spark):
    from reviewlab.operators.svd import fit_projection
    clf = mq._classifier(spark, SMALL)
    f = clf.features(mq._prepared(spark, SMALL).frame, C.text, already_clean=True)
    X = np.array([r[0] for r in f.select(clf.tfidf.dense(F.col(FEATURES))).collect()])
    _, sv, vt = np.linalg.svd(X, full_matrices=False)
    p = fit_projection(f, clf.tfidf, FEATURES)
    assert np.allclose(p.singular, sv[:2], rtol=1e-9)
    v = np.array(p.v)
    for k in range(2):
        assert abs(abs(float(v[:, k] @ vt[k])) - 1.0) < 1e-6
    xs = f.select(p.apply(F.col(FEATURES))[0].alias("x")).toPandas()["x"]
    assert abs(xs.mean()) < 1e-9 and abs(xs.std(ddof=0) - 1.0) < 1e-9


def test_confusion_matrix_many_labels_and_given_list(spark):
    from reviewlab.operators import evaluate as ev
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a")], "y_true string, y_pred string")
    assert ev.confusion_matrix(df).count() == 9
    got = {(r["y_true"], r["y_pred"]): r["count"] for r in ev.confusion_matrix(df, labels=["a", "z"]).collect()}
    assert got == {("a", "a"): 1, ("a", "z"): 0, ("z", "a"): 0, ("z", "z"): 0}
    many = spark.range(3000).select(F.concat(F.lit("l"), F.col("id") % 300).alias("y_true"), F.concat(F.lit("l"), F.col("id") % 7).alias("y_pred"))
    m = ev.confusion_matrix(many)
    assert m.count() == 300 * 300 and m.agg(F.sum("count")).first()[0] == 3000


def test_drift_of_a_side_without_values(spark):
    from reviewlab.operators import drift as dr
    df = spark.createDataFrame([("reference", "1.5", "x"), ("reference", "n/a", "y"), ("current", None, None)], "side string, v string, k string")
    n, k = dr.numeric_drift(df, "side", ["v"]).first(), dr.categorical_drift(df, "side", ["k"]).first()
    assert (n["n_ref"], n["n_cur"], n["ks"], n["wasserstein"], n["drifted"]) == (1, 0, None, None, False)
    assert (k["n_ref"], k["n_cur"], k["js_distance"], k["drifted"]) == (2, 0, None, False)
