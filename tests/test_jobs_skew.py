"""End-to-end jobs on the smallest tables, and operators under a hot key."""

from pyspark.sql import functions as F

from review_paths import SMALL
from reviewlab.operators import profile as pf
from reviewlab.plans import jobs
from reviewlab.schema import DEFAULT as C
from reviewlab.session import scratch_path
from reviewlab.sources import sinks
from reviewlab.sources import tables as tb


def test_daily_profile_and_training(spark):
    reviews = tb.reviews(spark, SMALL)
    path = jobs.daily_profile(reviews, scratch_path(spark, "reports"))
    assert spark.read.json(path).count() > 0
    root = scratch_path(spark, "registry")
    registry, plan = jobs.daily_training(reviews, root, models=("nb", "rf"))
    runs = {r["model_name"]: r for r in registry.runs().collect()}
    assert set(runs) == {"NaiveBayes", "RandomForest"}
    best = max(runs.values(), key=lambda r: (r["macro_f1"], r["start_seq"]))
    row = plan.first()
    assert (row["promoted"], row["best_run_id"], row["version"]) == (True, best["run_id"], 1)
    assert registry.classifier() is not None and 0 < len(registry.classifier().tfidf.terms) <= 100
    # a second day: new versions; the alias moves only to a better or newer best run
    registry, plan = jobs.daily_training(reviews, root, models=("nb",))
    assert sorted(r["version"] for r in registry.versions().filter("name = 'NaiveBayes'").collect()) == [1, 2]
    assert registry.aliases().filter("alias = 'Production'").count() >= 1


def test_retrain_check(spark):
    d = tb.drift_frame(spark, SMALL)
    ref = d.filter("side = 'reference'").drop("side")
    cur = d.filter("side = 'current'").drop("side")
    row = jobs.retrain_check(ref, cur, tb.aliases(spark, SMALL), ["n_chars"], ["lang"]).first()
    assert row["has_production"] is True and row["decision"] in ("train", "stop")
    # identical samples never drift
    same = jobs.retrain_check(ref, ref, tb.aliases(spark, SMALL), ["n_chars"], ["lang"]).first()
    assert same["drift_share"] == 0.0 and same["decision"] == "stop"


def test_retrain_check_sees_drift_of_texts_labels_and_features(spark):
    """Equal lengths and languages on both sides; texts, labels and TF-IDF weights differ, each alone enough."""
    def side(word, label, weight, start):
        rows = [(start + i, f"{word} w{i % 7} end", 11, "en", label if i % 3 else "mid", [(f"t{i % 3}", weight)]) for i in range(400)]
        return spark.createDataFrame(rows, "review_id long, review_text string, n_chars int, lang string, label string, "
                                           "tfidf array<struct<term:string,weight:double>>")
    ref = side("good", "pos", 0.5, 0)
    aliases = spark.createDataFrame([("m", "Production", 1)], "name string, alias string, version long")
    plain, terms = (["n_chars"], ["lang"]), ["t0", "t1", "t2"]
    text = {"text": ["review_text"], "id_col": "review_id"}
    for cur, kw, categorical in ((side("fine", "pos", 0.5, 1000), text, ["lang"]), (side("good", "neg", 0.5, 1000), {}, ["lang", "label"]),
                                 (side("good", "pos", 0.9, 1000), {"features": "tfidf", "terms": terms}, ["lang"])):
        assert jobs.retrain_check(ref, cur, aliases, *plain).first()["decision"] == "stop"
        assert jobs.retrain_check(ref, cur, aliases, plain[0], categorical, **kw).first()["decision"] == "train"
    same = jobs.retrain_check(ref, side("good", "pos", 0.5, 1000), aliases, plain[0], ["lang", "label"], features="tfidf", terms=terms, **text).first()
    assert (same["drift_share"], same["decision"]) == (0.0, "stop")


def test_gate_reads_the_production_runs_own_share(spark):
    from reviewlab.plans import experiment as ex
    from reviewlab.plans.training import prepare
    registry = ex.record_runs(prepare(tb.reviews(spark, SMALL)), scratch_path(spark, "registry"), models=("nb",))
    assert jobs.production_check(registry).first()["reason"] == "no production model"
    registry.promote()
    run, gate = registry.runs().first(), jobs.production_check(registry).first()
    columns = len(registry.classifier().tfidf.terms) + 3                      # text, target, prediction
    drifted = run["drift_share"] * columns
    assert abs(drifted - round(drifted)) < 1e-6 and gate["drift_share"] == run["drift_share"]
    assert gate["decision"] == ("train" if run["drift_share"] > 0.3 else "stop")
    for share, decision in ((0.9, "train"), (0.3, "stop"), (None, "stop")):
        other = ex.Registry(spark, scratch_path(spark, "registry"))
        other._append("runs", registry.runs().drop("drift_share").withColumn("drift_share", F.lit(share).cast("double")))
        other._append("model_versions", registry.versions())
        other._append("aliases", registry._read("aliases", ex.ALIAS_SCHEMA))
        assert jobs.production_check(other).first()["decision"] == decision


def test_drift_of_the_features_is_counted_once_for_all_candidates(spark, monkeypatch):
    from reviewlab.plans import experiment as ex
    from reviewlab.plans.training import prepare
    plans, share = [], ex.dr.drift_share
    monkeypatch.setattr(ex.dr, "drift_share", lambda d: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or share(d))
    words = ["good", "bad", "fine", "poor", "film", "plot"]
    rows = [(i, f"{words[i % 6]} {words[i * 5 % 6]} review {words[i // 7 % 6]} n{i}", "pos" if i % 6 in (0, 2) else "neg") for i in range(120)]
    ex.record_runs(prepare(spark.createDataFrame(rows, f"{C.id} long, {C.text} string, {C.label} string")),
                   scratch_path(spark, "registry"), models=("nb", "rf"))
    assert len(plans) == 2 and not any("tfidf:" in p for p in plans)         # the union with a cached table counted it again


def test_dedupe_and_duplicates_with_a_hot_text(spark):
    n = 30000
    df = spark.range(n).select(
        F.col("id").alias(C.id),
        F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias(C.text),
        F.when(F.col("id") % 2 == 0, "Positive").otherwise("Negative").alias(C.label))
    d = pf.dedupe_keep_first(df, key=C.text, order=C.id)
    hot = d.filter(F.col(C.text) == "same text").collect()
    assert len(hot) == 1 and hot[0][C.id] == 0 and hot[0][C.label] == "Positive"
    assert d.count() == n - n // 3 + 1
    s = pf.duplicate_summary(df).first()
    assert s["duplicate_rows"] == n // 3 and s["duplicate_value_count"] == 1


def test_full_profile_same_with_or_without_cache(spark):
    r = tb.reviews(spark, SMALL)
    a = sorted(map(tuple, pf.full_profile(r, cache=True).collect()), key=str)
    b = sorted(map(tuple, pf.full_profile(r, cache=False).collect()), key=str)
    assert a == b
