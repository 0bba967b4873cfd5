"""Softmax boosting against a small numpy version on the same fixed bins."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.operators import softmax_boost as sb
from reviewlab.operators.features import TFIDF_TYPE

SCALE = sb.SCALE


def drawn(i, r, p):
    return p.subsample >= 1 or hashlib.md5(f"{i}:{p.seed}:{r}".encode()).hexdigest()[:8] < f"{int(p.subsample * 2 ** 32):08x}"


def fixed(x):
    return np.floor(np.abs(x) * SCALE + 0.5).astype(np.int64) * np.sign(x).astype(np.int64)


def soft(m):
    e = np.exp(m - m.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def numpy_fit(ids, y, bins, k, p):
    """[(trees of the round)], margins; trees are {node: (f, b) or value}. ``bins``: dense (rows, features) bins."""
    margins, rounds, losses = np.zeros((len(y), k)), [], []
    losses.append(-np.log(soft(margins)[np.arange(len(y)), y]).mean())
    for r in range(1, p.rounds + 1):
        prob = soft(margins)
        g, h = fixed(prob - np.eye(k)[y]), fixed(np.maximum(2 * prob * (1 - prob), 1e-16))
        used = np.array([drawn(i, r, p) for i in ids])
        trees = []
        for c in range(k):
            tree = {}

            def grow(node, rows, depth, c=c, tree=tree):
                G, H = int(g[rows, c].sum()), int(h[rows, c].sum())
                score = lambda a, b: (a / SCALE) * (a / SCALE) / (b / SCALE + p.reg_lambda)
                best = None
                if depth < p.max_depth and len(rows):
                    for f in range(bins.shape[1]):
                        col = bins[rows, f]
                        for b in sorted({0, *col.tolist()}) if col.any() else ():
                            left = rows[col <= b]
                            gl, hl = int(g[left, c].sum()), int(h[left, c].sum())
                            if min(hl, H - hl) < p.min_child * SCALE:
                                continue
                            gain = round(score(gl, hl) + score(G - gl, H - hl) - score(G, H), 9)
                            if gain > sb.LEAST_GAIN and (best is None or gain > best[0]):
                                best = (gain, f, b)
                if best is None:
                    tree[node] = -p.step * (G / SCALE) / (H / SCALE + p.reg_lambda)
                    return
                tree[node] = best[1:]
                col = bins[rows, best[1]]
                grow(2 * node + 1, rows[col <= best[2]], depth + 1)
                grow(2 * node + 2, rows[col > best[2]], depth + 1)
            grow(0, np.flatnonzero(used), 0)
            trees.append(tree)
        for c, tree in enumerate(trees):
            for i in range(len(y)):
                n = 0
                while isinstance(tree[n], tuple):
                    n = 2 * n + 1 + int(bins[i, tree[n][0]] > tree[n][1])
                margins[i, c] += tree[n]
        rounds.append(trees)
        losses.append(-np.log(soft(margins)[np.arange(len(y)), y]).mean())
    return rounds, margins, losses


def sample(spark, n=240, v=9, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.randrange(3)
        codes = sorted({c for c in range(v) if rng.random() < (0.7 if c % 3 == y else 0.2)})
        w = [rng.choice([0.1, 0.25, 0.4, 0.7, 1.0]) for _ in codes]
        norm = math.sqrt(sum(x * x for x in w)) or 1.0
        rows.append((i, [10, 20, 30][y], [(f"t{c}", x / norm, c) for c, x in zip(codes, w)]))
    return rows, spark.createDataFrame(rows, f"id long, label long, w {TFIDF_TYPE}")


@pytest.mark.parametrize("p, local", [(sb.BoostParams(step=0.3, rounds=2, max_depth=3, bins=16), 0),
                                      (sb.BoostParams(step=0.3, rounds=4, max_depth=5, bins=16), sb.LOCAL_ENTRIES),
                                      (sb.BoostParams(step=0.3, rounds=2, max_depth=4, bins=8, subsample=1.0, min_child=2.0), sb.LOCAL_ENTRIES)])
def test_equals_numpy_on_fixed_bins(spark, p, local):
    rows, df = sample(spark)
    model = sb.fit_softmax_boost(df, "id", "label", "w", p, local_entries=local)
    bins = np.zeros((len(rows), 9), int)
    for i, _, w in rows:
        for _, x, c in w:
            bins[i, c] = max(1, min(p.bins, math.ceil(round(x * p.bins, 9))))
    y = np.array([[10, 20, 30].index(r[1]) for r in rows])
    rounds, margins, losses = numpy_fit([r[0] for r in rows], y, bins, 3, p)
    assert model.classes == (10, 20, 30)
    splits = 0
    for got, want in zip(model.trees, rounds):
        for nodes, tree in zip(got, want):
            for n, e in tree.items():
                if isinstance(e, tuple):
                    assert (nodes[n]["f"], nodes[n]["b"]) == e
                    splits += 1
                else:
                    assert nodes[n]["f"] is None and nodes[n]["v"] == pytest.approx(e, abs=1e-12)
    assert splits > 10
    assert np.allclose(model.training_loss, losses, atol=1e-9) and losses[-1] < losses[0]
    scored = df.select("id", model.margins(F.col("w")).alias("m"), model.probabilities(F.col("w")).alias("p"),
                       model.predict(F.col("w")).alias("c")).orderBy("id").collect()
    assert np.allclose([r.m for r in scored], margins, atol=1e-9)
    assert np.allclose([r.p for r in scored], soft(margins), atol=1e-9)
    assert [r.c for r in scored] == [(10, 20, 30)[int(j)] for j in np.round(margins, 9).argmax(1)]
    assert np.mean([r.c == x[1] for r, x in zip(scored, rows)]) > 0.7
    again = sb.SoftmaxBoostModel.from_json(model.to_json())
    assert again.to_frame(spark).orderBy("round", "label_id", "node").collect() == \
        model.to_frame(spark).orderBy("round", "label_id", "node").collect()


def test_odd_rows(spark):
    """Rows without terms, null labels, one class only, no rows at all."""
    p = sb.BoostParams(rounds=1, max_depth=2, subsample=1.0)
    df = spark.createDataFrame([(1, 5, []), (2, 5, [("a", 1.0, 0)]), (3, None, [("a", 1.0, 0)])], f"id long, label long, w {TFIDF_TYPE}")
    model = sb.fit_softmax_boost(df, "id", "label", "w", p)
    assert model.classes == (5,) and model.training_loss == (0.0, 0.0)
    assert [r[0] for r in df.select(model.predict(F.col("w"))).collect()] == [5, 5, 5]
    with pytest.raises(ValueError):
        sb.fit_softmax_boost(df.limit(0), "id", "label", "w", p)


def test_saved_classifier_scores_alike(spark):
    from reviewlab.operators.features import LabelIndex, TfidfModel
    from reviewlab.plans.training import BoostedTextClassifier
    from reviewlab.session import scratch_path
    from reviewlab.sources.sinks import load_text_classifier, save_text_classifier
    rows = [(i, i % 2, ("good phone" if i % 2 else "bad screen") + " today" * (i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label long, text string")
    terms = ("bad", "good", "phone", "screen", "today")
    tfidf = TfidfModel(terms, (30, 30, 30, 30, 40), 60)
    feats = df.withColumn("w", tfidf.weights(F.col("text")))
    model = sb.fit_softmax_boost(feats, "id", "label", "w", sb.BoostParams(step=0.3, rounds=2, max_depth=2, subsample=1.0))
    clf = BoostedTextClassifier(tfidf, model, LabelIndex(("Negative", "Positive")), clean=False)
    path = scratch_path(spark, "boosted")
    save_text_classifier(clf, path)
    back = load_text_classifier(spark, path)
    assert type(back) is BoostedTextClassifier and back.boosted == model and back.tfidf.terms == terms and back.clean is False
    got = back.predict_proba(df, "text").orderBy("id").collect()
    assert [(r.prediction, r.probability) for r in got] == \
        [(r.prediction, r.probability) for r in clf.predict_proba(df, "text").orderBy("id").collect()]
    assert all((r.prediction == "Positive") == (r.id % 2 == 1) and sum(r.probability.values()) == pytest.approx(1.0) for r in got)
    assert [r.prediction for r in back.predict(df, "text").orderBy("id").collect()] == [r.prediction for r in got]
