"""Dataset drift over target, prediction, text and TF-IDF columns: each kind alone is seen, and only it."""

import random

import pytest

from reviewlab.operators import drift as dr
from reviewlab.operators.features import TFIDF_TYPE

TERMS = ("alpha", "beta", "gamma")


def frame(spark, change):
    rng = random.Random(8)
    rows = []
    for i in range(800):
        side = "train" if i % 2 else "val"
        odd = side == "val"
        label = "Negative" if change == "label" and odd else rng.choice(["Positive", "Negative"])
        pred = "Negative" if change == "prediction" and odd else rng.choice(["Positive", "Negative"])
        words = [rng.choice(["good", "bad", "phone", "screen"]) for _ in range(12)]
        text = " ".join(words + (["refund", "broken"] if change == "text" and odd else []))
        codes = [2] if change == "tfidf" and odd else sorted(rng.sample(range(2), rng.choice([1, 2])))
        rows.append((i, side, label, pred, text, [(TERMS[c], 1.0 / len(codes) ** 0.5, c) for c in codes]))
    return spark.createDataFrame(rows, f"id long, split string, label string, prediction string, text string, w {TFIDF_TYPE}")


@pytest.mark.parametrize("change, drifted", [(None, set()), ("label", {"label"}), ("prediction", {"prediction"}), ("text", {"text"}),
                                             ("tfidf", {"tfidf:alpha", "tfidf:beta", "tfidf:gamma"})])
def test_each_kind_of_column_drifts_alone(spark, change, drifted):
    columns = dr.drift_table(frame(spark, change), "split", categorical=["label", "prediction"], text=["text"], id_col="id",
                             features="w", terms=TERMS, reference="train", current="val")
    got = {r["column"]: r["drifted"] for r in columns.collect()}
    assert set(got) == {"label", "prediction", "text", "tfidf:alpha", "tfidf:beta", "tfidf:gamma"}
    assert {c for c, d in got.items() if d} == drifted
