"""Numeric drift in value blocks equals a direct computation, whatever the block count."""

import math

import numpy as np
import pytest

from reviewlab.operators import drift as dr


def _direct(ref, cur):
    ref, cur = np.sort(np.asarray(ref, float)), np.sort(np.asarray(cur, float))
    vals = np.unique(np.concatenate([ref, cur]))
    fr = np.searchsorted(ref, vals, side="right") / len(ref)
    fc = np.searchsorted(cur, vals, side="right") / len(cur)
    gap = np.abs(fr - fc)
    w = float(np.sum(gap[:-1] * np.diff(vals)))
    return float(gap.max()), w, float(ref.std())


@pytest.mark.parametrize("blocks", [1, 2, 3, 7, 1024])
def test_blocks_match_direct(spark, blocks):
    rng = np.random.default_rng(7)
    ref = list(rng.integers(0, 40, 300)) + [5] * 200          # a hot value on one side
    cur = list(rng.integers(10, 60, 250)) + [5] * 20 + [None]
    rows = [("reference", float(v), float(v) * 0.5) for v in ref] + \
           [("current", None if v is None else float(v), 3.0) for v in cur]
    df = spark.createDataFrame(rows, "side string, x double, y double")
    got = {r["column"]: r for r in dr.numeric_drift(df, "side", ["x", "y"], blocks=blocks).collect()}
    cur_x = [v for v in cur if v is not None]
    for col, (a, b) in {"x": (ref, cur_x), "y": ([v * 0.5 for v in ref], [3.0] * len(cur))}.items():
        ks, w, std = _direct(a, b)
        r = got[col]
        assert r["n_ref"] == len(a) and r["n_cur"] == len(b)
        assert math.isclose(r["ks"], ks, abs_tol=1e-9)
        assert math.isclose(r["wasserstein"], w, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["wasserstein_norm"], w / max(std, dr.STD_FLOOR), rel_tol=1e-9)


def test_block_search(spark):
    from pyspark.sql import functions as F
    cuts = [1.0, 2.0, 4.0, 8.0, 16.0]
    vals = [-1.0, 1.0, 1.5, 2.0, 3.9, 4.0, 15.9, 16.0, 99.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    arr = F.array(*[F.lit(c) for c in cuts])
    got = [r[0] for r in df.select(dr._block_of(F.col("v"), arr, len(cuts))).collect()]
    assert got == [int(np.searchsorted(cuts, v, side="right")) for v in vals]


@pytest.mark.parametrize("blocks", [2, 5, 1024])
def test_sparse_feature_drift_matches_dense(spark, blocks):
    rng = np.random.default_rng(11)
    terms = ["a", "b", "c", "never"]
    rows, dense = [], {t: {"train": [], "val": []} for t in terms}
    for i in range(400):
        side = "train" if i % 3 else "val"
        feats = []
        for t in terms[:3]:
            if rng.random() < (0.5 if t != "c" else 0.05):
                w = float(np.round(rng.random(), 3)) or 0.5
                feats.append((t, w))
                dense[t][side].append(w)
            else:
                dense[t][side].append(0.0)
        dense["never"][side].append(0.0)
        rows.append((side, feats))
    df = spark.createDataFrame(rows, "split string, f array<struct<term:string,weight:double>>")
    got = {r["column"]: r for r in dr.sparse_feature_drift(df, "split", "f", terms, reference="train",
                                                            current="val", blocks=blocks).collect()}
    assert set(got) == set(terms)
    for t in terms:
        ks, w, std = _direct(dense[t]["train"], dense[t]["val"])
        assert got[t]["n_ref"] == len(dense[t]["train"]) and got[t]["n_cur"] == len(dense[t]["val"])
        assert math.isclose(got[t]["ks"], ks, abs_tol=1e-9)
        assert math.isclose(got[t]["wasserstein"], w, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[t]["wasserstein_norm"], w / max(std, dr.STD_FLOOR), rel_tol=1e-9, abs_tol=1e-9)
