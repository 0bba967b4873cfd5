"""Matrix-free SVD and sparse features against dense numpy versions."""

import numpy as np
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators import svd, trees
from reviewlab.operators.features import TfidfModel


def _rows(spark, x):
    data = [([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for r in x]
    return spark.createDataFrame(data, "codes array<int>, values array<double>")


def _sparse(rng, n, m, share=0.1):
    return rng.standard_normal((n, m)) * (rng.random((n, m)) < share)


def test_top_singular_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = _sparse(rng, 300, 150)
    top = svd.top_singular(_rows(spark, x).repartition(3), 150, k=3)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(top.values, s[:3], rtol=1e-9)
    assert np.allclose(abs(np.sum(top.vectors * vt[:3].T, axis=0)), 1.0, atol=1e-7)
    assert top.residual <= 1e-10 and (top.vectors.max(axis=0) >= -top.vectors.min(axis=0)).all()


def test_small_basis_restarts_and_still_converges(spark):
    x = _sparse(np.random.default_rng(2), 120, 80, 0.2)
    top = svd.top_singular(_rows(spark, x).coalesce(1), 80, k=2, block=4, max_basis=24)
    assert top.passes > 6 and np.allclose(top.values, np.linalg.svd(x, compute_uv=False)[:2], rtol=1e-9)


def test_equal_singular_values_no_rows_and_few_terms(spark):
    tied = svd.top_singular(_rows(spark, np.eye(5)), 5, k=2)
    assert np.allclose(tied.values, 1.0) and np.allclose(tied.vectors.T @ tied.vectors, np.eye(2))
    none = svd.top_singular(_rows(spark, np.eye(2)).where("false"), 4, k=2)
    assert (none.values == 0).all() and none.vectors.shape == (4, 2)
    one = svd.top_singular(_rows(spark, np.array([[2.0], [1.0]])), 1, k=2)
    assert one.vectors.shape == (1, 1) and np.isclose(one.values[0], 5 ** 0.5)
    assert svd.top_singular(_rows(spark, np.eye(2)), 0).values.shape == (0,)


def test_many_terms_need_no_square_matrix(spark):
    """20,000 terms: a Gram matrix would hold 3.2 GB."""
    n = 20_000
    rows = spark.range(2000, numPartitions=4).select(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda j: ((F.col("id") * 7919 + j * j * 31 + j * 1999) % n).cast("int")).alias("codes"))
    rows = rows.select(F.array_distinct("codes").alias("codes")).select(
        F.concat(F.array(F.lit(n)), "codes").alias("codes"), F.transform(F.concat(F.array(F.lit(n)), "codes"), lambda c: F.when(c == n, 3.0).otherwise(1.0)).alias("values"))
    top = svd.top_singular(rows, n + 1, k=1, tol=1e-8)
    assert top.residual <= 1e-8 and top.vectors[n, 0] > 0.5 and top.values[0] ** 2 >= 9 * 2000


def test_projection_without_terms(spark):
    model = TfidfModel((), (), 0)
    df = spark.createDataFrame([(1, [])], "id long, w array<struct<term:string,weight:double,code:int>>")
    p = svd.fit_projection(df, model, "w")
    assert p.v == () and p.singular == (0.0, 0.0)
    assert df.select(*p.apply(F.col("w"))).first()[0] == 0.0


def test_vectors_are_sparse_and_equal_the_weights(spark):
    model = TfidfModel(("bad", "good", "good value", "value"), (3, 5, 2, 4), 9)
    df = spark.createDataFrame([(1, "good value good"), (2, "nothing here"), (3, "bad value"), (4, None)], "id long, text string")
    tokens = tx.vectorizer_tokens(F.col("text"))
    got = trees.vectors(df.withColumn("w", model.weights_from_tokens(tokens)), model, tokens).orderBy("id").collect()
    for r in got:
        v = r["features"]
        assert type(v).__name__ == "SparseVector" and v.size == 4
        if r["text"] is None:
            assert not len(v.indices)
        else:
            assert {int(i): round(float(x), 12) for i, x in zip(v.indices, v.values)} == {e["code"]: round(e["weight"], 12) for e in r["w"]}


def test_model_comparison_releases_its_features(spark):
    from reviewlab.plans import model_queries as mq
    from reviewlab.plans.experiment import model_comparison
    from review_paths import SMALL
    prep = mq._prepared(spark, SMALL)
    stored = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = stored()
    rows = model_comparison(prep, models=("nb", "rf"))
    assert stored() == before and rows.count() == 2
