"""Selection by rank: hold-out thresholds and exact quantiles in bounded memory."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_paths import SMALL
from reviewlab.operators import select, stats
from reviewlab.operators.features import stratified_split


def test_split_cuts_every_label_exactly(spark):
    """Labels of many sizes (one row, ties of the rounding, a null label), several digits a round."""
    rows = [(i, lab) for lab, n in (("a", 1), ("b", 2), ("c", 13), ("d", 700), (None, 25)) for i in range(hash(n) % 7 * 1000, hash(n) % 7 * 1000 + n)]
    df = spark.createDataFrame(rows, "id long, label string")
    want = set()
    for lab in {r[1] for r in rows}:
        marks = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, x in rows if x == lab)
        want |= {(lab, i) for _, i in marks[:math.floor(0.2 * len(marks) + 0.5)]}
    for digits in (1, 4):
        got = stratified_split(df, "id", "label", bucket_hex=digits).where("split = 'val'").collect()
        assert {(r.label, r.id) for r in got} == want
    assert stratified_split(df.limit(0), "id", "label").collect() == []
    assert stratified_split(df, "id", "label", test_size=0.0).where("split = 'val'").count() == 0
    assert stratified_split(df, "id", "label", test_size=1.0).where("split = 'train'").count() == 0


def test_split_moves_no_text(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    split = stratified_split(df, "doc_id", "lang")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan and "text" in plan


def percentile(values, p):
    return float(np.percentile(values, 100 * p))


def test_quantiles_of_odd_groups(spark):
    rng = random.Random(4)
    groups = {"ties": [1.0] * 500 + [2.0] * 3, "one": [7.5], "two": [1.0, 2.0], None: [rng.gauss(0, 1) for _ in range(300)],
              "wide": [10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(400)], "inf": [math.inf, -math.inf, 0.0, 1.0, 2.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("one", math.nan), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    for final_rows in (1, 10, 1000):
        got = {r.g: r.q for r in select.exact_quantiles(df, F.col("k"), F.col("x"), probs, final_rows).collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            want = df.where(F.col("k").eqNullSafe(F.lit(g)) & ~F.isnan("x")).agg(F.percentile("x", probs).alias("q")).first().q
            assert got[g] == pytest.approx(want, rel=1e-12, nan_ok=True), (g, final_rows)
    assert select.exact_quantiles(df.limit(0), F.col("k"), F.col("x"), probs).collect() == []


def test_a_million_distinct_values_in_bounded_memory(spark):
    """Neither a map of a group's values nor a window over them: the tables between rounds hold some rows per rank."""
    n = 1_000_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"),
                               F.exp(F.rand(7) * 20).alias("x")).persist()
    pdf = df.toPandas()
    got = {r.g: r.q for r in select.exact_quantiles(df, F.col("k"), F.col("x"), [0.25, 0.5, 0.75]).collect()}
    for k, part in pdf.groupby("k"):
        assert got[k] == pytest.approx([percentile(part.x.to_numpy(), p) for p in (0.25, 0.5, 0.75)], rel=1e-12)
    df.unpersist()


def test_statistics_above_and_below_the_table_size_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(F.when(F.col("doc_id") % 9 > 0, F.col("lang")).alias("lang"), F.length("text").alias("n"))
    rounded = lambda df: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    assert rounded(stats.global_and_grouped_stats(docs, "n", "lang")) == rounded(stats.global_and_grouped_stats(docs, "n", "lang", small_table=0))
    assert rounded(stats.box_stats(docs, "n", "lang")) == rounded(stats.box_stats(docs, "n", "lang", small_table=0))
    plan = re.sub(r"\s+", " ", stats.box_stats(docs, "n", "lang", small_table=0)._jdf.queryExecution().optimizedPlan().toString())
    assert "percentile(" not in plan
