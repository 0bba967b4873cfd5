"""Drift between a reference and a current sample of the same columns.

Per-column tests (choices of published statistics; thresholds are arguments):
- numeric: two-sample Kolmogorov-Smirnov distance (+ asymptotic p-value) and the
  1-Wasserstein distance, normalised by the reference's population std;
  drift when the normalised distance >= 0.1;
- categorical: Jensen-Shannon distance (natural log) of the category shares,
  drift when >= 0.1; chi-square goodness-of-fit statistic of current counts
  against reference shares;
- text: a domain classifier (hashed term features + logistic regression)
  trained to tell the samples apart; drift when the held-out ROC AUC > 0.55.
Dataset drift: share of drifted columns > 0.3.

Numeric tests pre-aggregate to one row per distinct (column, value) and run the
cumulative sums inside ordered value blocks of a column, so no window ever sees raw
rows or a whole column. ``bins`` rounds continuous values first when distinct values are too many.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REFERENCE, CURRENT = "reference", "current"
NUMERIC_THRESHOLD = 0.1
CATEGORICAL_THRESHOLD = 0.1
TEXT_AUC_THRESHOLD = 0.55
DATASET_DRIFT_SHARE = 0.3
KS_TERMS = 100
STD_FLOOR = 0.001   # the Wasserstein distance is divided by max(reference std, this)
BLOCKS = 1024       # running sums of a numeric column are split into at most this many value blocks
QUANTILE_ACCURACY = 20_000


def _long(df: DataFrame, side: str, columns: list[str], as_type: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).try_cast(as_type).alias("value")) for c in columns])
    return df.select(F.col(side).alias("side"), F.inline(arr))


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample KS p-value Q(lambda), lambda = (sqrt(en) + 0.12 + 0.11/sqrt(en)) * D,
    en = nm/(n+m); the small-lambda series is used below 1.18 where the usual one converges slowly."""
    en = F.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    js = F.sequence(F.lit(1), F.lit(KS_TERMS))
    big = 2.0 * F.aggregate(F.transform(js, lambda j: F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam)),
                            F.lit(0.0), lambda a, b: a + b)
    small = 1.0 - F.sqrt(F.lit(2.0 * 3.141592653589793)) / lam * F.aggregate(
        F.transform(js, lambda j: F.exp(-F.pow(2.0 * j - 1.0, 2) * F.lit(3.141592653589793 ** 2) / (8.0 * lam * lam))),
        F.lit(0.0), lambda a, b: a + b)
    p = F.when(lam < 1.18, small).otherwise(big)
    return F.when(d <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def _block_of(value: Column, splits: Column, max_splits: int) -> Column:
    """Number of entries of the sorted array ``splits`` that are <= ``value`` (binary search)."""
    steps = math.ceil(math.log2(max_splits + 1)) + 1

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        right = F.element_at(splits, mid + 1) <= value
        return (F.when(lo >= hi, acc)
                .when(right, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
                .otherwise(F.struct(lo.alias("lo"), mid.alias("hi"))))

    init = F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def numeric_drift(df: DataFrame, side: str, columns: list[str], bins: float | None = None,
                  threshold: float = NUMERIC_THRESHOLD, reference: str = REFERENCE,
                  current: str = CURRENT, blocks: int = BLOCKS) -> DataFrame:
    """column, n_ref, n_cur, ks, ks_pvalue, wasserstein, wasserstein_norm, drifted.

    Exact running sums without a window over a whole column: the distinct values of
    each column are cut into at most ``blocks`` ordered blocks at approximate
    quantiles (the cut points only balance the work; the result does not depend on
    them). A small per-block table (columns x blocks rows, broadcast) carries the
    counts before each block and the first value of the next block; the running
    sums then run inside (column, block). ``blocks`` bounds that table; each
    block's window holds about 1/blocks of the column's distinct values.
    """
    lg = _long(df, side, columns, "double").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if bins:
        lg = lg.withColumn("value", F.round(F.col("value") / bins) * bins)
    cnt = lg.groupBy("column", "value").agg(F.count_if(F.col("side") == reference).alias("r"),
                                            F.count_if(F.col("side") == current).alias("c"))
    return drift_from_counts(cnt, threshold, blocks)


def drift_from_counts(cnt: DataFrame, threshold: float = NUMERIC_THRESHOLD, blocks: int = BLOCKS) -> DataFrame:
    """Numeric drift per column from counts (column, value, r, c): ``r`` reference and
    ``c`` current rows equal to ``value``, one row per distinct (column, value)."""
    blocks = max(2, blocks)
    # a non-nullable join key: otherwise the joins below infer an IS NOT NULL filter
    # that is pushed under one branch's aggregate only, and cnt is computed twice
    cnt = cnt.select(F.coalesce(F.col("column").cast("string"), F.lit("")).alias("column"), "value", "r", "c")
    probs = [i / blocks for i in range(1, blocks)]
    # one row per column: cut points (< blocks doubles), totals and the reference mean. The
    # totals are used both from cb and from its per-block aggregate: column pruning then
    # leaves both branches with all of cnt's columns, and cnt's shuffle is shared
    cuts = cnt.groupBy("column").agg(
        F.array_sort(F.array_distinct(F.percentile_approx("value", probs, QUANTILE_ACCURACY))).alias("_cuts"),
        F.sum("r").alias("nr"), F.sum("c").alias("nc"),
        F.try_divide(F.sum(F.col("r") * F.col("value")), F.sum("r")).alias("_mean"))
    cb = (cnt.join(cuts, "column")
          .select("column", "value", "r", "c", "nr", "nc", "_mean",
                  _block_of(F.col("value"), F.col("_cuts"), len(probs)).alias("blk")))
    per_block = cb.groupBy("column", "blk").agg(F.sum("r").alias("br"), F.sum("c").alias("bc"), F.min("value").alias("bmin"),
                                                F.first("nr").alias("tr"), F.first("nc").alias("tc"))
    by_col = Window.partitionBy("column").orderBy("blk")    # <= blocks rows per column
    before = by_col.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        "column", "blk", "tr", "tc",
        F.coalesce(F.sum("br").over(before), F.lit(0)).alias("r0"),
        F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("c0"),
        F.lead("bmin").over(by_col).alias("next_min"))
    upto = Window.partitionBy("column", "blk").orderBy("value")
    cdf = (cb.join(offsets, ["column", "blk"])  # columns x blocks rows; broadcast by Spark where small
           .withColumn("gap", F.abs(F.try_divide(F.col("r0") + F.sum("r").over(upto), F.col("tr"))
                                    - F.try_divide(F.col("c0") + F.sum("c").over(upto), F.col("tc"))))
           .withColumn("width", F.coalesce(F.lead("value").over(upto), F.col("next_min")) - F.col("value")))
    out = cdf.groupBy("column").agg(
        F.first("nr").alias("n_ref"), F.first("nc").alias("n_cur"),
        F.max("gap").alias("ks"),
        F.when((F.first("nr") > 0) & (F.first("nc") > 0), F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0))).alias("wasserstein"),
        F.sqrt(F.try_divide(F.sum(F.col("r") * F.pow(F.col("value") - F.col("_mean"), 2)),
                            F.first("nr"))).alias("ref_std"))
    # a side without values has no distance to the other: nulls, and not drifted
    norm = F.col("wasserstein") / F.greatest(F.coalesce(F.col("ref_std"), F.lit(0.0)), F.lit(STD_FLOOR))
    return out.select(
        "column", "n_ref", "n_cur", "ks",
        F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0),
               ks_pvalue(F.col("ks"), F.greatest("n_ref", F.lit(1)).cast("double"), F.greatest("n_cur", F.lit(1)).cast("double"))).alias("ks_pvalue"),
        "wasserstein", norm.alias("wasserstein_norm"),
        (F.coalesce(norm, F.lit(0.0)) >= threshold).alias("drifted"))


def sparse_feature_drift(df: DataFrame, side: str, features: str, terms: list[str],
                         threshold: float = NUMERIC_THRESHOLD, reference: str = REFERENCE,
                         current: str = CURRENT, blocks: int = BLOCKS) -> DataFrame:
    """Numeric drift of every feature column of a sparse vector, one row per term.

    ``features`` holds only the non-zero entries (array<struct<term, weight>>); a
    row without a term has weight 0 there. Non-zero weights are exploded and
    counted per (term, weight); the zeros of a term are one mass, the side's row
    count minus the term's non-zero count. Nothing is densified.
    """
    sizes = df.agg(F.count_if(F.col(side) == reference).alias("n"),
                   F.count_if(F.col(side) == current).alias("m")).first()   # two scalars
    is_r = F.when(F.col("side") == reference, 1).otherwise(0).cast("bigint")
    is_c = F.when(F.col("side") == current, 1).otherwise(0).cast("bigint")
    nz = (df.select(F.col(side).alias("side"), F.inline(features))
          .select("side", F.col("term").alias("column"), F.col("weight").cast("double").alias("value"))
          .filter(F.col("value").isNotNull() & ~F.isnan("value") & F.col("column").isin(list(terms))))
    # each non-zero entry counts once at its weight and takes one row off its term's
    # zero mass; every term starts with all rows of each side at weight 0. One pass
    # over the features, one aggregate.
    moves = nz.select("column", F.inline(F.array(
        F.struct(F.col("value").alias("value"), is_r.alias("r"), is_c.alias("c")),
        F.struct(F.lit(0.0).alias("value"), (-is_r).alias("r"), (-is_c).alias("c")))))
    start = df.sparkSession.createDataFrame(   # <= vocabulary size rows
        [(t, 0.0, int(sizes["n"] or 0), int(sizes["m"] or 0)) for t in terms],
        "column string, value double, r bigint, c bigint")
    cnt = (moves.unionByName(start).groupBy("column", "value")
           .agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
           .filter((F.col("r") + F.col("c")) > 0))
    return drift_from_counts(cnt, threshold, blocks)


def categorical_drift(df: DataFrame, side: str, columns: list[str], threshold: float = CATEGORICAL_THRESHOLD,
                      reference: str = REFERENCE, current: str = CURRENT) -> DataFrame:
    """column, n_ref, n_cur, categories, js_distance, chi2, dof, drifted."""
    lg = _long(df, side, columns, "string").filter(F.col("value").isNotNull())
    cnt = lg.groupBy("column", "value").agg(F.count_if(F.col("side") == reference).alias("r"),
                                            F.count_if(F.col("side") == current).alias("c"))
    totals = cnt.groupBy("column").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))   # one row per column
    shares = (cnt.join(totals, "column")
              .withColumn("p", F.try_divide("r", "nr")).withColumn("q", F.try_divide("c", "nc"))
              .withColumn("m", (F.col("p") + F.col("q")) / 2))

    def kl_part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / F.col("m"))).otherwise(F.lit(0.0))

    expected = F.col("p") * F.col("nc")
    stat = shares.groupBy("column").agg(
        F.first("nr").alias("n_ref"), F.first("nc").alias("n_cur"), F.count(F.lit(1)).alias("categories"),
        F.sum(0.5 * kl_part(F.col("p")) + 0.5 * kl_part(F.col("q"))).alias("_jsd"),
        F.sum(F.when(expected > 0, F.pow(F.col("c") - expected, 2) / expected)).alias("chi2"),
        F.count_if(expected > 0).alias("_k"))
    # a side without values has no distance to the other: null, and not drifted
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    js = F.when(both, F.sqrt(F.greatest(F.col("_jsd"), F.lit(0.0))))
    return stat.select("column", "n_ref", "n_cur", "categories", js.alias("js_distance"),
                       F.coalesce(F.col("chi2"), F.lit(0.0)).alias("chi2"),
                       (F.col("_k") - 1).cast("bigint").alias("dof"),
                       F.coalesce(js >= threshold, F.lit(False)).alias("drifted"))


def drift_table(df: DataFrame, side: str, numeric: list[str] = (), categorical: list[str] = (), text: list[str] = (),
                id_col: str | None = None, features: str | None = None, terms: list[str] = (),
                reference: str = REFERENCE, current: str = CURRENT) -> DataFrame:
    """One row per column: column, kind, score, drifted.

    ``categorical`` takes target and prediction columns too; ``text`` columns (with the row key ``id_col``)
    are tested by the domain classifier; ``features`` is a sparse TF-IDF column whose ``terms`` are one
    column each.
    """
    parts = []
    if numeric:
        parts.append(numeric_drift(df, side, list(numeric), reference=reference, current=current)
                     .select("column", F.lit("numeric").alias("kind"),
                             F.col("wasserstein_norm").alias("score"), "drifted"))
    if categorical:
        parts.append(categorical_drift(df, side, list(categorical), reference=reference, current=current)
                     .select("column", F.lit("categorical").alias("kind"),
                             F.col("js_distance").alias("score"), "drifted"))
    for name in text:
        parts.append(text_drift_auc(df, side, name, id_col, reference=reference)
                     .select(F.lit(name).alias("column"), F.lit("text").alias("kind"), F.col("auc").alias("score"), "drifted"))
    if features:
        parts.append(sparse_feature_drift(df, side, features, list(terms), reference=reference, current=current)
                     .select(F.concat(F.lit("tfidf:"), "column").alias("column"), F.lit("tfidf").alias("kind"),
                             F.col("wasserstein_norm").alias("score"), "drifted"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_share(columns: DataFrame, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """n_columns, n_drifted, share, dataset_drift (share > threshold, strict)."""
    a = columns.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted"))
    s = F.coalesce(F.try_divide(F.col("n_drifted").cast("double"), F.col("n_columns")), F.lit(0.0))
    return a.select("n_columns", "n_drifted", s.alias("share"), (s > share).alias("dataset_drift"))


def text_features(df: DataFrame, side: str, text: str, id_col: str, reference: str = REFERENCE, num_features: int = 1 << 18,
                  seed: int = 42, test_fraction: float = 0.5, keep: list[str] = ()) -> DataFrame:
    """_label (0: reference), _test (the half, by a hash of the id) and _x (hashed terms) of every row, and the columns ``keep``."""
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    bucket = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1000)) / 1000.0
    d = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"), F.when(F.col(side) == reference, 0.0).otherwise(1.0).alias("_label"),
                  (bucket < test_fraction).alias("_test"))
    d = RegexTokenizer(inputCol="_text", outputCol="_tok", pattern="[\\p{L}\\p{N}_]{2,}", gaps=False).transform(d)
    return HashingTF(inputCol="_tok", outputCol="_x", numFeatures=num_features, binary=True).transform(d).select(*keep, "_label", "_test", "_x")


def classifier_auc(rows: DataFrame, max_iter: int = 20) -> float:
    """Held-out ROC AUC of a classifier of ``text_features`` rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    model = LogisticRegression(featuresCol="_x", labelCol="_label", maxIter=max_iter, regParam=0.01).fit(rows.filter(~F.col("_test")))
    return BinaryClassificationEvaluator(labelCol="_label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC").evaluate(model.transform(rows.filter(F.col("_test"))))


def auc_cut(n_ref: Column, n_cur: Column, threshold: float = TEXT_AUC_THRESHOLD, test_fraction: float = 0.5) -> Column:
    """The AUC above which text drifted. A small sample's AUC strays from 0.5 by chance: at least 1.645 standard errors above it."""
    a, b = F.greatest(n_ref * test_fraction, F.lit(1.0)), F.greatest(n_cur * test_fraction, F.lit(1.0))
    return F.greatest(F.lit(threshold), 0.5 + 1.645 * F.sqrt((a + b + 1) / (12 * a * b)))


def text_drift_auc(df: DataFrame, side: str, text: str, id_col: str, reference: str = REFERENCE,
                   num_features: int = 1 << 18, seed: int = 42, threshold: float = TEXT_AUC_THRESHOLD,
                   test_fraction: float = 0.5, max_iter: int = 20) -> DataFrame:
    """Classifier two-sample test: can a model tell reference rows from current rows?

    Rows are assigned to fit/test halves by a hash of the id (repeatable); the
    classifier is distributed (HashingTF + LogisticRegression); the result is
    the held-out ROC AUC. AUC near 0.5 means no text drift.
    """
    d = text_features(df, side, text, id_col, reference, num_features, seed, test_fraction).persist()
    auc = classifier_auc(d, max_iter)
    n = d.agg(F.count_if(F.col("_label") == 0).alias("n_ref"), F.count_if(F.col("_label") == 1).alias("n_cur")).first()
    d.unpersist()
    counts = df.sparkSession.createDataFrame([(text, n["n_ref"], n["n_cur"], float(auc))], "column string, n_ref bigint, n_cur bigint, auc double")
    return counts.select("*", (F.col("auc") > auc_cut(F.col("n_ref"), F.col("n_cur"), threshold, test_fraction)).alias("drifted"))


def retrain_gate(aliases: DataFrame, share: DataFrame, alias: str = "Production",
                 threshold: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """Decision row: train when no model carries ``alias`` or the drift share exceeds
    ``threshold``; stop otherwise. The two one-row inputs are combined by a union
    and an aggregate (no join)."""
    a = aliases.agg((F.count_if(F.col("alias") == alias) > 0).alias("has_production"),
                    F.lit(None).cast("double").alias("share"))
    s = share.select(F.lit(None).cast("boolean").alias("has_production"), F.col("share").cast("double"))
    both = a.unionByName(s).agg(F.max("has_production").alias("has_production"),
                                F.coalesce(F.max("share"), F.lit(0.0)).alias("drift_share"))
    decision = (F.when(~F.col("has_production"), "train")
                .when(F.col("drift_share") > threshold, "train").otherwise("stop"))
    reason = (F.when(~F.col("has_production"), "no production model")
              .when(F.col("drift_share") > threshold, "drift above threshold")
              .otherwise("drift at or below threshold"))
    return both.select("has_production", "drift_share", decision.alias("decision"), reason.alias("reason"))
