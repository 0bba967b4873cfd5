"""Shared aggregate building blocks: numeric summaries, box statistics, skew-safe top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.operators.select import SMALL_TABLE, exact_quantiles

STATS = ["count", "min", "max", "mean", "median", "std"]


def stat_columns(value: Column, approx: bool = False) -> list[Column]:
    """count, min, max, mean, median, sample std of non-null values (doubles).

    The exact median keeps a value->count map per group (partial aggregation merges
    maps), so memory follows the number of distinct values, not rows: ``global_and_grouped_stats``
    uses it for small tables only. ``approx=True`` switches to ``percentile_approx``.
    """
    v = value.cast("double")
    median = F.percentile_approx(v, 0.5, 10000) if approx else F.median(v)
    return [
        F.count(v).alias("count"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        median.cast("double").alias("median"),
        F.stddev_samp(v).alias("std"),
    ]


def global_and_grouped_stats(df: DataFrame, value: str, group: str, approx: bool = False, small_table: int = SMALL_TABLE) -> DataFrame:
    """One pass (ROLLUP) giving the global summary and one summary per non-null group.

    Output: scope ('global' | 'group'), <group>, count, min, max, mean, median, std.

    The exact median of a table of more than ``small_table`` rows is found by rank selection (bounded memory).
    """
    if not approx and df.count() > small_table:
        both = df.select(F.col(value).alias("v"), F.explode(F.array(
            F.struct(F.lit("global").alias("scope"), F.lit(None).cast(df.schema[group].dataType).alias("of")),
            F.struct(F.lit("group").alias("scope"), F.col(group).alias("of")))).alias("k")).where("k.scope = 'global' OR k.of IS NOT NULL")
        rest = both.groupBy("k").agg(*[c for c, n in zip(stat_columns(F.col("v"), True), STATS) if n != "median"])
        med = exact_quantiles(both, F.col("k"), F.col("v"), [0.5]).select(F.col("g").alias("k"), F.col("q")[0].alias("median"))
        out = rest.join(med, "k", "left").select(F.col("k.scope").alias("scope"), F.col("k.of").alias(group), *STATS)
        return out
    g = F.grouping(group)
    out = (df.rollup(group).agg(*stat_columns(F.col(value), approx), g.alias("_g")))
    out = out.filter((F.col("_g") == 1) | F.col(group).isNotNull())
    return out.select(F.when(F.col("_g") == 1, "global").otherwise("group").alias("scope"),
                      F.when(F.col("_g") == 1, F.lit(None)).otherwise(F.col(group)).alias(group),
                      "count", "min", "max", "mean", "median", "std")


def box_stats(df: DataFrame, value: str, group: str, whis: float = 1.5, small_table: int = SMALL_TABLE) -> DataFrame:
    """Box-plot statistics per group: quartiles, whiskers (most extreme values inside
    q1 - whis*iqr .. q3 + whis*iqr) and outlier count.

    Two aggregations: quartiles, then whiskers against the per-group fences. The
    fence table has one row per group and is joined back on the group key. Quartiles of a table of more than
    ``small_table`` rows are found by rank selection, and its rows are counted against the fences as they are.
    """
    v = F.col(value).cast("double")
    rows = df.select(F.col(group), v.alias("_v")).filter(F.col(group).isNotNull() & F.col("_v").isNotNull())
    probs = [0.25, 0.5, 0.75]
    if df.count() > small_table:
        rows = rows.where(~F.isnan("_v"))
        base = rows.withColumn("_n", F.lit(1).cast("long"))
        q = exact_quantiles(rows, F.col(group), F.col("_v"), probs).select(F.col("g").alias(group), F.col("q").alias("_q"))
    else:
        # one row per distinct value first: a hot group sends its values, not its rows
        base = rows.groupBy(group, "_v").agg(F.count(F.lit(1)).alias("_n"))
        q = base.groupBy(group).agg(F.percentile("_v", probs, F.col("_n")).alias("_q"))
    q = (q.select(group, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3")))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = (q.withColumn("_lo", F.col("q1") - whis * F.col("iqr"))
         .withColumn("_hi", F.col("q3") + whis * F.col("iqr")))
    j = base.join(q, group)
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    w = (j.groupBy(group)
         .agg(F.min(F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))).alias("_wl"),
              F.max(F.when(F.col("_v") <= F.col("_hi"), F.col("_v"))).alias("_wh"),
              F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
              F.sum("_n").alias("n"),
              F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("_out_fence")))
    wl = F.coalesce(F.col("_wl"), F.col("q1"))
    wh = F.coalesce(F.col("_wh"), F.col("q3"))
    return w.select(group, "n", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                    wl.alias("whisker_low"), wh.alias("whisker_high"),
                    F.col("_out_fence").alias("outliers"))


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    salt_key: Column | None = None, salt_buckets: int | None = None,
                    rank_col: str = "rank") -> DataFrame:
    """Exact top-k rows per group under a total order, safe when one group is huge.

    A salted two-stage rank: rank inside (group, salt) sub-groups, keep k, then rank
    the at most k * salt_buckets survivors per group. Spark adds its own map-side
    limit to either stage where k allows it; the result is the same for every k.
    ``salt_key`` defaults to all columns.
    """
    spark = df.sparkSession
    if salt_key is None:
        salt_key = F.struct(*[F.col(x) for x in df.columns])
    if salt_buckets is None:
        salt_buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_key), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (stage1.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)
            .drop("_salt", "_r1"))
