"""Selection by rank without sorting or gathering a group: hold-out thresholds and exact quantiles.

Both narrow a range round by round: a small aggregate counts what lies in each part of the range, and the part that holds the
wanted rank is the next round's range. Rows are only read and counted (map-side first); the driver holds a few values
per group and rank, never rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 32             # of an md5
ACCURACY = 10000            # of the sketch that proposes cuts
FINAL_ROWS = 20000          # a range of at most so many rows is finished by counting its distinct values
SMALL_TABLE = 1 << 20       # rows up to which Spark's own exact percentile (a map of a group's values) is used


# ---------------------------------------------------------------- thresholds
def hash_thresholds(df: DataFrame, group: str, mark: Column, share: float, digits: int = 4) -> dict:
    """{group value: threshold}: exactly round(share * n) of the group's n rows have a ``mark`` (32 hex digits) below it.

    Each round counts the rows that share the prefix found so far by their next ``digits`` hex digits. Rows of equal marks
    stay together, so where marks repeat the number can be missed by those of one mark."""
    rows = df.select(F.col(group).alias("g"), mark.alias("h"))
    found: dict = {}
    open_: dict = {}                                            # group -> (prefix, rank left inside it)
    length = 0
    while length < HEX_DIGITS:
        part = F.substring("h", length + 1, digits)
        if length == 0:
            left = rows
        else:
            prefix = _by_group(F.col("g"), {g: p for g, (p, _) in open_.items()})
            left = rows.where(F.substring("h", 1, length) == prefix)
        per = left.groupBy("g", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
        whole = Window.partitionBy("g")                         # at most 16 ** digits rows
        upto = whole.orderBy("part")
        rank = (F.round(F.lit(share) * F.sum("n").over(whole)).cast("long") if length == 0
                else _by_group(F.col("g"), {g: k for g, (_, k) in open_.items()}))
        per = per.select("g", "part", "n", F.sum("n").over(upto).alias("upto"), rank.alias("k"))
        hit = per.where(((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k")))).collect()    # one row per group
        if length == 0:
            groups = [r["g"] for r in per.select("g").distinct().collect()]
            found = {g: "" for g in groups}                     # k = 0: nothing is below
        length += digits
        was, open_ = open_, {}
        for r in hit:
            prefix = (was[r["g"]][0] if r["g"] in was else "") + r["part"]
            inside = r["k"] - (r["upto"] - r["n"])
            found[r["g"]] = prefix + "g"                        # above every mark with this prefix
            if inside < r["n"]:
                open_[r["g"]] = (prefix, inside)
        if not open_:
            break
    return found


def _by_group(group: Column, values: dict) -> Column:
    """The value of the row's group (null for others), for a few groups."""
    out = F.lit(None)
    for g, v in values.items():
        out = F.when(group.eqNullSafe(F.lit(g)), F.lit(v)).otherwise(out)
    return out


def below(df: DataFrame, group: str, mark: Column, thresholds: dict) -> Column:
    """Is the row's mark below its group's threshold? A per-row comparison."""
    return F.coalesce(mark < _by_group(F.col(group), thresholds), F.lit(False))


# ---------------------------------------------------------------- quantiles
RANGE = "rank long, lo double, hi double, less long, held long"


def _inside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows (g, v) of each open range (lo, hi); null ends are unbounded."""
    r = ranges.withColumnRenamed("g", "of")
    return rows.join(r, rows.g.eqNullSafe(r.of)).where(F.coalesce(F.col("v") > F.col("lo"), F.lit(True)) & F.coalesce(
        F.col("v") < F.col("hi"), F.lit(True))).drop("of")


def _narrowed(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """(g, rank, lo, hi, less, held, exact): the part of each range that holds its rank.

    A sketch proposes up to 65 values of the range as cuts; the rows on each cut and between neighbouring cuts are counted
    exactly, so the sketch's error costs rounds at most, never the result."""
    keys = ["g", "rank", "lo", "hi", "less"]
    cuts = _inside(rows, ranges).groupBy(*keys).agg(F.array_distinct(F.array_sort(
        F.percentile_approx("v", [i / 64 for i in range(65)], ACCURACY))).alias("cuts"))
    inside = _inside(rows, cuts)
    upto = F.aggregate("cuts", F.lit(0), lambda n, c: n + (c <= F.col("v")).cast("int"))
    inside = inside.withColumn("upto", upto)
    on_cut = F.coalesce(F.try_element_at("cuts", F.when(F.col("upto") > 0, F.col("upto"))) == F.col("v"), F.lit(False))
    # part 2j - 1 is the j-th cut, part 2j what lies between it and the next one
    parts = inside.withColumn("part", 2 * F.col("upto") - on_cut.cast("int")).groupBy(*keys, "cuts", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.col("less") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("part")) - F.col("n")      # at most 131 rows
    hit = parts.withColumn("before", before).where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
    j = F.ceil(F.col("part") / 2).cast("int")
    exact = F.col("part") % 2 == 1
    cut = lambda k: F.try_element_at("cuts", F.when(k > 0, k))
    return hit.select("g", "rank", F.coalesce(cut(j), "lo").alias("lo"), F.when(exact, cut(j)).otherwise(F.coalesce(cut(j + 1), "hi")).alias("hi"),
                      F.col("before").alias("less"), F.col("n").alias("held"), exact.alias("exact"))


def exact_quantiles(df: DataFrame, group: Column, value: Column, probs: list[float], final_rows: int = FINAL_ROWS) -> DataFrame:
    """(g, q): per group the quantiles of its non-null, non-NaN values, interpolated like Spark's ``percentile``.

    Every wanted rank is narrowed to a range of at most ``final_rows`` rows (or one value), whose distinct values are then
    counted. A round divides a range by about 64, so no task holds more than sketches and ``final_rows`` values."""
    spark = df.sparkSession
    rows = df.select(group.alias("g"), value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    sizes = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}        # one number per group
    kind = rows.select("g").schema["g"].dataType.simpleString()
    ranks = {(g, k) for g, n in sizes.items() for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    now = [(g, k, None, None, 0, sizes[g]) for g, k in ranks]
    found: dict = {}
    while wide := [r for r in now if r[5] > final_rows]:
        small = [r for r in now if r[5] <= final_rows]
        hits = _narrowed(rows, spark.createDataFrame(wide, f"g {kind}, {RANGE}")).collect()                # one row per open rank
        found.update({(r["g"], r["rank"]): r["lo"] for r in hits if r["exact"]})
        now = small + [tuple(r)[:6] for r in hits if not r["exact"]]
    if now:
        per = _inside(rows, spark.createDataFrame(now, f"g {kind}, {RANGE}")).groupBy("g", "rank", "less", "v").agg(F.count(F.lit(1)).alias("n"))
        before = F.col("less") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("v")) - F.col("n")     # at most final_rows rows
        hits = per.withColumn("before", before).where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        found.update({(r["g"], r["rank"]): r["v"] for r in hits.collect()})

    def read(g, p):
        at = p * (sizes[g] - 1)
        lo, hi = math.floor(at), math.ceil(at)
        return found[g, lo] if lo == hi else (hi - at) * found[g, lo] + (at - lo) * found[g, hi]
    return spark.createDataFrame([(g, [read(g, p) for p in probs]) for g in sizes], f"g {kind}, q array<double>")
