"""Classification metrics from (true, predicted) label columns.

Everything starts from one aggregate, the confusion counts (at most K x K rows),
so the row data is scanned once; the rest works on that small table. Classes
are the union of true and predicted labels; an undefined ratio counts as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def confusion_counts(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    d = df.filter(F.col(y_true).isNotNull() & F.col(y_pred).isNotNull())
    return d.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("count"))


def per_class(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """label, tp, support, predicted, precision, recall, f1."""
    cm = confusion_counts(df, y_true, y_pred)
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("count")).otherwise(F.lit(0))
    contrib = cm.select(F.inline(F.array(
        F.struct(F.col("y_true").alias("label"), hit.alias("tp"), F.col("count").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("count").alias("predicted")))))
    pc = contrib.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                      F.sum("predicted").alias("predicted"))
    zero = F.lit(0.0)
    return pc.select(
        "label", "tp", "support", "predicted",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), zero).alias("recall"),
        F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("predicted") + F.col("support")), zero).alias("f1"))


def eval_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """accuracy, macro/micro/weighted F1, macro precision and recall (one row)."""
    pc = per_class(df, y_true, y_pred)
    tp, sup, prd = F.sum("tp"), F.sum("support"), F.sum("predicted")
    return pc.agg(
        F.coalesce(F.try_divide(tp.cast("double"), sup), F.lit(0.0)).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.coalesce(F.try_divide(2.0 * tp, prd + sup), F.lit(0.0)).alias("micro_f1"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), sup.cast("double")), F.lit(0.0)).alias("weighted_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"))


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                     labels: list[str] | None = None) -> DataFrame:
    """Every (true, predicted) cell over the label list, zero filled.

    ``labels`` gives the list (other labels are left out, as a chosen axis does);
    by default it is every label seen. The list is expanded twice to the K x K cells
    of the result, to which the counts are joined by key.
    """
    cm = confusion_counts(df, y_true, y_pred)
    if labels is None:
        names = cm.select(F.explode(F.array("y_true", "y_pred")).alias("label")).agg(
            F.array_sort(F.collect_set("label")).alias("ls"))           # one value per label
    else:
        names = df.sparkSession.createDataFrame([(sorted(set(labels)),)], "ls array<string>")
    grid = names.select("ls", F.explode("ls").alias("y_true")).select("y_true", F.explode("ls").alias("y_pred"))
    return (grid.join(cm, ["y_true", "y_pred"], "left")
            .select("y_true", "y_pred", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def _report_row(name: str, p: str, r: str, f: str):
    return F.struct(F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                    F.col(f).alias("f1_score"), F.col("n").alias("support"))


def classification_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted averages."""
    pc = per_class(df, y_true, y_pred)   # both branches share one exchange (reused), one scan
    rows = pc.select(F.col("label").alias("class"), "precision", "recall", F.col("f1").alias("f1_score"),
                     F.col("support").cast("bigint").alias("support"))
    sup = F.sum("support")
    avg = pc.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), sup.cast("double")).alias("wp"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), sup.cast("double")).alias("wr"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), sup.cast("double")).alias("wf"),
        F.try_divide(F.sum("tp").cast("double"), sup).alias("acc"),
        sup.cast("bigint").alias("n"))
    summary = avg.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1_score"), F.col("n").alias("support")),
        _report_row("macro avg", "mp", "mr", "mf"),
        _report_row("weighted avg", "wp", "wr", "wf"))))
    return rows.unionByName(summary)
