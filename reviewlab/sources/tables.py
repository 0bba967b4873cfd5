"""Readers for the parquet tables and the review-shaped views derived from them.

The views (reviews, predictions, drift_frame, runs, model_versions, aliases,
snapshots) are written once as DataFrame code here and once as SQL text in
``reviewlab.sources.fixture_sql`` for the DuckDB oracle; both follow FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just (review_id, review_text): the review table's rows without the label join."""
    d = documents(spark, sf_dir, ["doc_id", "text"])
    return d.select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review table: documents left-joined to labels, with nullable brand and string rating."""
    d = documents(spark, sf_dir, ["doc_id", "text", "source"])
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    sentiment = (F.when(F.col("toxic") == 1, "Negative")
                 .when(F.col("quality") == 1, "Positive")
                 .when(F.col("quality") == 0, "Neutral"))
    brand = F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("source"))
    rating = (F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("string"))
              .when(F.col("doc_id") % 17 == 0, F.lit("n/a"))
              .otherwise((F.col("doc_id") % 7).cast("string")))
    return j.select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"),
                    sentiment.alias("sentiment"), brand.alias("brand"), rating.alias("rating"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled reviews with a deterministic imperfect prediction column."""
    r = reviews(spark, sf_dir).filter(F.col("sentiment").isNotNull())
    y_pred = (F.when(F.col("review_id") % 5 == 0, "Neutral")
              .when(F.col("review_id") % 7 == 0, "Negative")
              .otherwise(F.col("sentiment")))
    return r.select("review_id", F.col("sentiment").alias("y_true"), y_pred.alias("y_pred"))


def drift_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split into a labelled reference side and an unlabelled current side."""
    d = documents(spark, sf_dir, ["doc_id", "text", "lang", "n_chars"])
    lab = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_doc_id"))
    j = d.join(lab, d.doc_id == lab.l_doc_id, "left")
    side = F.when(F.col("l_doc_id").isNull(), "current").otherwise("reference")
    return j.select(F.col("doc_id").alias("review_id"), side.alias("side"),
                    F.col("text").alias("review_text"), "lang", "n_chars")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked training runs with metrics (one row per run)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")

    def metric(mult: int) -> F.Column:
        return ((k * mult) % 101).cast("double") / 101

    model = (F.when(k % 3 == 0, "NaiveBayes").when(k % 3 == 1, "RandomForest").otherwise("XGBoost"))
    return s.select(F.concat(F.lit("r"), k.cast("string")).alias("run_id"),
                    k.alias("start_seq"), model.alias("model_name"),
                    F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise(metric(37)).alias("macro_f1"),
                    metric(41).alias("micro_f1"), metric(43).alias("accuracy"),
                    metric(47).alias("macro_precision"), metric(53).alias("macro_recall"))


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered model versions; some runs have none."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    return (s.filter(k % 7 != 0)
            .select(F.concat(F.lit("m"), (k % 4).cast("string")).alias("name"), k.alias("version"),
                    F.concat(F.lit("r"), k.cast("string")).alias("run_id")))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table with one Production alias (the registry's current state)."""
    return spark.createDataFrame([("m1", "Production", 1)], "name string, alias string, version bigint")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled snapshots keyed by day."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("ts").cast("date").alias("snapshot_day"), "event_id", "event_type", "value")
