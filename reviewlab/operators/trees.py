"""Tree classifiers on sparse TF-IDF vectors (Spark ML).

- random forest: 10 trees, depth 3, seed 42, sqrt feature subsets;
- boosted trees are in ``softmax_boost`` (Spark ML's GBT is binary).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.functions.text import let
from reviewlab.operators.features import TfidfModel

FEATURES_VEC = "features"
LABEL_DOUBLE = "label"


def vectors(df: DataFrame, tfidf: TfidfModel, tokens: Column, label_id: str | None = None) -> DataFrame:
    """Adds the sparse TF-IDF vector (vocabulary order) of an array of vectoriser tokens (null: zero), and a double label."""
    grams, counts, scaled = "_grams", "_counts", "_scaled"
    steps = [CountVectorizerModel.from_vocabulary(list(tfidf.terms), inputCol=grams, outputCol=counts, minTF=1.0),
             ElementwiseProduct(scalingVec=Vectors.dense(tfidf.idf), inputCol=counts, outputCol=scaled),
             Normalizer(p=2.0, inputCol=scaled, outputCol=FEATURES_VEC)]
    out = df.withColumn(grams, F.coalesce(tx.word_ngrams(tokens), F.array().cast("array<string>")))
    for step in steps:
        out = step.transform(out)
    out = out.drop(grams, counts, scaled)
    if label_id:
        out = out.withColumn(LABEL_DOUBLE, F.col(label_id).cast("double"))
    return out


def random_forest(num_trees: int = 10, max_depth: int = 3, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL_DOUBLE, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, featureSubsetStrategy="sqrt")


def softmax(raw: Column) -> Column:
    def body(a):
        e = F.transform(a, lambda x: F.exp(x - F.array_max(a)))
        return let(e, lambda ev: let(F.aggregate(ev, F.lit(0.0), lambda s, x: s + x),
                                     lambda tot: F.transform(ev, lambda x: x / tot)))
    return let(vector_to_array(raw), body)


def class_probabilities(scored: DataFrame) -> Column:
    """array<double> class probabilities of a scored frame (softmax of raw margins
    when the model has no probability column)."""
    if "probability" in scored.columns:
        as_array = scored.schema["probability"].dataType.typeName() == "array"
        return F.col("probability") if as_array else vector_to_array(F.col("probability"))
    return softmax(F.col("rawPrediction"))


def confidence_columns(scored: DataFrame, names: Column) -> tuple[Column, Column]:
    """(confidence, label -> probability map) of a scored frame.

    Probabilities come from the model's probability column, else from a softmax
    of its raw margins; a model with neither gets confidence 1.0 and an empty map.
    """
    if "probability" in scored.columns or "rawPrediction" in scored.columns:
        p = class_probabilities(scored)
        return F.array_max(p), F.map_from_arrays(names, p)
    return F.lit(1.0), F.create_map().cast("map<string,double>")
