"""Training data preparation and the naive-Bayes text classifier chain.

prepare: drop rows missing text/label -> keep the first row of each text ->
clean text -> encode labels -> stratified split. Dedupe happens before cleaning
(as in the original job), so equal cleaned texts may remain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators import profile as pf
from reviewlab.operators.features import (LabelIndex, TfidfModel, fit_label_index, fit_tfidf,
                                          stratified_split)
from reviewlab.operators.naive_bayes import NaiveBayesModel, fit_naive_bayes
from reviewlab.operators.softmax_boost import SoftmaxBoostModel
from reviewlab.schema import DEFAULT, Cols

LABEL_ID = "label_id"
SPLIT = "split"
FEATURES = "tfidf"


@dataclass
class Prepared:
    frame: DataFrame          # id, text (cleaned), label, label_id, split
    labels: LabelIndex
    cols: Cols

    def train(self) -> DataFrame:
        return self.frame.filter(F.col(SPLIT) == "train")

    def val(self) -> DataFrame:
        return self.frame.filter(F.col(SPLIT) == "val")


def prepare(reviews: DataFrame, c: Cols = DEFAULT, test_size: float = 0.2, seed: int = 42,
            clean: bool = True, keep: str | None = "persist") -> Prepared:
    """``keep``: "persist" caches the prepared rows (memory, spilling to disk) for the
    several jobs of a fit; "checkpoint" writes them to spark.checkpoint.dir and cuts
    the lineage (long pipelines, executor loss); None keeps the plan lazy."""
    d = pf.drop_missing(reviews.select(c.id, c.text, c.label), c)
    d = pf.dedupe_keep_first(d, key=c.text, order=c.id)
    if clean:
        d = d.withColumn(c.text, tx.clean_text(F.col(c.text)))
    base = d.persist() if keep else d   # read by the label-index job and the split
    labels = fit_label_index(base, c.label)
    d = base.withColumn(LABEL_ID, labels.encode(F.col(c.label)))
    d = stratified_split(d, c.id, c.label, test_size, seed, out=SPLIT)
    if keep == "checkpoint":
        d = d.checkpoint(eager=True)   # reliable checkpoint in spark.checkpoint.dir
    elif keep == "persist":
        d = d.persist()
        d.count()
    if keep:
        base.unpersist()   # one cached copy of the training text, not two
    return Prepared(d, labels, c)


@dataclass
class TextClassifier:
    """Fitted vectoriser + naive Bayes + label map."""

    tfidf: TfidfModel
    nb: NaiveBayesModel
    labels: LabelIndex
    clean: bool = True

    def features(self, df: DataFrame, text: str, already_clean: bool = False) -> DataFrame:
        t = F.col(text)
        if self.clean and not already_clean:
            t = tx.clean_text(t)
        return df.withColumn(FEATURES, self.tfidf.weights(t))

    def predict(self, df: DataFrame, text: str, out: str = "prediction", already_clean: bool = False) -> DataFrame:
        f = self.features(df, text, already_clean)
        return (f.withColumn("pred_id", self.nb.predict(F.col(FEATURES)))
                .withColumn(out, self.labels.decode(F.col("pred_id"))).drop(FEATURES))

    def predict_proba(self, df: DataFrame, text: str, already_clean: bool = False) -> DataFrame:
        """Adds ``probability`` (map label -> p), ``confidence`` (max p) and ``prediction``."""
        f = self.features(df, text, already_clean)
        p = self.nb.probabilities(F.col(FEATURES))
        names = F.array(*[self.labels.decode(F.lit(c)) for c in self.nb.classes])
        return (f.withColumn("_p", p)
                .withColumn("probability", F.map_from_arrays(names, F.col("_p")))
                .withColumn("confidence", F.array_max("_p"))
                .withColumn("prediction", self.labels.decode(self.nb.predict(F.col(FEATURES))))
                .drop("_p", FEATURES))


@dataclass
class VectorTextClassifier:
    """Fitted vectoriser + a Spark ML classifier on sparse TF-IDF vectors + label map."""

    tfidf: TfidfModel
    model: object
    labels: LabelIndex
    clean: bool = True

    def _scored(self, df: DataFrame, text: str, already_clean: bool) -> DataFrame:
        from reviewlab.operators import trees
        t = F.col(text)
        if self.clean and not already_clean:
            t = tx.clean_text(t)
        v = trees.vectors(df, self.tfidf, tx.vectorizer_tokens(t))
        return self.model.transform(v).drop(trees.FEATURES_VEC)

    def predict(self, df: DataFrame, text: str, out: str = "prediction", already_clean: bool = False) -> DataFrame:
        s = self._scored(df, text, already_clean)
        pid = F.col("prediction").cast("bigint")
        s = s.withColumn("pred_id", pid).drop("prediction", "probability", "rawPrediction")
        return s.withColumn(out, self.labels.decode(F.col("pred_id")))

    def predict_proba(self, df: DataFrame, text: str, already_clean: bool = False) -> DataFrame:
        from reviewlab.operators import trees
        s = self._scored(df, text, already_clean)
        names = F.array(*[F.lit(x) for x in self.labels.labels])
        conf, probs = trees.confidence_columns(s, names)
        return (s.withColumn("confidence", conf).withColumn("probability", probs)
                .withColumn("prediction", self.labels.decode(F.col("prediction").cast("bigint")))
                .drop("rawPrediction"))


@dataclass
class BoostedTextClassifier:
    """Fitted vectoriser + softmax-boosted trees + label map."""

    tfidf: TfidfModel
    boosted: SoftmaxBoostModel
    labels: LabelIndex
    clean: bool = True

    def _weights(self, text: str, already_clean: bool):
        t = F.col(text)
        return self.tfidf.weights(tx.clean_text(t) if self.clean and not already_clean else t)

    def predict(self, df: DataFrame, text: str, out: str = "prediction", already_clean: bool = False) -> DataFrame:
        return (df.withColumn("pred_id", self.boosted.predict(self._weights(text, already_clean)))
                .withColumn(out, self.labels.decode(F.col("pred_id"))))

    def predict_proba(self, df: DataFrame, text: str, already_clean: bool = False) -> DataFrame:
        """Adds ``probability`` (map label -> p), ``confidence`` (max p) and ``prediction``."""
        names = F.array(*[self.labels.decode(F.lit(c)) for c in self.boosted.classes])
        f = df.withColumn("_w", self._weights(text, already_clean)).withColumn("_p", self.boosted.probabilities(F.col("_w")))
        return (f.withColumn("probability", F.map_from_arrays(names, F.col("_p"))).withColumn("confidence", F.array_max("_p"))
                .withColumn("prediction", self.labels.decode(self.boosted.predict(F.col("_w")))).drop("_p", "_w"))


def fit_text_classifier(prep: Prepared, max_features: int = 100, min_df: int = 2,
                        alpha: float = 4.0) -> TextClassifier:
    """Tokenise the training rows once (persisted); the vocabulary and the naive
    Bayes fit both read those tokens."""
    c = prep.cols
    toks = prep.train().select(c.id, LABEL_ID, tx.vectorizer_tokens(F.col(c.text)).alias("_tok")).persist()
    tfidf = fit_tfidf(toks, None, max_features, min_df, tokens="_tok", id_col=c.id)
    feats = toks.select(LABEL_ID, tfidf.weights_from_tokens(F.col("_tok")).alias(FEATURES))
    nb = fit_naive_bayes(feats, LABEL_ID, FEATURES, tfidf, alpha)
    toks.unpersist()
    return TextClassifier(tfidf, nb, prep.labels, clean=True)
