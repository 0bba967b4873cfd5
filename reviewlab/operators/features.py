"""Training features: label encoding, stratified hold-out split, TF-IDF vocabulary and weights.

Fitting aggregates over the training rows (shuffles on term); the fitted model
(at most ``max_features`` terms) is held on the driver like any Spark ML model,
and transforming a document is a per-row expression: no join, no shuffle.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlab.functions import text as tx
from reviewlab.operators.select import below, hash_thresholds

TFIDF_TYPE = "array<struct<term:string,weight:double,code:int>>"
LOOKUP_TERMS = 1 << 17      # a dictionary of more terms is joined instead of travelling with the plan


# ---------------------------------------------------------------- dictionaries
def literal(values, schema: str) -> Column:
    """``values`` as one constant array: parsed once when the plan is optimised, read by position after that."""
    return F.from_json(F.lit(json.dumps(values)), schema)


class TermCodes:
    """Term -> code (its position) by a hash table that is one constant array of buckets.

    A lookup is a checksum, one positional read and a scan of a bucket of about one term, whatever the number of terms."""

    def __init__(self, terms: Sequence[str]):
        if len(terms) > LOOKUP_TERMS:
            raise ValueError(f"{len(terms)} terms are too many for a lookup table ({LOOKUP_TERMS}); join them instead")
        self.buckets = max(1, 2 * len(terms))
        table: list[list[dict]] = [[] for _ in range(self.buckets)]
        for code, term in enumerate(terms):
            table[zlib.crc32(term.encode()) % self.buckets].append({"t": term, "c": code})
        self.table = literal(table, "array<array<struct<t:string,c:int>>>")

    def code(self, term: Column) -> Column:
        """The term's code, null for other terms."""
        slot = (F.crc32(term.cast("binary")) % self.buckets + 1).cast("int")
        return F.get(F.filter(F.element_at(self.table, slot), lambda e: e["t"] == term), 0)["c"]


# ---------------------------------------------------------------- labels
@dataclass(frozen=True)
class LabelIndex:
    """Sorted distinct labels; a label's id is its position (like a label encoder)."""

    labels: tuple[str, ...]

    def encode(self, label: Column) -> Column:
        pos = F.array_position(F.array(*[F.lit(x) for x in self.labels]), label)
        return F.when(pos > 0, pos - 1).cast("bigint")

    def decode(self, label_id: Column) -> Column:
        """Id -> label; an id without a label keeps its own text."""
        name = F.try_element_at(F.array(*[F.lit(x) for x in self.labels]), (label_id + 1).cast("int"))
        return F.coalesce(name, label_id.cast("string"))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.labels)), "label_id bigint, label string")


def fit_label_index(df: DataFrame, label: str) -> LabelIndex:
    """The distinct labels, sorted (one driver value per class of the classifier)."""
    rows = df.select(label).filter(F.col(label).isNotNull()).distinct().collect()
    return LabelIndex(tuple(sorted(r[0] for r in rows)))


def label_map_frame(df: DataFrame, label: str) -> DataFrame:
    """Label map as a DataFrame without collecting: dense rank over distinct labels."""
    d = df.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct()
    return d.select((F.dense_rank().over(Window.orderBy("label")) - 1).cast("bigint").alias("label_id"), "label")


# ---------------------------------------------------------------- split
def stratified_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
                     seed: int = 42, bucket_hex: int = 4, out: str = "split") -> DataFrame:
    """Exact, repeatable stratified hold-out: per label, the round(test_size * n) rows
    with the smallest md5(id || ':' || seed) go to 'val', the rest to 'train'.

    The hash at which each label is cut is found by counting hash prefixes (``bucket_hex`` hex digits a round) over ids and
    labels alone; a row is then labelled by comparing its own hash, so no other column is moved. Rows of one id
    stay on one side.
    """
    mark = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    cuts = hash_thresholds(df, label, mark, test_size, bucket_hex)
    return df.withColumn(out, F.when(below(df, label, mark, cuts), "val").otherwise("train"))


# ---------------------------------------------------------------- tf-idf
def doc_terms(text: Column) -> Column:
    """Uni- and bigrams of the vectoriser tokens of a text."""
    return tx.word_ngrams(tx.vectorizer_tokens(text))


@dataclass(frozen=True)
class TfidfModel:
    """Fitted vocabulary (sorted) with smoothed idf = ln((1 + n) / (1 + df)) + 1."""

    terms: tuple[str, ...]
    doc_freq: tuple[int, ...]
    n_docs: int

    @property
    def idf(self) -> tuple[float, ...]:
        return tuple(math.log((1 + self.n_docs) / (1 + d)) + 1.0 for d in self.doc_freq)

    def weights(self, text: Column) -> Column:
        """L2-normalised tf*idf of the vocabulary terms of one text -> array<struct<term, weight>>."""
        return self.weights_from_tokens(tx.vectorizer_tokens(text))

    @cached_property
    def codes(self) -> TermCodes:
        return TermCodes(self.terms)

    def weights_from_tokens(self, tokens: Column) -> Column:
        """As ``weights``, of an array of tokens. Entries are in code (and term) order."""
        found = F.filter(F.transform(tx.word_ngrams(tokens), self.codes.code), lambda c: c.isNotNull())
        return self._weighted(tx.term_counts(found, "int"), literal(self.idf, "array<double>"))

    def _weighted(self, counts: Column, idf: Column) -> Column:
        terms = literal(self.terms, "array<string>")

        def normalise(raw):
            norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda acc, x: acc + x["weight"] * x["weight"]))
            return tx.let(norm, lambda nrm: F.transform(raw, lambda x: F.struct(
                F.element_at(terms, x["code"] + 1).alias("term"), (x["weight"] / nrm).alias("weight"), x["code"].alias("code"))))

        raw = F.transform(counts, lambda x: F.struct(
            x["term"].alias("code"), (x["tf"] * F.element_at(idf, x["term"] + 1)).alias("weight")))
        return tx.let(raw, normalise).cast(TFIDF_TYPE)

    def weights_by_join(self, df: DataFrame, id_col: str, tokens: str, out: str) -> DataFrame:
        """``df`` with its weights in column ``out``, for a vocabulary beyond ``LOOKUP_TERMS``: the terms of each row (counted
        inside it) are joined to the dictionary on the term and gathered again by ``id_col`` (unique); Spark chooses the join."""
        rows = [(t, i, float(w)) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        dictionary = df.sparkSession.createDataFrame(rows, "term string, code int, idf double")
        entries = (df.select(id_col, F.inline(tx.term_counts(tx.word_ngrams(F.col(tokens))))).join(dictionary, "term")
                   .groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("code", "term", (F.col("tf") * F.col("idf")).alias("w")))).alias("_e"),
                                        F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("_n"))
                   .select(id_col, F.transform("_e", lambda x: F.struct(
                       x["term"].alias("term"), (x["w"] / F.col("_n")).alias("weight"), x["code"].alias("code"))).cast(TFIDF_TYPE).alias(out)))
        return df.join(entries, id_col, "left").withColumn(out, F.coalesce(out, F.array().cast(TFIDF_TYPE)))

    def dense(self, weights: Column) -> Column:
        """Dense array<double> in vocabulary order (for vector-based estimators)."""
        pairs = F.transform(weights, lambda x: F.struct(x["code"], x["weight"]))
        return tx.let(F.map_from_entries(pairs), lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(len(self.terms) - 1)) if self.terms else F.array().cast("array<int>"),
            lambda c: F.coalesce(F.element_at(m, c), F.lit(0.0))))

    def vocabulary_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(t, int(d), float(i)) for t, d, i in zip(self.terms, self.doc_freq, self.idf)]
        return spark.createDataFrame(rows, "term string, doc_freq bigint, idf double")


def term_doc_stats(df: DataFrame, terms: Column) -> DataFrame:
    """(term, doc_freq, term_freq) of an array-of-terms column: one shuffle on term.

    Term frequency counts every element, document frequency every distinct
    element of a row (native ``array_distinct``); both streams go through one
    aggregation, partially aggregated map-side, so hot terms collapse before
    the shuffle and no (document, term) pairs are shuffled.
    """
    arr = df.select(terms.alias("_t"))
    every = arr.select(F.explode("_t").alias("term"), F.lit(1).alias("_tf"), F.lit(0).alias("_df"))
    once = arr.select(F.explode(F.array_distinct("_t")).alias("term"), F.lit(0).alias("_tf"), F.lit(1).alias("_df"))
    return every.unionByName(once).groupBy("term").agg(
        F.sum("_df").cast("bigint").alias("doc_freq"), F.sum("_tf").cast("bigint").alias("term_freq"))


def vocabulary_counts(docs: DataFrame, text: str) -> DataFrame:
    """(term, doc_freq, term_freq) over all uni/bigrams of the documents."""
    return term_doc_stats(docs, doc_terms(F.col(text)))


def _top(stats: DataFrame, max_features: int, min_df: int) -> DataFrame:
    return (stats.filter(F.col("doc_freq") >= min_df)
            .orderBy(F.desc("term_freq"), F.asc("term")).limit(max_features))


def vocabulary_frame(docs: DataFrame, text: str, max_features: int = 100, min_df: int = 2) -> DataFrame:
    """Top ``max_features`` terms by total count among terms in >= ``min_df`` documents."""
    return _top(vocabulary_counts(docs, text), max_features, min_df)


def _counted(docs: DataFrame, counts: Column) -> DataFrame:
    """(term, doc_freq, term_freq) from one array<struct<term, tf>> per document: one explode, one shuffle on term."""
    return _per_term(docs.select(F.inline(counts)))


def _per_term(counted: DataFrame) -> DataFrame:
    return (counted.groupBy("term")
            .agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").cast("bigint").alias("term_freq")))


def _frequent_bigrams(tokens: Column, frequent: TermCodes) -> Column:
    """Space-joined neighbours that are both in ``frequent``."""
    def pairs(toks):
        known = F.transform(toks, lambda w: frequent.code(w).isNotNull())
        joined = tx.let(known, lambda k: F.transform(
            F.slice(toks, 2, F.greatest(F.size(toks), F.lit(0))),
            lambda nxt, i: F.when(F.get(k, i) & F.get(k, i + 1), F.concat(F.get(toks, i), F.lit(" "), nxt))))
        return F.filter(joined, lambda x: x.isNotNull())
    return tx.let(tokens, pairs)


def fit_vocabulary(docs: DataFrame, text: str | None, max_features: int = 100, min_df: int = 2,
                   tokens: str | None = None, id_col: str | None = None, lookup_terms: int = LOOKUP_TERMS) -> list:
    """Exact top-``max_features`` vocabulary with bigram pruning.

    A bigram occurs at most as often as each of its words. Let T1 be the
    ``max_features``-th best unigram count (among unigrams in >= min_df docs);
    the final cut-off is >= T1, so only bigrams of two words that both occur >= T1
    times can qualify. Unigrams are counted first; other bigrams are then dropped inside
    each document's row by a lookup of the frequent words, before anything is aggregated.
    Where more than ``lookup_terms`` words are frequent, each document's counted bigrams are semi-joined to them instead.
    """
    if tokens is None:
        toks = docs.select(tx.vectorizer_tokens(F.col(text)).alias("t")).persist()   # two passes
    else:
        toks = docs.select(F.col(tokens).alias("t"))
    uni = _counted(toks, tx.term_counts(F.col("t"))).persist()
    top_uni = _top(uni, max_features, min_df).collect()
    t1 = min((r["term_freq"] for r in top_uni), default=0) if len(top_uni) >= max_features else 0
    frequent = uni.filter(F.col("term_freq") >= t1).select("term")
    few = frequent.limit(lookup_terms + 1).collect() if t1 > 0 else []
    if t1 > 0 and len(few) <= lookup_terms:
        bi = _counted(toks, tx.term_counts(_frequent_bigrams(F.col("t"), TermCodes(sorted(r[0] for r in few)))))
    else:
        bigrams = F.slice(tx.word_ngrams(F.col("t")), F.size("t") + 1, F.greatest(F.size("t"), F.lit(1)))
        pairs = toks.select(F.inline(tx.term_counts(bigrams)))
        if t1 > 0:
            word = lambda i: F.element_at(F.split("term", " "), i)
            pairs = (pairs.withColumn("a", word(1)).withColumn("b", word(2))
                     .join(frequent.withColumnRenamed("term", "a"), "a", "left_semi")
                     .join(frequent.withColumnRenamed("term", "b"), "b", "left_semi").select("term", "tf"))
        bi = _per_term(pairs)
    rows = _top(uni.unionByName(bi), max_features, min_df).collect()
    uni.unpersist()
    if tokens is None:
        toks.unpersist()
    return rows


def fit_tfidf(docs: DataFrame, text: str | None, max_features: int = 100, min_df: int = 2,
              tokens: str | None = None, id_col: str | None = None) -> TfidfModel:
    """Fit on documents given as text, or as an already tokenised column ``tokens``;
    ``id_col`` (unique document key) enables the pruned bigram count."""
    n_docs = docs.count()
    rows = fit_vocabulary(docs, text, max_features, min_df, tokens=tokens, id_col=id_col)   # <= max_features rows
    rows = sorted(rows, key=lambda r: r["term"])
    return TfidfModel(tuple(r["term"] for r in rows), tuple(int(r["doc_freq"]) for r in rows), int(n_docs))
