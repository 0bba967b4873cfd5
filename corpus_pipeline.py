"""The training-corpus pipeline: five stages from raw documents to token-id files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
every result as Parquet in the shared folder and reads it back as the next stage's input. All stages but the last
return the columns of ``documents``. A stage first lets go of its predecessor's shuffle files and driver objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlab.llm import decontamination, jaccard_join, language_id, mixing, token_files
from reviewlab.llm.common import let_go, staged, table


LEAST_LANGUAGE = 0.65       # score under which a document's language counts as unknown


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or in no known language: the identifier's best score must reach ``LEAST_LANGUAGE``."""
    return language_id.language_filter(docs, least=LEAST_LANGUAGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by shingle Jaccard of 0.8 or more."""
    let_go(spark)
    return jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    let_go(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out each source's documents to its target weight."""
    let_go(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token-id files and return their digest per document copy."""
    let_go(spark)
    return token_files.token_output(docs)


STAGES = [
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_files", tokens),
]

ORACLE_SQL = None       # language models, BPE and 64-bit hashes are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
