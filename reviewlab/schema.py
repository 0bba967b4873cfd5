"""Column roles and run-time guards (required columns, non-empty input)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Cols:
    """Names of the review table's columns; every operator takes one of these."""

    text: str = "review_text"
    label: str = "sentiment"
    brand: str = "brand"
    rating: str = "rating"
    id: str = "review_id"
    length: str = "text_length_chars"


DEFAULT = Cols()

# Explicit schema for review CSV uploads: the four known columns; rating stays a
# string so unparseable values can be coerced to null instead of failing the read.
REVIEW_SCHEMA = T.StructType([
    T.StructField("review_text", T.StringType(), True),
    T.StructField("sentiment", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("rating", T.StringType(), True),
])


def ensure_columns(df: DataFrame, required: list[str]) -> None:
    """Raise with the list of missing columns (checked on the plan, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Required columns missing: {missing}")


def ensure_not_empty(df: DataFrame, what: str = "input") -> None:
    """Raise when the frame has no rows (a limit-1 job)."""
    if df.isEmpty():
        raise ValueError(f"Input dataframe is empty. Cannot run {what}.")
