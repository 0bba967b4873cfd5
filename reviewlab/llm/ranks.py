"""Consecutive positions of rows inside their group, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import staged

SLOT_BITS = 33              # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def _taken(df: DataFrame, *names: str) -> None:
    clash = [n for n in names if n in df.columns]
    if clash:
        raise ValueError(f"columns {clash} are made here; rename them")


def positions(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0) and ``group_size`` inside each value of ``group`` (never null), ordered by ``order``.

    The rows are range-partitioned by group and order, sorted and written once, so a group of any size is spread over
    partitions and a re-run task finds the same order. A partition's part of a group starts where the parts before it
    end: one small row per (group, partition) carries that start. Rows equal in all of ``order`` may stand either way.
    """
    _taken(rows, "pos", "group_size", "at", "part")
    keys = [F.col(group), *order]
    at = staged(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .withColumn("at", F.monotonically_increasing_id()), name)
    at = at.withColumn("part", F.shiftright("at", SLOT_BITS))
    spans = at.groupBy(group, "part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(group)                         # one row per partition that holds the group
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(group, "part", "first_at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.sum("n").over(whole).alias("group_size"))
    return at.join(spans, [group, "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first_at")).drop(
        "at", "part", "first_at", "before")
