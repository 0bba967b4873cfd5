"""Connected components of an edge table by alternating large-star and small-star steps.

Each step groups by one end with a map-side minimum and joins back, so a vertex with very many links is split by
the adaptive skew join; nothing is collected but two numbers per round. The rounds needed grow with the
logarithm of the longest path. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    u, v = F.col("u"), F.col("v")
    both = edges.select("u", "v").union(edges.select(v.alias("u"), u.alias("v"))) if large else \
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    linked = both.join(low, both.u == low.c)
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex reachable from every vertex that has a link.

    ``edges`` has long columns u, v in any direction, repeats and loops allowed; no edges give no rows."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        now = staged(_star(_star(now, True), False), "cc-edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
