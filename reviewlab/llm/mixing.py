"""Mixing sources to target weights by temperature.

A source's share p of all words becomes the weight p**t / sum(p**t). The exponent t in [0, 1] is the smallest whose
entropy is at most ``entropy`` x ln(sources) and under which no source is repeated more than ``repeats``
times; it is found by bisection on interval sums that Spark computes for many exponents at once. (Smaller t
flattens the mix: entropy and the repetition of small sources both fall as t grows.)

A source with weight w gets a target of w x budget words (by default the smallest budget that takes every document at
least once, so flattening repeats small sources and drops nothing), realised as whole passes over its documents and a part of
one more pass. A pass is a permutation of the source's blocks, and inside them of its documents, by a hash of the
pass's number: the last pass takes whole blocks while they fit the rest of the target, then the documents of the
next block in their order while they fit. Block sums are one small table; only one block of each source is ranked by document,
and the decision itself is a filter on each row, so a source with a third of all rows is split like any other.

Defined cases: null is a source of its own; empty and null texts have no words, and a source without words keeps each
document once; repeated rows are separate documents; an empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import staged

ENTROPY = 0.95        # largest share of the entropy of equal weights
REPEATS = 4.0         # largest number of passes over any source
BLOCKS = 256          # blocks of a source
POINTS, ROUNDS = 33, 6


def _hash(*parts):
    """A 60-bit number from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def sources(docs: DataFrame) -> DataFrame:
    """(key, source, words, docs) of every source; ``key`` is never null."""
    return (docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("words"), F.count("*").alias("docs"))
            .select(_key().alias("key"), "source", "words", "docs"))


def _key():
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("null"))


def exponent(table: DataFrame, budget: float | None, total: float, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The smallest exponent in [0, 1] that meets both limits (1, the given shares, if none does)."""
    used = table.where("words > 0").select((F.col("words") / total).alias("p"))
    count = used.count()
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / (POINTS - 1) for i in range(POINTS)]
        sums = (used.select("p", F.explode(F.array(*[F.lit(t) for t in grid])).alias("t"))
                .groupBy("t").agg(F.sum(F.pow("p", "t")).alias("z"), F.sum(F.pow("p", "t") * F.log("p")).alias("e"), F.min("p").alias("least"), F.max("p").alias("most"))
                .select("t", (F.log("z") - F.col("t") * F.col("e") / F.col("z")).alias("entropy"),
                        (F.pow(F.col("least") / F.col("most"), F.col("t") - 1) if budget is None
                         else F.pow("least", F.col("t") - 1) / F.col("z") * budget / total).alias("repeats")).collect())
        ok = {r.t: r.entropy <= entropy * math.log(count) + 1e-12 and r.repeats <= repeats + 1e-12 for r in sums}
        at = next((i for i, t in enumerate(grid) if ok.get(t)), None)
        if at is None:
            return 1.0
        if at == 0:
            return grid[0]
        low, high = grid[at - 1], grid[at]
    return high


def plan(docs: DataFrame, budget: float | None = None, entropy: float = ENTROPY, repeats: float = REPEATS) -> DataFrame:
    """One row per source: key, source, words, share, weight, target, whole passes, and the cut of the last pass.

    ``cut_block`` is the rank hash of the block where the last pass ends (blocks before it are taken whole) and
    ``cut_doc`` the largest document hash taken inside it."""
    table = staged(sources(docs), "mix-sources")
    total = table.agg(F.sum("words")).first()[0] or 0
    if not total:
        return table.select("key", "source", "words", F.lit(0.0).alias("share"), F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("target"),
                            F.lit(1).cast("long").alias("passes"), F.lit(-1).cast("long").alias("cut_block"), F.lit(-1).cast("long").alias("cut_doc"))
    t = exponent(table, budget, total, entropy, repeats)
    share = F.col("words") / total
    raised = F.when(F.col("words") > 0, F.pow(share, F.lit(t))).otherwise(0.0)
    z = table.agg(F.sum(raised)).first()[0]
    weight = raised / z
    whole = budget is None
    if whole:       # the budget that takes the most over-represented source once
        budget = total * table.where("words > 0").agg(F.max(share / weight)).first()[0]
    target = F.floor(F.col("weight") * float(budget)).cast("long")
    table = (table.withColumn("share", share).withColumn("weight", weight)
             .withColumn("target", F.greatest(target, F.col("words")) if whole else target)
             .withColumn("passes", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(1).cast("long"))
             .withColumn("rest", F.when(F.col("words") > 0, F.col("target") - F.col("passes") * F.col("words")).otherwise(0)))
    table = staged(table, "mix-targets")
    rows = keyed(docs, table).select("key", "block", "turn", "words", "passes", "rest", "ticket")
    rows = staged(rows, "mix-rows")
    blocks = rows.groupBy("key", "turn", "rest").agg(F.sum("words").alias("words"))
    before = Window.partitionBy("key").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = blocks.withColumn("upto", F.sum("words").over(before)).where("upto > rest")
    cut = ends.groupBy("key").agg(F.min_by(F.struct("turn", (F.col("rest") - F.col("upto") + F.col("words")).alias("left")), "turn").alias("c")) \
        .select("key", F.col("c.turn").alias("cut_block"), F.col("c.left").alias("left"))
    inside = rows.join(cut, "key").where("turn = cut_block")
    by = Window.partitionBy("key").orderBy("ticket").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (inside.withColumn("upto", F.sum("words").over(by)).where("upto <= left")
            .groupBy("key").agg(F.max("ticket").alias("cut_doc")))
    return (table.join(cut.select("key", "cut_block"), "key", "left").join(last, "key", "left")
            .select("key", "source", "words", "share", "weight", "target", "passes",
                    F.coalesce("cut_block", F.lit(-1)).alias("cut_block"), F.coalesce("cut_doc", F.lit(-1)).alias("cut_doc")))


def keyed(docs: DataFrame, table: DataFrame) -> DataFrame:
    """Documents (struct ``row``) with their source's line of ``table``, their words, and their place in its last pass:
    block, the block's rank hash ``turn`` and the document's hash ``ticket``. Rows of one doc_id share their place."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(_key().alias("key"), word_count(F.col("text")).alias("words"),
                      F.coalesce(F.col("doc_id").cast("string"), F.md5(text)).alias("name"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = own.join(table.drop("source", "words"), "key").withColumn("pass_key", F.col("passes").cast("string"))
    own = own.withColumn("block", _hash("name") % BLOCKS)
    return (own.withColumn("turn", _hash("key", "pass_key", F.col("block").cast("string")))
            .withColumn("ticket", _hash("pass_key", "name")).drop("pass_key", "name"))


def mixed(docs: DataFrame, table: DataFrame) -> DataFrame:
    """Every taken copy: row (the document), key, words, weight, copy (its pass, from 0), turn and ticket."""
    last = (F.col("turn") < F.col("cut_block")) | ((F.col("turn") == F.col("cut_block")) & (F.col("ticket") <= F.col("cut_doc")))
    copies = F.col("passes") + F.when((F.col("words") > 0) & last | (F.col("words") == 0) & (F.col("passes") == 0), 1).otherwise(0)
    rows = keyed(docs, table).withColumn("copies", copies).where("copies > 0")
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .select("row", "key", "words", "weight", "copy", "turn", "ticket"))


def mix(docs: DataFrame, budget: float | None = None) -> DataFrame:
    """Pipeline stage: the mixed corpus, a row for every taken copy; columns stay."""
    return mixed(docs, staged(plan(docs, budget), "mix-plan")).select("row.*")


def sample(docs: DataFrame, budget: float | None = None) -> DataFrame:
    """doc_id, source, copy, n_words, weight and the place (pass, block turn, ticket) of every taken copy."""
    slim = docs.select("doc_id", "source", "text")
    out = mixed(slim, staged(plan(slim, budget), "mix-plan"))
    return out.select("row.doc_id", "row.source", "copy", F.col("words").alias("n_words"), "weight", "turn", "ticket")
