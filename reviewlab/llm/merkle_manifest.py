"""Merkle manifest of a table: a root over all rows, a subroot per source, and a proof for every row.

The digest H of values is the lowercase hex SHA-256 of their concatenation. A row's leaf is H of its fields, each ``-`` if
null, else its UTF-8 byte count, ``:``, and the value. Leaves of one source, in order, are hashed in runs of ``FAN`` until one
node remains, the subroot; the subroots, in order of their sources, make the root the same way.

Levels are climbed with lag and lead. Rows are cut into blocks of ``FAN ** BLOCK_LEVELS`` neighbours, so no window holds
more. At level l a node stands on the row of its first leaf, its neighbours are ``FAN ** l`` rows apart, and lag and lead
columns of these fixed offsets, masked by the node's slot in its run and by the length of the run, give its siblings;
rows that are first children hash their parents. On the way down, lag columns hand each parent's steps to its other children.
A block's top is one row of the next tier, which is climbed alike, until every group has one node.

A proof is the list of (left, right) siblings from leaf to root; ``fold`` hashes a leaf through it.

Defined cases: rows of equal key are ordered by their leaves (whole repeats are interchangeable); null keys come first;
null sources are a group of their own; an empty table gives no rows; columns besides the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import staged
from reviewlab.llm.ranks import positions

FAN = 3
BLOCK_LEVELS = 6            # a block holds FAN ** BLOCK_LEVELS = 729 neighbours
STEPS = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else ``<UTF-8 bytes>:<value>``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*values).cast("binary"), 256)


def leaf_of(values: list[Column]) -> Column:
    return digest(*[encoded(v) for v in values])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` has under ``proof``."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def _either(mask: Column, value: Column) -> Column:
    return F.coalesce(F.when(mask, value), F.lit(""))


def _climb(rows: DataFrame, levels: int) -> DataFrame:
    """Adds ``top``, the hash of the row's block ``levels`` up (on the block's first row), and ``sib0``.. of its nodes."""
    by = Window.partitionBy("grp", "block").orderBy("pos")
    rows = rows.withColumn("top", F.col("node"))
    for level in range(levels):
        step = FAN ** level
        at = rows.select("*", *[F.lead("top", k * step).over(by).alias(f"lead{k}") for k in range(1, FAN)],
                         *[F.lag("top", k * step).over(by).alias(f"lag{k}") for k in range(1, FAN)])
        index = F.floor(F.col("pos") / step)
        nodes = F.ceil(F.col("group_size") / step)
        slot = index % FAN
        run = F.least(F.lit(FAN), nodes - (index - slot))
        here = (F.col("pos") % step == 0) & (nodes > 1)
        left = F.concat(*[_either(slot >= k, F.col(f"lag{k}")) for k in range(FAN - 1, 0, -1)])
        right = F.concat(*[_either(slot + k < run, F.col(f"lead{k}")) for k in range(1, FAN)])
        rows = at.select(*rows.drop("top").columns,
                         F.when(here, F.struct(left.alias("left"), right.alias("right"))).alias(f"sib{level}"),
                         F.when(nodes == 1, F.col("top")).when(here & (slot == 0), digest(F.col("top"), right)).alias("top"))
    return rows


def _steps_down(rows: DataFrame, levels: int) -> DataFrame:
    """Adds ``steps``: every row's siblings up to its block's top."""
    by = Window.partitionBy("grp", "block").orderBy("pos")
    rows = rows.withColumn("steps", F.array().cast(STEPS))
    for level in reversed(range(levels)):
        step = FAN ** level
        slot = F.floor(F.col("pos") / step) % FAN
        above = rows.select("*", *[F.lag("steps", k * step).over(by).alias(f"up{k}") for k in range(1, FAN)])
        parent = F.col("steps")
        for k in range(1, FAN):
            parent = F.when(slot == k, F.col(f"up{k}")).otherwise(parent)
        own = F.when(F.col(f"sib{level}").isNull(), F.array().cast(STEPS)).otherwise(F.array(f"sib{level}"))
        rows = above.select(*rows.drop("steps", f"sib{level}").columns,
                            F.when(F.col("pos") % step == 0, F.concat(own, parent)).alias("steps"))
    return rows


def _tiers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """``nodes`` (grp, pos, group_size, node and more) and the tiers above it; the last one has a row per group.

    A tier above the first has 1/729 of the rows below it and is written to the shared folder."""
    size = FAN ** BLOCK_LEVELS
    block = F.floor(F.col("pos") / size)
    tiers = [nodes.withColumn("block", block)]
    while True:
        tops = _climb(tiers[-1].select("grp", "pos", "group_size", "block", "node"), BLOCK_LEVELS).where(F.col("pos") % size == 0)
        tops = staged(tops.select("grp", F.col("block").alias("pos"), F.ceil(F.col("group_size") / size).alias("group_size"),
                                  F.col("top").alias("node")), name)
        tiers.append(tops.withColumn("block", block))
        if (tops.agg(F.max("group_size")).first()[0] or 1) == 1:
            return tiers


def _proofs(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first tier's rows with ``proof`` and the columns of ``above`` (grp, block, further, ...), one row per group."""
    rest = [c for c in above.columns if c not in ("grp", "block", "further")]
    for n, tier in reversed(list(enumerate(tiers[:-1]))):
        rows = _steps_down(_climb(tier, BLOCK_LEVELS), BLOCK_LEVELS).drop("top")
        rows = rows.join(above, ["grp", "block"]).withColumn("proof", F.concat("steps", "further"))
        if n == 0:
            return rows.drop("steps", "further", "block", "pos", "group_size", "node")
        above = rows.select("grp", F.col("pos").alias("block"), F.col("proof").alias("further"), *rest)


def manifest(rows: DataFrame, source: str, key: str, leaf: str) -> DataFrame:
    """``rows`` with ``subroot`` and ``root`` digests and their ``proof``; ``leaf`` names the column of leaf digests.

    Columns of ``rows`` must not use the names made here (grp, node, pos, group_size, block, steps, proof, subroot, root)."""
    top = F.array().cast(STEPS)
    grouped = rows.withColumn("grp", encoded(F.col(source))).withColumn("node", F.col(leaf))
    tiers = _tiers(positions(grouped, "grp", [F.col(key), F.col(leaf)], "manifest-leaves"), "manifest-tier")
    subroots = tiers[-1].select(F.col("grp").alias("of"), "node", F.lit("all").alias("grp"),
                                F.when(F.col("grp") != "-", F.regexp_replace("grp", r"^\d+:", "")).alias("source"))
    upper = _tiers(positions(subroots, "grp", [F.col("source")], "manifest-subroots"), "manifest-upper")
    root = upper[-1].select("grp", "block", top.alias("further"), F.col("node").alias("root"))
    above = _proofs([upper[0].withColumn("subroot", F.col("node")), *upper[1:]], root)
    above = above.select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("block"), F.col("proof").alias("further"), "subroot", "root")
    return _proofs(tiers, above).drop("grp")


def tampered_leaves(docs: DataFrame, fields: list[str], key: str, text: str) -> DataFrame:
    """(key, source, leaf, altered): ``altered`` is the leaf of the row without its line feeds where crc32(key) is even."""
    changed = {text: F.replace(F.col(text), F.lit("\n"), F.lit(""))}
    even = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    return docs.select(F.col(key), F.col("source"), leaf_of([F.col(f) for f in fields]).alias("leaf"),
                       F.when(even, leaf_of([changed.get(f, F.col(f)) for f in fields])).alias("altered"))


def audit(docs: DataFrame) -> DataFrame:
    """Per document its leaf, subroot, root, proof digest, and what its (partly tampered) leaf folds to."""
    leaves = tampered_leaves(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "text")
    signed = manifest(leaves, "source", "doc_id", "leaf")
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    signed = signed.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("proof")))
    return signed.select("doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
