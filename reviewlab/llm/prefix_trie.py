"""Prefix trie of conversations by van Emde Boas recursion.

Every conversation is a sequence of turns; every distinct sequence of first d turns is a node of depth d. Depths are cut in
half again and again at fixed places (a cut at depth m has the lowest set bit of m as its half height):

1. Bottom up, digests of aligned runs of 1, 2, 4, ... turns are made from their two halves.
2. Top down, cut prefixes get names: the prefix that ends at a cut is named by the digest of the name at the cut above and of the
   run between both. One round names the cuts of all upper tries and lower forests of that height at once; after the last
   round (height 1) every prefix of every conversation has a name, equal exactly for equal sequences.
3. Members are counted per name, which gives the nodes.
4. Totals are grafted upward: in round k the lower forests of height 2^k are done, each of their roots adds its total to its 2^k
   ancestors in the upper trie, whose names are those of its smallest member.

So D levels take log2(D) rounds, each a join on (conversation, depth), which no group of copies can crowd, and an aggregate with
map-side sums. Rounds are written to the shared folder. Nothing holds a whole conversation; a parent with very many children
is looked up with a salt. The digest of a node's own conversations needs their ids in one order: they are packed per 4096
ids, and one task streams the packs of a node (SHA-256 cannot be split), holding one pack at a time.

Defined cases: null role or text is empty; null turns come first, equal turns are ordered by role and then by the digest of role and
text; repeated rows are turns of their own; rows without conv_id belong to no conversation and are left out; an empty table
gives no rows; other columns are ignored. ``%`` of a negative conv_id keeps its sign, as in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import importable, staged
from reviewlab.llm.ranks import positions

WORDS = r"[^\x20\x09-\x0D]+"
HEAVY = 4096                # a parent with more children is looked up with a salt
SALTS = 64
PACK_BITS = 12              # conversation ids packed together: 2^12


def _name(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, pos from 0, group_size, turn digest, words) of every turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = _name(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").alias("conv"), "turn", role.alias("role"), digest.alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))).cast("long").alias("words"))
    ranked = positions(rows, "conv", [F.col("turn"), F.col("role"), F.col("digest")], "trie-turns")
    return ranked.select("conv", "pos", "group_size", "digest", "words")


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, words) of the rebuilt conversations, and (conv, length).

    Conversation c starts with the first h turns of c - c % family (h = crc32(c) % most) and goes on with its own after h."""
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.where("pos = 0").select("conv", F.col("group_size").alias("size"), share.alias("h"),
                                          (F.col("conv") - F.col("conv") % family).alias("base"))
    sizes = convs.where("conv = base").select(F.col("base"), F.col("size").alias("base_size"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0)))).drop("base_size")
    heads = turns.where((F.col("pos") < most) & (F.col("conv") % family == 0)).select(
        F.col("conv").alias("base"), "pos", "digest", "words")
    first = convs.where("taken > 0").select("conv", "base", "taken").join(heads, "base").where("pos < taken").select(
        "conv", (F.col("pos") + 1).alias("depth"), "digest", "words")
    rest = turns.where(F.col("pos") >= share).join(convs.select("conv", "h", "taken"), "conv").select(
        "conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "words")
    lengths = convs.select("conv", (F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length"))
    return first.unionByName(rest), lengths


def _low_bit(depth: Column) -> Column:
    return depth.bitwiseAND(-depth)


def named_prefixes(rows: DataFrame, convs: DataFrame, rounds: int) -> DataFrame:
    """(conv, depth, name) of every prefix, the empty one included; ``rows``: (conv, depth from 1, digest)."""
    runs = [rows.select("conv", (F.col("depth") - 1).alias("start"), "digest")]
    for k in range(1, rounds):
        # two halves make a run of 2^k turns; a conversation's incomplete last run has no cut at its end
        half = F.shiftright("start", k - 1).bitwiseAND(F.lit(1))
        whole = runs[-1].groupBy("conv", F.shiftleft(F.shiftright("start", k), k).alias("start")).agg(
            F.max(F.when(half == 0, F.col("digest"))).alias("a"), F.max(F.when(half == 1, F.col("digest"))).alias("b"))
        runs.append(staged(whole.where("a IS NOT NULL AND b IS NOT NULL").select("conv", "start", _name("a", "b").alias("digest")), "trie-runs"))
    names = [convs.select("conv", F.lit(0).cast("long").alias("depth"), _name(F.lit(b"root")).alias("name"))]
    for k in reversed(range(rounds)):
        known = _union(names).withColumnRenamed("depth", "start")
        below = runs[k].where(F.shiftright("start", k).bitwiseAND(F.lit(1)) == 0)
        names.append(staged(known.join(below, ["conv", "start"]).select(
            "conv", (F.col("start") + (1 << k)).alias("depth"), _name("name", "digest").alias("name")), "trie-names"))
    return _union(names)


def grafted(prefixes: DataFrame, nodes: DataFrame, values: list[str], rounds: int) -> DataFrame:
    """(name, *values): what each node's descendants add to it; ``nodes``: (name, conv, depth, *values)."""
    done: list[DataFrame] = []
    sums = [F.sum(v).alias(v) for v in values]
    for k in range(rounds):
        cut = nodes.where(_low_bit(F.col("depth")) == (1 << k)).select("name", "conv", "depth", *values)
        if done:
            # a root of a forest of height 2^k has got all that its descendants add to it in the rounds before
            late = _union(done).where(_low_bit(F.col("depth")) == (1 << k)).groupBy("name").agg(*[F.sum(v).alias(f"late_{v}") for v in values])
            cut = cut.join(late, "name", "left").select(
                "conv", "depth", *[(F.col(v) + F.coalesce(f"late_{v}", F.lit(0))).alias(v) for v in values])
        block = F.shiftright("depth", k)
        upper = prefixes.where(block.bitwiseAND(F.lit(1)) == 0).select(
            "conv", "name", F.col("depth").alias("at"), F.shiftleft(block + 1, k).alias("depth"))
        done.append(staged(upper.join(cut.select("conv", "depth", *values), ["conv", "depth"])
                           .groupBy("name", F.col("at").alias("depth")).agg(*sums), "trie-grafts"))
    if not done:
        return nodes.select("name", *values).limit(0)
    return _union(done).groupBy("name").agg(*sums)


def _of_parent(children: DataFrame, parents: DataFrame) -> DataFrame:
    """``children`` (parent, ...) with ``parent_conv``; ``parents``: (name, conv, n_children)."""
    salt = F.pmod(F.xxhash64("name"), F.lit(SALTS))
    heavy = parents.where(F.col("n_children") > HEAVY).select(
        F.col("name").alias("parent"), F.col("conv").alias("parent_conv"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    light = parents.where(F.col("n_children").between(1, HEAVY)).select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv"))
    first = staged(children.withColumn("salt", salt.cast("int")).join(heavy, ["parent", "salt"], "left").drop("salt"), "trie-children")
    rest = first.where("parent_conv IS NULL").drop("parent_conv").join(light, "parent", "left")
    return first.where("parent_conv IS NOT NULL").unionByName(rest)


def _ends(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256): digest of the comma-joined ids of the conversations that end at each node; ``ends``: (name, conv)."""
    packs = ends.groupBy("name", F.shiftright("conv", PACK_BITS).alias("pack")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for name, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if name == held:
                    state.update(b",")
                else:
                    if held is not None:
                        done.append((held, state.hexdigest()))
                    held, state = name, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["name", "ends_sha256"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])
    importable(ends.sparkSession)
    return packs.repartition("name").sortWithinPartitions("name", "pack").mapInArrow(run, "name binary, ends_sha256 string")


def trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv, depth from 1, digest, words) and ``lengths`` (conv, length; all conversations)."""
    rows, lengths = staged(rows, "trie-rows"), staged(lengths, "trie-lengths")
    rounds = int(lengths.agg(F.max("length")).first()[0] or 0).bit_length()
    names = named_prefixes(rows, lengths, rounds)
    words = rows.select("conv", "depth", "words").unionByName(
        lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words")))
    prefixes = staged(names.join(words, ["conv", "depth"]), "trie-prefixes")
    nodes = prefixes.groupBy("name").agg(F.min("conv").alias("conv"), F.max("depth").alias("depth"),
                                         F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    above = prefixes.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = staged(nodes.join(above, ["conv", "depth"], "left"), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = staged(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-nodes")
    below = grafted(prefixes.select("conv", "depth", "name"), nodes, ["leaves", "saved"], rounds).select(
        "name", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    last = prefixes.select("conv", "depth", "name").join(lengths.withColumnRenamed("length", "depth"), ["conv", "depth"])
    out = _of_parent(nodes, nodes.select("name", "conv", "n_children"))
    out = out.join(below, "name", "left").join(_ends(last.select("name", "conv")), "name", "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    return trie(*rebuilt(turns_of(conversations)))
