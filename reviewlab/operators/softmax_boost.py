"""Multiclass boosted trees on the softmax loss (second order), fitted from gradient histograms.

Every round grows one tree per class on the gradients of the multinomial log loss, g = p - y and h = 2 p (1 - p), of the rows drawn
for that round. A level of all the round's trees is one aggregate: sums of g and h per (class, node, feature, bin), made map-side
first; only non-zero features are counted, and a feature's zeros are what its node has beyond them. The best split of a node
(largest gain; ties to the smaller feature, then bin) is picked in Spark too, so the driver sees at most classes x nodes
rows a level. Rows find their node by walking the trees grown so far, which are small constants of the plan: nothing but
histograms is shuffled.

A round whose drawn rows have at most ``LOCAL_ENTRIES`` entries is grown by one task per class instead, level by level in numpy
with the same sums, candidates and ties, so it gives the same trees without a job per level.

Gradients are summed as whole numbers of 2**-24, so sums do not depend on the order of rows or tasks. Features are TF-IDF
weights in (0, 1], cut into ``bins`` equal steps; bin 0 is an absent term. A split sends bins up to its own to the left.
Rows are drawn by a hash of their id and the round. The rows with their margins are written to the shared folder after each
round, so plans stay short and a lost executor costs no more than its tasks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlab.functions.text import let
from reviewlab.operators.features import literal
from reviewlab.session import written

SCALE = 1 << 24
BINNED = "array<struct<f:int,b:int>>"
NODES = "array<struct<f:int,b:int,v:double>>"
LEAST_GAIN = 1e-6
LOCAL_ENTRIES = 1 << 22     # entries (feature values) that one task may hold


@dataclass(frozen=True)
class BoostParams:
    step: float = 0.01
    rounds: int = 10
    max_depth: int = 6
    subsample: float = 0.5
    reg_lambda: float = 1.0
    min_child: float = 1.0      # least sum of h in a child
    bins: int = 64
    seed: int = 42


def binned(weights: Column, bins: int) -> Column:
    """Non-zero features as (f, b): code and bin (1 to ``bins``)."""
    return F.transform(weights, lambda x: F.struct(x["code"].alias("f"), F.greatest(F.lit(1), F.least(
        F.lit(bins), F.ceil(F.round(x["weight"] * bins, 9)).cast("int"))).alias("b"))).cast(BINNED)


def drawn(id_col: Column, round_: int, p: BoostParams) -> Column:
    """Does the row with this id take part in the round?"""
    if p.subsample >= 1:
        return F.lit(True)
    mark = F.substring(F.md5(F.concat(id_col.cast("string"), F.lit(f":{p.seed}:{round_}"))), 1, 8)
    return mark < F.lit(f"{int(p.subsample * (1 << 32)):08x}")


_SOFTMAX = ("transform(array(transform({m}, x -> exp(x - array_max({m})))), "
            "e -> transform(e, x -> x / aggregate(e, 0D, (a, b) -> a + b)))[0]")


def softmax(margins: str) -> Column:
    return F.expr(_SOFTMAX.format(m=margins))


def _walk(depth: int) -> str:
    """Heap position (from 0) of the node of ``tree`` that a row reaches in at most ``depth`` steps; ``bins`` maps feature to bin."""
    if not depth:
        return "0"
    step = "2 * n + 1 + int(coalesce(try_element_at(bins, e.f), 0) > e.b)"
    return (f"aggregate(sequence(1, {depth}), 0, (n, i) -> transform(array(get(tree, n)), "
            f"e -> if(e.f IS NULL, n, {step}))[0])")


def _per_tree(trees: list, features: str, body: str) -> str:
    """``body`` for each of the trees (node lists), with ``tree`` and ``bins`` bound."""
    return f"transform(array(map_from_entries({features})), bins -> transform(from_json('{json.dumps(trees)}', 'array<{NODES}>'), tree -> {body}))[0]"


def _values(trees: list, features: str, depth: int) -> Column:
    """The leaf value of every tree for one row."""
    return F.expr(_per_tree(trees, features, f"get(tree, {_walk(depth)}).v"))


class Tree:
    """A tree under growth: nodes in heap order, (feature, bin) of a split, value of a leaf."""

    def __init__(self, depth: int):
        self.nodes: list[dict] = [{"f": None, "b": None, "v": 0.0} for _ in range(2 ** (depth + 1) - 1)]


@dataclass(frozen=True)
class SoftmaxBoostModel:
    classes: tuple[int, ...]                # label ids, ascending
    params: BoostParams
    trees: tuple                            # [round][class] -> nodes in heap order: {"f", "b", "v"}
    training_loss: tuple[float, ...] = field(default=())    # mean log loss of the training rows, before and after each round

    def margins(self, weights: Column) -> Column:
        """array<double> in ``classes`` order: the sum of the leaf values of each class's trees."""
        k = len(self.classes)
        trees = literal([nodes for row in self.trees for nodes in row], f"array<{NODES}>")

        def value(bins_of):
            def reach(tree):
                def step(node, _):
                    def move(e):
                        right = F.coalesce(F.element_at(bins_of, e["f"]), F.lit(0)) > e["b"]
                        return F.when(e["f"].isNull(), node).otherwise(2 * node + 1 + right.cast("int"))
                    return let(F.element_at(tree, node + 1), move)
                return F.element_at(tree, F.aggregate(F.sequence(F.lit(1), F.lit(self.params.max_depth)), F.lit(0), step) + 1)["v"]
            return F.transform(trees, reach)
        values = let(F.map_from_entries(binned(weights, self.params.bins)), value)
        return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: F.aggregate(
            F.filter(v, lambda _, i: i % k == c), F.lit(0.0), lambda a, b: a + b)))

    def probabilities(self, weights: Column) -> Column:
        def body(m):
            e = F.transform(m, lambda x: F.exp(x - F.array_max(m)))
            return let(e, lambda v: let(F.aggregate(v, F.lit(0.0), lambda a, b: a + b), lambda t: F.transform(v, lambda x: x / t)))
        return let(self.margins(weights), body)

    def predict(self, weights: Column) -> Column:
        """Class id with the largest rounded margin (smallest id on ties)."""
        ids = F.array(*[F.lit(c) for c in self.classes])
        rounded = F.transform(self.margins(weights), lambda x: F.round(x, 9))
        return let(rounded, lambda v: F.element_at(ids, F.array_position(v, F.array_max(v)).cast("int"))).cast("bigint")

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per node that a row can reach: (round, label_id, node, code, bin, value)."""
        rows = []
        for r, row in enumerate(self.trees):
            for c, nodes in zip(self.classes, row):
                reached = [0]
                for n in reached:
                    e = nodes[n]
                    rows.append((r + 1, c, n, e["f"], e["b"], None if e["f"] is not None else e["v"]))
                    if e["f"] is not None:
                        reached += [2 * n + 1, 2 * n + 2]
        return spark.createDataFrame(rows, "round int, label_id bigint, node int, code int, bin int, value double")

    def to_json(self) -> str:
        return json.dumps({"classes": self.classes, "params": self.params.__dict__, "trees": self.trees, "training_loss": self.training_loss})

    @staticmethod
    def from_json(text: str) -> SoftmaxBoostModel:
        d = json.loads(text)
        return SoftmaxBoostModel(tuple(d["classes"]), BoostParams(**d["params"]), tuple(tuple(r) for r in d["trees"]), tuple(d["training_loss"]))


_GRADIENTS = (f"transform({_SOFTMAX.format(m='margins')}, (x, c) -> named_struct('k', c, "
              f"'g', bigint(round((x - if(y = c, 1D, 0D)) * {SCALE})), 'h', bigint(round(greatest(2 * x * (1 - x), 1e-16D) * {SCALE}))))")


def root_sums(classes: int) -> list[Column]:
    """Aggregates g0, h0, g1, ... over the rows with ``used``: each class's sums, as whole numbers of 1 / SCALE."""
    return [F.expr(f"coalesce(sum(if(used, ({_GRADIENTS})[{c}].{x}, 0L)), 0L)").alias(f"{x}{c}") for c in range(classes) for x in "gh"]


def histogram(rows: DataFrame, trees: list[Tree], depth: int) -> DataFrame:
    """(k, node, f, b, g, h): sums over ``rows`` (y, margins, features) at the nodes of this depth, of non-zero features."""
    nodes = _per_tree([t.nodes for t in trees], "features", _walk(depth))
    at = f"filter(zip_with({_GRADIENTS}, {nodes}, (x, n) -> named_struct('k', x.k, 'node', n, 'g', x.g, 'h', x.h)), x -> x.node >= {2 ** depth - 1})"
    each = rows.select(F.expr(at).alias("at"), "features").select("at", F.inline("features"))
    return each.select("f", "b", F.inline("at")).groupBy("k", "node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(hist: DataFrame, totals: dict, p: BoostParams) -> DataFrame:
    """(k, node, gain, f, b, left_g, left_h): the best allowed split of each node; ``totals``: {(k, node): (g, h)} of the open nodes."""
    known = json.dumps({f"{k}:{n}": {"g": g, "h": h} for (k, n), (g, h) in totals.items()})
    total = F.expr(f"try_element_at(from_json('{known}', 'map<string,struct<g:bigint,h:bigint>>'), concat(k, ':', node))")
    by = Window.partitionBy("k", "node", "f")                           # at most ``bins`` rows
    upto = by.orderBy("b")
    rows = hist.select("*", F.sum("g").over(upto).alias("upto_g"), F.sum("h").over(upto).alias("upto_h"), F.sum("g").over(by).alias("all_g"),
                       F.sum("h").over(by).alias("all_h"), (F.row_number().over(upto) == 1).alias("first"), total.alias("t"))
    # left of a split are the node's rows without the feature and those up to the bin; the first row also stands for bin 0
    rows = rows.select("k", "node", "f", "t", F.expr("""inline(array_compact(array(
        named_struct('b', b, 'left_g', t.g - all_g + upto_g, 'left_h', t.h - all_h + upto_h),
        if(first, named_struct('b', 0, 'left_g', t.g - all_g, 'left_h', t.h - all_h), NULL))))"""))
    score = f"pow({{g}} / {SCALE}D, 2) / ({{h}} / {SCALE}D + {p.reg_lambda}D)"
    right = {"g": "(t.g - left_g)", "h": "(t.h - left_h)"}
    gain = f"round({score.format(g='left_g', h='left_h')} + {score.format(**right)} - {score.format(g='t.g', h='t.h')}, 9)"
    least = int(p.min_child * SCALE)
    allowed = rows.where(f"left_h >= {least} AND {right['h']} >= {least}").withColumn("gain", F.expr(gain)).where(f"gain > {LEAST_GAIN}D")
    return allowed.groupBy("k", "node").agg(F.max_by(F.struct("gain", "f", "b", "left_g", "left_h"),
                                                     F.struct("gain", -F.col("f"), -F.col("b"))).alias("s")).select("k", "node", "s.*")


def _by_level(splits: list) -> list[list]:
    """Splits in the order of their nodes' depths."""
    levels: dict[int, list] = {}
    for s in splits:
        levels.setdefault((s["node"] + 1).bit_length(), []).append(s)
    return [levels[d] for d in sorted(levels)]


def _grow(trees: list[Tree], totals: dict, splits: list, p: BoostParams) -> dict:
    """Write a level's splits into the trees; the sums of the children, each a leaf until it is split."""
    value = lambda g, h: -p.step * (g / SCALE) / (h / SCALE + p.reg_lambda)
    children = {}
    for s in splits:
        k, n = s["k"], s["node"]
        g, h = totals[k, n]
        trees[k].nodes[n].update(f=s["f"], b=s["b"])
        children[k, 2 * n + 1] = s["left_g"], s["left_h"]
        children[k, 2 * n + 2] = g - s["left_g"], h - s["left_h"]
    for (k, n), (g, h) in children.items():
        trees[k].nodes[n]["v"] = value(g, h)
    return children


def _local_tree(g: np.ndarray, h: np.ndarray, row: np.ndarray, f: np.ndarray, b: np.ndarray, p: BoostParams) -> list[tuple]:
    """[(node, f, b, left_g, left_h)] of one tree; entry i says that row ``row[i]`` has feature ``f[i]`` in bin ``b[i]``."""
    order = np.lexsort((b, f))
    row, f, b = row[order], f[order], b[order]
    node, out = np.zeros(len(g), np.int64), []
    score = lambda x, y: (x / SCALE) ** 2 / (y / SCALE + p.reg_lambda)
    least = int(p.min_child * SCALE)
    for depth in range(p.max_depth):
        open_ = np.flatnonzero(node[row] >= 2 ** depth - 1)
        open_ = open_[np.argsort(node[row[open_]], kind="stable")]            # by node, feature, bin
        if not len(open_):
            break
        r, ff, bb = row[open_], f[open_], b[open_]
        nn = node[r]
        new = np.concatenate([[True], (nn[1:] != nn[:-1]) | (ff[1:] != ff[:-1])])
        cell = np.flatnonzero(new | np.concatenate([[True], bb[1:] != bb[:-1]]))
        cg, ch = np.add.reduceat(g[r], cell), np.add.reduceat(h[r], cell)
        first = np.flatnonzero(new[cell])                                       # each (node, feature)'s first cell
        group = np.cumsum(new[cell]) - 1
        tg, th = np.bincount(node, g, 2 ** (depth + 1)).astype(np.int64), np.bincount(node, h, 2 ** (depth + 1)).astype(np.int64)
        at = nn[cell]
        before_g, before_h = np.concatenate([[0], np.cumsum(cg)]), np.concatenate([[0], np.cumsum(ch)])
        ends = np.append(first[1:], len(cell))
        zero_g, zero_h = tg[at[first]] - (before_g[ends] - before_g[first]), th[at[first]] - (before_h[ends] - before_h[first])
        left_g = np.concatenate([zero_g, zero_g[group] + before_g[1:] - before_g[first][group]])
        left_h = np.concatenate([zero_h, zero_h[group] + before_h[1:] - before_h[first][group]])
        cand = [np.concatenate([x[first], x]) for x in (at, ff[cell])] + [np.concatenate([np.zeros(len(first), np.int64), bb[cell]])]
        all_g, all_h = tg[cand[0]], th[cand[0]]
        gain = np.round(score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h), 9)
        fit = np.flatnonzero((left_h >= least) & (all_h - left_h >= least) & (gain > LEAST_GAIN))
        fit = fit[np.lexsort((cand[2][fit], cand[1][fit], -gain[fit], cand[0][fit]))]
        best = fit[np.concatenate([[True], cand[0][fit][1:] != cand[0][fit][:-1]])] if len(fit) else fit
        value = {}
        for i in best:
            value[int(cand[0][i])] = (int(cand[1][i]), int(cand[2][i]))
            out.append((int(cand[0][i]), int(cand[1][i]), int(cand[2][i]), int(left_g[i]), int(left_h[i])))
        right = np.zeros(len(g), bool)
        has_f = np.array([value.get(n, (-1, 0))[0] for n in range(2 ** (depth + 1))])
        has_b = np.array([value.get(n, (-1, 0))[1] for n in range(2 ** (depth + 1))])
        right[r[(ff == has_f[nn]) & (bb > has_b[nn])]] = True
        node = np.where((node >= 2 ** depth - 1) & (has_f[np.minimum(node, 2 ** (depth + 1) - 1)] >= 0), 2 * node + 1 + right, node)
    return out


def local_splits(rows: DataFrame, p: BoostParams) -> DataFrame:
    """(k, node, f, b, left_g, left_h): all splits of a round's trees, one task per class (bounded by ``LOCAL_ENTRIES``)."""
    each = rows.select(F.col("features.f").alias("f"), F.col("features.b").alias("b"), F.expr(f"inline({_GRADIENTS})"))

    def grow(table: pa.Table) -> pa.Table:
        sizes = np.array([len(x) for x in table["f"].to_pylist()], np.int64)
        flat = lambda c: np.asarray(table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.int64)
        found = _local_tree(table["g"].to_numpy(), table["h"].to_numpy(), np.repeat(np.arange(len(sizes)), sizes), flat("f"), flat("b"), p)
        k = table["k"][0].as_py()
        cols = list(zip(*found)) or [()] * 5
        return pa.table([pa.array([k] * len(found), pa.int32()), *[pa.array(c, t) for c, t in zip(
            cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))]], names=["k", "node", "f", "b", "left_g", "left_h"])
    return each.groupBy("k").applyInArrow(grow, "k int, node int, f int, b int, left_g long, left_h long")


def start_rows(train: DataFrame, id_col: str, label_id: str, weights: str, classes: tuple[int, ...], p: BoostParams) -> DataFrame:
    """(id, y, features, margins) before the first round; ``y`` is the class's position."""
    y = F.array_position(F.array(*[F.lit(c).cast("bigint") for c in classes]), F.col(label_id).cast("bigint")) - 1
    return train.select(F.col(id_col).alias("id"), y.cast("int").alias("y"), binned(F.col(weights), p.bins).alias("features"),
                        F.array(*[F.lit(0.0) for _ in classes]).alias("margins"))


def fit_softmax_boost(train: DataFrame, id_col: str, label_id: str, weights: str, params: BoostParams = BoostParams(),
                      local_entries: int = LOCAL_ENTRIES) -> SoftmaxBoostModel:
    """Fit on rows (id, label id, TF-IDF entries). The driver holds the trees and, per level, one row per open node."""
    p = params
    classes = tuple(sorted(r[0] for r in train.select(F.col(label_id).cast("bigint")).where(F.col(label_id).isNotNull()).distinct().collect()))
    if not classes:
        raise ValueError("no labelled rows to fit")
    n = len(classes)
    loss = F.expr(f"-avg(ln(get({_SOFTMAX.format(m='margins')}, y)))").alias("loss")
    rows = start_rows(train.where(F.col(label_id).isNotNull()), id_col, label_id, weights, classes, p)
    rows = written(rows, "boost-rows")
    grown, losses = [], []
    for r in range(1, p.rounds + 2):
        # one pass for the loss so far and the sums at the roots of this round's trees
        drawn_now = drawn(F.col("id"), r, p)
        now = rows.withColumn("used", drawn_now).agg(
            loss, F.sum(F.expr("if(used, size(features) + 1L, 0L)")).alias("entries"), *root_sums(n)).first()
        losses.append(now["loss"])
        if r > p.rounds:
            break
        sample = rows.where(drawn_now)
        trees = [Tree(p.max_depth) for _ in classes]
        totals = {(c, 0): (now[f"g{c}"], now[f"h{c}"]) for c in range(n)}
        for (c, _), (g, h) in totals.items():
            trees[c].nodes[0]["v"] = -p.step * (g / SCALE) / (h / SCALE + p.reg_lambda)
        if now["entries"] <= local_entries:
            for level in _by_level(local_splits(sample, p).collect()):              # at most classes x 2**max_depth rows
                totals.update(_grow(trees, totals, level, p))
            totals = {}
        for depth in range(p.max_depth if totals else 0):
            splits = best_splits(histogram(sample, trees, depth), totals, p).collect()      # at most classes x 2**depth rows
            totals = _grow(trees, totals, splits, p)
            if not totals:
                break
        grown.append(tuple(t.nodes for t in trees))
        added = _values([t.nodes for t in trees], "features", p.max_depth)
        rows = written(rows.withColumn("margins", F.zip_with("margins", added, lambda a, b: a + b)), "boost-rows")
    return SoftmaxBoostModel(classes, p, tuple(grown), tuple(losses))
