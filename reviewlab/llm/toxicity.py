"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult (from a learned lexicon of whole words and word beginnings), threat verb, intent, target,
negation, reported speech, other. Five small transducers read a clause's symbols side by side, as one composed
machine: negation and intent reach over the next ``REACH`` words, reported speech and targets over the clause. Each
insult or threat verb leaves the machine as a match of one kind (plain, targeted, negated, reported, threat) with its
lexicon weight. A document's score is a logistic function of what its matched clauses add up to; isolated words
outside a match weigh nothing.

The lexicon and the logistic weights are learned from at most ``FIT_ROWS`` different texts of each label (taken by a
hash); each half's clauses are weighed with the other half's lexicon, the model keeps both. Every text is scored whole. Defined cases: null and empty texts
score like a text without matches; without labelled rows, or with one label only, all score the base rate (0 without
any); rows with several labels count as toxic if any is; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, blobs, flat_blobs, importable, texts_of
from reviewlab.llm.words import Words, plain_words_of, text_slices

FIT_ROWS = 8000            # texts of each label
PREFIXES = (4, 5, 6, 7)    # bytes of a word's beginning that can stand for it
LEAST_ROWS = 5             # toxic texts that a lexicon entry needs
LEAST_SHARE = 0.5          # lower confidence bound of the toxic share among texts with the entry
LEXICON = 20_000           # entries, at most
REACH = 3
THRESHOLD = 0.3

# Closed word classes in English, German, French and Spanish.
TARGETS = "you your yours yourself u ya he she they them him her these those people du dich dir ihr euch sie tu toi te vous eux ils elles usted ustedes ellos ellas vosotros".split()
NEGATIONS = "not no never none neither nor isn't aren't don't doesn't nicht kein keine keiner nie niemals pas jamais aucun nunca jamás ningún tampoco".split()
REPORTS = "said says say told tells wrote writes claimed called reported quoted according sagte sagt schrieb meinte dit disait écrit selon dijo dice escribió según".split()
THREATS = "kill hurt beat destroy murder shoot stab burn hang crush attack smash töten umbringen schlagen vernichten verprügeln tuer frapper détruire brûler matar golpear destruir quemar".split()
INTENTS = "will shall gonna going must should werde werden sollte muss vais va vas allons voy vamos debería".split()

OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = range(7)
PLAIN, TARGETED, NEGATED, REPORTED, THREATENED = range(5)       # kinds of matches
# Features of a text and the sign that a weight may have: a match never makes a text less toxic, negation and
# reported speech never more.
SIGNS = np.array([1, 1, 1, 1, -1, -1])     # all matches, strongest match, targeted, threats, negated, reported
_CLAUSE = np.zeros(256, bool)
_CLAUSE[[10, 13, *b".!?;:|,()\"["]] = True


def _closed() -> tuple[np.ndarray, np.ndarray]:
    lists = ((THREAT, THREATS), (INTENT, INTENTS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
    pairs = [(w, s) for s, ws in lists for w in ws if "'" not in w]
    h = plain_words_of(pa.array([" ".join(w for w, _ in pairs)])).hash
    order = np.argsort(h)
    return h[order], np.array([s for _, s in pairs])[order]


class Negation:
    """Counts down REACH words after a negation."""
    start = 0

    @staticmethod
    def step(state: int, symbol: int) -> int:
        return REACH if symbol == NEGATION else max(0, state - 1)


class Intent:
    """Counts down REACH words after an expression of intent."""
    start = 0

    @staticmethod
    def step(state: int, symbol: int) -> int:
        return REACH if symbol == INTENT else max(0, state - 1)


class Flag:
    """Remembers that a symbol was read in the clause."""
    start = 0

    def __init__(self, symbol: int):
        self.symbol = symbol

    def step(self, state: int, symbol: int) -> int:
        return int(state or symbol == self.symbol)


MACHINE = (Negation, Intent, Flag(TARGET), Flag(REPORT))


def clause_matches(symbols: list[int], weights: list[float]) -> list[tuple[int, float]]:
    """(kind, weight) of every insult and threat that the composed machine finds in one clause."""
    states = tuple(m.start for m in MACHINE)
    target = TARGET in symbols
    out = []
    for symbol, weight in zip(symbols, weights):
        states = tuple(m.step(s, symbol) for m, s in zip(MACHINE, states))
        negated, intent, _, reported = states
        if symbol == INSULT:
            kind = NEGATED if negated else REPORTED if reported else TARGETED if target else PLAIN
            out.append((kind, weight))
        elif symbol == THREAT and intent and target and not negated and not reported:
            out.append((THREATENED, 1.0))
    return out


@dataclass
class ToxicityModel:
    """Sorted lexicon hashes with weights, logistic coefficients and their intercept."""
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    coef: np.ndarray = field(default_factory=lambda: np.zeros(len(SIGNS)))
    base: float = -20.0

    def features(self, words: Words) -> np.ndarray:
        """A row per text of what SIGNS names: the sums as logarithms, and the largest weight."""
        sums = np.zeros((len(words.first) - 1, 5))
        top = np.zeros(len(sums))
        if not len(words.hash):
            return np.zeros((len(sums), len(SIGNS)))
        weight = np.zeros(len(words.hash))
        for h in _word_features(words):
            weight = np.maximum(weight, _lookup(self.lexicon, self.weights, h))
        closed, symbols = _closed()
        symbol = _lookup(closed, symbols, words.hash).astype(np.int64)
        symbol[weight > 0] = INSULT
        ends = np.concatenate([[0], np.cumsum(_CLAUSE[words.data])])
        clause = ends[words.start]
        text = np.searchsorted(words.first, np.arange(len(words.hash)), "right") - 1
        clause = np.cumsum(np.concatenate([[0], (np.diff(clause) > 0) | (np.diff(text) > 0)]))
        edge = np.searchsorted(clause, np.arange(clause[-1] + 2))
        for c in np.unique(clause[(symbol == INSULT) | (symbol == THREAT)]).tolist():
            lo, hi = edge[c], edge[c + 1]
            for kind, w in clause_matches(symbol[lo:hi].tolist(), weight[lo:hi].tolist()):
                sums[text[lo], kind] += w
                top[text[lo]] = max(top[text[lo]], w)
        return np.column_stack([np.log1p(sums.sum(1)), top, *np.log1p(sums[:, [TARGETED, THREATENED, NEGATED, REPORTED]]).T])

    def scores(self, words: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(words) @ self.coef + self.base, -30, 30)))


def _word_features(words: Words) -> list[np.ndarray]:
    return [words.hash, *[words.prefix_hash(k) for k in PREFIXES]]


def _lookup(keys: np.ndarray, values: np.ndarray, h: np.ndarray) -> np.ndarray:
    """values of the sorted keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(h))
    at = np.searchsorted(keys, h)
    at[at == len(keys)] = 0
    return np.where(keys[at] == h, values[at], 0)


def _text_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Different features of each text (0 left out) and row bounds."""
    words = plain_words_of(texts)
    text = np.searchsorted(words.first, np.arange(len(words.hash)), "right") - 1
    h = np.concatenate(_word_features(words))
    row = np.tile(text, 1 + len(PREFIXES))[h != 0]
    h = h[h != 0]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[keep], np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(texts)))])


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic, h): at most ``rows`` different labelled texts of each label, those with the smallest hashes.

    Ids and hashes are joined to the labels and ranked (a share of hash space that holds about twice as many texts is
    cut off first); the ids chosen, 2 x ``rows`` at most, are broadcast to the scan, so only sampled texts move."""
    toxic = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    slim = docs.where("text is not null and doc_id is not null").select("doc_id", F.xxhash64("text").alias("h")).join(toxic, "doc_id")
    count = {r.toxic: r.k for r in slim.groupBy("toxic").agg(F.approx_count_distinct("h", 0.02).alias("k")).collect()}
    chosen = None
    for label in (0, 1):
        share = 4.0 * rows / max(count.get(label, 0), 1)
        own = slim.where((F.col("toxic") == label) & (F.col("h") <= float(1 << 63) * min(1.0, share - 1)))
        own = own.groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id")).orderBy("h").limit(rows)
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = docs.where("text is not null").select("doc_id", "text")
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["toxic", "h"]).select("text", "toxic", "h")


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from labelled rows; the driver holds lexicon candidates (LEAST_ROWS toxic texts each) and feature rows."""
    spark = importable(docs.sparkSession)
    sample = fit_sample(docs, labels).persist()
    try:
        totals = np.zeros((2, 2))       # [label, fold]
        for r in sample.groupBy("toxic", F.pmod("h", F.lit(2)).alias("fold")).agg(F.count("*").alias("n")).collect():
            totals[min(r.toxic, 1), r.fold] += r.n
        if not totals.sum(1).all():
            return ToxicityModel(base=20.0 if totals[1].sum() else -20.0)
        seen = {r.toxic: r.n for r in labels.where("toxic is not null").groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
        scale = float((seen[0] / totals[0].sum()) / (seen[1] / totals[1].sum()))
        bad = _counted(sample.where("toxic >= 1"), None, 3)
        good = _counted(sample.where("toxic = 0"), np.sort(bad[0]), 0)
        order = np.argsort(good[0])
        n_good = np.stack([_lookup(good[0][order], good[1][order, k], bad[0]) for k in (0, 1)], 1)
        # each fold's rows get features from the other fold's lexicon; the model keeps the lexicon of both
        by_fold = [_lexicon(bad[0], bad[1][:, 1 - k], n_good[:, 1 - k], totals[:, 1 - k], scale) for k in (0, 1)]
        model = _lexicon(bad[0], bad[1].sum(1), n_good.sum(1), totals.sum(1), scale)
        shipped = spark.sparkContext.broadcast(by_fold)

        def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, fold = texts_of(batch.column("text")), batch.column("fold").to_numpy()
            x = np.concatenate([np.where(fold[lo:hi, None] == 0, *(m.features(words) for m in shipped.value))
                                for lo, hi in text_slices(texts) for words in [plain_words_of(texts.slice(lo, hi - lo))]])
            return pa.RecordBatch.from_arrays([blobs(x.reshape(-1), np.arange(len(x) + 1) * x.shape[1]), batch.column("toxic")], names=["x", "toxic"])
        got = arrow_map(sample.select("text", "toxic", F.pmod("h", F.lit(2)).alias("fold")), rows, "x binary, toxic int").toArrow()
    finally:
        sample.unpersist()
    x = flat_blobs(got.column("x"), np.float64)[0].reshape(got.num_rows, -1)
    y = (got.column("toxic").to_numpy() > 0).astype(float)
    # the sample holds up to FIT_ROWS texts of each label; weigh rows back to the labels' own shares
    size = np.bincount(y.astype(int), minlength=2)
    w = np.array([seen.get(k, 0) / max(size[k], 1) for k in (0, 1)])[y.astype(int)]
    w *= len(y) / w.sum()
    model.coef, model.base = _logistic(x, y, w)
    return model


def _counted(sample: DataFrame, only: np.ndarray | None, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, number of texts with each, by fold) over the sample; ``only`` limits the features."""
    kept = sample.sparkSession.sparkContext.broadcast(only)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, fold, found = texts_of(batch.column("text")), batch.column("fold").to_numpy(), []
        for lo, hi in text_slices(texts):
            h, bounds = _text_sets(texts.slice(lo, hi - lo))
            of = np.repeat(fold[lo:hi], np.diff(bounds))
            if kept.value is not None:
                ok = np.isin(h, kept.value)
                h, of = h[ok], of[ok]
            found.append((h, of))
        h, of = (np.concatenate(c) for c in zip(*found))
        f, inv = np.unique(h, return_inverse=True)
        n = [np.bincount(inv, weights=of == k, minlength=len(f)).astype(np.int64) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n[0]), pa.array(n[1])], names=["f", "n0", "n1"])
    rows = sample.select("text", F.pmod("h", F.lit(2)).alias("fold"))
    got = (arrow_map(rows, run, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
           .where(F.col("n0") + F.col("n1") >= least).toArrow())
    return got.column("f").to_numpy().view(np.uint64), np.stack([got.column(c).to_numpy() for c in ("n0", "n1")], 1).reshape(-1, 2)


def _lexicon(f: np.ndarray, n_bad: np.ndarray, n_good: np.ndarray, totals: np.ndarray, scale: float) -> ToxicityModel:
    """The features whose toxic share is high beyond doubt, weighted by its lower confidence bound."""
    # counts of clean texts as if the sample held the labels in their own proportions
    n, z = np.maximum(n_bad + n_good * scale, 1e-9), 1.64
    share = n_bad / n
    bound = (share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    keep = np.flatnonzero((n_bad >= min(LEAST_ROWS, 3 + totals[1] // 50)) & (bound >= LEAST_SHARE))
    keep = keep[np.lexsort((f[keep], -bound[keep]))][:LEXICON]
    order = np.argsort(f[keep])
    return ToxicityModel(f[keep][order], np.clip(np.log(bound[keep] / (1.02 - bound[keep])) + 1, 0.1, None)[order])


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Weighted ridge logistic regression with signed weights, by damped Newton steps over the weights that are not held
    at zero; rows are used in a fixed order."""
    order = np.lexsort(np.vstack([x.T, y]))
    x, y, w = np.hstack([x[order], np.ones((len(x), 1))]), y[order], w[order]
    beta, sign = np.zeros(x.shape[1]), np.append(SIGNS, 0)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + penalty * beta
        free = (beta != 0) | (sign == 0) | (grad * sign < 0)
        z = x[:, free]
        step = np.linalg.solve((z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty[free]), grad[free])
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        new = beta.copy()
        new[free] -= step
        new[new * sign < 0] = 0
        if np.abs(new - beta).max() < 1e-8:
            break
        beta = new
    return beta[:-1], float(beta[-1])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, out = texts_of(batch.column("text")), []
        for lo, hi in text_slices(texts):
            out.append(shipped.value.scores(plain_words_of(texts.slice(lo, hi - lo))))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out))], names=["doc_id", "score"])
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, score double")


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from the labels of rows that are not held out."""
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    model = fit(docs.where(part != 2), labels.where(part != 2))
    return score(docs, model).select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
