"""Benchmark decontamination with BM25 and block-max WAND.

The benchmark items are the indexed collection; every passage (PASSAGE words, half overlapping) of every training
document is a query of its distinct words. An item is retrieved when its BM25 score reaches ``SHARE`` of the
score of its own words (for items longer than half a passage: of a half passage's part). Index lists are cut
into blocks of ``BLOCK`` consecutive items, each with its largest contribution; passages, then blocks, whose upper
bounds stay under the threshold are skipped, and WAND pivots inside the blocks that remain.

A retrieved item counts as leaked when at least ``OVERLAP`` of its question's words lie in 5-word shingles that the
document holds too, and the same for its answer (the words after the last question mark, if any).

The index is broadcast in shards of at most ``SHARD_ITEMS`` items and ``SHARD_WORDS`` words; a larger benchmark takes
more shards, each queried by all documents. No document is shuffled. Defined cases: null and empty texts or items
match nothing; items that repeat are all reported; other columns are ignored; rows without item_id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, keep_rows, staged, texts_of
from reviewlab.llm.words import Words, plain_words_of, text_slices

K1, B = 1.2, 0.75
PASSAGE = 64
SHARE = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 4
SHARD_ITEMS = 50_000
SHARD_WORDS = 5_000_000
LOOKED_UP = 1 << 18        # index blocks looked up at once for a slice's passages (one passage's blocks at least)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i] + 1, ... of size[i] each, one after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)


def _passage_cuts(passage: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole passages (in rising order) whose sizes add up to LOOKED_UP at most, or of one passage."""
    first = np.append(np.flatnonzero(np.diff(passage, prepend=-1)), len(passage))
    total = np.concatenate([[0], np.cumsum(size)])[first]
    lo = 0
    while lo < len(first) - 1:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + LOOKED_UP, "right")) - 1)
        yield int(first[lo]), int(first[hi])
        lo = hi


class ItemIndex:
    """Inverted index of benchmark items; contributions are divided by each item's threshold, so 1.0 retrieves."""

    def __init__(self, items: list[tuple[int, str]], stats: tuple[int, float] | None = None, df: dict | None = None):
        items = sorted((i, t or "") for i, t in items)
        cut = [t.rfind("?") + 1 or len(t) for _, t in items]
        self.ids = np.array([i for i, _ in items], np.int64)
        self.parts = [plain_words_of(pa.array([t[a:b] for (_, t), (a, b) in zip(items, edges)], pa.string()))
                      for edges in ([(0, c) for c in cut], [(c, len(t)) for c, (_, t) in zip(cut, items)])]
        words = plain_words_of(pa.array([t for _, t in items], pa.string()))
        length = np.diff(words.first)
        self.words = int(length.sum())
        row = np.repeat(np.arange(len(items)), length)
        self.vocabulary, term = np.unique(words.hash, return_inverse=True)
        key, tf = np.unique(term.astype(np.int64) * max(1, len(items)) + row, return_counts=True)
        term, item = key // max(1, len(items)), key % max(1, len(items))
        self.df = np.bincount(term, minlength=len(self.vocabulary))
        count, average = stats or (len(items), float(length.mean()) if len(items) else 0.0)
        freq = self.df if df is None else np.array([df[h] for h in self.vocabulary.tolist()])
        idf = np.log1p((count - freq + 0.5) / (freq + 0.5))
        gain = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / max(average, 1e-9)))
        own = np.bincount(item, weights=gain, minlength=len(items))
        need = SHARE * own * np.minimum(1.0, (PASSAGE // 2) / np.maximum(length, 1))
        self.post_first = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        self.post_item, self.post_gain = item, gain / need[item]
        block = key // max(1, len(items)) * (len(items) // BLOCK + 1) + item // BLOCK
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        self.block_max = np.maximum.reduceat(self.post_gain, starts) if len(starts) else np.zeros(0)
        self.block_id = (item // BLOCK)[starts]
        self.block_first = np.searchsorted(term[starts], np.arange(len(self.vocabulary) + 1))
        self.blocks = len(items) // BLOCK + 1
        self.term_max = np.maximum.reduceat(self.post_gain, self.post_first[:-1]) if len(term) else np.zeros(0)
        self.cache = {}
        self.shingles = [w.windows(SHINGLE, short=True) for w in self.parts]

    def retrieve(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, item position) pairs of which some passage reaches the item's threshold."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(words.hash):
            return none
        at = np.searchsorted(self.vocabulary, words.hash)
        at[at == len(self.vocabulary)] = 0
        known = np.flatnonzero(self.vocabulary[at] == words.hash)
        counts = np.diff(words.first)
        step = PASSAGE // 2
        per = np.maximum(1, -(-counts // step) - 1)
        base = np.concatenate([[0], np.cumsum(per)])
        text = np.repeat(np.arange(len(counts)), counts)[known]
        half = (known - words.first[text]) // step
        queries = []
        for back in (0, 1):
            p = half - back
            ok = (p >= 0) & (p < per[text])
            queries.append((base[text] + p)[ok] * np.int64(len(self.vocabulary)) + at[known][ok])
        key = np.unique(np.concatenate(queries))
        passage, term = key // len(self.vocabulary), key % len(self.vocabulary)
        live = np.bincount(passage, weights=self.term_max[term], minlength=base[-1]) >= 1 - 1e-9
        passage, term = passage[live[passage]], term[live[passage]]
        if not len(passage):
            return none
        size = self.block_first[term + 1] - self.block_first[term]
        blocks = np.concatenate([self._reaching(passage[lo:hi], term[lo:hi], size[lo:hi]) for lo, hi in _passage_cuts(passage, size)])
        start = np.searchsorted(passage, blocks // self.blocks)
        end = np.searchsorted(passage, blocks // self.blocks, "right")
        found = set()
        for b, lo, hi in zip(blocks.tolist(), start.tolist(), end.tolist()):
            t = int(np.searchsorted(base, b // self.blocks, "right")) - 1
            found.update((t, i) for i in self._wand(term[lo:hi], b % self.blocks) if (t, i) not in found)
        got = np.array(sorted(found), np.int64).reshape(-1, 2)
        return got[:, 0], got[:, 1]

    def _reaching(self, passage: np.ndarray, term: np.ndarray, size: np.ndarray) -> np.ndarray:
        """passage * blocks + block of every block whose upper bound reaches the threshold; ``size``: each term's blocks."""
        entry = _runs(self.block_first[term], size)
        where = np.repeat(passage, size) * np.int64(self.blocks) + self.block_id[entry]
        blocks, inv = np.unique(where, return_inverse=True)
        return blocks[np.bincount(inv, weights=self.block_max[entry]) >= 1 - 1e-9]

    def _part(self, term: int, block: int) -> tuple[list, list, float] | None:
        """A term's items, contributions and largest contribution in one block."""
        if (term, block) not in self.cache:
            a, b = self.post_first[term], self.post_first[term + 1]
            lo, hi = a + np.searchsorted(self.post_item[a:b], [block * BLOCK, (block + 1) * BLOCK])
            gains = self.post_gain[lo:hi].tolist()
            self.cache[term, block] = (self.post_item[lo:hi].tolist(), gains, max(gains)) if gains else None
        return self.cache[term, block]

    def _wand(self, terms: np.ndarray, block: int) -> list[int]:
        """Items of one block that the query ``terms`` lift to the threshold."""
        lists = [[*part, 0] for t in terms.tolist() if (part := self._part(t, block))]
        out = []
        while lists:
            lists.sort(key=lambda x: x[0][x[3]])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[2]
                if bound >= 1 - 1e-9:
                    pivot = x[0][x[3]]
                    break
            if pivot is None:
                break
            if lists[0][0][lists[0][3]] == pivot:
                if sum(x[1][x[3]] for x in lists if x[0][x[3]] == pivot) >= 1 - 1e-9:
                    out.append(pivot)
                pivot += 1
            for x in lists:
                while x[3] < len(x[0]) and x[0][x[3]] < pivot:
                    x[3] += 1
            lists = [x for x in lists if x[3] < len(x[0])]
        return out

    def overlap(self, part: int, item: int, held: np.ndarray) -> float:
        """Share of the part's words inside shingles of ``held`` (sorted hashes); 1 for a part without words."""
        words = int(self.parts[part].first[item + 1] - self.parts[part].first[item])
        if not words:
            return 1.0
        values, bounds = self.shingles[part]
        mine = values[bounds[item]:bounds[item + 1]]
        at = np.searchsorted(held, mine)
        hit = np.zeros(len(mine), bool)
        ok = at < len(held)
        hit[ok] = held[at[ok]] == mine[ok]
        covered = np.zeros(words, bool)
        for i in np.flatnonzero(hit):
            covered[i:i + SHINGLE] = True
        return float(covered.mean())


def _held(words: Words, text: int, sizes: set[int]) -> np.ndarray:
    """Sorted hashes of a text's windows of SHINGLE words, and of each shorter length that an item part has."""
    one = Words.__new__(Words)
    one.hash = words.hash[words.first[text]:words.first[text + 1]]
    one.first = np.array([0, len(one.hash)], np.int64)
    out = [one.windows(SHINGLE)[0]] + [one.short_windows(n) for n in sizes]
    return np.unique(np.concatenate(out))


def item_shards(benchmark: DataFrame) -> Iterator[ItemIndex]:
    """The benchmark's index, shard by shard; all use the statistics of the whole collection."""
    rows = staged(benchmark.where("item_id is not null and text is not null")
                  .select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t")), "benchmark-items")

    def shards() -> Iterator[list[tuple[int, str]]]:
        held, words = [], 0
        for r in rows.orderBy("i", "t").toLocalIterator():
            n = len(r.t) // 4 + 1
            if held and (len(held) >= SHARD_ITEMS or words + n > SHARD_WORDS):
                yield held
                held, words = [], 0
            held.append((r.i, r.t))
            words += n
        if held:
            yield held
    df, count, length = {}, 0, 0
    for s in shards():
        part = ItemIndex(s)
        for h, c in zip(part.vocabulary.tolist(), part.df.tolist()):
            df[h] = df.get(h, 0) + c
        count, length = count + len(s), length + part.words
    for s in shards():
        yield ItemIndex(s, (count, length / count), df)


def _leaked(index: ItemIndex, texts: pa.Array) -> Iterator[tuple[int, int, float, float]]:
    """(row, item position, question overlap, answer overlap) of every verified item in the texts."""
    lengths = {int(n) for p in index.parts for n in np.diff(p.first) if 0 < n < SHINGLE}
    for lo, hi in text_slices(texts):
        words = plain_words_of(texts.slice(lo, hi - lo))
        last, held = None, None
        for t, item in zip(*index.retrieve(words)):
            if t != last:
                last, held = t, _held(words, t, lengths)
            q, a = index.overlap(0, item, held), index.overlap(1, item, held)
            if q >= OVERLAP and a >= OVERLAP:
                yield lo + int(t), int(item), q, a


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, question_overlap, answer_overlap of every leaked item in every document."""
    schema = "doc_id long, item_id long, question_overlap double, answer_overlap double"
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], schema)
    for index in item_shards(benchmark):
        shipped = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, shipped=shipped) -> pa.RecordBatch:
            ids = batch.column("doc_id")
            found = [(ids[r].as_py(), int(shipped.value.ids[i]), q, a) for r, i, q, a in _leaked(shipped.value, texts_of(batch.column("text")))]
            cols = list(zip(*found)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())],
                                              names=["doc_id", "item_id", "question_overlap", "answer_overlap"])
        out = out.unionByName(arrow_map(rows, run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: drop every document that holds a benchmark item; columns stay, nothing is shuffled."""
    for index in item_shards(benchmark):
        shipped = docs.sparkSession.sparkContext.broadcast(index)

        def wanted(batch: pa.RecordBatch, shipped=shipped) -> np.ndarray:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in _leaked(shipped.value, texts_of(batch.column("text"))):
                keep[row] = False
            return keep
        docs = keep_rows(docs, wanted)
    return docs
