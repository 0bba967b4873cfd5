"""Exact removal of repeated word windows.

A window is ``WINDOW`` consecutive words of one document; every word covered by a window whose words also start
anywhere else (same document included) is removed, judged on the input.

1. Every window gets a Rabin-Karp hash. Its anchor is the smallest hash of its ``GRAM``-word parts: equal windows have
   equal anchors, and neighbouring windows share theirs, so anchors come as few runs of windows.
2. Anchors are counted in Spark over all documents. Windows under an anchor that occurs once are unique.
3. The other windows' hashes are counted in Spark, grouped by anchor, so repeated neighbours come out as intervals.
4. Each document's intervals are merged to maximal ones and cut from its words.

What repeats inside a task's slice of texts is known at once and sent on as one marker, so a window or anchor that very
many documents hold reaches its counting task once per slice. Defined cases: null text has no words; the kept
words of an empty text hash as the empty string; repeated rows count as places of their own; where doc_id is null or
repeated, rows are told apart by a hash of id and text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, blobs, flat_blobs, importable, staged, texts_of
from reviewlab.llm.words import mix, text_slices, words_of

WINDOW = 35
GRAM = 8
BUCKET_ITEMS = 1 << 19      # anchors or windows per counting bucket
SLICE = 8 << 20             # bytes of text in which repeats are found locally

PLACES = "bucket long, key binary, doc binary, start binary, size binary, hash binary"


def anchors_and_hashes(texts: pa.Array, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, hash) of every window of the texts, and each text's window bounds."""
    words = words_of(texts, False)
    value, bounds = words.windows(window)
    part, edge = words.windows(gram)
    span, low, width = window - gram + 1, part, 1
    while 2 * width <= span:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width:])
    n = np.diff(bounds)
    at = np.arange(bounds[-1]) + np.repeat(edge[:-1] - bounds[:-1], n)
    return (low[at] if len(at) else np.zeros(0, np.uint64)), value, bounds


def _runs(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs; ``same[i]`` tells whether item i continues item i - 1."""
    start = np.flatnonzero(~same)
    return start, np.diff(np.append(start, len(same)))


def _repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is the value there more than once?, one position of each such value)."""
    _, first, inv, count = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    return count[inv] > 1, first[count > 1]


def _rows(bucket, key, doc, start, size, hashes=None, of=None) -> pa.RecordBatch:
    """Items packed by bucket; ``hashes`` belong to items by ``of`` (the items' bounds in it)."""
    order = np.argsort(bucket, kind="stable")
    ids, first = np.unique(bucket[order], return_index=True)
    bounds = np.append(first, len(order))
    cols = [blobs(c[order], bounds) for c in (key, doc, start, size)]
    if hashes is None:
        packed = pa.nulls(len(ids), pa.binary())
    else:
        n = np.diff(of)[order]
        total = np.concatenate([[0], np.cumsum(n)])
        packed = blobs(hashes[np.arange(total[-1]) + np.repeat(of[:-1][order] - total[:-1], n)], total[bounds])
    return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), *cols, packed], names=["bucket", "key", "doc", "start", "size", "hash"])


def _scatter(value: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(value) >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)


def anchor_places(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc, start, size): runs of windows whose anchor occurs in more than one place."""
    def run(batch: pa.RecordBatch) -> pa.Table:
        texts, ids, out = texts_of(batch.column("text")), batch.column("id").to_numpy(zero_copy_only=False), []
        for lo, hi in text_slices(texts, SLICE):
            anchor, value, bounds = anchors_and_hashes(texts.slice(lo, hi - lo))
            if not len(anchor):
                continue
            same = np.zeros(len(anchor), bool)
            same[1:] = anchor[1:] == anchor[:-1]
            same[bounds[:-1][np.diff(bounds) > 0]] = False
            start, size = _runs(same)
            row = np.searchsorted(bounds, start, "right") - 1
            inside = np.add.reduceat(_repeated(value)[0], start) > 0      # a window repeats in this very slice
            key = anchor[start]
            many, _ = _repeated(key)
            known = many | inside
            doc, at = ids[lo:hi][row].astype(np.int64), (start - bounds[row]).astype(np.int32)
            mark = np.unique(key[known])
            none = np.full(len(mark), -1, np.int32)
            out.append(_rows(np.concatenate([_scatter(np.where(known, key ^ mix(doc.view(np.uint64)), key), buckets), _scatter(mark, buckets)]),
                             np.concatenate([key, mark]), np.concatenate([doc, none.astype(np.int64)]), np.concatenate([at, none]),
                             np.concatenate([np.where(known, -size, size).astype(np.int32), none * 0])))
        return pa.Table.from_batches(out) if out else None

    def count(group: pa.Table) -> pa.Table:
        key, doc, start, size = (flat_blobs(group.column(c), k)[0] for c, k in (("key", np.uint64), ("doc", np.int64), ("start", np.int32), ("size", np.int32)))
        known = size < 0
        _, inv = np.unique(key, return_inverse=True)
        weight = np.bincount(inv, weights=np.where(known, 0, np.where(size == 0, 2, 1)))
        keep = known | ((size > 0) & (weight[inv] >= 2))
        return pa.table({"doc": doc[keep], "start": start[keep], "size": np.abs(size[keep])})

    return arrow_map(docs, run, PLACES).groupBy("bucket").applyInArrow(count, "doc long, start int, size int")


def window_places(docs: DataFrame, places: DataFrame, buckets: int) -> DataFrame:
    """(doc, start, size): runs of repeated windows."""
    by_doc = places.groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    rows = docs.join(by_doc, docs.id == by_doc.doc).select("id", "text", "runs.start", "runs.size")

    def run(batch: pa.RecordBatch) -> pa.Table | None:
        texts, ids, out = texts_of(batch.column("text")), batch.column("id").to_numpy(zero_copy_only=False), []
        for lo, hi in text_slices(texts, SLICE):
            anchor, value, bounds = anchors_and_hashes(texts.slice(lo, hi - lo))
            starts, sizes = (batch.column(c).slice(lo, hi - lo) for c in ("start", "size"))
            n = pa.compute.list_value_length(starts).to_numpy(zero_copy_only=False)
            first = starts.flatten().to_numpy() + np.repeat(bounds[:-1], n)
            count = sizes.flatten().to_numpy().astype(np.int64)
            order = np.argsort(first)
            first, count = first[order], count[order]
            total = np.cumsum(count)
            at = np.unique(np.arange(total[-1]) + np.repeat(first - (total - count), count))   # candidate windows, in order
            row = np.searchsorted(bounds, at, "right") - 1
            known, one = _repeated(value[at])
            same = np.zeros(len(at), bool)
            same[1:] = (at[1:] == at[:-1] + 1) & (row[1:] == row[:-1]) & (anchor[at[1:]] == anchor[at[:-1]]) & (known[1:] == known[:-1])
            start, size = _runs(same)
            doc, pos = ids[lo:hi][row[start]].astype(np.int64), (at[start] - bounds[row[start]]).astype(np.int32)
            sure = known[start]
            # known runs go through without hashes; every repeated value is sent once as a marker
            of = np.concatenate([[0], np.cumsum(np.where(sure, 0, size))])
            hashes = value[at][~known]
            mark = at[one]
            key = np.concatenate([anchor[at[start]], anchor[mark]])
            spread = np.concatenate([np.where(sure, key[: len(start)] ^ mix(doc.view(np.uint64)), key[: len(start)]), key[len(start):]])
            out.append(_rows(_scatter(spread, buckets), key, np.concatenate([doc, np.full(len(mark), -1)]), np.concatenate([pos, np.full(len(mark), -1, np.int32)]),
                             np.concatenate([np.where(sure, -size, size), np.zeros(len(mark), np.int64)]).astype(np.int32),
                             np.concatenate([hashes, value[mark]]), np.concatenate([of, of[-1] + np.arange(1, len(mark) + 1)])))
        return pa.Table.from_batches(out) if out else None

    def count(group: pa.Table) -> pa.Table:
        doc, start, size, value = (flat_blobs(group.column(c), k)[0] for c, k in (("doc", np.int64), ("start", np.int32), ("size", np.int32), ("hash", np.uint64)))
        held = np.where(size < 0, 0, np.maximum(size, 1)).astype(np.int64)      # hashes of each item
        item = np.repeat(np.arange(len(size)), held)
        within = np.arange(len(item)) - np.repeat(np.cumsum(held) - held, held)
        _, inv = np.unique(value, return_inverse=True)
        weight = np.bincount(inv, weights=np.where(size[item] == 0, 2, 1))
        good = (weight[inv] >= 2) & (size[item] > 0)
        d, p = doc[item][good], (start[item] + within)[good]
        same = np.zeros(len(d), bool)
        same[1:] = (d[1:] == d[:-1]) & (p[1:] == p[:-1] + 1)
        first, n = _runs(same)
        sure = size < 0
        return pa.table({"doc": np.concatenate([d[first], doc[sure]]), "start": np.concatenate([p[first], start[sure]]).astype(np.int32),
                         "size": np.concatenate([n, -size[sure]]).astype(np.int32)})

    return arrow_map(rows, run, PLACES).groupBy("bucket").applyInArrow(count, "doc long, start int, size int")


def removal_intervals(docs: DataFrame) -> DataFrame:
    """(doc, start, size) runs of repeated windows of ``docs`` (id, text): words start .. start + size + WINDOW - 2 go."""
    spark = importable(docs.sparkSession)
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(parts, int(words // 6 // 8 // BUCKET_ITEMS))
    places = staged(anchor_places(docs, buckets), "anchor-places")
    return staged(window_places(docs, places, buckets), "window-places")


def keyed(docs: DataFrame) -> DataFrame:
    """(id, doc_id, text): ``id`` tells rows apart; doc_id itself where it is never null and never repeated."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain = rows.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()
    return rows.withColumn("id", F.col("doc_id") if plain else F.xxhash64("doc_id", "text"))


def _with_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text and the runs of repeated windows of every row."""
    rows = keyed(docs)
    places = removal_intervals(rows.select("id", "text"))
    by_doc = places.groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    return rows.join(by_doc, rows.id == by_doc.doc, "left").select("doc_id", "text", "runs.start", "runs.size")


def merged(start: np.ndarray, size: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal word intervals [from, to) that repeated windows cover."""
    out: list[tuple[int, int]] = []
    for a, n in sorted(zip(start.tolist(), size.tolist())):
        b = a + n + window - 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, start, size in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "start", "size"))):
            words = (text or "").encode().split()
            spans = merged(np.array(start or [], np.int64), np.array(size or [], np.int64))
            kept, last = [], 0
            for a, b in spans:
                kept += words[last:a]
                last = b
            kept += words[last:]
            body = b" ".join(kept)
            rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest() if digest else body.decode()))
        cols = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "text"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the text that is left."""
    return _with_runs(docs).mapInArrow(lambda b: _cut(b, False), "doc_id long, n_words long, n_removed long, text string")


def removal_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return _with_runs(docs).mapInArrow(lambda b: _cut(b, True), "doc_id long, n_words long, n_removed long, kept_sha256 string")
