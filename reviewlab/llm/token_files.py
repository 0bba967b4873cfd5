"""Token-ID output: ORC files of token ids in ascending document order.

Files hold ``doc_id, n_tokens, local_start, tokens``. ORC writes integer columns with run-length encoding
(version 2), keeps row indexes and, for ``doc_id``, Bloom filters, so a lookup by document id skips files,
stripes and row groups, and every stripe can be read by its own task.

Rows are range-partitioned and sorted by ``doc_id`` before they are encoded, so only texts are shuffled.
Defined cases: null text encodes to the end id alone; a null ``doc_id`` sorts first; repeated ids keep every
row, next to each other, ordered by text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import give_back, importable, shared_path, texts_of
from reviewlab.llm.words import text_slices

END_ID = 0
STRIPE_BYTES = 64 << 20
ROW_INDEX_STRIDE = 1000
BLOOM_FPP = 0.01
SLICE_BYTES = 8 << 20      # larger slices find more repeated words
GLUE = 2000                # pieces encoded in one call
PUT_BACK = 1 << 18         # pieces whose ids are put back in place at once

FILE_SCHEMA = "doc_id long, n_tokens long, local_start long, tokens array<int>"

# A space or line feed before one of these bytes starts a new pre-token whatever stands before it.
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_UNKNOWN, _BLANK, _LETTER, _DIGIT, _MARK = range(5)
_KIND = np.full(256, _UNKNOWN, np.uint8)        # other bytes from 128 on: see _LEADS
_KIND[:128] = _MARK
_KIND[28:32] = _UNKNOWN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[9:14] = _KIND[32] = _BLANK
_CHANGES = np.array([[left > _BLANK and right != left and right != _UNKNOWN for right in range(5)] for left in range(5)]).ravel()
_LEADS = np.zeros(256, bool)                    # first bytes of Latin and Cyrillic letters of two bytes
_LEADS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True
_SIGNS = np.zeros(256, bool)                    # after 0xC3 these are no letters: the signs of multiplication and division
_SIGNS[[0x97, 0xB7]] = True
# A byte-level vocabulary writes visible Latin-1 bytes as themselves and the others as characters from 256 on.
_WRITTEN = np.arange(256, dtype="<u4")
_WRITTEN[[*range(33), *range(127, 161), 173]] = 256 + np.arange(68)


@lru_cache(maxsize=2)
def _load(path: str):
    """(tokenizer, bytes of each token)."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    if hasattr(t.model, "_resize_cache"):
        t.model._resize_cache(0)            # no word is encoded twice in a slice
    vocab = t.get_vocab()
    width = np.zeros(max(vocab.values()) + 1, np.int64)
    for s, i in vocab.items():
        width[i] = len(s)                   # byte-level vocabulary: one character stands for one byte
    return t, width


@lru_cache(maxsize=2)
def _rules(path: str):
    """(added tokens, whether all other text is cut as the plain byte-level pre-tokenizer cuts it)."""
    from tokenizers import pre_tokenizers
    t, _ = _load(path)
    added = [a.content.encode() for a in t.get_added_tokens_decoder().values()]
    split = t.pre_tokenizer
    return added, (isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space
                   and t.normalizer is None and all(_MARK in _KIND[[*token]] for token in added))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _kinds(data: np.ndarray) -> np.ndarray:
    """What each byte belongs to, as far as one or two bytes tell."""
    kind = _KIND[data]
    at = np.flatnonzero(_LEADS[data])
    at = at[~((data[at] == 0xC3) & _SIGNS[data[at + 1]])]
    kind[at] = kind[at + 1] = _LETTER
    return kind


def _cuts(data: np.ndarray, added: list[bytes], plain: bool) -> np.ndarray:
    """Where the pre-tokenizer always cuts, whatever stands farther left or right: before each byte of ``data``.

    Before a space that a visible character follows; if ``plain`` also between letters, digits and marks (but for an
    apostrophe and a letter), before white space, and after a single line feed or tab. Added tokens stay whole, with
    the white space before them.
    """
    cut = np.zeros(len(data) + 1, bool)
    kind = _kinds(data)
    if plain:
        cut[1:-1] = _CHANGES[kind[:-1] * np.uint8(5) + kind[1:]]
        at = np.flatnonzero(data[:-1] == 39)
        cut[at[kind[at + 1] == _LETTER] + 1] = False
        at = np.flatnonzero((kind[1:-1] == _BLANK) & (data[1:-1] != 32)) + 1
        cut[at[(kind[at - 1] > _BLANK) & (kind[at + 1] > _BLANK)] + 1] = True
    at = np.flatnonzero(data[:-1] == 32)
    cut[at[_SOLID[data[at + 1]]]] = True
    for token in added:
        whole = data.tobytes()
        p = whole.find(token)
        firm = np.flatnonzero(kind > _BLANK) if p >= 0 else None
        while p >= 0:
            i = np.searchsorted(firm, p)
            cut[(firm[i - 1] if i else -1) + 2:p + len(token)] = False
            p = whole.find(token, p + 1)
    return cut


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, bounds) of an array without nulls."""
    off = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] else np.zeros(0, np.uint8), off - off[0]


def _ids_of_words(words: pa.Array, model) -> np.ndarray:
    """Ids of pieces that the pre-tokenizer leaves whole: these go straight to the model."""
    data, edge = _bytes_of(words)
    written = _WRITTEN[data].tobytes().decode("utf-32-le")
    tokenize = model.tokenize
    return np.fromiter((t.id for a, b in zip(edge.tolist(), edge[1:].tolist()) for t in tokenize(written[a:b])), np.uint32)


def _ids_of_pieces(pieces: pa.Array, tokenizer, added: list[bytes], plain: bool) -> np.ndarray:
    """Ids of any pieces; some are encoded in one call where that keeps them apart."""
    data, edge = _bytes_of(pieces)
    start = ~_cuts(data, added, plain)[edge]
    start[::GLUE] = start[-1] = True
    call = edge[start].tolist()
    coded = tokenizer.encode_batch_fast([data[a:b].tobytes().decode() for a, b in zip(call, call[1:])], add_special_tokens=False)
    return np.concatenate([np.array(e.ids, np.uint32) for e in coded])


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, row bounds), the same ids as encoding each whole text on its own.

    Texts are cut where the byte-level pre-tokenizer always cuts (``_cuts``); each distinct piece is encoded once,
    words of letters without the pre-tokenizer, and the ids are put back in place.
    """
    (tokenizer, width), (added, plain) = _load(path), _rules(path)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.uint32), np.zeros(len(ends) + 1, np.int64)
    before = int(np.frombuffer(texts.buffers()[1], np.int32, 1, 4 * texts.offset)[0])
    blob = texts.buffers()[2].slice(before, int(ends[-1]))          # the texts' bytes one after the other, not copied
    data = np.frombuffer(blob, np.uint8)
    cut = _cuts(data, added, plain)
    last = ends[ends > 0] - 1
    cut[last[data[last] == 32]] = False     # the next byte belongs to another text
    cut[0] = True
    cut[ends] = True
    off = np.flatnonzero(cut).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(off) - 1, pa.py_buffer(off), blob).dictionary_encode()
    unique, index = pieces.dictionary, pieces.indices.to_numpy()
    word = np.zeros(len(unique), bool)
    if plain:                               # letters alone, or after one space
        data, edge = _bytes_of(unique)
        space = data[edge[:-1]] == 32
        word = (np.add.reduceat(_kinds(data) != _LETTER, edge[:-1], dtype=np.int64) == space) & (np.diff(edge) > space)
    order = np.argsort(~word, kind="stable")
    words, others = unique.take(pa.array(order[:word.sum()])), unique.take(pa.array(order[word.sum():]))
    flat = [_ids_of_words(words, tokenizer.model)] if len(words) else []
    if len(others):
        flat.append(_ids_of_pieces(others, tokenizer, added, plain))
    flat = np.concatenate(flat)
    at = np.concatenate([[0], np.cumsum(width[flat])])
    edge = np.concatenate([[0], np.cumsum(pc.binary_length(unique).to_numpy()[order])])
    pos = np.searchsorted(at, edge)
    if not np.array_equal(at[pos], edge):
        raise ValueError("token boundaries do not match word boundaries")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    index = place[index]
    size = np.diff(pos).astype(np.int32)[index]
    total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    out = np.empty(total[-1], np.uint32)
    for lo in range(0, len(size), PUT_BACK):                        # in parts: positions take more room than ids
        part = slice(lo, lo + PUT_BACK)
        a, b = total[lo], total[min(lo + PUT_BACK, len(size))]
        out[a:b] = flat[np.repeat(pos[index[part]] - total[:-1][part], size[part]) + np.arange(a, b)]
    return out, np.concatenate([[0], total[np.searchsorted(off, ends)]])


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the ORC files under ``path``."""
    importable(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            texts, ids = texts_of(batch.column("text")), batch.column("doc_id")
            for lo, hi in text_slices(texts, SLICE_BYTES):
                flat, bounds = encode(texts.slice(lo, hi - lo), tokenizer)
                flat = np.insert(flat, bounds[1:], end_id).astype(np.int32)
                bounds = bounds + np.arange(len(bounds))
                n = np.diff(bounds)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(n), pa.array(start + bounds[:-1]),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))],
                    names=["doc_id", "n_tokens", "local_start", "tokens"])
                start += int(bounds[-1])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, FILE_SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.row.index.stride", ROW_INDEX_STRIDE).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP)
     .orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows and the ``file`` each one stands in."""
    return importable(spark).read.schema(FILE_SCHEMA).orc(path).withColumn("file", F.input_file_name())


def file_offsets(stored: DataFrame) -> DataFrame:
    """(file, base): what ``local_start`` lacks in each file. A task may write several files, so a file's own first
    ``local_start`` is taken off. One row per file is added up, in document order."""
    files = stored.groupBy("file").agg(F.sum("n_tokens").alias("held"), F.min("local_start").alias("first"),
                                       F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("lowest"))
    # files that hold rows of one id follow each other as their task wrote them
    before = Window.orderBy("lowest", "first", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("base"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Stored rows of some documents; min/max statistics and Bloom filters prune files, stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path).where(F.col("doc_id").isin(*doc_ids))


def digest(stored: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the CRC-32 of the ids as little-endian
    unsigned 32-bit integers. Only the digest rows meet the file offsets, not the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(n)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends - n, ends)]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("doc_id"), batch.column("local_start"),
                                              pa.array(n), pa.array(crc, pa.int64())],
                                             names=["file", "doc_id", "local_start", "n_tokens", "ids_crc32"])
    rows = stored.select("file", "doc_id", "local_start", "tokens").mapInArrow(
        run, "file string, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return (rows.join(file_offsets(stored), "file")
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_output(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the files to the shared folder, read them back and return the digest of every document."""
    spark = docs.sparkSession
    path = shared_path(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return digest(read_token_files(spark, path))
