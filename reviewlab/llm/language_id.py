"""Language identification with blended-spectrum string kernels.

A text is the set of its character n-grams (n = 1..4 of the lower-cased text, digits and punctuation read as
spaces); the kernel of two texts is the number of n-grams in both, divided by the geometric mean of their
numbers. The Nystrom method maps a text to its kernel values with ``LANDMARKS`` training texts, whitened
by the landmarks' own kernel matrix; one-versus-rest kernel ridge regression in that space gives a score per
language. Texts are scored by batched matrix products: presence matrix x landmark matrix x coefficients.

N-grams are hashed to ``BUCKETS`` presence bits. Fitting uses a bounded sample of labelled rows (``SAMPLE`` per
language, chosen by a hash of the text); scoring reads every text from start to end, in pieces.

Defined cases: null text or a text without a letter gives ``und`` with score 0; equal scores go to the
language that sorts first; a table without labelled rows gives ``und`` for all; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, keep_rows, texts_of

UNKNOWN = "und"
SAMPLE = 400          # fitting rows per language
LANDMARKS = 256       # over all languages
BUCKETS = 1 << 15
MAX_N = 4
RIDGE = 1e-3
SHARP = 8.0           # scores are softmax(SHARP * ridge outputs)
BLOCK = 64            # texts per matrix product
PIECE = 1 << 16       # characters hashed at once

_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def presence(text: str) -> np.ndarray:
    """Hashed n-gram presence of one whole text (bool vector), n = 1..MAX_N."""
    bits = np.zeros(BUCKETS, bool)
    text = " " + text.lower() + " "
    for lo in range(0, len(text), PIECE):
        c = np.frombuffer(text[lo:lo + PIECE + MAX_N - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where((c < 97) | ((c > 122) & (c < 0xAA)) | ((c >= 0x2000) & (c < 0x2070)), np.uint32(32), c)
        h = np.zeros(len(c), np.uint32)
        for n in range(MAX_N):
            if len(c) <= n:
                break
            h = (h[: len(c) - n] + c[n:] * _MULT[n]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
            bits[(h * np.uint32(0x2C1B3C6D)) >> np.uint32(17)] = True
    return bits


def has_letter(text: str) -> bool:
    return any(ch.isalpha() for ch in text[:256]) or any(ch.isalpha() for ch in text[256:])


def kernel(bits: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Normalised presence kernel between rows of ``bits`` and the landmarks."""
    own = bits.sum(1, dtype=np.float32)
    both = bits.astype(np.float32) @ landmarks
    return both / np.sqrt(np.maximum(own, 1)[:, None] * sizes[None, :])


def _unpacked(packed: np.ndarray) -> np.ndarray:
    return np.unpackbits(packed, axis=1).astype(bool)


def _kernel_rows(packed: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``kernel`` of packed presence rows, BLOCK rows at a time."""
    return np.concatenate([kernel(_unpacked(packed[i:i + BLOCK]), landmarks, sizes) for i in range(0, len(packed), BLOCK)]).astype(np.float64)


@dataclass
class LanguageModel:
    """Landmark matrix (BUCKETS x landmarks, 0/1), landmark sizes, coefficients (landmarks x languages)."""
    languages: list[str]
    landmarks: np.ndarray
    sizes: np.ndarray
    coef: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Softmax scores of every text, BLOCK texts per product."""
        out = np.zeros((len(texts), len(self.languages)))
        dense = self.landmarks.astype(np.float32)
        for lo in range(0, len(texts), BLOCK):
            bits = np.stack([presence(t) for t in texts[lo:lo + BLOCK]])
            z = SHARP * (kernel(bits, dense, self.sizes) @ self.coef + self.bias)
            z = np.exp(z - z.max(1, keepdims=True))
            out[lo:lo + BLOCK] = z / z.sum(1, keepdims=True)
        return out


def fit_rows(languages: list[str], presences: list[bytes]) -> LanguageModel | None:
    """Fit on rows of (language, packed presence bits), in any order (they are sorted first)."""
    rows = sorted(set(zip(languages, presences)))
    names = sorted({lang for lang, _ in rows})
    if not names:
        return None
    packed = np.frombuffer(b"".join(p for _, p in rows), np.uint8).reshape(len(rows), -1)
    y = np.array([names.index(lang) for lang, _ in rows])
    per = max(1, LANDMARKS // len(names))
    rng = np.random.default_rng(7)
    pick = np.concatenate([rng.permutation(np.flatnonzero(y == k))[:per] for k in range(len(names))])
    land = _unpacked(packed[pick]).T
    sizes = np.maximum(land.sum(0, dtype=np.float32), 1)
    dense = land.astype(np.float32)
    value, vector = np.linalg.eigh(_kernel_rows(packed[pick], dense, sizes))
    keep = value > 1e-6 * value.max()
    white = vector[:, keep] / np.sqrt(value[keep])
    phi = _kernel_rows(packed, dense, sizes) @ white
    target = np.where(y[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
    weight = 1.0 / np.bincount(y, minlength=len(names))[y]          # languages count alike
    weight *= len(y) / weight.sum()
    mean, ty = np.average(phi, 0, weight), np.average(target, 0, weight)
    centred = (phi - mean) * weight[:, None]
    w = np.linalg.solve(centred.T @ (phi - mean) + RIDGE * len(y) * np.eye(phi.shape[1]), centred.T @ (target - ty))
    return LanguageModel(names, land, sizes, (white @ w).astype(np.float32), (ty - mean @ w).astype(np.float32))


def fit(labelled: DataFrame, per_language: int = SAMPLE) -> LanguageModel | None:
    """Fit on ``per_language`` different texts of every language: those with the smallest hashes.

    A share of hash space that holds about twice as many texts is read off each language's count of different
    texts; only hashes inside it are ranked. The texts that pass are turned into presence bits by tasks, so the
    driver holds languages x per_language bit vectors and no text."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("k"))
    reach = counts.select("lang", F.when(F.col("k") <= 4 * per_language, F.lit(float(1 << 63)))
                          .otherwise(F.lit(float(1 << 63)) * (4 * per_language / F.col("k") - 1)).alias("reach"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    last = (rows.select("lang", "h").join(reach, "lang").where(F.col("h") <= F.col("reach")).select("lang", "h").distinct()
            .withColumn("rank", rank).where(F.col("rank") <= per_language).groupBy("lang").agg(F.max("h").alias("last")))
    # one cut-off per language, as a filter on the scan: only texts under it move
    wanted = F.lit(False)
    for r in last.collect():
        wanted = wanted | ((F.col("lang") == r["lang"]) & (F.col("h") <= r["last"]))
    chosen = rows.where(wanted).dropDuplicates(["lang", "h"]).select("lang", "text")

    def bits(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        pairs = [(a, np.packbits(presence(t)).tobytes()) for a, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                 if has_letter(t)]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.binary())],
                                          names=["lang", "bits"])
    got = arrow_map(chosen, bits, "lang string, bits binary").collect()
    return fit_rows([r[0] for r in got], [bytes(r[1]) for r in got])


def _judged(texts: list[str], model: LanguageModel | None) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    if known:
        s = model.scores([texts[i] for i in known])
        best = s.argmax(1)
        for j, i in enumerate(known):
            lang[i], score[i] = model.languages[best[j]], s[j, best[j]]
    return lang, score


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _judged(texts_of(batch.column("text")).to_pylist(), shipped.value)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                     "doc_id long, lang_pred string, score double")


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows whose crc32(doc_id as text) mod 4 is not 2."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; fitted on the rows that are not held out."""
    model = fit(training_rows(docs))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def language_filter(docs: DataFrame, labelled: DataFrame | None = None, least: float = 0.0) -> DataFrame:
    """Pipeline stage: drop documents in no known language (``und``) or scored under ``least``; columns stay.

    Where nothing is labelled no language is known, and all documents with a letter stay."""
    model = fit(training_rows(docs) if labelled is None else labelled)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def wanted(batch: pa.RecordBatch) -> np.ndarray:
        texts = texts_of(batch.column("text")).to_pylist()
        if shipped.value is None:
            return np.array([has_letter(t) for t in texts])
        lang, score = _judged(texts, shipped.value)
        return np.array([x != UNKNOWN and s >= least for x, s in zip(lang, score)])
    return keep_rows(docs, wanted)
