"""Rank-k SVD of sparse TF-IDF rows without their Gram matrix, and the 2-D projection made from it.

The right singular vectors of X are the eigenvectors of X'X, which is only ever multiplied with a thin block of
vectors: each task adds ``x (x . q)`` over its rows' non-zero entries, one aggregate sums the tasks' blocks per term.
The driver holds (terms x basis) numbers, at most ``BASIS`` columns, and never terms x terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.features import TfidfModel, literal

BLOCK = 8           # vectors multiplied in one pass over the rows
BASIS = 96          # columns of the basis kept on the driver before it is shrunk to its best BLOCK
PASSES = 60


def sparse_rows(df: DataFrame, weights: str) -> DataFrame:
    """(codes array<int>, values array<double>) of every row with an entry."""
    w = F.col(weights)
    return df.where(F.size(w) > 0).select(F.transform(w, lambda x: x["code"]).alias("codes"),
                                          F.transform(w, lambda x: x["weight"]).alias("values"))


def gram_product(rows: DataFrame, q: np.ndarray) -> DataFrame:
    """(code, q0, q1, ...): the rows of X'(Xq) that are not zero; ``q`` has one row per term and few columns."""
    n, k = q.shape
    names = [f"q{i}" for i in range(k)]
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(q, np.float64))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = shared.value, np.zeros((n, k))
        for batch in batches:
            lists = batch.column("codes")
            sizes = np.diff(lists.offsets.to_numpy())
            if not sizes.sum():
                continue
            codes = lists.flatten().to_numpy(zero_copy_only=False)
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            for j in range(k):
                dots = np.bincount(row, values * block[codes, j], len(sizes))
                total[:, j] += np.bincount(codes, values * dots[row], n)
        found = np.flatnonzero(total.any(axis=1))
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), *[pa.array(total[found, j]) for j in range(k)]],
                                             names=["code", *names])
    schema = ", ".join(["code int", *[f"{c} double" for c in names]])
    return rows.mapInArrow(multiply, schema).groupBy("code").agg(*[F.sum(c).alias(c) for c in names])


@dataclass(frozen=True)
class SingularVectors:
    values: np.ndarray          # singular values, largest first
    vectors: np.ndarray         # terms x k, the largest loading of each column is positive
    residual: float             # largest ||X'Xv - s^2 v|| relative to the largest s^2
    passes: int


def _orthogonal(block: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """Orthonormal columns spanning what ``block`` adds to ``basis``."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(2):          # the second round removes what rounding left of the basis
        if basis is not None:
            block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10]
    return block


def top_singular(rows: DataFrame, n_terms: int, k: int = 2, block: int = BLOCK, tol: float = 1e-10,
                 max_basis: int = BASIS, passes: int = PASSES, seed: int = 42) -> SingularVectors:
    """The k largest singular values and right singular vectors of the sparse rows.

    Each pass multiplies a block of new directions (what the best approximations so far still miss), so the
    basis is that of a block Lanczos method; when it is full, its best ``block`` columns are kept with their images and the
    search goes on. It ends at the tolerance, when the basis spans all terms, or after ``passes`` passes (see ``residual``).
    Without rows all values are 0. Fewer terms than k give fewer columns.
    """
    k = min(k, n_terms)
    if not k:
        return SingularVectors(np.zeros(0), np.zeros((n_terms, 0)), 0.0, 0)
    block = min(max(block, k), n_terms)
    new = _orthogonal(np.random.default_rng(seed).standard_normal((n_terms, block)), None)
    basis = images = np.zeros((n_terms, 0))
    for done in range(1, passes + 1):
        image = np.zeros((n_terms, new.shape[1]))
        part = gram_product(rows, new).toArrow()            # at most one row per term
        image[part["code"].to_numpy()] = np.column_stack([part[f"q{j}"].to_numpy() for j in range(new.shape[1])])
        basis, images = np.hstack([basis, new]), np.hstack([images, image])
        small = basis.T @ images
        lam, s = np.linalg.eigh((small + small.T) / 2)
        best = np.argsort(lam)[::-1][:block]
        lam, found, found_images = lam[best], basis @ s[:, best], images @ s[:, best]
        missing = found_images - found * lam
        residual = float(np.linalg.norm(missing[:, :k], axis=0).max() / lam[0]) if lam[0] > 0 else 0.0
        if residual <= tol or basis.shape[1] >= n_terms:
            break
        if basis.shape[1] + block > max_basis:
            basis, images = found, found_images
        new = _orthogonal(missing, basis)[:, :n_terms - basis.shape[1]]
        if not new.shape[1]:
            break
    vectors = found[:, :k].copy()
    for j in range(k):
        if vectors[abs(vectors[:, j]).argmax(), j] < 0:
            vectors[:, j] = -vectors[:, j]
    return SingularVectors(np.sqrt(np.maximum(lam[:k], 0.0)), vectors, residual, done)


@dataclass
class Projection:
    v: tuple[tuple[float, float], ...]    # V (n_features x 2)
    mean: tuple[float, float]
    std: tuple[float, float]
    singular: tuple[float, float] = (0.0, 0.0)

    def apply(self, weights: Column) -> tuple[Column, Column]:
        """Standardised coordinates of TF-IDF entries; an entry reads its loading by position."""
        cols = []
        for k in range(2):
            comp = literal([row[k] for row in self.v], "array<double>")
            dot = F.aggregate(weights, F.lit(0.0), lambda s, x: s + x["weight"] * F.element_at(comp, x["code"] + 1))
            std = self.std[k] if self.std[k] > 0 else 1.0
            cols.append((dot - F.lit(self.mean[k])) / F.lit(std))
        return cols[0], cols[1]


def fit_projection(df: DataFrame, tfidf: TfidfModel, weights: str) -> Projection:
    """Rank-2 SVD of the (uncentred) TF-IDF rows, standardised with population statistics."""
    rows = sparse_rows(df, weights).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        top = top_singular(rows, len(tfidf.terms))
    finally:
        rows.unpersist()
    pad = 2 - top.vectors.shape[1]
    v = tuple(map(tuple, np.pad(top.vectors, ((0, 0), (0, pad))).tolist()))
    singular = tuple(np.pad(top.values, (0, pad)).tolist())
    x, y = Projection(v, (0.0, 0.0), (1.0, 1.0)).apply(F.col(weights))
    st = df.select(x.alias("x"), y.alias("y")).agg(F.avg("x"), F.avg("y"), F.stddev_pop("x"), F.stddev_pop("y")).first()
    return Projection(v, (float(st[0] or 0.0), float(st[1] or 0.0)), (float(st[2] or 0.0), float(st[3] or 0.0)), singular)
