"""Helpers shared by the operators: table reads, staged tables, Arrow task wrappers."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from reviewlab.session import ensure_checkpoint_dir


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (on a cluster: ship it with --py-files)."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (env.get("PYTHONPATH"), _ROOT) if p)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_MADE: list[list[str]] = []         # paths made inside each open ``scratch`` block, innermost last


def shared_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names; ``keep`` outlives the innermost ``scratch`` block."""
    base = importable(spark).conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    owners = _MADE[:-1] if keep else _MADE
    if owners:
        owners[-1].append(path)
    return path


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name, keep)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return freed memory to the system: processes live long, and what the last work needed would stay with them."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
        if trim:
            trim(0)


def let_go(spark: SparkSession) -> None:
    """Have both collectors run: Spark removes shuffle files and broadcasts of finished plans only once their
    driver objects are collected, which a driver with memory to spare puts off."""
    gc.collect()
    spark._jvm.System.gc()
    give_back()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, but for those made with ``keep``; nothing lazy may leave the block
    that still reads them. After an error they stay."""
    _MADE.append([])
    try:
        yield
    except BaseException:
        _MADE.pop()
        raise
    for path in _MADE.pop():
        drop_staged(spark, path)
    let_go(spark)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``; empty results are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield from out.to_batches() if isinstance(out, pa.Table) else (out,)
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, wanted: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``df`` for which ``wanted`` gives true, whatever their columns are called; nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(wanted(batch)))
        give_back()
    importable(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column with null read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per row: the bytes of ``values[bounds[i]:bounds[i + 1]]``."""
    width = values.dtype.itemsize
    offsets = (np.asarray(bounds, np.int64) * width).astype(np.int64)
    data = np.ascontiguousarray(values)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1,
                                            [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def flat_blobs(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``blobs``: (values of all rows, row bounds)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    data = b"".join(v for v in column.to_pylist() if v)
    return np.frombuffer(data, dtype), np.concatenate([[0], np.cumsum(sizes // np.dtype(dtype).itemsize)]).astype(np.int64)
