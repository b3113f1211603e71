"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts
    lineage, survives lost executors, and what reads it twice computes it once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(col: str, divisor: int) -> Column:
    """crc32 of the id as text, mod ``divisor`` (a null id counts as 0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(0)) % divisor


def slices(batches, rows: int = 1000):
    """Arrow batches cut to at most ``rows`` rows, so that a task holds few texts as Python objects."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)
    give_back()


def portions(batches, column: str, size: int = 8 << 20):
    """Arrow batches cut so that the texts of ``column`` have about ``size`` bytes (a longer one alone)."""
    for b in batches:
        at = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                yield b.slice(lo, hi - lo)
    give_back()


def give_back() -> None:
    """Freed memory goes back to the system: a worker idle between tasks would else keep its peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file; the folder may be set by the
    environment variable LEDGERLAKE_TOKENIZERS."""
    root = os.environ.get("LEDGERLAKE_TOKENIZERS")
    if root:
        return os.path.join(root, name)
    import public_tokenizers
    return public_tokenizers.path(name)
