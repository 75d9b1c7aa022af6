"""Shared helpers of the corpus operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tarn.session import scratch_dir


def reachable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, wherever the
    driver was started. (On a cluster the package is shipped, as any other.)"""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written under ``spark.checkpoint.dir``, one folder per run.

    A written table cuts the lineage: a lost executor costs the tasks that
    read it, never the stages that made it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = scratch_dir(spark, f"llm/{label}-{uuid.uuid4().hex}")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        # the schema is given: an empty table may have no file to infer it from
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# -- byte-level helpers for Arrow batches ------------------------------------

def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string column without making Python
    strings; a null text is an empty slice."""
    import pyarrow as pa

    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return off - off[0] if len(off) else np.zeros(1, np.int64), raw[off[0]: off[-1]] if len(off) else raw


def text_slices(batch, column: int, limit: int = 4 << 20):
    """A batch in slices of at most ``limit`` text bytes (one row at least):
    what numpy needs beside a text is many times its size."""
    off, _ = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64) over uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
