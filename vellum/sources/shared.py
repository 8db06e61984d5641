"""Tables and files on their way, in the folder that all executors share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

Batches = Iterator[pa.RecordBatch]
#: What Python holds of a column at once, but for one row that is longer.
PIECE = 1 << 20


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, gone when the driver ends; below one of our own where none is set and all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/vellum-{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def save(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to a table in the shared folder and read back: what follows neither makes them again nor loses them with an executor."""
    spark = rows.sparkSession
    path = folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a write or an action within goes from the disks when that is done, and not when the driver's JVM next collects garbage, which may be never."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def pieces(batches: Batches, column: int, most: int = PIECE) -> Batches:
    """Batches cut into runs of rows whose texts (or bytes) in one column take up to ``most`` bytes together, so that memory depends on neither the number of rows in a batch nor that of batches in a task."""
    for b in batches:
        size = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)]
        at = 0
        while at < b.num_rows:
            to = max(int(np.searchsorted(size, size[at] + most, "right")) - 1, at + 1)
            yield b.slice(at, to - at)
            at = to


def thrifty(f: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``f``, giving freed memory back to the system once its partition is done: workers outlive their tasks and wait beside the JVM."""

    @wraps(f)
    def run(batches: Batches) -> Batches:
        try:
            yield from f(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run
