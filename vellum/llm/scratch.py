"""Intermediate tables in the folder that all executors share.

A job that is cut into steps writes each step's rows as a Parquet table below ``spark.checkpoint.dir`` and reads
them back, so that an executor lost later costs one task and not the whole lineage. A table's files go when no
plan in the JVM refers to them any more, and at the latest when the driver's JVM ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K1, K2 = "__vellum_k1", "__vellum_k2"
#: So many keys at most are sent to every task by a join that takes the most frequent ones out of its shuffle.
HOT_KEYS = 10_000

_tables: list = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. One of our own only where none is set and all runs on this machine, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/vellum-{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)
    fs.cancelDeleteOnExit(p)


def watch(spark: SparkSession, frame: DataFrame, path: str) -> None:
    """Let ``path`` be deleted once no plan reads it through ``frame`` any more."""
    index = frame._jdf.queryExecution().analyzed().relation().location()
    _tables.append((spark.sparkContext._jvm.java.lang.ref.WeakReference(index), path, spark.sparkContext.applicationId))


def sweep(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    for entry in list(_tables):
        ref, path, owner = entry
        if owner != app:
            _tables.remove(entry)
        elif ref.get() is None:
            _tables.remove(entry)
            delete(spark, path)


def save(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it."""
    sweep(spark)
    path = new_folder(spark, name)
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    watch(spark, out, path)
    return out


def join_evenly(rows: DataFrame, keys: DataFrame, on: list[str], times: str) -> DataFrame:
    """``rows`` with those of ``keys`` (one row for each key; ``times``: how many of the rows have it, a column that is dropped). Keys that more than one row in
    HOT_KEYS has, and of which there can't be more than HOT_KEYS, are sent to every task; rows with such a key aren't shuffled. Both tables should be saved ones."""
    most = max(rows.count() // HOT_KEYS, 1)
    hot, cold = (keys.where(F.col(times) > most).drop(times), keys.where(F.col(times) <= most).drop(times))
    rest = rows.join(F.broadcast(hot.select(on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


def row_key(*cols: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a row's values in ``cols``; rows that are alike share them."""
    return [F.xxhash64(*cols).alias(K1), F.xxhash64(F.lit(7), *cols).alias(K2)]


def bounded_sample(df: DataFrame, n: int, *key: Column) -> DataFrame:
    """At most ``n`` rows of ``df``, those with the smallest hash of ``key``. Only about 1.5 n rows are sorted."""
    total = df.count()
    share = min(1.0, 1.5 * n / max(total, 1) + 64.0 / max(total, 1))
    slot = F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 30))
    return df.where(slot < int(share * (1 << 30)) + 1).orderBy(slot, *key).limit(n)
