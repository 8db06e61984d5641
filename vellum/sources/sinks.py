"""Where results go: tables, pages, logs, and the versions of what is live."""

from __future__ import annotations

import hashlib
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage

#: How many buckets a table by key has.
BUCKETS = 64
#: An archive of pages ends with the page that brings it to so many pages or bytes.
PACK_PAGES, PACK_BYTES = 10_000, 1 << 26


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def save_table(rows: DataFrame, path: str, replace: bool = True, partition_by: tuple[str, ...] = ()) -> None:
    """Write a table. Without ``replace`` one that exists is an error; nothing is asked."""
    w = rows.write.mode("overwrite" if replace else "errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def save_by_key(rows: DataFrame, path: str, key: str, n: int = BUCKETS) -> None:
    """Write a table in ``n`` buckets of ``key``, each sorted by it: what an index is to a database. The folder below ``path`` says so in its name, so that no reader takes it for another layout."""
    spark, at = rows.sparkSession, f"{path.rstrip('/')}/by={key}-{n}"
    drop(spark, path)
    name = _table_name(at)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # a bucket is one task's, so it is one sorted file
    rows.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key).option("path", at).saveAsTable(name)


def load_by_key(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A table that ``save_by_key`` wrote, in this session or in another. Joins and aggregations by its key need no exchange."""
    fs, p = file_system(spark, path)
    found = [str(s.getPath()) for s in (fs.listStatus(p) if fs.exists(p) else []) if s.getPath().getName().startswith(f"by={key}-")]
    if not found:
        raise FileNotFoundError(f"{path} holds no table by {key}")
    at, n = found[0], int(found[0].rpartition("-")[2])
    name = _table_name(f"{path.rstrip('/')}/by={key}-{n}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(at).dtypes)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{at}'")
    return spark.table(name)


def _table_name(at: str) -> str:
    return "vellum_" + hashlib.md5(at.encode()).hexdigest()


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


# -- pages -----------------------------------------------------------------------------------------------------------------------------------------------


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    n: int


class PageSink(DataSource):
    """Rows (path, html) as files below a folder. Rows of one path that follow each other in a task go into one file, one behind the other. Each attempt at a task writes into a folder of its own; when all are done, the names of
    those that count are left in committed.txt, and if any fails for good nothing is left."""

    @classmethod
    def name(cls) -> str:
        return "vellum_pages"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return {"files": _PageWriter, "zip": _PackWriter, "arrows": _StreamWriter}[self.options.get("form", "files")](self.options["path"])


class _PageWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def write(self, iterator) -> WriterCommitMessage:
        import pyarrow.fs as pafs

        t = TaskContext.get()
        mine = f"{t.partitionId()}-{t.taskAttemptId()}"
        fs, root = pafs.FileSystem.from_uri(self.folder)
        now, out, n, made = None, None, 0, set()
        try:
            for path, html in iterator:
                if path != now:
                    if out:
                        out.close()
                    now, n = path, n + 1
                    where = f"{root}/{mine}/{path.lstrip('/')}"
                    up = where.rsplit("/", 1)[0]
                    if up not in made:
                        fs.create_dir(up, recursive=True)
                        made.add(up)
                    out = fs.open_output_stream(where)
                out.write(html.encode())
        finally:
            if out:
                out.close()
        return _Written(mine, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/committed.txt") as out:
            out.write("".join(f"{m.folder}\n" for m in messages if m and m.n).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(self.folder)
        if fs.get_file_info(root).type != pafs.FileType.NotFound:
            fs.delete_dir(root)


class _PackWriter(_PageWriter):
    """The same into zip archives, whose names no other task or save gives."""

    def write(self, iterator) -> WriterCommitMessage:
        import pyarrow.fs as pafs

        t = TaskContext.get()
        mine = f"{t.partitionId()}-{t.taskAttemptId()}"
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(f"{root}/{mine}", recursive=True)
        now, raw, pack, page, n, held, size = None, None, None, None, 0, 0, 0
        try:
            for path, html in iterator:
                if path != now:
                    if "\0" in path:
                        raise ValueError(f"no archive can name {path!r}")
                    if page:
                        page.close()
                        page = None
                    if pack and (held >= PACK_PAGES or size >= PACK_BYTES):
                        pack.close()
                        raw.close()
                        pack = None
                    if not pack:
                        raw = fs.open_output_stream(f"{root}/{mine}/{uuid.uuid4().hex}.zip")
                        pack, held, size = zipfile.ZipFile(_Forward(raw), "w", zipfile.ZIP_DEFLATED), 0, 0
                    now, n, held = path, n + 1, held + 1
                    info = zipfile.ZipInfo(path)
                    info.compress_type = zipfile.ZIP_DEFLATED
                    page = pack.open(info, "w", force_zip64=True)
                data = html.encode()
                size += len(data)
                page.write(data)
        finally:
            for x in (page, pack, raw):
                if x:
                    x.close()
        return _Written(mine, n)


class _StreamWriter(_PageWriter, DataSourceArrowWriter):
    """The same into Arrow streams (path, html), in which a page is a row, or several that follow each other. Streams are compressed across pages, and no page costs Python anything."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import pyarrow.fs as pafs

        t = TaskContext.get()
        mine = f"{t.partitionId()}-{t.taskAttemptId()}"
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(f"{root}/{mine}", recursive=True)
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        now, raw, out, n, held, size = None, None, None, 0, 0, 0
        try:
            for b in iterator:
                b = _one_row_each(b)
                while b.num_rows:
                    goes_on = b.column(0)[0].as_py() == now
                    full = out and (held >= PACK_PAGES or size >= PACK_BYTES)
                    if full and not goes_on:
                        out.close()
                        raw.close()
                        out = None
                    if not out:
                        raw = fs.open_output_stream(f"{root}/{mine}/{uuid.uuid4().hex}.arrows")
                        out, held, size = pa.ipc.new_stream(raw, b.schema, options=options), 0, 0
                    # a full stream takes the rest of its last page and no more
                    part = b.slice(0, 1) if full and goes_on else b
                    out.write_batch(part)
                    now, held, size, n = part.column(0)[-1].as_py(), held + part.num_rows - goes_on, size + part.nbytes, n + part.num_rows - goes_on
                    b = b.slice(part.num_rows)
        finally:
            for x in (out, raw):
                if x:
                    x.close()
        return _Written(mine, n)


def _one_row_each(b: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (path, html), neither null, with those that follow each other with one path as one row. Their texts lie one behind the other as they are."""
    path, html = b.column(0).cast(pa.large_string()), b.column(1).cast(pa.large_string())
    if len(path):
        first = np.flatnonzero(np.r_[True, pc.not_equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy(zero_copy_only=False)])
        at = np.frombuffer(html.buffers()[1], np.int64)[html.offset : html.offset + len(html) + 1]
        path, html = path.take(pa.array(first)), pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at[np.r_[first, len(html)]]), html.buffers()[2])
    return pa.RecordBatch.from_arrays([path, html], ["path", "html"])


class _Forward:
    """A stream that is only written forward, as a zip archive may be."""

    def __init__(self, out):
        self.write, self.flush = out.write, out.flush


def _move(stage: str, folder: str):
    """From names of tasks' folders below ``stage``: their files moved to ``folder``, and how many there were. A task that runs twice finds its files gone and does no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(folder.rstrip("/"))
        _, from_ = pafs.FileSystem.from_uri(stage)
        for b in batches:
            counts = []
            for mine in b.column(0).to_pylist():
                base, made = f"{from_}/{mine}", set()
                files = [f.path for f in fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)) if f.is_file]
                for f in files:
                    to = f"{root}/{f[len(base) :].lstrip('/')}"
                    up = to.rsplit("/", 1)[0]
                    if up not in made:
                        fs.create_dir(up, recursive=True)
                        made.add(up)
                    fs.move(f, to)
                counts.append(len(files))
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n"])

    return run


def _commit(rows: DataFrame, folder: str, form: str = "files") -> None:
    spark, folder = rows.sparkSession, folder.rstrip("/")
    stage = f"{folder}.{uuid.uuid4().hex}.part"
    spark.dataSource.register(PageSink)
    try:
        rows.write.format("vellum_pages").option("form", form).mode("append").save(stage)
        done = spark.read.text(f"{stage}/committed.txt").repartition(spark.sparkContext.defaultParallelism * 4, "value")
        done.mapInArrow(_move(stage, folder), "n bigint").agg(F.sum("n")).collect()
    finally:
        drop(spark, stage)


def save_pages(pages: DataFrame, folder: str, path_col: str = "path", html_col: str = "html") -> None:
    """One file per row, below ``folder``, in the file system that the folder is in. No file of ``folder`` is touched before all tasks have written theirs beside it; then tasks move them to their places. A job that fails leaves the folder
    as it was. (Readers that mustn't see some new pages and some old ones are served by ``publish``.)"""
    _commit(pages.select(F.col(path_col).alias("path"), F.col(html_col).alias("html")).where("path is not null and html is not null"), folder)


def save_page_blocks(blocks: DataFrame, folder: str) -> None:
    """As ``save_pages``, for pages in blocks: path, place and html. A page's blocks are written one behind the other in order of place, as they come, so neither a row nor a task holds a whole page."""
    _commit(_in_order(blocks), folder)


def save_packed_blocks(blocks: DataFrame, folder: str) -> None:
    """As ``save_page_blocks``, into zip archives below a folder that holds nothing yet: pages number too many where each takes a block of the disk and a place in a directory. ``pages.packed`` reads them."""
    fs, p = file_system(blocks.sparkSession, folder)
    if fs.exists(p) and fs.listStatus(p):
        raise FileExistsError(f"{folder} isn't empty")
    _commit(_in_order(blocks), folder, "zip")


def save_streams(rows: DataFrame, folder: str) -> None:
    """As ``save_packed_blocks``, for rows (path, html) that are in order already: all blocks of a page in one task, one behind the other. They go into Arrow streams, which are compressed across pages, so many small pages take less of the disk than an
    archive's entries do. ``pages.streamed`` reads them."""
    fs, p = file_system(rows.sparkSession, folder)
    if fs.exists(p) and fs.listStatus(p):
        raise FileExistsError(f"{folder} isn't empty")
    _commit(rows.select("path", "html").where("path is not null and html is not null"), folder, "arrows")


def _in_order(blocks: DataFrame) -> DataFrame:
    return blocks.where("path is not null and html is not null").repartition("path").sortWithinPartitions("path", "place").select("path", "html")


def stale(old: DataFrame, new: DataFrame, path_col: str = "path") -> DataFrame:
    """Paths that were written before and aren't any more."""
    return old.select(path_col).join(new.select(path_col), path_col, "left_anti")


def purge(spark: SparkSession, folder: str, before: datetime, suffix: str = ".html") -> int:
    """Delete the files below ``folder`` with this suffix that were last written before a time, each task its own, and count them. No path comes to the driver; a task that runs twice finds its files
    gone and does no harm."""
    import pyarrow.fs as pafs

    hadoop, p = file_system(spark, folder)
    address_of_folder = hadoop.makeQualified(p).toString().rstrip("/")

    def delete(batches):
        # names of pages may hold what no address may, so only the folder is read as one
        fs, root = pafs.FileSystem.from_uri(folder.rstrip("/"))
        for b in batches:
            for address in b.column(0).to_pylist():
                path = root + address[len(address_of_folder) :]
                if fs.get_file_info(path).type != pafs.FileType.NotFound:
                    fs.delete_file(path)
            yield b

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(folder)
    return files.where(F.col("modificationTime") < F.lit(before)).select("path").mapInArrow(delete, "path string").count()


# -- versions ----------------------------------------------------------------------------------------------------------------------------------------------

POINTER = "CURRENT"


def current(spark: SparkSession, live: str) -> str | None:
    """The folder of the version that is live; None before the first one."""
    fs, p = file_system(spark, f"{live.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    jvm, stream = spark.sparkContext._jvm, fs.open(p)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, jvm.java.nio.charset.StandardCharsets.UTF_8).strip()
    finally:
        stream.close()
    return f"{live.rstrip('/')}/{name}"


def publish(spark: SparkSession, staging: str, live: str) -> str:
    """Make the staging folder the live version: it is moved below ``live`` as a new version, then the pointer to the current one is replaced in one step, and versions before the last one go. Readers go by ``current`` and have the whole
    old state or the whole new one, wherever this stops. The new version's folder is returned."""
    fs, a = file_system(spark, staging)
    if not fs.exists(a):
        raise FileNotFoundError(f"there is no staging folder {staging}; {live} stays as it is")
    live, name = live.rstrip("/"), f"v-{uuid.uuid4().hex}"
    path = lambda x: file_system(spark, f"{live}/{x}")[1]
    before = current(spark, live)
    fs.mkdirs(file_system(spark, live)[1])
    if not fs.rename(a, path(name)):
        raise OSError(f"can't move {staging} to {live}/{name}")
    _point(spark, live, name)
    keep = {name, before.rpartition("/")[2] if before else None}
    for s in fs.listStatus(file_system(spark, live)[1]):
        if s.getPath().getName().startswith("v-") and s.getPath().getName() not in keep:
            fs.delete(s.getPath(), True)
    return f"{live}/{name}"


def roll_back(spark: SparkSession, live: str) -> str:
    """Make the version before the current one live again."""
    now, fs = current(spark, live), file_system(spark, live)[0]
    others = [s.getPath().getName() for s in fs.listStatus(file_system(spark, live)[1]) if s.getPath().getName().startswith("v-")]
    others = [x for x in others if now is None or x != now.rpartition("/")[2]]
    if not others:
        raise FileNotFoundError(f"{live} has no other version")
    _point(spark, live.rstrip("/"), others[0])
    return f"{live.rstrip('/')}/{others[0]}"


def _point(spark: SparkSession, live: str, name: str) -> None:
    """Write a pointer beside the current one and put it in its place, which file systems do in one step."""
    jvm, new = spark.sparkContext._jvm, f"{live}/{POINTER}.{uuid.uuid4().hex}"
    fs, p = file_system(spark, new)
    out = fs.create(p, True)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    options = jvm.org.apache.hadoop.fs.Options
    overwrite = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    overwrite[0] = getattr(options, "Rename").OVERWRITE
    target = file_system(spark, f"{live}/{POINTER}")[1]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, target, overwrite)


# -- logs ------------------------------------------------------------------------------------------------------------------------------------------------


def errors(rows: DataFrame, stage: str, key: Column, message: Column) -> DataFrame:
    """Rows of the error table: stage, key, message."""
    return rows.where(message.isNotNull()).select(F.lit(stage).alias("stage"), key.cast("string").alias("key"), message.alias("message"))


def log_lines(errors_: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """The lines of a log: "[stage] key: message" for each error, and "*** message" for each counter (columns name and n)."""
    lines = errors_.select(F.concat(F.lit("["), "stage", F.lit("] "), "key", F.lit(": "), "message").alias("line"))
    return lines if counters is None else lines.unionByName(counters.select(F.concat(F.lit("*** "), "name", F.lit(": "), F.col("n").cast("string")).alias("line")))
