"""Files of pages: scan, decode, and the metadata of each."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from functools import partial, reduce
from operator import or_
from urllib.request import urlopen
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import citations, decode, html
from .shared import PIECE, pieces, thrifty
from .sinks import file_system

METADATA = "struct<title: string, source_url: string, citations: array<string>, court_name: string, date: date, parties: array<struct<position: int, name: string>>>"
#: What a task reads of small files, if there are enough of them to go round.
TASK = 1 << 25
SCHEMA = f"path string, filename string, page string, value {METADATA}, error string"


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """path (by which a file is known), filename (its last part), content of all *.html files below folders, and of the files named; a file that is named and also below a folder, or named twice, comes once."""
    files = list(dict.fromkeys(p for p in paths if p.endswith(".html")))
    folders = list(dict.fromkeys(p for p in paths if not p.endswith(".html")))
    parts = []
    if folders:
        parts.append(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(folders))
    if files:
        named = spark.read.format("binaryFile").load(files)
        roots = [_address(spark, f) for f in folders]
        # what Spark calls a file begins with what it calls the folder that it is below
        below = [F.col("path").startswith(r) for r in roots]
        parts.append(named.where(~reduce(or_, below)) if below else named)
    if not parts:
        raise ValueError("no path given")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # Spark counts each file as 4 MB, so a task would have 32 small ones, and Python's start and end would cost it more than they do
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    rows = rows.coalesce(max(size // TASK, spark.sparkContext.defaultParallelism * 4))
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "content")


def _address(spark: SparkSession, folder: str) -> str:
    fs, p = file_system(spark, folder)
    return str(fs.makeQualified(p).toString()).rstrip("/") + "/"


def packed(spark: SparkSession, folder: str) -> DataFrame:
    """path (as it was given), filename and content of all pages in the archives below a folder (``sinks.save_packed_blocks``)."""
    hadoop, p = file_system(spark, folder)
    top = hadoop.makeQualified(p).toString().rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        # as in sinks.purge: only the folder is read as an address
        fs, root = pafs.FileSystem.from_uri(folder.rstrip("/"))
        for b in batches:
            for address in b.column(0).to_pylist():
                with fs.open_input_file(root + address[len(top) :]) as raw, zipfile.ZipFile(raw) as pack:
                    paths, contents, size = [], [], 0
                    for info in pack.infolist():
                        paths.append(info.filename)
                        contents.append(pack.read(info))
                        size += info.file_size
                        if size >= PIECE:
                            yield _packed(paths, contents)
                            paths, contents, size = [], [], 0
                    yield _packed(paths, contents)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(folder)
    rows = files.select("path").mapInArrow(thrifty(run), "path string, content binary")
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "content")


def _packed(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])


def streamed(spark: SparkSession, folder: str) -> DataFrame:
    """path (as it was given), filename and content of all pages in the streams below a folder (``sinks.save_streams``)."""
    hadoop, p = file_system(spark, folder)
    top = hadoop.makeQualified(p).toString().rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        # as in sinks.purge: only the folder is read as an address
        fs, root = pafs.FileSystem.from_uri(folder.rstrip("/"))
        for b in batches:
            for address in b.column(0).to_pylist():
                with fs.open_input_stream(root + address[len(top) :]) as raw, pa.ipc.open_stream(raw) as stream:
                    yield from _whole(stream)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.arrows").load(folder)
    rows = files.select("path").mapInArrow(thrifty(run), "path string, content binary")
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "content")


def _whole(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of a stream, a row each: only the last row of a batch may go on in the next one."""
    path, parts = None, []
    for b in stream:
        paths, html = b.column(0).cast(pa.string()), b.column(1).cast(pa.large_binary())
        if path is not None and paths[0].as_py() == path:
            parts.append(html[0].as_py())
            paths, html = paths.slice(1), html.slice(1)
        if len(paths):
            if path is not None:
                yield _packed([path], [b"".join(parts)])
            path, parts = paths[-1].as_py(), [html[-1].as_py()]
            # cut by bytes, since the streams' batches are as long as their pages
            rest = pa.RecordBatch.from_arrays([paths.slice(0, len(paths) - 1), html.slice(0, len(html) - 1)], ["path", "content"])
            for x in pieces(iter([rest]), 1):
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1).cast(pa.binary())], ["path", "content"])
    if path is not None:
        yield _packed([path], [b"".join(parts)])


def metadata(page: str) -> dict:
    """What a clean page says about itself. Any part that is missing is a ConversionError."""
    tree = html.Index(html.parse(page))
    title = html.title(tree)
    return {
        "title": title, "source_url": html.source_url(tree), "citations": sorted({citations.weak(c) for c in citations.find_citations(tree, title)}), "court_name": html.court_name(tree),
        "date": citations.find_date(tree, title), "parties": [{"position": p, "name": n} for p, n in citations.parties(title)],
    }


def analyse(files: DataFrame) -> DataFrame:
    """Per file: path, filename, the clean page, and either its metadata (value) or what is wrong (error). Every file gives a row, whatever fails."""
    return files.select("path", "filename", "content").mapInArrow(thrifty(partial(_read, True)), SCHEMA)


def decoded(files: DataFrame) -> DataFrame:
    """As ``analyse``, where no metadata is wanted: path, filename, the clean page or what is wrong."""
    return files.select("path", "filename", "content").mapInArrow(thrifty(partial(_read, False)), "path string, filename string, page string, error string")


def _read(values: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 2):
        pages, found, errors = [], [], []
        for content in b.column(2):
            page, value, error = None, None, None
            try:
                page = decode.open_page(content.as_py() or b"")
                value = metadata(page) if values else None
            except decode.ConversionError as e:
                error = str(e)
            except Exception as e:  # noqa: BLE001 - a file that breaks the parser goes to the error table like any other
                error = f"{type(e).__name__}: {e}"
            pages.append(page)
            found.append(value)
            errors.append(error)
        value = {"value": _values(found)} if values else {}
        yield pa.RecordBatch.from_pydict({"path": b.column(0), "filename": b.column(1), "page": pa.array(pages, pa.string()), **value, "error": pa.array(errors, pa.string())})


def _values(found: list[dict | None]) -> pa.StructArray:
    """Metadata of pages, column by column."""
    none = dict.fromkeys(_VALUE.names) | {"parties": ()}
    rows = [v or none for v in found]
    people = [p for v in rows for p in v["parties"]]
    party = pa.StructArray.from_arrays([pa.array([p[k] for p in people], _PARTY[k].type) for k in _PARTY.names], fields=list(_PARTY))
    ends = np.r_[0, np.cumsum([len(v["parties"]) for v in rows])].astype(np.int32)
    columns = [pa.ListArray.from_arrays(pa.array(ends), party) if f.name == "parties" else pa.array([v[f.name] for v in rows], f.type) for f in _VALUE]
    return pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(columns, _VALUE, strict=True)], fields=list(_VALUE), mask=pa.array([v is None for v in found], pa.bool_()))


_PARTY = pa.struct([("position", pa.int32()), ("name", pa.string())])
_VALUE = pa.struct([("title", pa.string()), ("source_url", pa.string()), ("citations", pa.list_(pa.string())), ("court_name", pa.string()), ("date", pa.date32()), ("parties", pa.list_(_PARTY))])


# -- feeds -----------------------------------------------------------------------------------------------------------------------------------------------


def next_page(feed: ElementTree.Element) -> str | None:
    """Where a feed goes on: its first link to the next page that is its own and not an entry's."""
    for link in feed.findall("{*}link"):
        if link.get("rel") == "next":
            return link.get("href")
    return None


def fetch(address: str) -> bytes:
    """What an address holds: of the web, or of a file system."""
    if address.startswith(("http://", "https://")):
        with urlopen(address, timeout=120) as got:
            return got.read()
    import pyarrow.fs as pafs

    fs, path = pafs.FileSystem.from_uri(address)
    with fs.open_input_stream(path) as got:
        return got.read()


class _Year(InputPartition):
    pass


class FeedSource(DataSource):
    """Atom feeds of legislation, one for each year, each with its next pages: option address (with %d for the year), first_year and last_year. A year is a task, which fetches its pages one after the other as each names the next; a page that
    was read for this year already ends it."""

    @classmethod
    def name(cls) -> str:
        return "vellum_feed"

    def schema(self) -> str:
        return "year int, page int, title string, link string"

    def reader(self, schema) -> DataSourceReader:
        return _FeedReader(self.options["address"], int(self.options.get("first_year", "1801")), int(self.options.get("last_year", "2011")))


class _FeedReader(DataSourceReader):
    def __init__(self, address: str, first: int, last: int):
        self.address, self.years = address, range(first, last + 1)

    def partitions(self) -> list[InputPartition]:
        return [_Year(y) for y in self.years]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at, seen = self.address % partition.value, set()
        while at and at not in seen:
            seen.add(at)
            tree = ElementTree.fromstring(fetch(at))
            for entry in tree.findall("{*}entry"):
                title = (entry.findtext("{*}title") or "").strip()
                own = next((x.get("href") for x in entry.findall("{*}link") if x.get("rel") == "self"), None)
                yield partition.value, len(seen), title.removeprefix("The "), own
            at = next_page(tree)


def feeds(spark: SparkSession, address: str, first_year: int = 1801, last_year: int = 2011) -> DataFrame:
    """legislationid, title, link, year, page of the feeds at ``address`` (see FeedSource): titles without a leading "The ", the first link that is the entry's own; every entry, twice if it is there twice."""
    spark.dataSource.register(FeedSource)
    rows = spark.read.format("vellum_feed").option("address", address).option("first_year", first_year).option("last_year", last_year).load()
    return rows.select(F.xxhash64("title", "link").alias("legislationid"), "title", "link", "year", "page")


def feed(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The same from Atom feeds that are saved as files: legislationid, title, link. ``years``: those of the first to the last of two years alone, for feeds in folders named year=1976 and so on below ``path``; nothing else about a
    file's name counts."""
    entry = spark.read.format("xml").option("rowTag", "entry").schema("id string, title string, link array<struct<_rel: string, _href: string>>").load(path)
    if years is not None:
        if "year" not in entry.columns:
            raise ValueError(f"{path} has no folders named year=...")
        entry = entry.where(F.col("year").cast("int").between(*years))
    rows = entry.select(F.regexp_replace(F.trim("title"), "^The ", "").alias("title"), F.element_at(F.concat(F.filter("link", lambda x: x["_rel"] == "self"), F.array(F.lit(None).cast("struct<_rel: string, _href: string>"))), 1)["_href"].alias("link"))
    return rows.select(F.xxhash64("title", "link").alias("legislationid"), "title", "link")
