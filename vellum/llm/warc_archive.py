"""WARC archives of web pages: written through Spark's text sink, read back by chains of record boundaries.

Writing: pages with equal payloads are found by digest; of each such group the page with the largest id is written as a ``response``, the others as ``revisit`` records that refer to it.
A group's decision is joined to its pages by digest, so pages are moved only if there are too many groups to send to every task.

Reading: the text source splits files at every ``WARC/1.``, true record start or not. For each such place a task reads the header and emits the length it declares, which is where the
record's successor would begin; a payload digest comes with it if the record ends before the next such place. Headers that hold ``WARC/1.`` themselves, of whatever length, are put together from the chunks that may go on
with one, each byte once. The places of a file then form a graph of pointers to successors. Pointers are doubled within an input split (numpy) until each place knows where its chain leaves the split; the few places that chains
enter a split at are linked and doubled by joins from the file's start on; from those that are reached, pointers are doubled within the splits once more, and what they reach are the records. No task follows a file from record
to record, and none sees more of it than a split. So ``WARC/1.`` inside a payload, a whole record there included, is never taken for one. Payloads that hold such places are put together from their parts in a last pass, which is left
out if there are none: each such chunk knows its record, and these alone are joined, sorted and read on one after the other.

Defined results: a null payload counts as empty; payloads of fewer than ``least`` bytes are always responses. Pages with a null id come last in the choice of the response. Repeated rows with the
chosen id are all responses. A file that doesn't begin with a record has none; a chain that meets no record start ends there. No pages give no records. Line breaks in a URL become
spaces, and URLs and payloads may be of any length. A round trip that doesn't give back as many records as pages is an error. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import delete, new_folder, save
from .streams import grouped

MAGIC = b"WARC/1."
#: So many groups of equal payloads, of 28 bytes each, are sent to every task; more are joined by a shuffle.
SENT_GROUPS = 100_000
#: So many chunks of records that hold magics are sent to every task, by their places of 30 bytes or so; more are joined by a shuffle.
SENT_CHUNKS = 100_000
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_VERSION = re.compile(rb"[0-9]\r\n")
_FIELDS = ["type", "record_id", "target_uri", "refers_to", "declared_digest", "payload_digest", "payload_bytes"]
_FIELD_TYPES = [pa.string()] * 6 + [pa.int64()]
_PLACES = pa.list_(pa.struct([("split", pa.int64()), ("number", pa.int64())]))


def base32(hex_digest: Column) -> Column:
    """A hexadecimal SHA-1 in base 32: five hexadecimal digits make four characters."""
    part = lambda i: F.conv(F.substring(hex_digest, F.floor(i / 4).cast("int") * 5 + F.lit(1), F.lit(5)), 16, 10).cast("int")
    five = lambda i: F.floor(part(i) / F.element_at(F.array(*map(F.lit, (32768, 1024, 32, 1))), (i % 4 + 1).cast("int"))).cast("int").bitwiseAND(F.lit(31))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.substring(F.lit(_ALPHABET), five(i) + F.lit(1), F.lit(1))), "")


def classify(spark: SparkSession, pages: DataFrame, id_col: str, payload: Column, least: int = 0) -> DataFrame:
    """``pages`` with __digest (hexadecimal SHA-1), __payload and __top: the id that the page revisits, or null."""
    keyed = pages.withColumn("__payload", F.coalesce(payload.cast("string"), F.lit(""))).withColumn("__digest", F.sha1(F.col("__payload").cast("binary")))
    groups = keyed.where(F.octet_length("__payload") >= least).groupBy(F.unhex("__digest").alias("__key")).agg(F.max(id_col).alias("__max"), F.count(F.lit(1)).alias("__n")).where("__n > 1 and __max is not null").drop("__n")
    groups = save(spark, groups, "groups")
    small = groups.limit(SENT_GROUPS + 1).count() <= SENT_GROUPS
    out = keyed.join(F.broadcast(groups) if small else groups, F.unhex("__digest") == F.col("__key"), "left")
    return out.withColumn("__top", F.when(~F.col(id_col).eqNullSafe(F.col("__max")), F.col("__max"))).drop("__max", "__key")


def write(spark: SparkSession, pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z", per_file: int = 20000) -> None:
    """Write one record per page below ``folder``; a file has at most ``per_file`` of them."""
    some = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload"))
    rows = classify(spark, some, "id", F.col("payload"), least)
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("__top").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("__payload").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("__payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: "), ident(F.col("id")), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        F.translate(F.coalesce("url", F.lit("urn:unknown")), "\r\n", "  "), F.lit("\r\nWARC-Payload-Digest: sha1:"), base32(F.col("__digest")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), ident(F.col("__top")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("__body").cast("string"), F.lit("\r\n\r\n"),
    )
    # the sink's line end is the last two of the four bytes that end a record
    lines = rows.withColumn("__body", body).select(F.concat(head, F.col("__body"), F.lit("\r\n")).alias("value"))
    lines.write.option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).text(folder)


def header(chunk: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """Of the bytes behind a magic: fields, where the block begins, and its length. None if no header of a record stands there."""
    if not _VERSION.match(chunk):
        return None
    end = chunk.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields: dict[bytes, bytes] = {}
    name = b""
    for line in chunk[3:end].split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and name:
            fields[name] += b" " + line.strip()
            continue
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        name = key.strip().lower()
        fields[name] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        return None
    return fields, end + 4, int(length)


def goes_on(chunk: bytes) -> bool:
    """Whether a header that reaches into the chunk may go on behind it: no blank line, and its whole lines are fields or continue one."""
    return b"\r\n\r\n" not in chunk and all(b":" in line or line[:1] in (b" ", b"\t") for line in chunk.split(b"\r\n")[1:-1])


def described(fields: dict[bytes, bytes], block: bytes) -> tuple:
    text = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None
    payload, size = block, len(block)
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if fields[b"warc-type"] == b"revisit":
            m = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", head)
            size = int(m[1]) if m else 0
    declared = text(b"warc-payload-digest")
    declared = declared.removeprefix("sha1:") if declared else None
    digest = declared if fields[b"warc-type"] == b"revisit" else base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return text(b"warc-type"), text(b"warc-record-id"), text(b"warc-target-uri"), text(b"warc-refers-to"), declared, digest, size


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What stands between one magic and the next, with its file, the start of the input split and its number in it."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = None, 0
        for b in batches:
            numbers = []
            for where in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                n = n + 1 if where == at else 0
                at = where
                numbers.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64())], ["chunk", "file", "split", "number"])

    raw = spark.read.option("lineSep", MAGIC.decode()).text(folder)
    raw = raw.select(F.col("value").cast("binary").alias("chunk"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    return raw.mapInArrow(number, "chunk binary, file string, split bigint, number bigint")


_FIELDS_DDL = "type string, record_id string, target_uri string, refers_to string, declared_digest string, payload_digest string, payload_bytes bigint"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk: where it begins in its split (at), its size, how far the record reaches whose header it begins with, what of it may belong to a header that began before or goes on (start), and the record's fields if it is whole."""
    is_open = True  # whether a header before this chunk may go on here
    at = 0
    for b in batches:
        rows = []
        for x, number in zip(b.column(0), b.column(3).to_pylist(), strict=True):
            chunk = x.as_py()
            at = at if number else 0
            h, stop = header(chunk), chunk.find(b"\r\n\r\n")
            # of the first chunks of a split it isn't known what stands before them
            into = is_open or number < 2
            is_open = (into or _VERSION.match(chunk) is not None) and goes_on(chunk)
            start = chunk[: stop + 4 if stop >= 0 else None] if into or is_open else None
            if h is None:
                rows.append((at, len(chunk), None, start, *[None] * 7))
            else:
                fields, begin, length = h
                whole = begin + length + 4 == len(chunk)
                rows.append((at, len(chunk), len(MAGIC) + begin + length + 4, start, *(described(fields, chunk[begin : begin + length]) if whole else [None] * 7)))
            at += len(chunk) + len(MAGIC)
        cols = list(zip(*rows, strict=True)) or [()] * 11
        yield pa.RecordBatch.from_arrays([*b.columns[1:], *(pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *_FIELD_TYPES], strict=True))], ["file", "split", "number", "at", "size", "reach", "start", *_FIELDS])


def stitched(parts: list[bytes]) -> list[int]:
    """Of chunks that follow each other, all but the last without a blank line and fit to be parts of a header: how far the record reaches whose header begins with each, 0 if none does. What holds for a header
    depends on the lines behind its version, so one look at all lines serves every chunk."""
    whole = MAGIC.join(parts)
    end = whole.find(b"\r\n\r\n")
    length, kind, bad, at = (-1, 0), -1, -1, 0
    for line in whole[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon and line[:1] not in (b" ", b"\t"):
            bad = at
        elif colon and line[:1] not in (b" ", b"\t"):
            key = name.strip().lower()
            if key == b"content-length":
                length = (at, int(value) if value.strip().isdigit() else -1)
            elif key == b"warc-type":
                kind = at
        at += len(line) + 2
    out, place = [], 0
    for p in parts:
        good = _VERSION.match(p) and end >= 0 and length[1] >= 0 and min(length[0], kind) > place and bad <= place
        out.append(len(MAGIC) + end + 4 - place + length[1] + 4 if good else 0)
        place += len(p) + len(MAGIC)
    return out


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (file, place, size, start) in order: file, place and reach of the records whose headers hold magics. Chunks belong together if each begins where the one before it ends."""
    now, end, run = None, 0, []
    for b in batches:
        out: list[tuple] = []
        for file, place, size, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if file != now or place != end:
                run = []
            now, end = file, place + len(MAGIC) + size
            run.append((place, start))
            if b"\r\n\r\n" in start:
                out += [(file, at, r) for (at, _), r in zip(run, stitched([x for _, x in run]), strict=True) if r and at != place]
                run = []
            elif not goes_on(start):
                run = []
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["file", "place", "stitched"])


def _successors(place: np.ndarray, size: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within a split: for each place the number of its successor (its own if there is none here), where the record ends (-1: no header), and whether that is beyond the split."""
    end = np.where(reach > 0, place + reach, -1)
    to = np.minimum(np.searchsorted(place, end), len(place) - 1)
    here = (end > place) & (place[to] == end)
    return np.where(here, to, np.arange(len(place))), end, end >= place[-1] + len(MAGIC) + size[-1]


def _doubled(next_: np.ndarray) -> Iterator[np.ndarray]:
    """Pointers over 1, 2, 4 ... steps, until they move no more."""
    while True:
        yield next_
        further = next_[next_]
        if np.array_equal(further, next_):
            return
        next_ = further


def _numpy(b: pa.RecordBatch, x: int, y: int, *names: str) -> list[np.ndarray]:
    return [b.column(b.schema.get_field_index(n)).slice(x, y - x).fill_null(0).to_numpy(zero_copy_only=False) for n in names]


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each place: where the chain from it leaves the split, -1 if it ends within."""
    for b, cut in grouped(batches, "key"):
        exits = []
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            next_, end, beyond = _successors(*_numpy(b, x, y, "place", "size", "reach"))
            for last in _doubled(next_):
                pass
            exits.append(np.where(beyond[last], end[last], -1))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.concatenate(exits))], ["file", "place", "exit"])


_RECORD = f"file string, split bigint, offset bigint, parts bigint, chunks array<struct<split: bigint, number: bigint>>, beyond boolean, lead bigint, first bigint, {_FIELDS_DDL}"


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places that pointers from the entered ones reach and whose records end at a start or at the end of the file; and a row without an offset for each split, with how many of its chunks stand before the first of these places (lead) from number ``first`` on, and whether there is any (beyond)."""
    names = [c.split()[0] for c in _RECORD.split(", ")][:5] + ["beyond", "lead", "first", *_FIELDS]
    for b, cut in grouped(batches, "key"):
        keep, offsets, parts, chunks_, over, leads = [], [], [], [], [], []
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            place, size, reach, entry, lands, file_end, number, split = _numpy(b, x, y, "place", "size", "reach", "entry", "lands", "end", "number", "split")
            next_, end, beyond = _successors(place, size, reach)
            mark = entry.astype(bool)
            for pointer in _doubled(next_):
                mark[pointer[mark]] = True
            n = len(place)
            there = np.flatnonzero(mark)
            leads.append((x, int(there[0]) if len(there) else n, int(number[0]), len(there) > 0))
            good = there[(next_[there] != there) | (beyond[there] & ((end[there] == file_end[there]) | lands[there].astype(bool)))]
            count = np.where(beyond[good], n, next_[good]) - good
            keep.append(x + good)
            offsets.append(place[good])
            parts.append(count)
            over.append(beyond[good])
            chunks_ += [[{"split": int(split[k]), "number": int(number[k])} for k in range(i, i + c)] if c > 1 or o else None for i, c, o in zip(good.tolist(), count.tolist(), beyond[good].tolist(), strict=True)]
        at = pa.array(np.concatenate(keep))
        m = len(at)
        col = lambda n: b.column(b.schema.get_field_index(n))  # noqa: E731, B023
        none = pa.nulls(m, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [col("file").take(at), col("split").take(at), pa.array(np.concatenate(offsets)), pa.array(np.concatenate(parts)), pa.array(chunks_, _PLACES), pa.array(np.concatenate(over)), none, none, *(col(f).take(at) for f in _FIELDS)], names
        )
        first, lead, numbers, some = (pa.array(c) for c in zip(*leads, strict=True))
        none = pa.nulls(len(leads), pa.int64())
        yield pa.RecordBatch.from_arrays([col("file").take(first), col("split").take(first), none, none, pa.nulls(len(leads), _PLACES), some, lead, numbers, *(pa.nulls(len(leads), t) for t in _FIELD_TYPES)], names)


def entered(spark: SparkSession, exits: DataFrame) -> DataFrame:
    """From each place's exit: the places that some chain enters a split at (file, place, reached): those that the chain from the file's start comes to, and others. Their pointers to each other are doubled, so rounds grow with the
    logarithm of a file's splits."""
    targets = exits.where("exit >= 0").select("file", F.col("exit").alias("place")).distinct()
    some = exits.join(targets, ["file", "place"], "left_semi").unionByName(exits.where("place = 0")).distinct()
    some = save(spark, some, "entries")
    reached = some.where("place = 0").select("file", "place")
    jump = some.join(some.select("file", F.col("place").alias("exit")), ["file", "exit"]).select("file", "place", F.col("exit").alias("to"))
    while True:
        jump = save(spark, jump, "jumps")
        if not jump.take(1):
            break
        reached = save(spark, reached.unionByName(reached.join(jump, ["file", "place"]).select("file", F.col("to").alias("place"))).distinct(), "reached")
        jump = jump.join(jump.select("file", F.col("place").alias("to"), F.col("to").alias("next")), ["file", "to"]).select("file", "place", F.col("next").alias("to"))
    return some.select("file", "place").distinct().join(reached.withColumn("reached", F.lit(True)), ["file", "place"], "left").select("file", "place", F.coalesce("reached", F.lit(False)).alias("reached"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives below ``folder``: file, offset, type, record_id, target_uri, refers_to, declared_digest, payload_digest (of a revisit: the declared one) and payload_bytes."""
    every = chunks(spark, folder)
    thin = save(spark, every.mapInArrow(_candidates, f"file string, split bigint, number bigint, at bigint, size bigint, reach bigint, start binary, {_FIELDS_DDL}"), "places")
    # one row for each input split, as many as the scan has tasks
    splits = thin.groupBy("file", "split").agg(F.max(F.col("at") + F.col("size") + len(MAGIC)).alias("total"))
    of_file = W.partitionBy("file")
    splits = splits.select("file", "split", (F.sum("total").over(of_file.orderBy("split")) - F.col("total")).alias("base"), (F.sum("total").over(of_file) - len(MAGIC)).alias("end"))
    thin = thin.join(F.broadcast(save(spark, splits, "splits")), ["file", "split"]).withColumn("place", F.col("base") + F.col("at") - len(MAGIC)).where("place >= 0").drop("base", "at")
    opens = thin.where("start is not null").select("file", "place", "size", "start").repartition("file").sortWithinPartitions("file", "place")
    more = save(spark, opens.mapInArrow(_stitch, "file string, place bigint, stitched bigint"), "stitched")
    nodes = thin.drop("start")
    if more.take(1):
        nodes = nodes.join(more, ["file", "place"], "left").withColumn("reach", F.coalesce("reach", "stitched")).drop("stitched")
    nodes = nodes.withColumn("key", F.xxhash64("file", "split"))
    in_splits = lambda rows: rows.repartition("key").sortWithinPartitions("key", "file", "split", "place")
    exits = save(spark, in_splits(nodes.select("file", "place", "size", "reach", "split", "key")).mapInArrow(_exits, "file string, place bigint, exit bigint"), "exits")
    doors = save(spark, entered(spark, exits), "doors")
    rows = nodes.withColumn("to", F.col("place") + F.col("reach")).join(doors.where("reached").select("file", "place", F.lit(1).alias("entry")), ["file", "place"], "left")
    rows = rows.join(doors.select("file", F.col("place").alias("to"), F.lit(1).alias("lands")), ["file", "to"], "left").drop("to")
    found = save(spark, in_splits(rows).mapInArrow(_reached, _RECORD), "records")
    # chunks before a split's first record belong to the last record that reaches over, in whichever split that was
    over = found.groupBy("file", "split").agg(F.max(F.when(F.col("beyond"), F.col("offset"))).alias("last"), F.max(F.when(F.col("offset").isNull(), F.col("beyond"))).alias("some"))
    over = over.select("file", "split", F.coalesce("last", F.when(F.col("some"), -1)).alias("last"))  # -1: the chain ended there
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    leads = found.where("offset is null").select("file", "split", "lead", "first").join(over, ["file", "split"], "left").withColumn("offset", F.last("last", True).over(before)).where("lead > 0 and offset >= 0")
    leads = leads.select("file", "offset", "split", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("lead") - 1)).alias("number"))
    leads = save(spark, leads, "leads")
    records = found.where("offset is not null")
    further = leads.groupBy("file", "offset").agg(F.count(F.lit(1)).alias("more"))
    records = records.join(further, ["file", "offset"], "left").withColumn("parts", F.col("parts") + F.coalesce("more", F.lit(0)))
    n = records.where("parts > 1").agg(F.sum("parts")).first()[0]
    short = records.where("parts = 1").select("file", "offset", *_FIELDS)
    if not n:
        return short
    long = records.where("parts > 1")
    places = long.select("file", "offset", F.explode("chunks").alias("c")).select("file", "offset", "c.split", "c.number")
    places = places.unionByName(leads.join(long.select("file", "offset"), ["file", "offset"], "left_semi").select("file", "offset", "split", "number"))
    # saved, so that the result reads nothing of the archives any more
    return short.unionByName(save(spark, spanning(every, places, n <= SENT_CHUNKS), "spanning"))


def spanning(every: DataFrame, places: DataFrame, few: bool) -> DataFrame:
    """Records whose payload holds magics, from the chunks that are theirs (file, offset, split, number). ``few``: there are few enough of these to be sent to every task."""
    mine = every.join(F.broadcast(places) if few else places, ["file", "split", "number"]).select(F.xxhash64("file", "offset").alias("record"), "file", "offset", "split", "number", "chunk")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, cut in grouped(batches, "record"):
            rows = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                chunk = MAGIC.join(b.column(5).slice(x, y - x).to_pylist())
                h = header(chunk)
                rows.append(described(h[0], chunk[h[1] : h[1] + h[2]]) if h else (None,) * 7)
            at = pa.array(cut[:-1])
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(1).take(at), b.column(2).take(at), *(pa.array(c, t) for c, t in zip(cols, _FIELD_TYPES, strict=True))], ["file", "offset", *_FIELDS])

    ddl = "file string, offset bigint, type string, record_id string, target_uri string, refers_to string, declared_digest string, payload_digest string, payload_bytes bigint"
    return mine.repartition("record").sortWithinPartitions("record", "file", "offset", "split", "number").mapInArrow(build, ddl)


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: per page its id, payload_bytes, payload_digest, record_type and refers_to."""
    folder = new_folder(spark, "warc")
    write(spark, pages, folder, id_col, url_col, payload_col, least)
    records = read(spark, folder)
    back_, there = records.count(), pages.count()
    if back_ != there:
        raise RuntimeError(f"{there} pages were written to {folder}, and {back_} records read back")
    delete(spark, folder)
    kind = dict(pages.dtypes)[id_col]
    number = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
    back = lambda c: F.when(number(c) != "null", number(c)).cast(kind)
    return records.select(back(F.col("record_id")).alias(id_col), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), back(F.col("refers_to")).alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS top FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('{_ALPHABET}', 1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
