"""Removal of long strings that occur more than once, by a sparse suffix array over all texts.

Every string of ``window`` bytes has one anchor: the place in it where the hash of the next ``gram`` bytes is least. Equal
strings have their anchors at the same place, so it is enough to sort the suffixes that begin at anchors (about
one byte in 130), each with the bytes in front of it that its strings reach back to:

1. each text gives its anchors, each with the range of strings that it serves and a hash of the bytes they cover;
2. grams that occur once are dropped; where all anchors of a gram cover the same bytes, all their strings repeat; covers that
   occur more than once need no look at their bytes either. These counts are combined before they are moved, so a cover
   that a third of all rows share arrives as one row per task;
3. of the rest one suffix for each distinct cover is cut from its text, range-partitioned by its leading bytes with sampled splitters,
   and sorted within its bucket by multikey quicksort. Splitters are compared on the whole gram, so no run of suffixes
   that could share a string lies across a boundary;
4. neighbours' common prefixes, and the same for the reversed bytes in front, tell for each distance between string and anchor
   which strings are equal. A gram with more different covers than one task should hold isn't sorted in one bucket: its covers are told apart
   by hashes of what they have in common for a range of distances, ranges of 32, then 4, then 1, and only those go on to a narrower range
   that others might equal in a part of it (``crowded_spans``);
5. the covered bytes are removed from each text.

Rows with a gram or cover that very many rows have aren't shuffled by it (``join_evenly``).

Defined results: a null or empty text has no bytes; a text shorter than the window is left whole. Strings are judged on the
input. Repeated rows and equal texts count as repetitions of each other. Texts of any length are read whole, in overlapping pieces.
An empty table gives an empty result. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import K1, K2, join_evenly, row_key, save
from .streams import grouped

WINDOW, GRAM = 400, 128
#: A gram with more different covers than this isn't compared in one task.
CROWD = 4096
#: A task compares about so many suffixes.
BUCKET = 8192
#: Up to so many covers of a gram are compared two by two, by what lies between them in their order; more of them one distance after the other.
FEW = 64
#: Numbers of distances that such covers are compared for at a time.
STEPS = (32, 4, 1)
_PLACE = np.uint64((1 << 24) - 1)
_PIECE = 1 << 20


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the ``gram`` bytes (a power of 2) from each position on."""
    h, size = tk.BYTES[data], 1
    while size < gram and len(h) > size:
        h = h[:-size] * np.uint64(0x9E3779B97F4A7C15) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    return tk.mix(h) if size == gram else np.zeros(0, np.uint64)


def anchors(data: np.ndarray, base: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same anchor: text, first and last string's position, anchor, gram hash."""
    h = gram_hashes(data, gram)
    span = window - gram + 1
    n = len(data) - window + 1
    if n <= 0 or not len(h):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    room = np.zeros(len(data) + 1, np.int64)  # strings that begin here end within their text
    long = np.diff(base) >= window
    np.add.at(room, base[:-1][long], 1)
    np.add.at(room, base[1:][long] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(room)[:n] > 0)
    if not len(at):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    anchor = (low[at] & _PLACE).astype(np.int64)
    cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    first, last, anchor = at[np.r_[0, cut]], at[np.r_[cut - 1, len(at) - 1]], anchor[np.r_[0, cut]]
    return np.searchsorted(base, first, "right") - 1, first, last, anchor, h[anchor]


def pieces(offs: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bounds of stretches of about a megabyte: the text numbers, where each begins and how far into its text that is."""
    for i, j in tk.slices(offs, _PIECE):
        if offs[j] - offs[i] <= 4 * _PIECE:
            yield np.arange(i, j), offs[i : j + 1], np.zeros(j - i, np.int64)
            continue
        for t in range(i, j):
            for at in range(0, max(int(offs[t + 1] - offs[t]) - window + 1, 1), _PIECE):
                yield np.array([t]), np.array([offs[t] + at, min(offs[t] + at + _PIECE + window - 1, offs[t + 1])]), np.array([at])


def multikey_quicksort(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of strings given as rows of big-endian 8-byte words padded with zeros, and their lengths: three-way partitions on
    one word at a time, deeper by a word where words are equal."""
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2:
            continue
        part = order[a:b]
        if depth == words.shape[1]:
            order[a:b] = part[np.argsort(sizes[part], kind="stable")]
            continue
        w = words[part, depth]
        pivot = np.sort(w[[0, len(w) // 2, -1]])[1]
        less, more = w < pivot, w > pivot
        if not (less.any() or more.any()):  # on to the next word in which they aren't all equal
            ahead = (words[part, depth + 1 :] != words[part[0], depth + 1 :]).any(0)
            todo.append((a, b, depth + 1 + int(ahead.argmax()) if ahead.any() else words.shape[1]))
            continue
        equal = ~(less | more)
        order[a:b] = np.concatenate([part[less], part[equal], part[more]])
        x, y = a + int(less.sum()), b - int(more.sum())
        todo += [(a, x, depth), (x, y, depth + 1), (y, b, depth)]
    return order


def suffix_array(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings' order, and the common prefix of each but the first with the one before it."""
    sizes = np.array([len(s) for s in strings])
    width = max(8, -(-int(sizes.max()) // 8) * 8)
    raw = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    order = multikey_quicksort(raw.view(">u8").astype(np.uint64), sizes)
    s = raw[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    return order, np.minimum(common, np.minimum(sizes[order][1:], sizes[order][:-1]))


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def between(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The common prefix of any two strings: the least one of neighbours from one to the other in their order."""
    n = len(order)
    out = np.zeros((n, n), np.int64)
    for k in range(n - 1):
        out[order[k], order[k + 1 :]] = out[order[k + 1 :], order[k]] = np.minimum.accumulate(common[k:])
    return out


def repeats(suffixes: list[bytes], fronts: list[bytes], low: np.ndarray, high: np.ndarray, times: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each of the distinct covers of one gram, the ranges of distances (anchor less string's start) whose strings occur in another one too,
    or more than once (``times``). ``fronts``: the bytes before the anchor, reversed."""
    n = len(suffixes)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n == 2:
        a = max(int(low.max()), window - common_prefix(*suffixes))
        b = min(int(high.min()), common_prefix(*fronts))
        if a <= b:
            out[0].append((a, b)), out[1].append((a, b))
        return out
    order, lcp = suffix_array(suffixes)
    order_l, lcs = suffix_array(fronts)
    if n <= FEW:
        a = np.maximum(np.maximum.outer(low, low), window - between(order, lcp))
        b = np.minimum(np.minimum.outer(high, high), between(order_l, lcs))
        b[np.diag_indices(n)] = -1
        for i, j in zip(*(x.tolist() for x in np.nonzero(a <= b)), strict=True):
            out[i].append((int(a[i, j]), int(b[i, j]) + 1))
        return [[(p, q - 1) for p, q in merged(x)] for x in out]
    steps = np.unique(np.concatenate([window - lcp, lcs + 1, low, high + 1]))
    steps = steps[(steps >= low.min()) & (steps <= high.max())]
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for s, j in enumerate(steps):
        j = int(j)
        end = int(steps[s + 1]) - 1 if s + 1 < len(steps) else int(high.max())
        on = np.flatnonzero((low <= j) & (j <= high))
        if len(on) < 2:
            continue
        right[order] = np.r_[0, np.cumsum(lcp < window - j)]
        left[order_l] = np.r_[0, np.cumsum(lcs < j)]
        _, back, count = np.unique(right[on] * n + left[on], return_inverse=True, return_counts=True)
        for i in on[count[back] > 1]:
            if out[i] and out[i][-1][1] == j - 1:
                out[i][-1] = (out[i][-1][0], end)
            else:
                out[i].append((j, end))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def in_buckets(suffixes: DataFrame, gram: int, bucket: int = BUCKET) -> DataFrame:
    """The suffixes in their order within buckets of about ``bucket``, so that there are more buckets for more suffixes and not larger ones. Equal grams stay together."""
    head = F.substring("suffix", 1, gram)
    return suffixes.repartitionByRange(suffixes.count() // bucket + 1, head).sortWithinPartitions(head)


def repeated_spans(spark: SparkSession, docs: DataFrame, text_col: str = "text", key_cols: tuple[str, ...] = ("doc_id",), window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD, bucket: int = BUCKET) -> DataFrame:
    """Per row key the covered byte ranges, not merged: __vellum_k1, __vellum_k2, spans array<struct<a,b>>; only for rows that have any."""
    text = F.col(text_col).cast("string")
    rows = docs.select(*row_key(*[F.col(c) for c in key_cols], text), text.alias("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2 = (b.column(i).to_numpy() for i in (0, 1))
            data, offs = tk.texts(b.column(2))
            for which, bounds, ahead in pieces(offs, window):
                part = data[bounds[0] : bounds[-1]]
                t, first, last, anchor, h = anchors(part, bounds - bounds[0], window, gram)
                if not len(t):
                    continue
                raw = memoryview(part.tobytes())
                cover = np.fromiter((xxhash.xxh3_64_intdigest(raw[x : y + window]) for x, y in zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(t))
                at = anchor - (bounds - bounds[0])[t] + ahead[t]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k1[which[t]], k2[which[t]], h.view(np.int64), cover.view(np.int64), at, (anchor - last).astype(np.int32), (anchor - first).astype(np.int32))], [K1, K2, "gram", "cover", "at", "low", "high"])

    found = rows.mapInArrow(emit, f"{K1} bigint, {K2} bigint, gram bigint, cover bigint, at bigint, low int, high int")
    found = save(spark, found, "anchors")
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("cover").alias("c0"), F.max("cover").alias("c1")).where("n > 1")
    grams = save(spark, grams.select("gram", (F.col("c0") == F.col("c1")).alias("alike"), "n"), "grams")
    again = save(spark, join_evenly(found, grams, ["gram"], "n"), "repeated")
    span = F.struct((F.col("at") - F.col("high")).alias("a"), (F.col("at") - F.col("low") + window).alias("b")).alias("span")
    alike = again.where("alike").select(K1, K2, span)

    differ = again.where("not alike")
    owner = F.struct(K1, K2, "at", "low", "high")
    covers = save(spark, differ.groupBy("gram", "cover").agg(F.count(F.lit(1)).alias("n"), F.min(owner).alias("o")), "covers")
    copied = join_evenly(differ, covers.where("n > 1").select("gram", "cover", "n"), ["gram", "cover"], "n").select(K1, K2, span)

    crowds = save(spark, covers.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > crowd), "crowds")
    some = not crowds.isEmpty()
    each = covers.join(crowds.select("gram", F.lit(True).alias("crowded")), "gram", "left") if some else covers.withColumn("crowded", F.lit(False))
    wanted = each.groupBy(F.col(f"o.{K1}").alias(K1), F.col(f"o.{K2}").alias(K2)).agg(F.collect_list(F.struct("gram", "cover", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"), F.col("o.at").alias("at"), F.col("o.low").alias("low"), F.col("o.high").alias("high"))).alias("w"))

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(2))
            raw = memoryview(data)
            cols: list[list] = [[] for _ in range(11)]
            size = 0
            for i, (x1, x2, want) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True)):
                o = int(offs[i])
                for w in want:
                    at = o + w["at"]
                    row = (x1, x2, w["gram"], w["cover"], w["n"], w["at"], w["low"], w["high"], bytes(raw[at : at - w["low"] + window]), bytes(raw[at - w["high"] : at])[::-1], w["crowded"])
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                    size += window + 64
                if size > 1 << 22:
                    yield out(cols)
                    cols, size = [[] for _ in range(11)], 0
            yield out(cols)

    def out(cols: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()] * 2 + [pa.bool_()], strict=True)], [K1, K2, "gram", "cover", "n", "at", "low", "high", "suffix", "front", "crowded"])

    schema = f"{K1} bigint, {K2} bigint, gram bigint, cover bigint, n bigint, at bigint, low int, high int, suffix binary, front binary, crowded boolean"
    suffixes = save(spark, rows.join(wanted, [K1, K2]).select(K1, K2, "text", "w").mapInArrow(slice_, schema), "suffixes")
    buckets = in_buckets(suffixes.where("not crowded"), gram, bucket)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, cut in grouped(batches, "gram"):
            k1, k2, cover, n, at, low, high = (b.column(b.schema.get_field_index(c)).to_numpy() for c in (K1, K2, "cover", "n", "at", "low", "high"))
            suffix, front = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("suffix", "front"))
            rows_: list[tuple[int, int, int, int]] = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                _, one = np.unique(cover[x:y], return_index=True)  # repeated rows give their suffix more than once
                one = x + one
                if len(one) < 2:
                    continue
                got = repeats([suffix[i] for i in one], [front[i] for i in one], low[one], high[one], n[one], window)
                for i, ranges in zip(one.tolist(), got, strict=True):
                    if n[i] == 1:
                        rows_ += [(k1[i], k2[i], at[i] - q, at[i] - p + window) for p, q in ranges]
            cols = list(zip(*rows_, strict=True)) or [()] * 4
            spans = pa.StructArray.from_arrays([pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["a", "b"])
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), spans], [K1, K2, "span"])

    parts = buckets.mapInArrow(compare, f"{K1} bigint, {K2} bigint, span struct<a: bigint, b: bigint>")
    spans = alike.unionByName(copied).unionByName(parts)
    if some:
        spans = spans.unionByName(crowded_spans(spark, suffixes.where("crowded"), window))
    return spans.groupBy(K1, K2).agg(F.collect_list("span").alias("spans"))


def crowded_spans(spark: SparkSession, covers: DataFrame, window: int = WINDOW) -> DataFrame:
    """The covered ranges (K1, K2, span) of covers that occur once, of grams that have very many of them. Covers are dealt by hashes, never gathered by gram.

    Distances are taken a slot at a time. Covers can only share a string of a slot if they agree in the bytes that all its strings have (``core``); covers that agree in all
    bytes that their strings of the slot have (``whole``) share all of them. One of each such set goes on to narrower slots, if another set has its core."""
    todo = covers.select(K1, K2, "gram", "cover", "at", "suffix", "front", F.array(F.struct(F.col("low").alias("p"), F.col("high").alias("q"), (F.col("n") > 1).alias("done"))).alias("ranges"))
    schema = f"{K1} bigint, {K2} bigint, gram bigint, cover bigint, at bigint, core bigint, whole bigint, p int, q int, done boolean"
    out = None
    for step in STEPS:

        def slots(batches: Iterator[pa.RecordBatch], step: int = step) -> Iterator[pa.RecordBatch]:
            for b in batches:
                index, found = [], []
                for i, (gram, suffix, front, ranges) in enumerate(zip(*(b.column(c).to_pylist() for c in (2, 5, 6, 7)), strict=True)):
                    for r in ranges:
                        for k in range(r["p"] // step, r["q"] // step + 1):
                            first, last = k * step, k * step + step - 1
                            p, q = max(r["p"], first), min(r["q"], last)
                            core = xxhash.xxh3_64_intdigest(b"%d %d %d %b" % (gram, first, len(front[:first]), front[:first] + suffix[: window - last]))
                            whole = xxhash.xxh3_64_intdigest(b"%d %d %d %b" % (core, p, q, front[:q] + suffix[: window - p]))
                            index.append(i)
                            found.append((core - (1 << 63), whole - (1 << 63), p, q, r["done"]))
                cols = list(zip(*found, strict=True)) or [()] * 5
                kept = b.take(pa.array(index, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns[:5], *(pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.bool_()], strict=True))], [K1, K2, "gram", "cover", "at", "core", "whole", "p", "q", "done"])

        each = save(spark, todo.mapInArrow(slots, schema), "slots")
        same = each.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("gram", "cover", "p", "q")).alias("one"), F.bool_or("done").alias("done"))
        same = save(spark, same, "same")
        span = F.struct((F.col("at") - F.col("q")).alias("a"), (F.col("at") - F.col("p") + window).alias("b")).alias("span")
        here = join_evenly(each.where("not done"), same.where("n > 1").select("core", "whole", "n"), ["core", "whole"], "n").select(K1, K2, span)
        out = here if out is None else out.unionByName(here)
        if step == STEPS[-1]:
            break
        open_ = same.groupBy("core").agg(F.count(F.lit(1)).alias("m"), F.bool_and(F.col("done") | (F.col("n") > 1)).alias("all")).where("m > 1 and not all").select("core", "m")
        on = join_evenly(same, save(spark, open_, "open"), ["core"], "m").select("one.*", (F.col("done") | (F.col("n") > 1)).alias("done"))
        ranges = on.groupBy("gram", "cover").agg(F.collect_list(F.struct("p", "q", "done")).alias("ranges"))
        todo = covers.join(ranges, ["gram", "cover"]).select(K1, K2, "gram", "cover", "at", "suffix", "front", "ranges")
    return out


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, texts: bool = False, crowd: int = CROWD, bucket: int = BUCKET) -> DataFrame:
    """Per row of ``docs``: the id, n_bytes, n_removed, n_spans, kept_sha256, and with ``texts`` the kept bytes (which need not be UTF-8 any more)
    and the removed ranges."""
    spans = repeated_spans(spark, docs, text_col, (id_col,), window, gram, crowd, bucket)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("__id"), *row_key(F.col(id_col), text), text.alias("text")).join(spans, [K1, K2], "left").select("__id", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(1))
            raw, got = memoryview(data), []
            for i, s in enumerate(b.column(2).to_pylist()):
                a, z, keep = int(offs[i]), int(offs[i + 1]), []
                gone = merged([(x["a"], x["b"]) for x in s]) if s else []
                at, sha = a, hashlib.sha256()
                for x, y in gone:
                    keep.append(raw[at : a + x])
                    at = a + y
                keep.append(raw[at:z])
                for part in keep:
                    sha.update(part)
                row = (z - a, sum(y - x for x, y in gone), len(gone), sha.hexdigest())
                got.append((*row, b"".join(keep), [{"a": x, "b": y} for x, y in gone]) if texts else row)
            cols = list(zip(*got, strict=True)) or [()] * (6 if texts else 4)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=False))], [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"][: len(cols) + 1])

    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(remove, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary, removed array<struct<a: bigint, b: bigint>>" * texts)


#: Strings are told apart by two sums of the hashes of their runs of 16 bytes, one of them weighted by place, which a window rolls over each text.
ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS l FROM documents),
b AS (SELECT r, len(l) AS n, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM t),
g AS (SELECT r, n, x, i, hash({", ".join(["x"] + [f"lead(x, {k}) OVER o" for k in range(1, 16)])})::HUGEINT AS v FROM b WINDOW o AS (PARTITION BY r ORDER BY i)),
w AS (SELECT r, n, x, i, CASE WHEN i <= n - {WINDOW - 1} THEN hash(sum(v) OVER o, sum(v * i) OVER o - i * sum(v) OVER o) END AS s FROM g WINDOW o AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 16} FOLLOWING)),
a AS (SELECT s FROM w WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
c AS (SELECT r, x, i, coalesce(max(CASE WHEN a.s IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW), 0) AS gone FROM w LEFT JOIN a ON w.s = a.s),
e AS (SELECT r, x, i, gone, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY i) AS before FROM c),
k AS (SELECT r, sum(gone)::BIGINT AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans, sha256(unhex(coalesce(string_agg(x, '' ORDER BY i) FILTER (gone = 0), ''))) AS kept FROM e GROUP BY r)
SELECT doc_id, len(l) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept, sha256('')) AS kept_sha256 FROM t LEFT JOIN k USING (r)
"""
