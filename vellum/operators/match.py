"""Search for all entries of a dictionary in all texts.

``search`` reports the longest entry at every place where one begins, overlaps included and without regard to word boundaries; ``replace`` takes the leftmost
longest entries that don't overlap. Both can work on a normalised view of a text and map what they find back to the text itself.

Dictionaries of up to SENT_BYTES are sent to every task, which builds an automaton. Larger ones stay tables: tasks get a filter over whole keys and over their beginnings of START, twice START characters and so on,
write down what passes, and that is joined with the keys. The filter has BITS bits for each of its entries, so what passes by chance doesn't grow with the dictionary; where it would be larger than FILTER_BYTES, the texts are read
several times, each time for a share of the keys.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import pieces, save, thrifty
from .tables import join_evenly

SENT_BYTES = 16 << 20
#: Bits of a filter for each entry, at least, and how many of them an entry sets: what is no entry passes with a probability below 0.007.
BITS, PROBES = 12, 4
FILTER_BYTES = 64 << 20

#: A normalised text, and for each of its characters where it stood.
View = tuple[str, array]
Normaliser = Callable[[View], View]


def view(text: str) -> View:
    return text, array("i", range(len(text)))


def rewriter(pattern: str, replacement: Callable[[re.Match[str]], list[tuple[str, int]]] | None = None) -> Normaliser:
    """A normaliser that replaces what ``pattern`` matches by characters, each with the place within the view that it stands for; by nothing if no replacement is given."""
    compiled = re.compile(pattern)

    def run(v: View) -> View:
        text, at = v
        out, places, last = [], array("i"), 0
        for m in compiled.finditer(text):
            out.append(text[last : m.start()])
            places += at[last : m.start()]
            for c, i in replacement(m) if replacement else ():
                out.append(c)
                places.append(at[i])
            last = m.end()
        return "".join(out) + text[last:], places + at[last:]

    return run


def lower(v: View) -> View:
    text = "".join(c.lower() if len(c.lower()) == 1 else c for c in v[0])
    return text, v[1]


def composed(*normalisers: Normaliser) -> Normaliser:
    """The last one listed runs first."""

    def run(v: View) -> View:
        for n in reversed(normalisers):
            v = n(v)
        return v

    return run


_ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&nbsp;": " "}
no_tags = rewriter("<[^>]*>?")
no_entities = rewriter("&(?:amp|lt|gt|nbsp);", lambda m: [(_ENTITIES[m[0]], m.start())])
plain = composed(no_entities, no_tags)
limp = composed(lower, rewriter("[^A-Za-z0-9]+", lambda m: [(" ", m.start())]))
violent = composed(lower, rewriter(r"[\W_]+"))
single_spaces = rewriter(r"(\s)\s+", lambda m: [(m[1], m.start())])


def removing(characters: str) -> Normaliser:
    return rewriter("[" + re.escape(characters) + "]+")


citation_view = composed(single_spaces, plain, removing(".'"))
law_view = composed(violent, plain)


@dataclass
class Match:
    start: int
    end: int
    key: str


class Dictionary:
    """Exact look-up, iteration in order, and search for its keys."""

    def __init__(self, entries: dict[str, object]):
        if not entries:
            raise ValueError("a dictionary needs an entry")
        self.entries = {k: entries[k] for k in sorted(entries)}
        self.automaton = ahocorasick.Automaton()
        for k in self.entries:
            if k:
                self.automaton.add_word(k, k)
        self.automaton.make_automaton()

    def __getitem__(self, key: str) -> object:
        return self.entries[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self.entries)

    def __len__(self) -> int:
        return len(self.entries)

    def search(self, text: str, legacy_end: bool = False) -> list[Match]:
        """The longest key at each start. legacy_end: nothing is reported where the longest key ends with the text."""
        longest: dict[int, str] = {}
        for last, key in self.automaton.iter(text) if len(self.automaton) else ():
            start = last + 1 - len(key)
            if len(key) > len(longest.get(start, "")):
                longest[start] = key
        return [Match(s, s + len(k), k) for s, k in sorted(longest.items()) if not (legacy_end and s + len(k) == len(text))]

    def leftmost(self, text: str) -> list[Match]:
        """Of these the leftmost ones that don't overlap."""
        out, end = [], 0
        for m in self.search(text):
            if m.start >= end:
                out.append(m)
                end = m.end
        return out

    def replace(self, text: str, normaliser: Normaliser | None, make: Callable[[str, object], str]) -> tuple[str, list[str]]:
        """The text with make(source, value) in place of each match, and the keys in order. A match's source goes on to just before the next character of
        the normalised view, so marks and tags behind it are within."""
        v, at = (normaliser or (lambda x: x))(view(text))
        out, keys, last = [], [], 0
        for m in self.leftmost(v):
            a, b = at[m.start], at[m.end] if m.end < len(at) else len(text)
            out += [text[last:a], make(text[a:b], self.entries[m.key])]
            keys.append(m.key)
            last = b
        return "".join(out) + text[last:], keys


def small(dictionary: DataFrame, key_col: str, value_col: str, sent_bytes: int = SENT_BYTES) -> dict[str, list] | None:
    """For each key its values; None if the dictionary is larger than ``sent_bytes``."""
    d = dictionary.select(F.col(key_col).cast("string").alias("k"), F.col(value_col).alias("v")).where("k <> ''")
    if int(d.agg(F.sum(F.octet_length("k") + F.coalesce(F.octet_length(F.col("v").cast("string")), F.lit(0)) + 64)).first()[0] or 0) > sent_bytes:
        return None
    part: dict[str, list] = {}
    for k, v in d.collect():
        part.setdefault(k, []).append(v)
    return {k: sorted(v, key=str) for k, v in part.items()}


def normalised(text: str | None, normaliser: Normaliser | None) -> str:
    return (normaliser(view(text))[0] if normaliser else text) if text else ""


def search(
    docs: DataFrame, id_col: str, text_col: str, dictionary: DataFrame, key_col: str, value_col: str, boundary: bool = False, legacy_end: bool = False, sent_bytes: int = SENT_BYTES, normaliser: Normaliser | None = None,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """A row per occurrence: the id, start (in characters, from 0), n_chars and the value. Both sides are taken as they are, but for texts with a ``normaliser``, whose result is searched. A key with several values
    gives a row for each. boundary: keep a match only if no letter or digit stands on either side of it."""
    ids, values = dict(docs.dtypes)[id_col], dict(dictionary.dtypes)[value_col]
    part = small(dictionary, key_col, value_col, sent_bytes)
    if part is None:
        return _search_large(docs, id_col, text_col, dictionary, key_col, value_col, boundary, legacy_end, normaliser, filter_bytes)
    if not part:
        return docs.select(id_col, F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("n_chars"), F.lit(None).cast(values).alias(value_col)).where("false")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = Dictionary(part)
        for b in pieces(batches, 1):
            rows = []
            for i, text in enumerate(b.column(1).to_pylist()):
                text = normalised(text, normaliser)
                for m in d.search(text, legacy_end):
                    if not (boundary and inside_word(text, m.start, m.end)):
                        rows += [(i, m.start, m.end - m.start, v) for v in part[m.key]]
            at, start, size, value = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(value) if rows else pa.array([], b.column(0).type)], [id_col, "start", "n_chars", value_col])

    return docs.select(id_col, text_col).mapInArrow(thrifty(_typed(find, value_col, values)), f"`{id_col}` {ids}, start bigint, n_chars bigint, `{value_col}` {values}")


def inside_word(text: str, start: int, end: int) -> bool:
    return text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()


START, _BASE = 6, 0xD6E8FEB86659FD93
_MIX = np.uint64(0x9E3779B97F4A7C15)


def geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def prefix_sums(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums over a text's characters, each with its own power of _BASE, and the powers of its inverse: with them the hash of any part of the text takes a few operations."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    return np.r_[np.uint64(0), np.cumsum(c * geometric(_BASE, len(c)), dtype=np.uint64)], geometric(pow(_BASE, -1, 1 << 64), len(c) + 1)


def part_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, size: int, whole: bool) -> np.ndarray:
    """Hashes of the parts of ``size`` characters from each start on, as whole keys or as beginnings of such."""
    h = (sums[start + size] - sums[start]) * inverse[start] + np.uint64(2 * size + whole)
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return (h ^ (h >> np.uint64(29))) * _MIX


def probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places of a filter of 2 ** bits that a hash sets."""
    step = (h * _MIX) | np.uint64(1)
    return [((h + np.uint64(i) * step) >> np.uint64(64 - bits)).astype(np.int64) for i in range(PROBES)]


def beginnings(size: int) -> list[int]:
    """The lengths of a key's beginnings that the filter knows."""
    out = []
    n = START
    while n <= size:
        out.append(n)
        n *= 2
    return out


def filter_size(entries: int) -> int:
    """The power of two of a filter's bits."""
    return max((BITS * max(entries, 1) - 1).bit_length(), 15)


def shares(entries: int, filter_bytes: int) -> int:
    """In how many shares keys with so many entries are searched, so that no filter is larger than ``filter_bytes``."""
    return -(-entries * BITS // (filter_bytes * 8 // 2)) if 1 << filter_size(entries) > 8 * filter_bytes else 1


class Filter:
    """Whole keys and their beginnings, and the lengths of keys by the longest beginning that they have (0: none)."""

    def __init__(self, map_: np.ndarray, bits: int, sizes: list[int]):
        self.map, self.bits = map_, bits
        self.levels: dict[int, list[int]] = {}
        for n in sorted(sizes):
            self.levels.setdefault(max(beginnings(n), default=0), []).append(n)
        self.deepest = max(self.levels, default=0)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in probes(h, self.bits):
            out &= (self.map[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return out

    def places(self, text: str) -> Iterator[tuple[int, int]]:
        """start, size of what may be a key: every key that is there, and little else. A place is tried for longer keys only as long as the text goes on as some key begins."""
        sums, inverse = prefix_sums(text)
        at, level = np.arange(len(text)), 0
        while True:
            if level:
                at = at[at <= len(text) - level]
                at = at[self.has(part_hash(sums, inverse, at, level, False))]
            for n in self.levels.get(level, ()):
                x = at[at <= len(text) - n]
                x = x[self.has(part_hash(sums, inverse, x, n, True))]
                yield from ((int(a), n) for a in x)
            level = 2 * level if level else START
            if level > self.deepest or not len(at):
                return


def key_entries(key: str) -> np.ndarray:
    """The hashes that a key adds to a filter."""
    sums, inverse = prefix_sums(key)
    zero = np.zeros(1, np.int64)
    return np.concatenate([part_hash(sums, inverse, zero, len(key), True), *(part_hash(sums, inverse, zero, n, False) for n in beginnings(len(key)))])


def make_filter(keys: DataFrame, entries: int) -> Filter:
    """A filter of the column k. Its bits are put together by an aggregation, in pieces of 4096 bytes."""
    bits = filter_size(entries)

    def set_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [key_entries(k) for k in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(probes(np.concatenate(h), bits))) if h else [], pa.int64())], ["bit"])

    # a bucket is 4096 bytes, for 32768 bits that are counted from 1 on
    got = keys.select("k").mapInArrow(set_, "bit bigint").groupBy(F.expr("bitmap_bucket_number(bit + 1)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("map"))
    out = np.zeros(1 << bits - 3, np.uint8)
    for bucket, m in got.toLocalIterator():
        at = (bucket - 1) * 4096
        out[at : at + len(m)] = np.frombuffer(bytes(m), np.uint8)
    return Filter(out, bits, [r[0] for r in keys.select(F.char_length("k")).distinct().collect()])


def candidates(docs: DataFrame, id_col: str, text_col: str, known: Filter, boundary: bool, legacy_end: bool, normaliser: Normaliser | None) -> DataFrame:
    """What passes the filter: the id, start, n_chars, __key, and __good: whether it stands where it must."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            rows: list[tuple] = []
            for i, text in enumerate(b.column(1).to_pylist()):
                text = normalised(text, normaliser)
                rows += [(i, a, n, text[a : a + n], not (boundary and inside_word(text, a, a + n)) and not (legacy_end and a + n == len(text))) for a, n in sent.value.places(text)]
            i, start, size, key, good = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i, pa.int64())), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(key, pa.string()), pa.array(good, pa.bool_())], [id_col, "start", "n_chars", "__key", "__good"])

    return docs.select(id_col, text_col).mapInArrow(thrifty(find), f"`{id_col}` {dict(docs.dtypes)[id_col]}, start bigint, n_chars bigint, __key string, __good boolean")


def _search_large(docs: DataFrame, id_col: str, text_col: str, dictionary: DataFrame, key_col: str, value_col: str, boundary: bool, legacy_end: bool, normaliser: Normaliser | None, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    keys = dictionary.select(F.col(key_col).cast("string").alias("k")).where("k <> ''")
    n = F.char_length("k")
    entries = int(keys.agg(F.sum(F.when(n < START, 1).otherwise(F.floor(F.log2(n / START)) + 2))).first()[0] or 0)
    passes = shares(entries, filter_bytes)
    found = None
    for i in range(passes):
        mine = keys.where(F.pmod(F.xxhash64("k"), F.lit(passes)) == i) if passes > 1 else keys
        some = candidates(docs, id_col, text_col, make_filter(mine, -(-entries // passes)), boundary, legacy_end, normaliser)
        found = some if found is None else found.unionByName(some)
    found = save(found, "candidates")
    times = found.groupBy("__key").agg(F.count(F.lit(1)).alias("times"))
    values = dictionary.select(F.col(key_col).cast("string").alias("__key"), F.col(value_col).alias("__value")).join(times, "__key").groupBy("__key").agg(F.first("times").alias("times"), F.collect_list("__value").alias("__values"))
    real = join_evenly(found, values, "__key", "times", found.count())
    # at a place the longest key counts, whether or not it stands at a boundary
    longest = W.partitionBy(id_col, "start")
    real = real.withColumn("__n", F.max("n_chars").over(longest)).where("n_chars = __n and __good")
    return real.select(id_col, "start", "n_chars", F.explode("__values").alias(value_col))


def _typed(find, value_col: str, kind: str):
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(_parse_datatype_string(kind))

    def run(batches):
        for b in find(batches):
            i = b.schema.get_field_index(value_col)
            yield b.set_column(i, value_col, b.column(i).cast(arrow) if b.num_rows else pa.array([], arrow))

    return run


def lookup(rows: DataFrame, key_col: str, entries: dict[str, str], value_col: str = "value") -> DataFrame:
    """``rows`` with the value of their key, null for a key that ``entries`` (a dictionary of this program's, not a table) hasn't; and with ``keys``, all keys in order."""

    @F.pandas_udf("string")
    def value(keys: pd.Series) -> pd.Series:
        d = Dictionary(entries)
        return keys.map(lambda k: d[k] if k in d.entries else None)

    return rows.withColumn(value_col, value(key_col)).withColumn("keys", F.array(*map(F.lit, Dictionary(entries))))


def hits(docs: DataFrame, id_col: str, text_col: str, dictionary: DataFrame, key_col: str, value_col: str, **options) -> DataFrame:
    """Which texts mention which entries: distinct pairs of id and value."""
    return search(docs, id_col, text_col, dictionary, key_col, value_col, **options).select(id_col, value_col).distinct()


def _linked(d: Dictionary, text: str | None, normaliser: Normaliser | None) -> tuple[str | None, list[str], list[int | None]]:
    if text is None:
        return None, [], []
    got, keys = d.replace(text, normaliser, lambda s, v: f'<a href="{v[0]}">{s}</a>')
    return got, keys, [d[k][1] for k in keys]


def _links(batch: pa.RecordBatch, got: list[tuple], names: list[str]) -> pa.RecordBatch:
    text, keys, ids = zip(*got, strict=True) if got else ((), (), ())
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string()), pa.array(keys, pa.list_(pa.string())), pa.array(ids, pa.list_(pa.int64()))], names)


def link(docs: DataFrame, id_col: str, text_col: str, entries: dict[str, str | tuple[str, int]], normaliser: Normaliser | None = law_view) -> DataFrame:
    """Per row: the id, the text with each mention of a key of ``entries`` (a normalised title) within a link to its value, and for each link its key and the id that stands beside the value, if one does."""
    pairs = {k: v if isinstance(v, tuple) else (v, None) for k, v in entries.items()}
    names = [id_col, text_col, "keys", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = Dictionary(pairs)
        for b in pieces(batches, 1):
            yield _links(b, [_linked(d, t, normaliser) for t in b.column(1).to_pylist()], names)

    return docs.select(id_col, text_col).mapInArrow(thrifty(run), _link_schema(docs, id_col, text_col))


def _link_schema(docs: DataFrame, id_col: str, text_col: str) -> str:
    return f"`{id_col}` {dict(docs.dtypes)[id_col]}, `{text_col}` string, keys array<string>, ids array<bigint>"


def link_table(docs: DataFrame, id_col: str, text_col: str, entries: DataFrame, key_col: str, href_col: str, normaliser: Normaliser | None = law_view, sent_bytes: int = SENT_BYTES, number_col: str | None = None) -> DataFrame:
    """As ``link``, for a table of entries with one row for each key; ``number_col`` holds the ids that links are given. A small one is sent to every task; of a larger one each text gets the entries that were found
    in it. Rows need different ids then."""
    number = F.col(number_col).cast("bigint") if number_col else F.lit(None).cast("bigint")
    pair = entries.select(F.col(key_col).alias("__k"), F.struct(F.col(key_col).alias("key"), F.col(href_col).alias("href"), number.alias("number")).alias("entry"))
    part = small(pair, "__k", "entry", sent_bytes)
    if part is not None:
        if part:
            return link(docs, id_col, text_col, {k: (v[0]["href"], v[0]["number"]) for k, v in part.items()}, normaliser)
        return docs.select(id_col, text_col, F.array().cast("array<string>").alias("keys"), F.array().cast("array<bigint>").alias("ids"))
    found = search(docs, id_col, text_col, pair, "__k", "entry", sent_bytes=-1, normaliser=normaliser).groupBy(id_col).agg(F.collect_set("entry").alias("__entries"))
    names = [id_col, text_col, "keys", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            got = []
            for t, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                got.append(_linked(Dictionary({e["key"]: (e["href"], e["number"]) for e in own}), t, normaliser) if t and own else (t, [], []))
            yield _links(b, got, names)

    rows = docs.select(id_col, text_col).join(found, id_col, "left")
    return rows.mapInArrow(thrifty(run), _link_schema(docs, id_col, text_col))
