"""Exact and near duplicates of files or texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import pieces, save, thrifty
from .tables import join_evenly

#: One window in so many is sampled.
RATE = 512
#: Texts that share a window are paired in blocks of so many.
BLOCK = 256


def by_hash(rows: DataFrame, id_col: str, content: Column) -> DataFrame:
    """Per content: its md5, n (how many rows have it) and the smallest id. Counts are combined before they are moved."""
    return rows.groupBy(F.md5(content.cast("binary")).alias("hash")).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id"))


def groups(rows: DataFrame, id_col: str, content: Column) -> DataFrame:
    """The rows whose content others have too: hash, n, id."""
    hashed = save(rows.select(F.md5(content.cast("binary")).alias("hash"), id_col), "hashes")
    many = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return join_evenly(hashed, many.withColumn("times", F.col("n")), "hash", "times", hashed.count()).select("hash", "n", id_col)


def totals(rows: DataFrame, id_col: str, content: Column) -> DataFrame:
    one = by_hash(rows, id_col, content)
    return one.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_files"), F.count(F.lit(1)).alias("n_distinct"), F.count(F.when(F.col("n") > 1, 1)).alias("n_groups"))


def sampled_starts(text: str, window: int, rate: int = RATE) -> np.ndarray:
    """Where the sampled windows of a text begin: those whose sum over a mixed value of each four characters is divisible by ``rate``. The sum rolls, so a character costs a few operations."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    p = (((c[:-3] * 131 + c[1:-2]) * 131 + c[2:-1]) * 131 + c[3:]) & 0x7FFFFFFF if len(c) > 3 else c[:0]
    sums = np.r_[0, np.cumsum(p * 1103515245 >> 15 & 0xFFFF)]
    k = window - 3
    return np.flatnonzero((sums[k:] - sums[:-k] if len(c) > window else sums[-1:]) % rate == 0)


def sampled_windows(docs: DataFrame, id_col: str, text: Column, window: int = 250, rate: int = RATE) -> DataFrame:
    """Per text: the id, ``key`` (the text's md5) and ``hashes``: the distinct md5s of its sampled windows. A text no longer than the window is one window. The choice depends on the window alone, so copies
    always choose alike; null texts have no row."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 2):
            found = []
            for t in b.column(2).to_pylist():
                found.append(sorted({hashlib.md5(t[at : at + window].encode()).hexdigest() for at in sampled_starts(t, window, rate).tolist()}))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], [id_col, "key", "hashes"])

    rows = docs.select(id_col, F.md5(text.cast("binary")).alias("key"), text.alias("__text")).where("__text is not null")
    return rows.mapInArrow(thrifty(hashes), f"`{id_col}` {dict(docs.dtypes)[id_col]}, key string, hashes array<string>")


def _postings(docs: DataFrame, id_col: str, text: Column, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sampled windows of each row (saved); of different texts the smallest id a, n (rows that have it) and key; and which of those (a) has which window that others have too, with n, the number of such texts."""
    w = save(sampled_windows(docs, id_col, text, window).where(F.size("hashes") > 0), "windows")
    one = w.groupBy("key").agg(F.min(id_col).alias("a"), F.count(F.lit(1)).alias("n"), F.first("hashes").alias("hashes"))
    one = save(one, "texts")
    h = one.select("a", F.explode("hashes").alias("hash"))
    shared = h.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("times", F.col("n"))
    total = one.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    return w, one.select("key", "a", "n"), save(join_evenly(h, shared, "hash", "times", total), "postings")


def _of_copies(w: DataFrame, one: DataFrame, id_col: str) -> DataFrame:
    """Rows with b and the smallest id a that has the same text, if that is another row, and how many windows they share."""
    rows = w.select("key", F.col(id_col).alias("b"), F.size("hashes").cast("bigint").alias("n_shared"))
    return join_evenly(rows, one.where("n > 1").withColumnRenamed("n", "times"), "key", "times", w.count()).where("a <> b").select("a", "b", "n_shared")


def _pairs(postings: DataFrame, block: int = BLOCK) -> DataFrame:
    """Different texts a < b with the number of windows that they share. A window's texts are dealt over blocks, and each two blocks meet in a cell of their own, so no window is the work of one task."""
    n = F.ceil(F.col("n") / block).cast("int")
    p = postings.withColumn("__n", n).withColumn("__b", F.pmod(F.xxhash64("a"), F.col("__n")).cast("int"))
    p = p.select("hash", "a", "__b", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__o"))
    cell = F.struct(F.least("__b", "__o").alias("i"), F.greatest("__b", "__o").alias("j"))
    p = p.select("hash", cell.alias("cell"), "a", "__b")
    left, right = p.where(F.col("__b") == F.col("cell.i")), p.where(F.col("__b") == F.col("cell.j"))
    met = left.select("hash", "cell", F.col("a").alias("x")).join(right.select("hash", "cell", F.col("a").alias("y")), ["hash", "cell"])
    # within one block each two texts meet twice, in cells of two blocks once
    met = met.where((F.col("cell.i") < F.col("cell.j")) | (F.col("x") < F.col("y")))
    return met.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("n_shared"))


def near(docs: DataFrame, id_col: str, text: Column, window: int = 250, most: int | None = None) -> DataFrame:
    """Pairs a, b with n_shared, the number of sampled windows that they share. Different texts are paired by the row with the smallest id that has them (a before b); every other row is paired with that
    of its own text alone, so copies never make pairs among each other. Texts that share a window are paired with each other, a row for each pair: ``near_classes`` has one for each text.
    ``most``: that many pairs only, those that share most first."""
    w, one, postings = _postings(docs, id_col, text, window)
    pairs = _pairs(postings).unionByName(_of_copies(w, one, id_col))
    return pairs if most is None else pairs.orderBy(F.desc("n_shared"), F.desc("a"), F.desc("b")).limit(most)


def near_classes(docs: DataFrame, id_col: str, text: Column, window: int = 250) -> DataFrame:
    """A row for each text that shares a sampled window with another row: the id, class_id (the smallest id that windows lead to, over any number of texts), and n_windows, how many of its windows other rows have. Rows grow
    with the texts, whatever they share: each window links its texts to the smallest of them, and classes are put together from those links."""
    w, one, postings = _postings(docs, id_col, text, window)
    least = postings.groupBy("hash").agg(F.min("a").alias("least"), F.max("n").alias("times"))
    stars = join_evenly(postings.select("hash", "a"), least, "hash", "times", postings.count()).where("a <> least").select("a", "least")
    root = components(stars)
    windows = postings.groupBy("a").agg(F.count(F.lit(1)).alias("n_windows"))
    different = one.join(windows, "a", "left").join(root.withColumnRenamed("node", "a"), "a", "left").select("key", "a", "n", F.coalesce("root", "a").alias("class_id"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"))
    different = save(different.where("n > 1 or n_windows > 0"), "classes")
    rows = w.select("key", id_col, F.size("hashes").cast("bigint").alias("size"))
    found = join_evenly(rows, different.withColumnRenamed("n", "times").withColumn("copied", F.col("times") > 1), "key", "times", w.count())
    return found.select(id_col, "class_id", F.when(F.col("copied"), F.col("size")).otherwise(F.col("n_windows")).alias("n_windows"))


def links_of(asked: DataFrame, docs: DataFrame, id_col: str, text: Column, window: int = 250) -> DataFrame:
    """The pairs of ``near`` that hold one of the texts of ``asked`` (its column ``id_col``), as a (asked) and b: rows grow with the links asked for."""
    w, one, postings = _postings(docs, id_col, text, window)
    mine = w.join(asked.select(id_col).distinct(), id_col, "left_semi").select("key", F.col(id_col).alias("asked"))
    known = mine.join(one.select("key", "a"), "key").select("asked", "a")
    x = postings.join(known.select("a").distinct(), "a", "left_semi").select("hash", F.col("a").alias("x"))
    # a hot window's rows are dealt by blocks, and the texts asked for go to each of them
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = postings.select("hash", "a", "n", F.pmod(F.xxhash64("a"), parts).cast("int").alias("cell"))
    x = x.join(postings.groupBy("hash").agg(F.max("n").alias("n")), "hash").select("hash", "x", F.explode(F.sequence(F.lit(0), parts - 1)).alias("cell"))
    others = x.join(dealt, ["hash", "cell"]).where("a <> x").groupBy("x", "a").agg(F.count(F.lit(1)).alias("n_shared"))
    others = known.withColumnRenamed("a", "x").join(others, "x").select(F.col("asked").alias("a"), F.col("a").alias("b"), "n_shared")
    # rows of its own text, wherever in the order they are
    same = mine.join(w.select("key", F.col(id_col).alias("b"), F.size("hashes").cast("bigint").alias("n_shared")), "key").where("asked <> b").select(F.col("asked").alias("a"), "b", "n_shared")
    return others.unionByName(same)


def components(links: DataFrame, a: str = "a", b: str = "least") -> DataFrame:
    """node, root: for every node of a link the smallest node that links lead to. Each round, an edge offers the smaller of its ends' roots to the larger one; a root takes the least that it is offered, and offers are
    followed to their ends, twice as far each time. Neither a node with very many links nor a root of very many nodes meets in one task."""
    e = save(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    n_links = e.count()
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = save(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("root"), F.count(F.lit(1)).alias("degree")), "roots")
    n_nodes = root.count()
    while True:
        ends = join_evenly(e, root.select(F.col("node").alias("u"), F.col("root").alias("ru"), "degree"), "u", "degree", n_links)
        ends = join_evenly(ends, root.select(F.col("node").alias("v"), F.col("root").alias("rv"), "degree"), "v", "degree", n_links)
        offers = save(ends.where("ru <> rv").groupBy(F.greatest("ru", "rv").alias("r")).agg(F.min(F.least("ru", "rv")).alias("to")), "offers")
        if not offers.take(1):
            return root.select("node", "root")
        while True:
            far = save(offers.join(offers.select(F.col("r").alias("to"), F.col("to").alias("next")), "to", "left").select("r", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "offers")
            offers = far.select("r", "to")
            if not far.where("moved").take(1):
                break
        sizes = root.groupBy("root").agg(F.count(F.lit(1)).alias("times"))
        moved = join_evenly(root, offers.withColumnRenamed("r", "root").join(sizes, "root"), "root", "times", n_nodes).select("node", F.col("to").alias("root"), "degree")
        root = save(moved.unionByName(root.join(moved.select("node"), "node", "left_anti")), "roots")
