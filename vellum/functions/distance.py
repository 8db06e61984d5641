"""Edit distance with weights, and the nearest of some names."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import save

#: So many names are compared in one expression; more are compared in several.
NAMES = 2000


def distance(a: str, b: str, insertion: int = 1, deletion: int = 1, substitution: int = 1) -> int:
    """What it costs to turn a into b."""
    row = [j * insertion for j in range(len(b) + 1)]
    for x in a:
        last, row[0] = row[0], row[0] + deletion
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + deletion, row[j - 1] + insertion, last + (x != y) * substitution)
    return row[-1]


def distances(a: list[str], b: list[str], insertion: int = 1, deletion: int = 1, substitution: int = 1) -> np.ndarray:
    """The same for many pairs. Pairs of the same two lengths are computed together, a row of the table at a time; of equal pairs one is."""
    pairs = {}
    number = np.array([pairs.setdefault(p, len(pairs)) for p in zip(a, b, strict=True)], np.int64)
    sizes: dict[tuple[int, int], list[int]] = {}
    every = list(pairs)
    for i, (x, y) in enumerate(every):
        sizes.setdefault((len(x), len(y)), []).append(i)
    out = np.zeros(len(every), np.int64)
    for (n, m), group in sizes.items():
        x, y = (np.frombuffer("".join(every[i][side] for i in group).encode("utf-32-le"), "<u4").reshape(len(group), size) for side, size in ((0, n), (1, m)))
        step = insertion * np.arange(m + 1)
        row = np.tile(step, (len(group), 1))
        for k in range(n):
            t = row + deletion
            np.minimum(t[:, 1:], row[:, :-1] + substitution * (x[:, k : k + 1] != y), out=t[:, 1:])
            row = np.minimum.accumulate(t - step, axis=1) + step  # an insertion comes from the left
        out[group] = row[:, -1]
    return out[number]


def weighted_distance(insertion: int = 1, deletion: int = 1, substitution: int = 1) -> Callable[..., Column]:
    """A vectorised function of two columns for the same; with unit costs the built-in one is faster. (As an expression of nested array functions it took 50 s for 30,000 pairs, so it isn't one.)"""

    @F.pandas_udf("int")
    def cost(a: pd.Series, b: pd.Series) -> pd.Series:
        some = (a.notna() & b.notna()).to_numpy()
        out = pd.Series(pd.NA, index=a.index, dtype="Int32")
        out[some] = distances(a[some].tolist(), b[some].tolist(), insertion, deletion, substitution).astype(np.int32)
        return out

    return cost


def nearest(names: DataFrame, name_col: str, dictionary: list[str], distance_col: str = "distance", nearest_col: str = "nearest") -> DataFrame:
    """``names`` with the entry of ``dictionary`` at the least edit distance, and that distance; ties go to the entry that sorts first. There is no greatest distance.
    The dictionary is a list of this program's, not a table: no join and no shuffle takes place."""
    best = None
    for i in range(0, len(dictionary), NAMES):
        words = F.array(*map(F.lit, sorted(dictionary)[i : i + NAMES]))
        one = F.array_min(F.transform(words, lambda w: F.struct(F.levenshtein(F.col(name_col), w).alias("d"), w.alias("w"))))
        best = one if best is None else F.least(best, one)
    return names.withColumn("__best", F.when(F.col(name_col).isNotNull(), best)).withColumn(distance_col, F.col("__best.d")).withColumn(nearest_col, F.col("__best.w")).drop("__best")


#: Words of a common beginning are kept together in blocks of at most so many; and there are about so many blocks at most, so that every task may know what they begin with.
PART, BLOCKS = 1000, 100_000
#: So many beginnings are followed to find a name's first block; so many cells of edit tables are held at once; so many names meet a block in one task.
_BEAM, _CELLS, _SHARE = 8, 1 << 21, 2000
_BINS = 32


def bags(words: list[str]) -> np.ndarray:
    """How many characters of each of _BINS kinds a word has. Two words are at least as far from each other as the larger of what one has more and what the other has more."""
    size = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    at = np.repeat(np.arange(len(words)), size) * _BINS + (codes * 2654435761 >> 7) % _BINS
    return np.bincount(at, minlength=len(words) * _BINS).reshape(len(words), _BINS).astype(np.int32)


class Words:
    """Words by length, and the nearest of them to a name: the least edit distance, and of equally near ones the first."""

    def __init__(self, words: list[str]):
        by: dict[int, list[str]] = {}
        for w in words:
            by.setdefault(len(w), []).append(w)
        self.by = {n: (np.array(ws, object), bags(ws)) for n, ws in by.items()}

    def nearest(self, name: str, best: tuple[int, str] = (1 << 30, "")) -> tuple[int, str]:
        """Words are tried by their length's distance and then by what their characters say at least, until no other can be as near. Only what comes before ``best`` counts."""
        bag = bags([name])[0]
        for n in sorted(self.by, key=lambda n: (abs(n - len(name)), n)):
            if abs(n - len(name)) > best[0]:
                break
            words, have = self.by[n]
            more = have - bag
            least = np.maximum(np.where(more > 0, more, 0).sum(1), np.where(more < 0, -more, 0).sum(1))
            order = np.argsort(least, kind="stable")
            at, step = 0, 64
            while at < len(order) and least[order[at]] <= best[0]:
                some = order[at : at + step]
                some = some[least[some] <= best[0]]
                got = distances([name] * len(some), words[some].tolist())
                k = int(got.min())
                if k <= best[0]:
                    best = min(best, (k, min(words[some][got == k])))
                at, step = at + step, step * 2
        return best


def common(a: str, b: str) -> int:
    """How many characters two words begin alike with."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def cut(words: list[str], part: int) -> Iterator[tuple[int, int]]:
    """Sorted words cut where their beginnings part, into blocks of at most ``part``; neighbours of few words stay together."""
    stack = [(0, len(words))]
    while stack:
        lo, hi = stack.pop()
        if hi - lo <= part:
            if hi > lo:
                yield lo, hi
            continue
        n = common(words[lo], words[hi - 1])
        began, i = lo, lo
        while i < hi:
            c = words[i][n : n + 1]
            j = bisect_left(words, chr(ord(c) + 1), i, hi, key=lambda w: w[n : n + 1]) if c and ord(c) < 0x10FFFF else hi if c else i + 1
            if 16 * (j - i) > part or 4 * (j - began) > part:
                yield from [(began, i)] if i > began else ()
                began = i
            if 16 * (j - i) > part:
                stack.append((i, j))
                began = j
            i = j
        yield from [(began, hi)] if hi > began else ()


class Beginnings:
    """What blocks of words begin with, as a tree whose levels are arrays; and at least how far a name is from each block. Blocks are numbered in the order of their words."""

    def __init__(self, blocks: list[tuple[str, int, int, int]]):
        """First word, length of the common beginning, least and greatest length of a word."""
        blocks = sorted(blocks)
        self.first = [b[0] for b in blocks]
        size = np.array([b[1:] for b in blocks], np.int64).reshape(-1, 3)
        #: Of each level: the characters, where each node's children begin in the next level, the least and greatest lengths below, and the blocks that end here with their nodes.
        self.levels: list[tuple[np.ndarray, ...]] = []
        rows, node, char = np.arange(len(blocks)), np.zeros(len(blocks), np.int64), np.zeros(1, np.uint32)
        depth = 0
        while len(rows):
            n = len(char)
            low, high = np.full(n, 1 << 30), np.zeros(n, np.int64)
            np.minimum.at(low, node, size[rows, 1])
            np.maximum.at(high, node, size[rows, 2])
            here = size[rows, 0] == depth
            ends, at = rows[here], node[here]
            rows, node = rows[~here], node[~here]
            c = np.array([ord(self.first[r][depth]) for r in rows.tolist()], np.uint32)
            # blocks that end here may stand between those of one child
            order = np.lexsort((rows, c, node))
            rows, node, c = rows[order], node[order], c[order]
            new = np.r_[True, (node[1:] != node[:-1]) | (c[1:] != c[:-1])] if len(rows) else np.zeros(0, bool)
            start = np.searchsorted(node[new], np.arange(n + 1))
            by = np.argsort(at, kind="stable")
            self.levels.append((char, start, low, high, ends[by], np.searchsorted(at[by], np.arange(n + 1))))
            char, node = c[new], np.cumsum(new) - 1
            depth += 1

    def _least(self, row: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """From rows of edit tables: at least how far words of these lengths are, that go on from this depth."""
        left = np.arange(row.shape[1] - 1, -1, -1)[None, :]
        return (row + np.maximum(np.maximum(low[:, None] - depth - left, left - (high[:, None] - depth)), 0)).min(1)

    def _below(self, depth: int, a: np.ndarray, v: np.ndarray, row: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """The children of nodes with their rows, and at least how far what is below each is."""
        start, (char, _, low, high, _, _) = self.levels[depth][1], self.levels[depth + 1]
        a, kid = _spread(a, start[v], start[v + 1]), _ranges(start[v], start[v + 1])
        old = np.repeat(row, start[v + 1] - start[v], axis=0)
        step = np.arange(row.shape[1], dtype=row.dtype)
        new = old + 1
        np.minimum(new[:, 1:], old[:, :-1] + (x[a] != char[kid][:, None]), out=new[:, 1:])
        new = np.minimum.accumulate(new - step, axis=1) + step
        return a, kid, new, self._least(new, depth + 1, low[kid], high[kid])

    def _begin(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, m = x.shape
        return np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(m + 1, dtype=np.int32), (n, 1))

    def nearby(self, x: np.ndarray) -> np.ndarray:
        """For names of one length (a row of characters each) a block that seems near."""
        a, v, row = self._begin(x)
        best, block, depth = np.full(len(x), 1 << 30), np.zeros(len(x), np.int64), 0
        low, high = self.levels[0][2:4]
        least = self._least(row, 0, low[v], high[v])
        while len(a):
            ends, at = self.levels[depth][4:6]
            k = at[v + 1] > at[v]
            order = np.flatnonzero(k)[np.argsort(-least[k], kind="stable")]  # the nearest comes last and stays
            good = order[least[order] < best[a[order]]]
            best[a[good]], block[a[good]] = least[good], ends[at[v[good]]]
            if depth + 1 == len(self.levels):
                break
            a, v, row, least = self._below(depth, a, v, row, x)
            order = np.lexsort((least, a))
            a, v, row, least = a[order], v[order], row[order], least[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            k = (rank < _BEAM) & (least < best[a])
            a, v, row, least = a[k], v[k], row[k], least[k]
            depth += 1
        return block

    def within(self, x: np.ndarray, bound: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Names (rows of ``x``) and blocks that may hold a word nearer than ``bound``, or as near in a block below ``before``."""
        stack = [(0, *self._begin(x))]
        while stack:
            depth, a, v, row = stack.pop()
            if len(a) > 1 and row.size > _CELLS:
                half = len(a) // 2
                stack += [(depth, a[:half], v[:half], row[:half]), (depth, a[half:], v[half:], row[half:])]
                continue
            _, _, low, high, ends, at = self.levels[depth]
            least = self._least(row, depth, low[v], high[v])
            name, block, far = _spread(a, at[v], at[v + 1]), ends[_ranges(at[v], at[v + 1])], np.repeat(least, at[v + 1] - at[v])
            k = (far < bound[name]) | (far == bound[name]) & (block < before[name])
            yield name[k], block[k]
            if depth + 1 < len(self.levels):
                a, v, row, least = self._below(depth, a, v, row, x)
                k = least <= bound[a]
                if k.any():
                    stack.append((depth + 1, a[k], v[k], row[k]))


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each start to each end, one behind the other."""
    n = end - start
    return np.arange(n.sum()) + np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else n


def _spread(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return np.repeat(a, end - start)


def _by_length(names: list[str], most: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of names of one length, and their characters."""
    sizes = np.array([len(n) for n in names], np.int64)
    for m in np.unique(sizes).tolist():
        same = np.flatnonzero(sizes == m)
        for i in range(0, len(same), most):
            some = same[i : i + most]
            yield some, np.frombuffer("".join(names[k] for k in some).encode("utf-32-le"), "<u4").reshape(len(some), m)


def _blocks(words: DataFrame, part: int, tasks: int) -> DataFrame:
    """block (its first word), same (how many characters its words begin alike with), low, high (their least and greatest length) and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ws = [w for b in batches for w in b.column(0).to_pylist()]
        rows = [(ws[i], common(ws[i], ws[j - 1]), min(map(len, ws[i:j])), max(map(len, ws[i:j])), ws[i:j]) for i, j in cut(ws, part)]
        for k in range(0, len(rows), 64):
            cols = zip(*rows[k : k + 64], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())), strict=True)], ["block", "same", "low", "high", "words"])

    return words.repartitionByRange(tasks, "word").sortWithinPartitions("word").mapInArrow(run, "block string, same int, low int, high int, words array<string>")


_FOUND = ((pa.string(), pa.string(), pa.int32(), pa.string()), ["name", "block", "d", "w"])


def _meet(blocks: DataFrame, asks: DataFrame, tasks: int) -> DataFrame:
    """asks: name, block, d, w. What a block holds before (d, w): name, block, d, w. A block that very many names ask for is dealt over tasks with them."""
    times = asks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / _SHARE).cast("int").alias("shares"))
    one = asks.join(F.broadcast(times), "block").select("block", F.pmod(F.xxhash64("name"), F.col("shares")).cast("int").alias("share"), F.lit(None).cast("array<string>").alias("words"), "name", "d", "w")
    held = blocks.join(F.broadcast(times), "block").select("block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "words", *(F.lit(None).cast(t).alias(c) for c, t in (("name", "string"), ("d", "int"), ("w", "string"))))
    stream = held.unionByName(one).repartition(tasks, "block", "share").sortWithinPartitions("block", "share", F.col("words").isNull())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for b in batches:
            out = []
            lists = b.column(2)
            for i, (block, name, d, w) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 3, 4, 5)), strict=True)):
                if lists[i].is_valid:
                    known = Words(lists[i].as_py())
                    continue
                got = known.nearest(name, (d, w))
                if got < (d, w):
                    out.append((name, block, *got))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 4, _FOUND[0], strict=True)], _FOUND[1])

    return stream.mapInArrow(compare, "name string, block string, d int, w string")


def nearest_of(names: DataFrame, name_col: str, dictionary: DataFrame, word_col: str, distance_col: str = "distance", nearest_col: str = "nearest", few: int = NAMES, part: int = PART) -> DataFrame:
    """As ``nearest``, for a table of words of any size; a null name has neither, and no word is null. Up to ``few`` words make an expression. More are sorted and cut into blocks of up to ``part`` words of a common beginning.
    Every task knows what blocks begin with, and with it at least how far each is from a name. So every different name goes to one block that seems near, and then to those alone that may hold a nearer word, or one as near that
    sorts before. All words count: a name that nothing is near to may go to all blocks."""
    spark = names.sparkSession
    words = dictionary.select(F.col(word_col).cast("string").alias("word")).where("word is not null").distinct()
    some = [r.word for r in words.limit(few + 1).collect()]
    if not some:
        return names.withColumn(distance_col, F.lit(None).cast("int")).withColumn(nearest_col, F.lit(None).cast("string"))
    if len(some) <= few:
        return nearest(names, name_col, some, distance_col, nearest_col)
    n, tasks = words.count(), spark.sparkContext.defaultParallelism * 4
    blocks = save(_blocks(words, max(part, -(-n // BLOCKS)), -(-n // 100_000)), "blocks")
    tree = spark.sparkContext.broadcast(Beginnings([tuple(r) for r in blocks.select("block", "same", "low", "high").collect()]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked, first = b.column(0).to_pylist(), tree.value.first
            for at, x in _by_length(asked):
                block = tree.value.nearby(x)
                yield pa.RecordBatch.from_arrays([pa.array([asked[i] for i in at], pa.string()), pa.array([first[k] for k in block], pa.string()), pa.array([1 << 30] * len(at), pa.int32()), pa.array([""] * len(at), pa.string())], _FOUND[1])

    def ask_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = tree.value.first
        for b in batches:
            asked, seen, d, w = (c.to_pylist() for c in b.columns)
            for at, x in _by_length(asked):
                bound, before, done = (np.array(v, np.int64) for v in ([d[i] for i in at], [bisect_left(first, w[i]) for i in at], [bisect_left(first, seen[i]) for i in at]))
                for name, block in tree.value.within(x, bound, before):
                    k = block != done[name]
                    mine = at[name[k]].tolist()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([asked[i] for i in mine], [first[j] for j in block[k].tolist()], [d[i] for i in mine], [w[i] for i in mine]), _FOUND[0], strict=True)], _FOUND[1])

    schema = "name string, block string, d int, w string"
    asked = names.select(F.col(name_col).alias("name")).where("name is not null").distinct().repartition(tasks, "name")
    near = save(_meet(blocks, save(asked.mapInArrow(ask, schema), "asks"), tasks), "near")
    more = save(near.repartition(tasks, "name").mapInArrow(ask_on, schema), "asks")
    best = near.unionByName(_meet(blocks, more, tasks)).groupBy(F.col("name").alias("__name")).agg(F.min(F.struct("d", "w")).alias("__best"))
    joined = names.join(best, F.col(name_col) == F.col("__name"), "left")
    return joined.withColumn(distance_col, F.col("__best.d")).withColumn(nearest_col, F.col("__best.w")).drop("__best", "__name")
