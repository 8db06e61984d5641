"""Quality classifier: ordinal regression with cumulative links on graded ratings.

One weight per hashed word or beginning of a word (4 and 5 bytes) that the text has, and per shape of words for the share of its words that have this shape, is shared by all grades; ordered thresholds
cut the score into grades: P(grade >= k) = 1 / (1 + exp(-(score - threshold_k))). The expected grade is the sum of these over k, and the tail probability P(grade >= k) for
one chosen k, the highest by default, decides what is selected.

The model is fitted on a bounded sample of rated documents by stochastic gradients with a step size per weight.

Defined results: a null or empty text has score 0, so its grade is what the thresholds alone say, and it is never selected. Texts are read whole. Repeated rows get equal
results; of more rated rows than the bound those with the smallest hashes of id and then of text are taken, and ties among these are rows that are alike. An empty table gives an empty result; without ratings of two grades all weights are 0, and everything with a word is selected. Only the named
columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import bounded_sample
from .streams import thrifty

SLOTS = 1 << 20
_SHIFT = np.uint64(64 - 20)
SHAPES = 64
_SHARE = 4.0  # weight of shares of shapes against presence of words
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BREAK = tk.SPACE.copy()
_BREAK[list(b".,;:\"'()")] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>!")] = True


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' features in order of the texts: text, slot and value. The last SHAPES slots are those of the shapes."""
    n = len(offs) - 1
    data = data[offs[0] : offs[-1]]
    w = tk.tokens(_LOWER[data], offs, _BREAK)
    slot = (w.hash >> _SHIFT).astype(np.int64)
    keys = [w.text * SLOTS + slot]
    for k in (4, 5):
        some = np.flatnonzero(w.end - w.start >= k)
        v = np.full(len(some), k, np.uint64)
        for i in range(k):
            v = v << np.uint64(8) | _LOWER[data[w.start[some] + i]]
        keys.append(w.text[some] * SLOTS + (tk.mix(v) >> _SHIFT).astype(np.int64))
    key = np.unique(np.concatenate(keys))
    text, slot = key // SLOTS, key % SLOTS
    # what a word looks like: its length, and whether it holds symbols or is in capitals
    symbols, capitals = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SYMBOL[data], out=symbols[1:])
    np.cumsum((data >= 0x41) & (data <= 0x5A), out=capitals[1:])
    shape = np.minimum(w.end - w.start, 15) * 4 + (symbols[w.end] > symbols[w.start]) * 2 + (capitals[w.end] - capitals[w.start] > 1)
    table = np.bincount(w.text * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)
    table = _SHARE * table / np.maximum(table.sum(1, keepdims=True), 1)
    t, s = np.nonzero(table)
    text, slot, value = np.r_[text, t], np.r_[slot, SLOTS + s], np.r_[np.ones(len(slot)), table[t, s]]
    order = np.argsort(text, kind="stable")
    return text[order], slot[order].astype(np.int32), value[order].astype(np.float32)


#: One text in so many is held out of the fit, and the share of good ones among them that must be selected.
HELD, KEEP = 5, 0.975


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade but the lowest
    cut: float = 0.2  # P(highest grade) from which on a document is selected

    def tails(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= k) for each text and k from 1 on, and whether the text has a word."""
        n = len(offs) - 1
        text, slot, value = features(data, offs)
        score = np.bincount(text, self.weights[slot] * value, n)
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -50, 50))), np.bincount(text, minlength=n) > 0


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, top: int, epochs: int = 8, rate: float = 0.2, l2: float = 1e-4, least_docs: int = 8) -> Model:
    """rows: each document's slots and values. Words of fewer than ``least_docs`` documents get no weight. Thresholds are kept in order through positive gaps."""
    size = SLOTS + SHAPES
    model = Model(np.zeros(size, np.float32), np.linspace(-1, 1, top) if top > 1 else np.zeros(1))
    if len(np.unique(grade)) < 2:
        return model
    seen_in = np.zeros(size, np.int64)
    for at, _ in rows:
        seen_in[at] += 1
    used = seen_in >= least_docs
    used[SLOTS:] = True
    rows = [(at[used[at]], x[used[at]]) for at, x in rows]
    share = np.array([np.clip((grade >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, top + 1)])
    th = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(top))
    first, gaps = th[0], np.log(np.maximum(np.diff(th), 1e-2))
    w, seen = np.zeros(size), np.full(size, 1e-6)
    rng = np.random.default_rng(2)
    levels = np.arange(1, top + 1)
    for e in range(epochs):
        step = rate / (1 + e / 2)
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            if not len(at):
                continue
            th = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
            p = 1 / (1 + np.exp(-np.clip(x @ w[at] - th, -50, 50)))
            g = p - (grade[i] >= levels)
            d = g.sum() * x + l2 * w[at]
            seen[at] += d * d
            w[at] -= step * d / np.sqrt(seen[at])
            first += 0.02 * step * g.sum()
            gaps += 0.02 * step * np.cumsum(g[::-1])[::-1][1:] * np.exp(gaps)
    return Model(w.astype(np.float32), first + np.r_[0.0, np.cumsum(np.exp(gaps))])


def graded(quality: Column, toxic: Column) -> Column:
    """The rating: 0 for a toxic document, 1 for one of low quality, 2 for a good one; null where both marks are."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def train(docs: DataFrame, labels: DataFrame, grade: Column, top: int = 2, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 8000, keep: float = KEEP) -> Model:
    """A model fitted on at most ``max_rows`` rated rows, those with the smallest hash of their id; that also bounds what is broadcast and collected. One text in HELD is held out, and the cut for selection is the highest one that
    selects a share ``keep`` of the held-out rows of the highest grade.
    ``grade``: an expression over ``labels``, from 0 to ``top``."""
    some = labels.select(F.col(id_col).alias("__id"), grade.cast("int").alias("__grade")).where("__id is not null and __grade is not null")
    some = bounded_sample(some, max_rows, F.col("__id"), F.col("__grade"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("text"), F.xxhash64(text).alias("mark")).join(F.broadcast(some), "__id").select("__grade", "text", "mark")

    @thrifty
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(1))
            for i, j in tk.slices(offs):
                text, slot, value = features(data, offs[i : j + 1])
                cut = pa.array(np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).cast(pa.int32()), b.column(2).slice(i, j - i), pa.ListArray.from_arrays(cut, pa.array(slot)), pa.ListArray.from_arrays(cut, pa.array(value))], ["grade", "mark", "slots", "share"])

    # rows with repeated ids may be more than max_rows: those with the smallest hashes count
    got = rows.mapInArrow(hashed, "grade int, mark bigint, slots array<int>, share array<float>").orderBy("mark", "grade").limit(max_rows).toArrow().combine_chunks()
    slots, share = (got[c].combine_chunks() if got.num_rows else pa.array([], pa.list_(t)) for c, t in (("slots", pa.int32()), ("share", pa.float32())))
    if isinstance(slots, pa.ChunkedArray):
        slots, share = slots.chunk(0), share.chunk(0)
    cut, at, x = slots.offsets.to_numpy(), slots.values.to_numpy(), share.values.to_numpy()
    rows = [(at[a:b], x[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    grades, marks = (got[c].to_numpy() if got.num_rows else np.zeros(0, np.int64) for c in ("grade", "mark"))
    held = marks % HELD == 0  # by text, so copies are on one side
    model = fit([r for r, h in zip(rows, held, strict=True) if not h], grades[~held], top)
    model.cut = cut_for(model, [r for r, h in zip(rows, held, strict=True) if h], grades[held], keep)
    return model


def cut_for(model: Model, rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, keep: float, least: int = 20) -> float:
    """The highest cut that selects a share ``keep`` of held-out rows of the highest grade; the model's own if there are fewer than ``least`` of those."""
    top = len(model.thresholds)
    best = [i for i in range(len(rows)) if grade[i] == top]
    if len(best) < least:
        return model.cut
    score = np.sort([float(rows[i][1] @ model.weights[rows[i][0]]) for i in best])
    place = score[int((1 - keep) * len(score) + 1e-9)] - model.thresholds[-1]
    return float(1 / (1 + np.exp(-np.clip(place, -50, 50))))


def score(docs: DataFrame, model: Model, tail: int | None = None, least: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, expected_grade, tail_prob = P(grade >= tail), by default that of the highest grade, and selected (tail_prob at least ``least``, by default the model's cut, and the text has a word)."""
    m, k, cut = model, len(model.thresholds) if tail is None else tail, model.cut if least is None else least

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(1))
            for i, j in tk.slices(offs):
                p, some = m.tails(data, offs[i : j + 1])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(p.sum(1)), pa.array(p[:, k - 1]), pa.array(some & (p[:, k - 1] >= cut))], [id_col, "expected_grade", "tail_prob", "selected"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, expected_grade double, tail_prob double, selected boolean")
