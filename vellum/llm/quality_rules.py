"""Quality rules: gradient-boosted trees over document statistics.

The statistics of every whole text are computed batch by batch in numpy. Trees are grown on histograms of the
statistics of a bounded sample of labelled documents, under monotonic constraints for chosen statistics, and then
flattened into parallel node arrays (feature, threshold, left child, value), through which a whole batch of rows
walks level by level.

Defined results: a null or empty text has no words, fails the base rules and isn't kept. Very long texts are read
whole. Repeated rows get equal results. Ties of a split's gain go to the earlier statistic and the lower cut. An
empty table gives an empty result; without labelled rows of both kinds there are no trees and the base rules
decide alone. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import bounded_sample
from .streams import thrifty

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_CONTINUATION = np.zeros(256, bool)
_CONTINUATION[0x80:0xC0] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC2, 0xF5)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?=_~^\\{}[]@")] = True

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Name and direction of each statistic: 1, more can only raise the score; -1, only lower it; 0, free.
FEATURES = {
    "log_words": 1, "mean_word_chars": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1,
    "distinct_word_share": 1, "upper_share": -1, "marks_per_word": -1, "stop_per_word": 0, "alpha_share": 1,
    "words_per_line": 0, "top_word_share": -1,
}


def statistics(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text its base counts (int64, a column per BASE) and its features (float64, a column per FEATURES)."""
    n = len(offs) - 1
    base = offs - offs[0]
    data = data[offs[0] : offs[-1]]
    w = tk.tokens(data, offs)
    n_words = tk.counts(w.text, n)
    sep = tk.SPACE[data]
    word_chars = tk.sums(~sep & ~_CONTINUATION[data], base)
    n_symbols = tk.sums(SYMBOLS[data], base)

    lines = tk.tokens(data, offs, tk.NEWLINE)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~sep, out=filled[1:])
    has_word = filled[lines.end] > filled[lines.start]
    _, earlier = tk.same_as_another(tk.within(lines.hash[has_word], lines.text[has_word]))
    n_lines = tk.counts(lines.text[has_word], n)
    n_dup = tk.counts(lines.text[has_word][earlier], n)

    h, at = tk.windows(w.hash, w.text, 8)
    again, _ = tk.same_as_another(tk.within(h, w.text[at]))
    edge = np.zeros(len(w.start) + 9, np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + 8, -1)
    covered = np.cumsum(edge)[: len(w.start)] > 0
    n_repeat = tk.counts(w.text[covered], n)
    counts = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], 1)

    key = tk.within(w.hash, w.text)
    order = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, np.int64)
    run = np.diff(np.r_[cut, len(key)])
    owner = w.text[order][cut] if len(key) else np.zeros(0, np.int64)
    distinct = tk.counts(owner, n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, run)
    words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    feats = np.stack([
        np.log1p(n_words), word_chars / words, n_symbols / words, n_dup / np.maximum(n_lines, 1), n_repeat / words,
        distinct / words, tk.sums(_UPPER[data], base) / chars, tk.sums(_MARKS[data], base) / words,
        tk.sums(_STOP[data], base) / words, tk.sums(_ALPHA[data], base) / chars, n_words / np.maximum(n_lines, 1), top / words,
    ], 1)
    return counts, feats


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])


@dataclass
class Trees:
    """Flattened trees: node i of tree t is row roots[t] + i; a leaf is its own left child."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0
    bias: float = 0.0
    threshold: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of good quality for each row of statistics."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                # the right child stands behind the left one; a leaf stays where it is
                node = self.left[node] + ((self.left[node] != node) & (x[rows, self.feature[node]] > self.cut[node]))
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, directions: list[int], rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 2.0, least: int = 10, floor: float = 0.002) -> Trees:
    """Boosted trees for log loss. A split of a constrained statistic is taken only if its leaves stand in order,
    and each child's values are kept on its side of their middle. ``floor``: the threshold is the score below which that share of the
    good training rows lies, 0.5 at most."""
    good = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or good in (0.0, 1.0):
        return Trees(bias=0.0, threshold=0.0)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    bias = float(np.log(good / (1 - good)))
    raw = np.full(len(y), bias)
    feature, cut, left, value, roots = [], [], [], [], []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return min(max(-g / (h + l2), low), high)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        start = len(feature)
        roots.append(start)
        feature.append(0), cut.append(0.0), left.append(start), value.append(0.0)
        todo = [(start, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop(0)
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = rate * leaf(gs, hs, low, high)
            raw[rows] += value[node]
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-9, None)
            for f, c in enumerate(cuts):
                size = len(c) + 1
                gb, hb = np.bincount(code[rows, f], g[rows], size).cumsum()[:-1], np.bincount(code[rows, f], h[rows], size).cumsum()[:-1]
                nb = np.bincount(code[rows, f], minlength=size).cumsum()[:-1]
                lv, rv = np.clip(-gb / (hb + l2), low, high), np.clip(-(gs - gb) / (hs - hb + l2), low, high)
                gain = -(gb * lv + (hb + l2) * lv**2 / 2) - ((gs - gb) * rv + (hs - hb + l2) * rv**2 / 2) + (gs * (v := leaf(gs, hs, low, high)) + (hs + l2) * v**2 / 2)
                gain[(nb < least) | (len(rows) - nb < least) | (directions[f] * (rv - lv) < 0)] = -np.inf
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (gain[k], (f, k, lv[k], rv[k]))
            if best[1] is None:
                continue
            f, k, lv, rv = best[1]
            raw[rows] -= value[node]
            value[node] = 0.0
            feature[node], cut[node], left[node] = f, float(cuts[f][k]), len(feature)
            middle, d = (lv + rv) / 2, directions[f]
            goes = code[rows, f] <= k
            for side, bounds in ((goes, (low, middle) if d > 0 else (middle, high) if d < 0 else (low, high)), (~goes, (middle, high) if d > 0 else (low, middle) if d < 0 else (low, high))):
                child = len(feature)
                feature.append(0), cut.append(0.0), left.append(child), value.append(0.0)
                todo.append((child, rows[side], level + 1, *bounds))
    out = Trees(np.array(feature, np.int32), np.array(cut), np.array(left, np.int32), np.array(value), np.array(roots, np.int32), depth, bias)
    s = out.score(x)[y > 0]
    out.threshold = float(min(0.5, np.quantile(s, floor)))
    return out


_STATS_SCHEMA = "label int, mark bigint, stats array<double>"


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 20000) -> Trees:
    """Trees fitted on at most ``max_rows`` labelled rows, those with the smallest hash of their id. That bound is
    also the bound of what is broadcast and of what the driver receives."""
    some = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).where("__id is not null and __label is not null")
    some = bounded_sample(some, max_rows, F.col("__id"), F.col("__label"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("text"), F.xxhash64(text).alias("mark")).join(F.broadcast(some), "__id").select("__label", "text", "mark")

    @thrifty
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(1))
            for i, j in tk.slices(offs):
                _, x = statistics(data, offs[i : j + 1])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).cast(pa.int32()), b.column(2).slice(i, j - i), pa.array(list(x), pa.list_(pa.float64()))], ["label", "mark", "stats"])

    # rows with repeated ids may be more than max_rows: those with the smallest hashes count
    got = rows.mapInArrow(stats, _STATS_SCHEMA).orderBy("mark", "label").limit(max_rows).toPandas()
    if not len(got):
        return Trees(threshold=0.0)
    x, y = np.stack(got["stats"].to_numpy()), got["label"].to_numpy()
    order = np.lexsort([*x.T, y])  # texts with equal hashes may arrive in any order
    return fit(x[order], (y[order] > 0).astype(float), list(FEATURES.values()))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the base counts, base_failed, the trees' score and kept for every row of ``docs``."""
    model = trees

    @thrifty
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(1))
            for i, j in tk.slices(offs):
                c, x = statistics(data, offs[i : j + 1])
                bad, s = base_failed(c), model.score(x)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *map(pa.array, c.T), pa.array(bad), pa.array(s), pa.array(~bad & (s >= model.threshold))], [id_col, *BASE, "base_failed", "score", "kept"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(rate, f"`{id_col}` {kind}, " + ", ".join(f"{k} bigint" for k in BASE) + ", base_failed boolean, score double, kept boolean")


def keep(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the base rules and the trees keep. Nothing is shuffled."""
    model, at = trees, docs.columns.index(text_col)

    @thrifty
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(at))
            kept = [np.zeros(0, bool)]
            for i, j in tk.slices(offs):
                c, x = statistics(data, offs[i : j + 1])
                kept.append(~base_failed(c) & (model.score(x) >= model.threshold))
            yield b.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(choose, docs.schema)


#: The base counts.
BASE_ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM t),
g AS (SELECT r, i, {" || ' ' || ".join(["x"] + [f"lead(x, {k}) OVER o" for k in range(1, 8)])} AS eight FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
a AS (SELECT r, i, count(*) OVER (PARTITION BY r, eight) > 1 AS again FROM g WHERE eight IS NOT NULL),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(8)) AS k FROM a WHERE again) GROUP BY r),
b AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
FROM t LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b
"""
