"""Language identification in two steps: the family of languages first, then one-versus-one machines within it.

A text's features are the shares of its byte 2-, 3- and 4-grams (ASCII letters in lower case, other ASCII characters
as spaces), hashed to a fixed number of slots. A linear support vector machine per family (one against the rest) picks
the family; within it a machine for each pair of languages votes. All machines stand side by side in one weight
matrix, so that a batch is scored by one look-up per n-gram.

Defined results: a text that is null or has no letter is ``und`` with score 0; a language that no family names is a
family of its own. Texts are read whole. Ties go to the family or language whose name sorts first. Repeated rows get
equal results, an empty table an empty one; with nothing to learn from, every text is ``und``. Only the named columns
are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import save
from .streams import thrifty

#: So many languages' bounds are sent to every task; more are joined by a shuffle.
SENT_LANGS = 100_000
#: Families of languages whose members are easily confused.
FAMILIES = {
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"), "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"), "uralic": ("et", "fi", "hu"), "turkic": ("az", "kk", "tr", "uz"),
}
SLOTS = 1 << 13
_SHIFT = np.uint64(64 - 13)
_FOLD = np.full(256, 0x20, np.uint64)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def grams(data: np.ndarray, base: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots of all n-grams, and in front of which of them each text begins (n-grams that span two texts left out)."""
    c = _FOLD[data]
    for n in (2, 3, 4):
        m = len(c) - n + 1
        if m <= 0:
            yield np.zeros(0, np.int64), np.zeros(len(base), np.int64)
            continue
        g = np.full(m, n, np.uint64)
        for i in range(n):
            g = (g << np.uint64(8)) | c[i : i + m]
        slot = ((g * np.uint64(0x9E3779B97F4A7C15)) >> _SHIFT).astype(np.int64)
        first = np.minimum(base, m)
        last = np.maximum(np.minimum(base[1:] - n + 1, m), first[:-1])
        keep = np.zeros(m + 1, np.int64)
        np.add.at(keep, first[:-1], 1)
        np.add.at(keep, last, -1)
        yield slot[np.cumsum(keep[:-1]) > 0], np.r_[0, np.cumsum(last - first[:-1])]


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    n, base = len(offs) - 1, offs - offs[0]
    x = np.zeros((n, SLOTS))
    for slot, begin in grams(data[offs[0] : offs[-1]], base):
        np.add.at(x, (np.repeat(np.arange(n), np.diff(begin)), slot), 1)
    return x / np.maximum(x.sum(1, keepdims=True), 1)


def has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    base = offs - offs[0]
    data = data[offs[0] : offs[-1]]
    out = tk.sums(_ASCII_LETTER[data], base) > 0
    for i in np.flatnonzero(~out & (np.diff(base) > 0)):
        out[i] = any(map(str.isalpha, data[base[i] : base[i + 1]].tobytes().decode("utf-8", "replace")))
    return out


Sparse = tuple[np.ndarray, np.ndarray]  # slots and values of one row


def machine(rows: list[Sparse], y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """The weights of a linear support vector machine (last: the bias) for y of -1 and 1, by dual coordinate ascent on sparse rows."""
    norm = np.array([v @ v + 1 for _, v in rows])
    w, a, rng = np.zeros(SLOTS + 1), np.zeros(len(y)), np.random.default_rng(1)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(y)):
            at, v = rows[i]
            g = y[i] * (v @ w[at] + w[-1]) - 1
            new = min(max(a[i] - g / norm[i], 0.0), c)
            if new != a[i]:
                d = (new - a[i]) * y[i]
                w[at] += d * v
                w[-1] += d
                most, a[i] = max(most, abs(new - a[i])), new
        if most < 1e-3:
            break
    return w


@dataclass
class Model:
    families: list[tuple[str, list[str]]]
    pairs: list[tuple[int, int, int]]  # family, and the two languages' places in it
    weights: np.ndarray  # slot by machine; the families' machines come first
    bias: np.ndarray

    def predict(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, base = len(offs) - 1, offs - offs[0]
        total, size = np.zeros((n, len(self.bias))), np.zeros(n)
        if not self.families:
            return np.full(n, "und", object), np.zeros(n)
        for slot, begin in grams(data[offs[0] : offs[-1]], base):
            size += np.diff(begin)
            for k in range(len(self.bias)):
                c = np.r_[0.0, np.cumsum(self.weights[slot, k], dtype=np.float64)]
                total[:, k] += c[begin[1:]] - c[begin[:-1]]
        margin = total / np.maximum(size, 1)[:, None] + self.bias
        p = 1 / (1 + np.exp(-np.clip(3 * margin, -50, 50)))
        nf = len(self.families)
        share = p[:, :nf] / np.maximum(p[:, :nf].sum(1, keepdims=True), 1e-12)
        fam = margin[:, :nf].argmax(1)
        lang, score = np.full(n, "und", object), np.zeros(n)
        for f, (_, members) in enumerate(self.families):
            rows = np.flatnonzero(fam == f)
            vote = np.zeros((len(rows), len(members)))
            for k, (g, i, j) in enumerate(self.pairs):
                if g == f:
                    vote[:, i] += p[rows, nf + k]
                    vote[:, j] += 1 - p[rows, nf + k]
            best = vote.argmax(1)
            lang[rows] = np.array(members, object)[best]
            within = vote[np.arange(len(rows)), best] / max(len(members) - 1, 1) if len(members) > 1 else 1.0
            score[rows] = share[rows, f] * within
        known = has_letter(data, offs)
        lang[~known], score[~known] = "und", 0.0
        return lang, np.clip(score, 0, 1)


def fit(rows: list[Sparse], langs: list[str], families: dict[str, tuple[str, ...]] = FAMILIES) -> Model:
    names = sorted(set(langs))
    of = {m: f for f, ms in families.items() for m in ms}
    groups: dict[str, list[str]] = {}
    for m in names:
        groups.setdefault(of.get(m, m), []).append(m)
    fams, y = sorted(groups.items()), np.array(langs)
    mean = np.zeros(SLOTS)
    for at, v in rows:
        mean[at] += v / max(len(rows), 1)
    scale = 1 / np.sqrt(mean + 1e-5)
    # rows have length 1 in the mean
    scale /= max(np.mean([np.sqrt(((v * scale[at]) ** 2).sum()) for at, v in rows]), 1e-12) if rows else 1.0
    scaled = [(at, v * scale[at]) for at, v in rows]
    ws, pairs = [], []
    for _, members in fams:
        ws.append(machine(scaled, np.where(np.isin(y, members), 1.0, -1.0)) if len(fams) > 1 else np.r_[np.zeros(SLOTS), 1.0])
    for f, (_, members) in enumerate(fams):
        for i, j in combinations(range(len(members)), 2):
            some = np.flatnonzero(np.isin(y, [members[i], members[j]]))
            ws.append(machine([scaled[k] for k in some], np.where(y[some] == members[i], 1.0, -1.0)))
            pairs.append((f, i, j))
    w = np.array(ws).reshape(len(ws), SLOTS + 1)
    return Model(fams, pairs, (w[:, :-1] * scale).T.astype(np.float32), w[:, -1])


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text is 2 modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 250, most_rows: int = 25_000, least_per_lang: int = 10) -> Model:
    """Machines for every language that has a labelled row, fitted on at most ``per_lang`` different texts of each (those with the smallest hash), held-out rows never. With so many languages
    that these would be more than ``most_rows``, fewer are taken of each, though at least ``least_per_lang``. Each gives its whole text, and two short pieces of it as texts of their own."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    slot = F.pmod(F.xxhash64(F.lit("langid"), "text"), F.lit(1 << 30))
    # copies count once, both here and in the sample; the estimate doesn't depend on how rows are dealt
    sizes = save(docs.sparkSession, known.groupBy("lang").agg(F.approx_count_distinct(slot).alias("count")), "languages")
    n = sizes.count()
    per_lang = max(min(per_lang, most_rows // max(n, 1)), min(per_lang, least_per_lang))
    bounds = sizes.select("lang", (F.least(F.lit(1.0), 2.0 * per_lang / F.col("count") + 64.0 / F.col("count")) * (1 << 30)).cast("long").alias("bound"))
    some = known.withColumn("slot", slot).join(F.broadcast(bounds) if n <= SENT_LANGS else bounds, "lang").where("slot <= bound").select("lang", "slot", "text").distinct()
    some = some.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("slot", "text"))).where(F.col("place") <= per_lang).select("lang", "text")

    @thrifty
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, pieces = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for piece in (text, text[:200], text[len(text) // 2 :][:60]):
                    langs.append(lang), pieces.append(piece)
            data, offs = tk.texts(pa.array(pieces, pa.string()))
            ok = has_letter(data, offs)
            for i in np.flatnonzero(ok):
                x = features(data, offs[i : i + 2])[0].astype(np.float32)
                at = np.flatnonzero(x)
                yield pa.RecordBatch.from_arrays([pa.array([langs[i]]), pa.array([at], pa.list_(pa.int32())), pa.array([x[at]], pa.list_(pa.float32()))], ["lang", "at", "share"])

    got = some.mapInArrow(count, "lang string, at array<int>, share array<float>").toPandas()
    rows = [(np.asarray(at), np.asarray(share, np.float64)) for at, share in zip(got["at"], got["share"], strict=True)]
    langs = got["lang"].tolist()
    del got
    marks = [xxhash.xxh3_64_intdigest(at.tobytes() + share.tobytes()) for at, share in rows]
    order = sorted(range(len(langs)), key=lambda i: (langs[i], marks[i]))  # rows arrive in any order
    return fit([rows[i] for i in order], [langs[i] for i in order])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, held_out, lang_pred and score."""
    m = model

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(2))
            for i, j in tk.slices(offs):
                lang, score = m.predict(data, offs[i : j + 1])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(lang, pa.string()), pa.array(score)], [id_col, "held_out", "lang_pred", "score"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(id_col, held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
