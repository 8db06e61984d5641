"""SentencePiece encoding and decoding with the n best segmentations of each text.

A text's lattice has a node for each place between characters and an edge for each piece that stands there. Forward Viterbi gives the best score of any path from the start to a node.
These scores are exact, so an A* search backwards from the end, whose priority is the score of what it has walked plus the forward score of where it is, pops complete
segmentations in order of their score.

No piece of the vocabulary has a space behind another character, so every lattice falls apart in front of each run of spaces (and around line breaks, which no piece has): a text's segmentations are the
combinations of those of its parts. The parts of a batch are mostly the same few; forward scores, and the loss of each part's second-best path, are computed for all different
parts of a batch at once. A* runs in those parts only whose alternatives can be among the text's n best, which are the n - 1 with the smallest loss.

Vocabularies of the BPE kind have merge ranks for scores; for these a piece's score is the logarithm of its probability under Zipf's law, 1 / (H (rank + 2)). A character that no piece
covers becomes its UTF-8 bytes, at the price of the least score less 10.

Defined results: a null or empty text has no piece, score 0 and one segmentation. Texts are read whole. Decoding gives the text back exactly, U+2581 included, which is taken apart into bytes. Of equal scores the
longer last piece wins in the best path; later ones come in the order that the search finds them, which depends on the text alone. Repeated rows get equal results, an empty table an empty one. Only the named columns are read,
so further columns never clash.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .streams import thrifty

SLICE = 1 << 21
#: Parts that are hashed at a time.
HASHED = 1 << 15
LONG_PART = 40
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(44)


class Vocabulary:
    """The pieces of a model as byte strings (its space mark as a space), with their scores, in a hash table for arrays."""

    def __init__(self, pieces: list[tuple[str, float, str]], prefix: bool, scoring: str = "auto"):
        """pieces: text, score and kind (normal, byte, unknown or other) in order of their ids. prefix: a space goes in front of every text."""
        self.prefix = prefix
        kinds = [k for _, _, k in pieces]
        score = np.array([s for _, s, _ in pieces], np.float64)
        normal = np.array([k == "normal" for k in kinds])
        if scoring == "zipf" or scoring == "auto" and (score[normal] == np.round(score[normal])).all():
            score = np.where(normal, -np.log(2 - score), 0.0)
            score[normal] -= np.log(np.exp(score[normal]).sum())
        self.score = score
        self.unknown_score = float(score[normal].min()) - 10.0
        self.unknown = kinds.index("unknown") if "unknown" in kinds else -1
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.raw: list[bytes] = []
        self.of: dict[bytes, int] = {}
        for i, (p, _, k) in enumerate(pieces):
            if k == "byte":
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            elif k == "normal":
                self.raw.append(p.replace("▁", " ").encode())
                self.of.setdefault(self.raw[i], i)
            else:
                self.raw.append(" ⁇ ".encode() if k == "unknown" else b"")
        self.bytes_known = (self.byte_ids != self.unknown).all()
        self.longest = max(map(len, self.of), default=0)
        self.cuts_at_spaces = all(p.rstrip(b" ") == p and b" " not in p.lstrip(b" ") or not p.strip(b" ") for p in self.of)
        self.cuts_at_lines = not any(b"\n" in p for p in self.of)
        self.size = np.array([len(p) for p in self.raw], np.int64)
        self.at = np.r_[0, np.cumsum(self.size)[:-1]]
        self.all_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self._tables()

    def _tables(self) -> None:
        ids = np.array(list(self.of.values()), np.int32)
        h = np.array([self.hash_of(p) for p in self.of], np.uint64)
        _, first = np.unique(h >> _TOP, return_index=True)
        rest = np.setdiff1d(np.arange(len(h)), first)
        for turn in range(1, 1000):
            self.turn = np.uint64((2 * turn + 1) * int(_STEP) % (1 << 64))
            if len(np.unique((h[rest] * self.turn) >> _TOP)) == len(rest):
                break
        self.h1, self.i1 = np.zeros(1 << 20, np.uint64), np.full(1 << 20, -1, np.int32)
        self.h2, self.i2 = np.zeros(1 << 20, np.uint64), np.full(1 << 20, -1, np.int32)
        self.h1[h[first] >> _TOP], self.i1[h[first] >> _TOP] = h[first], ids[first]
        k = (h[rest] * self.turn) >> _TOP
        self.h2[k], self.i2[k] = h[rest], ids[rest]

    @staticmethod
    def hash_of(p: bytes) -> int:
        h = 0
        for b in p:
            h = (h + int(tk.BYTES[b])) * int(_STEP) % (1 << 64)
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """The ids of pieces with these hashes, or -1."""
        k = h >> _TOP
        out = np.where(self.h1[k] == h, self.i1[k], -1)
        k = (h * self.turn) >> _TOP
        return np.where((out < 0) & (self.h2[k] == h), self.i2[k], out)

    def ids_of(self, piece: int, raw: bytes) -> list[int]:
        return [piece] if piece >= 0 else [int(self.byte_ids[b]) for b in raw] if self.bytes_known else [self.unknown]


@cache
def load(path: str, scoring: str = "auto") -> Vocabulary:
    """The vocabulary of a SentencePiece model file. Models that rewrite their input other than by a space in front are refused."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "a  b\tÅＡ "
    normal = sp.normalize(probe).replace("▁", " ")
    if normal.removeprefix(" ") != probe:
        raise ValueError(f"the model rewrites its input: {probe!r} becomes {normal!r}")
    kind = lambda i: "byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "other" if sp.is_control(i) or sp.is_unused(i) else "normal"
    return Vocabulary([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())], normal != probe, scoring)


def char_size(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def edges_from(v: Vocabulary, part: bytes, s: int) -> list[tuple[int, int, float]]:
    """Edges of the lattice that begin at s: end, id (-1: a character without a piece) and score."""
    out = []
    for e in range(s + 1, min(len(part), s + v.longest) + 1):
        i = v.of.get(part[s:e])
        if i is not None:
            out.append((e, i, float(v.score[i])))
    e = min(s + char_size(part[s]), len(part))
    if not any(x == e for x, _, _ in out):
        out.append((e, -1, v.unknown_score))
    return out


def lattice(v: Vocabulary, part: bytes) -> tuple[list[float], list[list[tuple[int, int, float]]], list[tuple[int, int]]]:
    """Forward scores, the edges that end at each node (start, id, score), and the best edge to each node (start, id)."""
    n = len(part)
    forward, into, back = [float("-inf")] * (n + 1), [[] for _ in range(n + 1)], [(0, -1)] * (n + 1)
    forward[0] = 0.0
    for s in range(n):
        if forward[s] == float("-inf"):
            continue
        for e, i, score in edges_from(v, part, s):
            into[e].append((s, i, score))
            if forward[s] + score > forward[e]:
                forward[e], back[e] = forward[s] + score, (s, i)
    return forward, into, back


def n_best(v: Vocabulary, part: bytes, n: int) -> list[tuple[float, list[int]]]:
    """The n best segmentations of a part, by A* from its end; the first is the Viterbi path."""
    forward, into, back = lattice(v, part)
    best, at, ids = set(), len(part), []
    while at:
        s, i = back[at]
        best.add((at, s, i))
        ids[:0] = [v.ids_of(i, part[s:at])]
        at = s
    out: list[tuple[float, list[int]]] = [(forward[-1], [x for piece in ids for x in piece])]
    # Scores that agree to 6 places are equal; of equals the one nearest to the start goes first, so a search among very many equals runs straight on.
    heap: list[tuple[float, int, int, int, float, tuple | None]] = [(round(-forward[-1], 6), len(part), 0, 0, 0.0, None)]
    order = 0
    while heap and len(out) < n:
        _, at, off, _, walked, path = heapq.heappop(heap)
        if at == 0:
            if off:  # else it is the Viterbi path
                ids, node = [], path
                while node:
                    s, e, i, node = node
                    ids += v.ids_of(i, part[s:e])
                out.append((walked, ids))
            continue
        for s, i, score in into[at]:
            order += 1
            heapq.heappush(heap, (round(-(walked + score + forward[s]), 6), s, off + ((at, s, i) not in best), order, walked + score, (s, at, i, path)))
    return out


def parts_of(v: Vocabulary, data: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Where the parts of all texts begin."""
    cut = np.zeros(len(data), bool)
    cut[base[:-1][np.diff(base) > 0]] = True
    if v.cuts_at_spaces and len(data):
        space = data == 0x20
        cut[1:] |= space[1:] & ~space[:-1]
    if v.cuts_at_lines and len(data):
        line = data == 0x0A
        cut |= line
        cut[1:] |= line[:-1]
    return np.flatnonzero(cut)


class Parts:
    """Of different parts: their ids one after the other (ids[begin[k]:begin[k + 1]]), best score, and the loss of the second-best path."""

    def __init__(self, ids: np.ndarray, begin: np.ndarray, best: np.ndarray, loss: np.ndarray):
        self.ids, self.begin, self.best, self.loss = ids, begin, best, loss


def solve(v: Vocabulary, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Parts:
    n = len(start)
    best, loss, each = np.zeros(n), np.full(n, np.inf), [np.zeros(0, np.int32)] * n
    for length in np.unique(size):
        rows = np.flatnonzero(size == length)
        if length > LONG_PART:
            for r in rows.tolist():
                got = n_best(v, data[start[r] : start[r] + length].tobytes(), 2)
                best[r], each[r] = got[0][0], np.array(got[0][1], np.int32)
                loss[r] = got[0][0] - got[1][0] if len(got) > 1 else np.inf
            continue
        for a in range(0, len(rows), 16384):
            some = rows[a : a + 16384]
            _solve_equal(v, data[start[some][:, None] + np.arange(length)], some, best, loss, each)
    sizes = np.array([len(x) for x in each], np.int64)
    return Parts(np.concatenate(each) if n else np.zeros(0, np.int32), np.r_[0, np.cumsum(sizes)], best, loss)


def _solve_equal(v: Vocabulary, x: np.ndarray, rows: np.ndarray, best: np.ndarray, loss: np.ndarray, each: list[np.ndarray]) -> None:
    """Parts of one length: forward and backward scores, the best path, and the best path that leaves it."""
    m, n = x.shape
    hashed = tk.BYTES[x]
    forward = np.full((n + 1, m), -np.inf)
    forward[0] = 0
    back_at, back_id = np.zeros((n + 1, m), np.int32), np.full((n + 1, m), -1, np.int32)
    chars = np.where(x < 0xC0, 1, np.where(x < 0xE0, 2, np.where(x < 0xF0, 3, 4)))
    edges: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
    for s in range(n):
        live = np.flatnonzero(forward[s] > -np.inf)
        if not len(live):
            continue
        h = np.zeros(len(live), np.uint64)
        single = np.minimum(chars[live, s], n - s)
        bare = np.ones(len(live), bool)
        for e in range(s + 1, min(n, s + v.longest) + 1):
            h = (h + hashed[live, e - 1]) * _STEP
            ids = v.find(h)
            hit = ids >= 0
            bare &= ~(hit & (single == e - s))
            if hit.any():
                edges.append((s, e, live[hit], ids[hit], v.score[ids[hit]]))
        for k in np.unique(single[bare]):
            some = live[bare & (single == k)]
            edges.append((s, s + int(k), some, np.full(len(some), -1, np.int32), np.full(len(some), v.unknown_score)))
        for _, e, some, ids, score in (z for z in reversed_from(edges, s)):
            total = forward[s, some] + score
            up = total > forward[e, some]
            forward[e, some[up]], back_at[e, some[up]], back_id[e, some[up]] = total[up], s, ids[up]
    backward = np.full((n + 1, m), -np.inf)
    backward[n] = 0
    for s, e, some, _, score in reversed(edges):
        backward[s, some] = np.maximum(backward[s, some], score + backward[e, some])
    on = np.zeros((n + 1, m), bool)
    on[n] = True
    for e in range(n, 0, -1):
        some = np.flatnonzero(on[e])
        on[back_at[e, some], some] = True
    other = np.full(m, -np.inf)
    for s, e, some, ids, score in edges:
        off = ~(on[e, some] & (back_at[e, some] == s) & (back_id[e, some] == ids))
        some = some[off]
        other[some] = np.maximum(other[some], forward[s, some] + score[off] + backward[e, some])
    best[rows], loss[rows] = forward[n], np.maximum(forward[n] - other, 0)
    # the path's ids, in order of part and place; a character without a piece gives its bytes
    ends, part = np.nonzero(on[1:])
    ends += 1
    order = np.lexsort([ends, part])
    ends, part = ends[order], part[order]
    ids, begin = back_id[ends, part], back_at[ends, part]
    plain = ids >= 0
    width = np.where(plain, 1, ends - begin if v.bytes_known else 1)
    flat = np.repeat(ids, width)
    step = np.arange(len(flat)) - np.repeat(np.cumsum(width) - width, width)
    lost = np.flatnonzero(flat < 0)
    if len(lost):
        where = np.repeat(np.arange(len(ids)), width)[lost]
        flat[lost] = v.byte_ids[x[part[where], begin[where] + step[lost]]] if v.bytes_known else v.unknown
    cut = np.searchsorted(np.repeat(part, width), np.arange(m + 1))
    for k, r in enumerate(rows.tolist()):
        each[r] = flat[cut[k] : cut[k + 1]]


def reversed_from(edges: list, s: int) -> list:
    """The edges that begin at s, in the order in which they were found."""
    k = len(edges)
    while k and edges[k - 1][0] == s:
        k -= 1
    return edges[k:]


class Encoded:
    """The segmentations of the texts of a slice."""

    def __init__(self, v: Vocabulary, data: np.ndarray, offs: np.ndarray, n: int):
        base = offs - offs[0]
        data = data[offs[0] : offs[-1]]
        self.v, self.n = v, n
        if v.prefix:
            some = np.flatnonzero(np.diff(base) > 0)
            data = np.insert(data, base[some], 0x20)
            extra = np.zeros(len(base), np.int64)
            extra[some + 1] = 1
            base = base + np.cumsum(extra)
        self.data, self.base = data, base
        start = parts_of(v, data, base)
        end = np.r_[start[1:], len(data)] if len(start) else start
        size = end - start
        self.text = np.searchsorted(base, start, "right") - 1
        h = np.zeros(len(start), np.uint64)
        for i in range(0, len(start), HASHED):  # some parts at a time, as each byte takes 48 in between
            some, sizes = start[i : i + HASHED] - start[i], size[i : i + HASHED]
            at = np.arange(sizes.sum()) - np.repeat(some, sizes)
            h[i : i + HASHED] = np.add.reduceat(tk.BYTES[data[start[i] : start[i] + len(at)]] * tk.powers(int(sizes.max()) + 1)[at], some)
        h = tk.mix(h + size.astype(np.uint64))
        _, first, self.which = np.unique(h, return_index=True, return_inverse=True)
        self.start, self.size, self.first = start, size, first
        self.parts = solve(v, data, start[first], size[first])
        count = np.diff(self.parts.begin)[self.which]
        self.ids = self.parts.ids[np.repeat(self.parts.begin[:-1][self.which] - np.r_[0, np.cumsum(count)[:-1]] if len(count) else count, count) + np.arange(count.sum())]
        self.part_ids = np.r_[0, np.cumsum(count)]
        self.cut = np.searchsorted(self.text, np.arange(len(base)))
        self.id_cut = self.part_ids[self.cut]

    def decoded(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the best segmentations stand for, and where each text begins."""
        return decode_ids(self.v, self.ids, self.id_cut)

    def lossless(self) -> np.ndarray:
        back, cut = self.decoded()
        n = len(self.base) - 1
        if len(back) != len(self.data) or (cut != self.base).any():
            return np.array([np.array_equal(back[cut[i] : cut[i + 1]], self.data[self.base[i] : self.base[i + 1]]) for i in range(n)], bool)
        return tk.sums(back != self.data, self.base) == 0

    def alternatives(self, t: int) -> list[tuple[float, list[tuple[int, Sequence[int]]]]]:
        """The n best segmentations of text t: score, and which parts are other than in the best one (number in the text, ids)."""
        a, b = int(self.cut[t]), int(self.cut[t + 1])
        which = self.which[a:b]
        total = float(self.parts.best[which].sum())
        if a == b or self.n == 1:
            return [(total, [])]
        loss = self.parts.loss[which]
        k = min(self.n - 1, len(loss))
        near = np.argpartition(loss, k - 1)[:k] if k < len(loss) else np.arange(len(loss))
        bound = loss[near].max()
        near = np.flatnonzero(loss <= bound)
        near = near[np.lexsort([near, loss[near]])][:k]
        near = near[np.isfinite(loss[near])]
        lists = []
        for i in near.tolist():
            p = a + i
            raw = self.data[self.start[p] : self.start[p] + self.size[p]].tobytes()
            lists.append(remembered(self.v, raw, self.n))
        heap = [(0.0, (0,) * len(lists))]
        seen, out = {heap[0][1]}, []
        while heap and len(out) < self.n:
            lost, ranks = heapq.heappop(heap)
            out.append((total - lost, [(int(near[j]), lists[j][r][1]) for j, r in enumerate(ranks) if r]))
            for j, r in enumerate(ranks):
                if r + 1 < len(lists[j]):
                    new = (*ranks[:j], r + 1, *ranks[j + 1 :])
                    if new not in seen:
                        seen.add(new)
                        heapq.heappush(heap, (sum(lists[q][0][0] - lists[q][x][0] for q, x in enumerate(new)), new))
        return out

    def replaced(self, t: int, changes: list[tuple[int, Sequence[int]]]) -> np.ndarray:
        """The ids of text t with some parts' ids replaced."""
        a, at, out = int(self.cut[t]), int(self.id_cut[t]), []
        for i, ids in sorted(changes):
            out += [self.ids[at : self.part_ids[a + i]], np.array(ids, np.int32)]
            at = int(self.part_ids[a + i + 1])
        return np.concatenate([*out, self.ids[at : self.id_cut[t + 1]]])


@lru_cache(1 << 15)
def _remembered(v: Vocabulary, part: bytes, n: int) -> list[tuple[float, Sequence[int]]]:
    """Short parts' segmentations, as arrays: a worker keeps them, so their size counts."""
    return [(score, array("i", ids)) for score, ids in n_best(v, part, n)]


def remembered(v: Vocabulary, part: bytes, n: int) -> list[tuple[float, Sequence[int]]]:
    return _remembered(v, part, n) if len(part) <= LONG_PART else n_best(v, part, n)


def decode_ids(v: Vocabulary, ids: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of runs of ids (the space in front included), and where each run's begin."""
    size = v.size[ids]
    ahead = np.r_[0, np.cumsum(size)]
    at = np.repeat(v.at[ids] - ahead[:-1], size) + np.arange(ahead[-1])
    return v.all_bytes[at], ahead[cut]


def encode(docs: DataFrame, model_path: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", scoring: str = "auto") -> DataFrame:
    """Per row: the id, and ``segmentations``: the n best, each with its score and ids."""

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model_path, scoring)
        for b in batches:
            data, offs = tk.texts(b.column(1))
            for i, j in tk.slices(offs, SLICE):
                e = Encoded(v, data, offs[i : j + 1], n)
                rows = [[{"score": s, "ids": e.replaced(t, c)} for s, c in e.alternatives(t)] for t in range(j - i)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(rows, pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))])))], [id_col, "segmentations"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, segmentations array<struct<score: double, ids: array<int>>>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids", scoring: str = "auto") -> DataFrame:
    """Per row: the id and the text that the ids stand for (null for null)."""

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model_path, scoring)
        for b in batches:
            out = []
            for x in b.column(1):
                if not x.is_valid:
                    out.append(None)
                    continue
                ids = np.array(x.as_py(), np.int64)
                back, _ = decode_ids(v, ids, np.array([0, len(ids)]))
                raw = back.tobytes()
                out.append((raw[1:] if v.prefix and raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [id_col, "text"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, F.col(ids_col).cast("array<int>").alias("__ids")).mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(docs: DataFrame, model_path: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", scoring: str = "auto") -> DataFrame:
    """Per row: the id, n_pieces and ids_sha256 (of little-endian 32-bit ids) of the best segmentation, lossless (whether decoding it gives the text back), and nbest: for each of the n best
    its score to 6 places, and each part that differs from the best one's as part:id.id..."""

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model_path, scoring)
        for b in batches:
            data, offs = tk.texts(b.column(1))
            for i, j in tk.slices(offs, SLICE):
                e = Encoded(v, data, offs[i : j + 1], n)
                raw = e.ids.astype("<i4")
                sha = [hashlib.sha256(raw[e.id_cut[t] : e.id_cut[t + 1]].tobytes()).hexdigest() for t in range(j - i)]
                best = [";".join(" ".join([f"{s:.6f}", *(f"{p}:{'.'.join(map(str, ids))}" for p, ids in sorted(c))]) for s, c in e.alternatives(t)) for t in range(j - i)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.diff(e.id_cut)), pa.array(sha), pa.array(e.lossless()), pa.array(best)], [id_col, "n_pieces", "ids_sha256", "lossless", "nbest"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, n_pieces bigint, ids_sha256 string, lossless boolean, nbest string")
