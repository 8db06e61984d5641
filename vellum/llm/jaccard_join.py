"""Similarity join of texts on their word n-grams by chosen paths, and the classes of near copies that it makes.

A text's set is that of the hashes of its runs of five words (a text of one to four words has one element: all of them). In each of a number of
runs a set follows random paths: at a node it selects those of its elements whose hash, seeded with the path so far, is under a threshold of 1 / (similarity x
size), and goes on from each of them. Two similar sets select the same element with fair probability, so they meet at the end of a path; two others seldom do. Selection
depends on nothing but the set and the path, so each set walks the first DEPTH steps of its paths alone, without a shuffle. The number of runs is
what the target recall takes, given the chance that a pair just at the threshold shares a path in one run.

Sets at the end of one path are a bucket. Buckets of more than BUCKET sets are split on (``deepened``): each set goes on from such a node by tokens sampled from its
sketch, 64 bytes of minima, until its bucket is small; sets that agree with one drawn member almost wholly are linked with it and go no further, so groups of near copies don't
stay together for ever. Small buckets are searched by brute force on the sketches: sets whose sketches agree well enough are linked. The
linked sets' components are small, and their true sets are then compared pair by pair, exactly; a component above a fixed size is compared in blocks,
each pair of blocks in a task of its own. Nowhere is a row made for a pair: tasks give each set's number of links, and a star for each class.

Equal sets are one set from the start, by a hash of the set, so groups of copies never meet in a bucket.

Defined results: a text that is null or has no word has no set, no link and a class of its own; copies count as links of each other. A class's id is the smallest id in it
(nulls aside). Texts are read whole. Repeated rows are copies; ``one_of_each`` keeps one of them. An empty table gives an empty result. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .components import components
from .scratch import K1, K2, join_evenly, row_key, save
from .streams import grouped, thrifty

WORDS, SIMILARITY, RECALL, DEPTH, BLOCK = 5, "0.8", 0.99999, 3, 1024
#: Sketches of pairs at similarity 0.8 agree in fewer than this many of 64 places less than once in a million times (binomial: 3.2e-7).
SKETCH, AGREE = 64, 34
#: Larger buckets are split on, in so many steps at most; then what is left is searched as it is.
BUCKET, LEVELS = 2048, 12
#: Places in which a set that leaves a large bucket agrees with its drawn member. If x leaves and y doesn't even agree in AGREE places with that member, x and y agree in fewer than 48.
STRONG = 50
#: The chance that a pair at the threshold is still together where a large bucket ends: it has 3 children, then 1.6 in the mean, 0.8 of them common (the fixed point is 0.73).
KEPT = 0.92
_rng = np.random.default_rng(0xC0FFEE)
_SKETCH_A = _rng.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SKETCH_B = _rng.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32)


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, even if each bucket it meets in is split on. Such a pair selects one common element per node in the mean."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    p *= KEPT
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def sets(data: np.ndarray, offs: np.ndarray, k: int = WORDS) -> list[np.ndarray]:
    """For each text its set of shingle hashes, sorted."""
    n = len(offs) - 1
    w = tk.tokens(data[offs[0] : offs[-1]], offs)
    h, at = tk.windows(w.hash, w.text, k)
    cut = np.searchsorted(w.text[at], np.arange(n + 1)) if len(at) else np.zeros(n + 1, np.int64)
    out = [np.unique(h[cut[i] : cut[i + 1]]) for i in range(n)]
    begin = np.searchsorted(w.text, np.arange(n + 1))
    for i in np.flatnonzero((np.diff(begin) > 0) & (np.diff(begin) < k)):
        words = w.hash[begin[i] : begin[i + 1]]
        short, _ = tk.windows(words, np.zeros(len(words), np.int64), len(words))
        out[i] = short + np.uint64(len(words))
    return out


def paths(s: np.ndarray, runs: int, depth: int, similarity: float) -> np.ndarray:
    """The keys of all paths of set ``s``."""
    small = (s >> np.uint64(32)).astype(np.uint32)
    bound = np.uint32(min(2**32 - 1, int(2**32 / (similarity * len(s)))))
    nodes = tk.mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = max(1, (1 << 21) // len(s))
    for _ in range(depth):
        grown = []
        for i in range(0, len(nodes), step):
            part = nodes[i : i + step]
            a, b = part.astype(np.uint32) | np.uint32(1), (part >> np.uint64(32)).astype(np.uint32)
            v = small[None, :] * a[:, None]
            v += b[:, None]
            node, element = np.nonzero(v <= bound)
            grown.append(tk.mix(part[node] + s[element] * np.uint64(0xD6E8FEB86659FD93)))
        nodes = np.concatenate(grown) if grown else nodes
    return np.unique(nodes)


def sketch(s: np.ndarray) -> np.ndarray:
    """64 bytes, each from the least element under another order."""
    small, out = (s & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(small), 1 << 14):
        out = np.minimum(out, (small[None, i : i + (1 << 14)] * _SKETCH_A[:, None] + _SKETCH_B[:, None]).min(1))
    return ((out * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def stars(near, n: int) -> list[int]:
    """For each of n members its component's first member; near(i, rest): which of ``rest`` (an index array) are linked with i. Members that are reached
    aren't compared with each other."""
    root, rest = [-1] * n, np.arange(n)
    while len(rest):
        first = int(rest[0])
        root[first], queue, rest = first, [first], rest[1:]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            for i in rest[hit].tolist():
                root[i] = first
                queue.append(i)
            rest = rest[~hit]
    return root


def links_within(elements: list[np.ndarray], cross: np.ndarray | None, similarity: Fraction) -> np.ndarray:
    """The matrix of links between sets. cross: the side of each set, if only sets of different sides are asked for."""
    n, size = len(elements), np.array([len(s) for s in elements], np.int64)
    _, inverse, count = np.unique(np.concatenate(elements), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = count[inverse] > 1
    column = np.cumsum(count > 1) - 1
    owner, column = owner[shared], column[inverse[shared]]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    slab, width = max(256, (1 << 23) // max(n, 1)), int((count > 1).sum())
    for a in range(0, width, slab):
        x, y = np.searchsorted(column, [a, a + slab])
        m = np.zeros((n, min(slab, width - a)), np.float32)
        m[owner[x:y], column[x:y] - a] = 1
        both += m @ m.T
    p, q = similarity.numerator, similarity.denominator
    out = np.rint(both).astype(np.int64) * (p + q) >= p * (size[:, None] + size[None, :])
    np.fill_diagonal(out, False)
    if cross is not None:
        out &= cross[:, None] != cross[None, :]
    return out


def agreement(sketch_: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """In how many places sketches agree; 0 for sets whose sizes differ too much to be similar."""
    return np.where(np.minimum(m, n) >= similarity * np.maximum(m, n) - 1e-9, (sketch_ == other).sum(1), 0)


def children(key: np.ndarray, used: np.ndarray, sketch_: np.ndarray, level: int) -> tuple[np.ndarray, ...]:
    """For each row the nodes that it goes on to, the places used on the way there (a bit each), and which row each is of. A node samples places that its path hasn't used; a row goes on by the
    bytes that its sketch has there."""
    h = tk.mix(key.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    count = np.full(len(key), 3) if level == 0 else 1 + ((h >> np.uint64(32)) % np.uint64(5) < 3)
    row = np.repeat(np.arange(len(key)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    bits, place = used.view(np.uint64)[row], ((h[row] & np.uint64(63)).astype(np.int64) + 23 * nth) % SKETCH
    while (taken := (bits >> place.astype(np.uint64)) & np.uint64(1) > 0).any():
        place[taken] = (place[taken] + 5) % SKETCH
    token = (place * 256 + sketch_[row, place]).astype(np.uint64)
    return tk.mix(h[row] + (token + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64), (bits | np.uint64(1) << place.astype(np.uint64)).view(np.int64), row


def deepened(spark: SparkSession, hot: DataFrame, similarity: float, bucket: int, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Of the members of large buckets (key, sid, n, sketch): the members of small ones that they are split into, and links (a, b). A large bucket is never gathered:
    one of its members, drawn by a hash, is sent to the others."""

    def split(level: int):
        @thrifty
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                key, sid, n, used, lead, lead_n = (b.column(c).to_numpy() for c in (0, 1, 2, 4, 5, 6))
                sk, lead_sk = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in (3, 7))
                agree = agreement(sk, lead_sk, n, lead_n, similarity)
                linked = np.flatnonzero((agree >= AGREE) & (sid != lead))
                stay = np.flatnonzero((agree < STRONG) & (sid != lead))
                node, bits, row = children(key[stay], used[stay], sk[stay], level)
                at = pa.array(stay[row])
                none = pa.nulls(len(linked), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(sid[linked]), none, pa.nulls(len(linked), pa.binary()), none, pa.array(lead[linked])], names)
                yield pa.RecordBatch.from_arrays([pa.array(node), b.column(1).take(at), b.column(2).take(at), b.column(3).take(at), pa.array(bits), pa.nulls(len(node), pa.int64())], names)

        return run

    names = ["key", "sid", "n", "sketch", "used", "lead"]
    small, links, hot = [], [], hot.withColumn("used", F.lit(0).cast("bigint"))
    for level in range(levels):
        drawn = hot.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min_by(F.struct("sid", "n", "sketch"), F.xxhash64("key", "sid")).alias("d"))
        drawn = save(spark, drawn.select("key", "m", F.col("d.sid").alias("lead"), F.col("d.n").alias("lead_n"), F.col("d.sketch").alias("lead_sketch")), "drawn")
        both = join_evenly(hot, drawn, ["key"], "m").select("key", "sid", "n", "sketch", "used", "lead", "lead_n", "lead_sketch")
        out = save(spark, both.mapInArrow(split(level), "key bigint, sid bigint, n bigint, sketch binary, used bigint, lead bigint"), "level")
        links.append(out.where("lead is not null").select(F.col("sid").alias("a"), F.col("lead").alias("b")))
        nodes = out.where("key is not null").drop("lead")
        sizes = save(spark, nodes.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "sizes")
        small.append(nodes.join(sizes.where(F.col("m") <= bucket).select("key"), "key").drop("used"))
        large = sizes.where(F.col("m") > bucket)
        if large.isEmpty():
            break
        hot = save(spark, join_evenly(nodes, large, ["key"], "m"), "hot")
    else:
        small.append(hot.drop("used"))
    return reduce(DataFrame.unionByName, small), reduce(DataFrame.unionByName, links)


def join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: str = SIMILARITY, recall: float = RECALL, depth: int = DEPTH, words: int = WORDS, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """Per row of ``docs``: the row's key (two columns), the id, class_id, n_links (other rows that are similar enough, copies too),
    n_shingles and first (whether the row is its class's representative, the one with the smallest id; rows alike in id and text all are)."""
    sim, runs = Fraction(similarity), runs_for(recall, depth)
    text = F.col(text_col).cast("string")
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), *row_key(F.col(id_col), text), text.alias("text"))

    @thrifty
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = tk.texts(b.column(3))
            for i, j in tk.slices(offs):
                got = sets(data, offs[i : j + 1], words)
                some = [len(s) > 0 for s in got]
                sig = [xxhash.xxh3_128_digest(s.tobytes()) if ok else None for s, ok in zip(got, some, strict=True)]
                keys = [paths(s, runs, depth, float(sim)).view(np.int64) if ok else None for s, ok in zip(got, some, strict=True)]
                sk = [sketch(s).tobytes() if ok else None for s, ok in zip(got, some, strict=True)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in range(3)), pa.array(sig, pa.binary()), pa.array([len(s) for s in got], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sk, pa.binary())], ["id", K1, K2, "sig", "n", "keys", "sketch"])

    each = save(spark, rows.mapInArrow(walk, f"id {kind}, {K1} bigint, {K2} bigint, sig binary, n bigint, keys array<bigint>, sketch binary"), "sets")
    distinct = each.where("sig is not null").groupBy("sig").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", K1, K2)).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    distinct = save(spark, distinct.withColumn("sid", F.xxhash64("sig")), "distinct")

    thin = distinct.select("sid", F.explode("keys").alias("key"))
    # written first: a join straight from an aggregate keeps its partitions, and a key that very many sets share couldn't be split
    meet = save(spark, thin.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "keys")

    def members(keys: DataFrame) -> DataFrame:
        return thin.join(keys.select("key"), "key").join(distinct.select("sid", "n", "sketch"), "sid").select("key", "sid", "n", "sketch")

    large = meet.where(F.col("m") > bucket)
    met, more = members(meet), None
    if not large.isEmpty():
        deep, more = deepened(spark, save(spark, members(large), "hot"), float(sim), bucket)
        met = members(meet.where(F.col("m") <= bucket)).unionByName(deep)

    @thrifty
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, cut in grouped(batches, "key"):
            sid, n = b.column(1).to_numpy(), b.column(2).to_numpy()
            sk = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, SKETCH)
            out: list[tuple[int, int]] = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):

                def near(i: int, rest: np.ndarray, x: int = x) -> np.ndarray:
                    return agreement(sk[x + rest], sk[x + i], n[x + rest], n[x + i], float(sim)) >= AGREE

                out += [(int(sid[x + i]), int(sid[x + r])) for i, r in enumerate(stars(near, y - x)) if r != i]
            cols = list(zip(*set(out), strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    found = met.repartition("key").sortWithinPartitions("key").mapInArrow(search, "a bigint, b bigint")
    found = found if more is None else found.unionByName(more)
    near = components(spark, found, "a", "b")

    some = distinct.join(near, distinct["sid"] == near["node"]).select("root", "sig", "times", F.col(f"rep.{K1}").alias(K1), F.col(f"rep.{K2}").alias(K2))
    some = save(spark, some, "candidates")
    sizes = some.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    some = some.join(sizes, "root").withColumn("side", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    some = some.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    some = some.withColumn("cell", F.xxhash64("root", F.least("side", "other"), F.greatest("side", "other"))).withColumn("own", (F.col("side") == F.col("other")))
    # in the cell of a block with itself every pair counts, in others only pairs across
    # merged at every size: the candidates grow with the input, and so does what this join moves
    some = some.hint("merge").join(rows.select(K1, K2, "text"), [K1, K2]).select("cell", "sig", "times", F.when(F.col("own"), F.lit(-1)).otherwise(F.col("side")).alias("side"), "text")

    @thrifty
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, cut in grouped(batches, "cell"):
            sig, times, side = b.column(1).to_pylist(), b.column(2).to_numpy(), b.column(3).to_numpy()
            out: list[tuple[bytes, int, bytes]] = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                one = {sig[i]: i for i in range(x, y)}  # repeated rows give their set more than once
                at = np.array([one[s] for s in sorted(one)])
                if len(at) < 2:
                    continue
                data, offs = tk.texts(pa.array([b.column(4)[int(i)].as_py() for i in at], pa.string()))
                elements = [s for i, j in tk.slices(offs) for s in sets(data, offs[i : j + 1], words)]
                link = links_within(elements, side[at] if (side[at] >= 0).any() else None, sim)
                root = stars(lambda i, rest, link=link: link[i, rest], len(at))
                weight = link @ times[at]
                out += [(sig[at[i]], int(weight[i]), sig[at[root[i]]]) for i in range(len(at)) if weight[i]]
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["sig", "links", "root"])

    true = save(spark, some.repartition("cell").sortWithinPartitions("cell").mapInArrow(verify, "sig binary, links bigint, root binary"), "links")
    degree = true.groupBy("sig").agg(F.sum("links").alias("links"))
    root = components(spark, true, "sig", "root").withColumnRenamed("node", "sig")
    grade = distinct.select("sig", "times", "rep").join(degree, "sig", "left").join(root, "sig", "left")
    grade = grade.select("sig", F.coalesce("root", "sig").alias("root"), (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "rep")
    grade = save(spark, grade, "grades")
    heads = grade.groupBy("root").agg(F.min("rep").alias("head"))
    grade = grade.select("sig", "root", "n_links").join(heads, "root").select("sig", "n_links", "head")
    with_words = each.where("sig is not null").select("id", K1, K2, "sig", "n").join(grade, "sig")
    with_words = with_words.select(K1, K2, F.col("id").alias(id_col), F.col("head.id").alias("class_id"), "n_links", F.col("n").alias("n_shingles"), ((F.col(K1) == F.col(f"head.{K1}")) & (F.col(K2) == F.col(f"head.{K2}"))).alias("first"))
    alone = each.where("sig is null").select(K1, K2, F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("n").alias("n_shingles"), F.lit(True).alias("first"))
    return with_words.unionByName(alone)


def one_of_each(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their class: one for each class. Rows without words all stay."""
    text = F.col(text_col).cast("string")
    first = join(spark, docs, id_col, text_col, **options).where("first").groupBy(K1, K2).agg(F.max("n_shingles").alias("n"))
    # within a struct, so that no name of the caller's clashes
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(F.col(id_col), text)).join(first, [K1, K2])
    spoken = keyed.where("n > 0").dropDuplicates([K1, K2]).select("row.*")
    return spoken.unionByName(keyed.where("n = 0").select("row.*"))


#: All pairs of different rows that share a shingle, and what can be reached over links.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY ALL) JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE 9 * c >= 4 * (p.n + q.n)),
h AS (SELECT r AS a, r AS b FROM d UNION SELECT h.a, l.b FROM h JOIN l ON h.b = l.a),
m AS (SELECT h.a AS r, min(d.doc_id) AS class_id FROM h JOIN d ON h.b = d.r GROUP BY h.a)
SELECT doc_id, class_id, (SELECT count(*) FROM l WHERE l.a = d.r) AS n_links, coalesce((SELECT n FROM n WHERE n.r = d.r), 0) AS n_shingles FROM d JOIN m ON d.r = m.r
"""
