"""Jaccard join and removal of repeated strings against brute force."""

import math
import random

import numpy as np
import pytest
from fixtures_llm import covered, edge_texts, frame, near_classes, near_texts, words
from pyspark.sql import functions as F

from vellum.llm import jaccard_join as jj
from vellum.llm import suffix_dedup as sd
from vellum.llm.components import components


@pytest.mark.parametrize(("block", "bucket"), [(1024, 2048), (16, 2048), (1024, 3)])
def test_join_is_what_all_pairs_give(spark, block, bucket):
    texts = near_texts()
    texts += [*edge_texts(), texts[5], texts[5]]
    ids = [*range(len(texts) - 2), 5, 7000]
    got = sorted(tuple(r) for r in jj.join(spark, frame(spark, texts, ids), block=block, bucket=bucket).select("doc_id", "class_id", "n_links", "n_shingles").collect())
    assert got == sorted(near_classes(list(zip(ids, texts, strict=True))))


def test_one_of_each(spark):
    texts = near_texts(4)[:60] + [None, None, ""]
    docs = frame(spark, texts)
    kept = jj.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _, _ in near_classes(list(enumerate(texts)))})


def test_join_of_nothing(spark):
    assert jj.join(spark, frame(spark, ["a"]).limit(0)).count() == 0


def test_recall_of_paths():
    rng, met, n = random.Random(1), 0, 300
    runs = jj.runs_for(0.99, 3)
    for _ in range(n):
        a = np.array(rng.sample(range(1, 1 << 62), 100), np.uint64)
        b = np.r_[a[:89], np.array(rng.sample(range(1, 1 << 62), 11), np.uint64)]
        met += len(np.intersect1d(jj.paths(np.sort(a), runs, 3, 0.8), jj.paths(np.sort(b), runs, 3, 0.8))) > 0
    assert met >= 0.98 * n


def sharing(rng, n, shared, own):
    """Sets that have a passage in common, every tenth of them with a partner that is just similar enough."""
    passage = rng.sample(range(1, 1 << 62), shared)
    out, pairs = [], []
    for i in range(n):
        mine = passage + rng.sample(range(1, 1 << 62), own)
        out.append(mine)
        if i % 10 == 0:
            size = len(mine)
            rest = mine[: -(size // 9)]
            pairs.append((len(out) - 1, len(out)))
            out.append(rest + rng.sample(range(1, 1 << 62), size - len(rest)))
    return [np.unique(np.array(x, np.uint64)) for x in out], pairs


def test_large_buckets_are_split_and_pairs_within_are_kept(spark):
    """1,100 sets of 96 with a passage of 46 in common meet in large buckets. All end in small ones, and pairs that were together mostly still are, as KEPT says."""
    sets, pairs = sharing(random.Random(4), 1000, 46, 50)
    sk = [jj.sketch(s).tobytes() for s in sets]
    rows = [(r, i, len(s), bytearray(k)) for r in range(6) for i, (s, k) in enumerate(zip(sets, sk, strict=True))]
    hot = spark.createDataFrame(rows, "key long, sid long, n long, sketch binary")
    small, links = jj.deepened(spark, hot, 0.8, 64)
    members = {}
    for r in small.collect():
        members.setdefault(r.key, set()).add(r.sid)
    assert max(map(len, members.values())) <= 64 and sum(map(len, members.values())) < 8 * len(rows)
    linked = {frozenset((r.a, r.b)) for r in links.collect()}
    met = [any(a in m and b in m for m in members.values()) or frozenset((a, b)) in linked for a, b in pairs]
    assert sum(met) == len(pairs)  # of six buckets one at least


def test_near_copies_leave_large_buckets(spark):
    rng = random.Random(5)
    base = rng.sample(range(1, 1 << 62), 200)
    sets = [np.unique(np.array(base[:190] + rng.sample(range(1, 1 << 62), 10), np.uint64)) for _ in range(1500)]
    hot = spark.createDataFrame([(1, i, len(s), bytearray(jj.sketch(s).tobytes())) for i, s in enumerate(sets)], "key long, sid long, n long, sketch binary")
    small, links = jj.deepened(spark, hot, 0.8, 64)
    assert small.count() < 100 and len({r.a for r in links.collect()}) > 1400


def test_measured_recall(spark):
    """Of pairs just at the threshold, in texts that share a passage, nine of ten at least are found; here all of them."""
    rng, texts, pairs = random.Random(6), [], []
    passage = [f"p{i}" for i in range(50)]
    for i in range(400):
        own = [f"w{rng.randrange(1 << 40)}" for _ in range(70)]
        texts.append(" ".join(passage + own))
        if i % 4 == 0:
            own[-12:] = [f"w{rng.randrange(1 << 40)}" for _ in range(12)]
            pairs.append((len(texts) - 1, len(texts)))
            texts.append(" ".join(passage + own))
    want = near_classes(list(enumerate(texts)))
    for bucket in (jj.BUCKET, 100):
        got = {r.doc_id: r.n_links for r in jj.join(spark, frame(spark, texts), bucket=bucket).collect()}
        assert sum(got.values()) >= 0.9 * sum(n for _, _, n, _ in want) and sum(n for _, _, n, _ in want) >= 2 * len(pairs)
        assert got == {i: n for i, _, n, _ in want}


def test_sketches_miss_less_than_one_in_a_million():
    assert sum(math.comb(jj.SKETCH, k) * 0.8**k * 0.2 ** (jj.SKETCH - k) for k in range(jj.AGREE)) < 1e-6


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(400, 400)]
    root = {}
    changed = True
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    alone = {a for a in root if not any(a in e and e[0] != e[1] for e in edges)}
    assert got == {k: v for k, v in root.items() if k not in alone}


@pytest.mark.parametrize(("window", "gram", "crowd"), [(40, 8, 4096), (400, 128, 4096), (40, 8, 1), (400, 128, 1), (200, 16, 3)])
def test_repeated_strings_are_what_all_windows_give(spark, window, gram, crowd):
    rng, texts = random.Random(1), []
    passages = [" ".join(words(rng, window // 2)) for _ in range(6)]
    for _ in range(80):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            parts.append(p[rng.randint(0, len(p) // 3) : len(p) - rng.randint(0, len(p) // 3)] if rng.random() < 0.5 else " ".join(words(rng, rng.randint(1, window // 3))))
        texts.append("".join(parts))
        if rng.random() < 0.2 and texts[-1]:
            t = rng.choice(texts)
            texts.append(t[: len(t) // 2] + "X" + t[len(t) // 2 + 1 :])
    texts += [*edge_texts(), texts[0], "ab" * window]
    ids = [*range(len(texts) - 1), 0]
    got = sorted(map(tuple, sd.dedup(spark, frame(spark, texts, ids), window=window, gram=gram, crowd=crowd).collect()))
    assert got == sorted((i, *e) for i, e in zip(ids, covered(texts, window), strict=True))


def test_pieces_of_long_texts_agree(spark, monkeypatch):
    rng = random.Random(9)
    p = " ".join(words(rng, 300))
    texts = [p + " ".join(words(rng, 3000)) + p, " ".join(words(rng, 500)) + p[:700], "z" * 5000]
    from vellum.llm import textkit as tk

    data, offs = tk.texts(__import__("pyarrow").array(texts))
    monkeypatch.setattr(sd, "_PIECE", 100)
    seen = []
    for which, bounds, ahead in sd.pieces(offs, 400):
        part = data[bounds[0] : bounds[-1]]
        t, first, last, *_ = sd.anchors(part, bounds - bounds[0], 400, 128)
        for a, x, y in zip(t, first, last, strict=True):
            seen += [(int(which[a]), int(ahead[a] + q - (bounds - bounds[0])[a])) for q in range(x, y + 1)]
    assert sorted(seen) == [(i, q) for i, t in enumerate(texts) for q in range(len(t.encode()) - 399)]


def test_suffix_order():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    order, common = sd.suffix_array(strings)
    got = [strings[i] for i in order]
    assert got == sorted(strings)
    assert common.tolist() == [sd.common_prefix(a, b) for a, b in zip(got, got[1:], strict=False)]


@pytest.mark.parametrize("few", [0, 64])
@pytest.mark.parametrize("n", [2, 3, 7, 30])
def test_covers_of_a_gram_are_compared_alike_in_either_way(monkeypatch, few, n):
    monkeypatch.setattr(sd, "FEW", few)
    rng = np.random.default_rng(n)
    for _ in range(20):
        low, window = rng.integers(0, 8, n), 24
        high = low + rng.integers(0, 8, n)
        fronts = [bytes(rng.choice([97, 98], h, p=[0.9, 0.1]).astype(np.uint8)) for h in high]
        suffixes = [b"gram" + bytes(rng.choice([97, 98], window - 4 - x, p=[0.9, 0.1]).astype(np.uint8)) for x in low]
        strings = [{q: f[:q] + b"|" + s[: window - q] for q in range(x, y + 1)} for f, s, x, y in zip(fronts, suffixes, low, high, strict=True)]
        want = [{q for q in mine if any(other.get(q) == mine[q] for k, other in enumerate(strings) if k != i)} for i, mine in enumerate(strings)]
        got = sd.repeats(suffixes, fronts, low, high, np.ones(n, np.int64), window)
        assert [{q for a, b in r for q in range(a, b + 1)} for r in got] == want
        assert all(b < c for r in got for (_, b), (c, _) in zip(r, r[1:], strict=False))


def test_more_suffixes_get_more_buckets_and_no_larger_ones(spark):
    def sizes(n):
        rows = spark.range(n).select(F.concat(F.sha2(F.floor(F.col("id") / 3).cast("string"), 256), F.col("id").cast("string")).cast("binary").alias("suffix"))
        found = sd.in_buckets(rows, 64, 100).select(F.spark_partition_id().alias("p"), F.substring("suffix", 1, 64).alias("head"), "suffix").collect()
        parts = {}
        for r in found:
            parts.setdefault(r.p, []).append(bytes(r.suffix))
        assert sorted(x for p in parts.values() for x in p) == sorted(bytes(r.suffix) for r in rows.collect())
        assert all([x[:64] for x in p] == sorted(x[:64] for x in p) for p in parts.values())
        assert len({(r.p, bytes(r.head)) for r in found}) == len({bytes(r.head) for r in found})
        return sorted(map(len, parts.values()))

    small, large = sizes(900), sizes(9000)
    assert len(large) > 5 * len(small)
    assert large[-1] < 300


def test_small_buckets_and_many_distances_give_what_all_windows_give(spark, monkeypatch):
    monkeypatch.setattr(sd, "FEW", 3)
    rng = random.Random(4)
    passages = [" ".join(words(rng, 30)) for _ in range(12)]
    texts = [" ".join([*words(rng, rng.randint(0, 6)), (p := rng.choice(passages))[rng.randint(0, 30) : len(p) - rng.randint(0, 30)], *words(rng, rng.randint(0, 6))]) for _ in range(60)]
    got = sorted(map(tuple, sd.dedup(spark, frame(spark, texts), window=60, gram=16, bucket=2).collect()))
    assert got == sorted((i, *e) for i, e in enumerate(covered(texts, 60)))
    assert any(x[2] for x in got)


def test_suffixes_equal_for_long_are_sorted_without_a_step_for_each_word(monkeypatch):
    steps = []
    sort = np.sort
    monkeypatch.setattr(sd.np, "sort", lambda *a, **k: steps.append(1) or sort(*a, **k))
    strings = [b"x" * 390 + bytes([c]) * 10 for c in (99, 97, 98)]
    assert sd.suffix_array(strings)[0].tolist() == [1, 2, 0]
    assert len(steps) < 6


def test_dedup_of_nothing_and_texts(spark):
    assert sd.dedup(spark, frame(spark, ["a"]).limit(0)).count() == 0
    r = sd.dedup(spark, frame(spark, ["ab" * 300]), texts=True).first()
    assert bytes(r.kept) == b"" and [tuple(x) for x in r.removed] == [(0, 600)] and r.n_removed == 600
    assert sd.dedup(spark, frame(spark, ["q"]).select(F.lit(None).cast("long").alias("doc_id"), "text")).count() == 1
