"""The trie over conversations, against one that is built of dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from vellum.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, part int, n long"


def plain(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).digest(), text or ""))
    turns = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in by.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        f = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = turns.get(f, [])[:h] + own[h:]
    nodes = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for k, members in nodes.items():
        inside = [x for x in nodes if x[: len(k)] == k]
        children = [x for x in inside if len(x) == len(k) + 1]
        leaves = sum(1 for x in inside if not any(len(y) == len(x) + 1 and y[:-1] == x for y in inside))
        saved = sum((len(nodes[x]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", x[-1][1])) for x in inside if x)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(k))))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def made(seed, n=60, long=0):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-70, 200), n):
        for t in range(rng.choice([1, 1, 2, 3, 4, 5, 9])):
            rows.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "assistant", None, "system"]), rng.choice(["a b", "a b", "x", "", None, "long " * 50])))
    for c in (0, 20, 21, 33, 500, 501):
        rows += [(c, t, "user", f"w{t % 3 if c in (500, 501) and t < long // 2 else t}" + str(c) * (c != 501 and t > long // 2)) for t in range(long)]
    return rows + rows[:5] + [(None, 1, "user", "x")]


@pytest.mark.parametrize(("seed", "parts", "long"), [(1, 4, 0), (2, 40, 0), (3, 25, 40), (4, 3, 90)])
def test_trie(spark, monkeypatch, seed, parts, long):
    rows = made(seed, long=long)
    monkeypatch.setattr(prefix_trie, "FULL", 7 if seed % 2 else 20_000)
    monkeypatch.setattr(prefix_trie, "HOT_KEYS", 3 if seed % 2 else 10_000)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
        assert sorted(map(str, map(tuple, prefix_trie.trie(spark, table).collect()))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_tables(spark):
    table = lambda rows: spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(spark, table([])).count() == 0
    assert prefix_trie.trie(spark, table([(None, 1, "a", "b")])).count() == 0
    for rows in ([(21, 0, "user", "x")], [(0, 0, "user", "a"), (21, None, None, None)], [(c, t, "user", "same words") for c in range(100, 160) for t in range(3)]):
        assert sorted(map(str, map(tuple, prefix_trie.trie(spark, table(rows)).collect()))) == plain(rows)
