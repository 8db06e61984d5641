"""Repair of conversations: all edits by brute force, the products' laws, and conversations that lie across many parts."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, cost long, absent boolean"
LEGAL = re.compile(r"\A(s?(ua)+)?\Z")


def edits(rows, left):
    """Every way to edit the rows: cost, audit, turns; with at most ``left`` insertions in a row."""
    if left:
        for role in ("user", "assistant"):
            for c, a, t in edits(rows, left - 1):
                yield c + 2, "I" + a, [(role, ""), *t]
    if not rows:
        yield 0, "", []
        return
    (role, text, fault), rest = rows[0], rows[1:]
    for c, a, t in edits(rest, 2):
        yield c + 3, "D" + a, t
        if fault not in "bd":
            more = fault == "t"
            yield c + more, "K" + a, [(role, text), *t]
            for r in ("user", "assistant"):
                yield c + 2 + more, "R" + a, [(r, text), *t]


def brute(rows):
    good = ((c, a, t) for c, a, t in edits(rows, 2) if LEGAL.match("".join(r[:1] or "-" for r, _ in t)))
    return min(good, key=lambda x: x[:2])


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.findall("[^\x20\x09-\x0d]", text)
        out.append((role, text, "b" if not last else "d" if (role, text) in seen else "f" if last[-1] in ".!?" else "t"))
        seen.add((role, text))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", " "]), st.sampled_from(["a.", "b", "c!", " ", "d?", "e"])), max_size=3))
def test_cheapest_edits(rows):
    rows = faults(rows)
    m = tr._of(tuple((r[:1], f) for r, _, f in rows)) if rows else None
    cost, audit, turns = brute(rows)
    assert tr.cheapest(m) == (cost, audit) and list(tr.repaired(iter((r, t) for r, t, _ in rows), audit)) == turns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("usax"), st.sampled_from("btdf")), min_size=3, max_size=30), st.data())
def test_products_are_associative(turns, data):
    i = data.draw(st.integers(1, len(turns) - 2))
    j = data.draw(st.integers(i + 1, len(turns) - 1))
    a, b, c = (tr._of(tuple(x)) for x in (turns[:i], turns[i:j], turns[j:]))
    assert tr.product(tr.product(a, b), c) == tr.product(a, tr.product(b, c)) == tr._of(tuple(turns))


def plain(rows):
    """The contract, conversation by conversation; edits by a search over states."""
    by, out = {}, []
    for c, turn, role, text in rows:
        name = lambda x: " " if x is None else x
        k = zlib.crc32(f"{name(c)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        by.setdefault(c, []).extend([(turn is not None, turn or 0, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1))
    for c, own in by.items():
        own.sort()
        turns = faults([(r, t) for _, _, r, t in own])
        known = [n for some, n, _, _ in own if some]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        go, next_ = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}, {0: ("u", "user", 2), 1: ("u", "user", 2), 2: ("a", "assistant", 3), 3: ("u", "user", 2)}

        @lru_cache(None)
        def cost(i, q):
            return min(ways(i, q))[0] if (i < len(turns) or q in (1, 2)) else 0

        def ways(i, q, inserts=2):
            x = []
            if i < len(turns):
                role, text, fault = turns[i]
                x.append((3 + cost(i + 1, q), "D", i + 1, q))
                if fault not in "bd":
                    more = fault == "t"
                    if (q, role[:1]) in go:
                        x.append((more + cost(i + 1, go[q, role[:1]]), "K", i + 1, go[q, role[:1]]))
                    x.append((2 + more + cost(i + 1, next_[q][2]), "R", i + 1, next_[q][2]))
            elif q in (0, 3):
                x.append((0, "", i, q))
            if inserts:
                x += [(2 + min(ways(i, next_[q][2], inserts - 1))[0], "I", i, next_[q][2])] if ways(i, next_[q][2], inserts - 1) else []
            return x

        for i in range(len(turns), -1, -1):
            for q in range(4):
                cost(i, q)
        i = q = 0
        total, audit, kept = cost(0, 0), "", []
        while i < len(turns) or q not in (0, 3):
            c0, letter, j, p = min(ways(i, q), key=lambda w: w[:2])
            if letter != "D":
                kept.append((next_[q][1] if letter in "IR" else turns[i][0]) + ":" + ("" if letter == "I" else turns[i][1]))
            audit, i, q = audit + letter, j, p
        count = [sum(f == k for _, _, f in turns) for k in "bdt"]
        out.append((c, gaps, *count, illegal, total, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


def made(seed, n, longest):
    rng, rows = random.Random(seed), []
    for c in [None, -3, *range(n)]:
        for t in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, t, None, t * 2]), rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice(["one.", "two", "three!", " ", "fünf?\n", "long " * 40 + "."]) + (str(t) if rng.random() < 0.3 else "") if rng.random() < 0.9 else None))
    for c in (n, n + 1):
        rows += [(c, t, rng.choice(["user", "assistant", "user", "system"]), f"{rng.randrange(40)}" + rng.choice([".", "!", ""])) for t in range(longest)]
    return rows + rows[:4]


@pytest.mark.parametrize(("seed", "parts", "longest"), [(1, 4, 0), (2, 30, 60), (3, 60, 300), (4, 3, 40)])
def test_repair(spark, monkeypatch, seed, parts, longest):
    rows = [(c, t, r, x) for c, t, r, x in made(seed, 25, longest)]
    monkeypatch.setattr(tr, "PIECE", 50)
    monkeypatch.setattr(tr, "FAN", 3)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame([(*r, "k", 1, 2, True) for r in rows], SCHEMA).repartition(3)
        got = tr.repair(spark, tr.damaged(table), absent=F.col("absent")).collect()
        assert sorted(map(str, map(tuple, got))) == plain(rows)
        if not longest:
            con = duckdb.connect()
            con.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
            con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
            assert sorted(map(str, con.sql(tr.ORACLE).fetchall())) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_tables(spark):
    table = lambda rows: spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert tr.repair(spark, table([])).count() == 0
    r = tr.repair(spark, table([(1, 0, "user", "hi."), (1, 1, "assistant", "so.")])).first()
    assert tuple(r) == (1, 0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:hi.\nassistant:so.").hexdigest())
    gone = next(t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = table([(7, gone, "user", "x")])
    assert tuple(tr.repair(spark, tr.damaged(rows), absent=F.col("absent")).first()) == (7, 0, 0, 0, 0, 0, 0, "", tr.EMPTY)
