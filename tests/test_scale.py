"""Steps that must hold for hot keys, very many words and very many names."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellum.functions import distance
from vellum.operators import duplicates, match, tables
from vellum.sources.shared import save


def passage(rng, n):
    return "".join(rng.choice("abcdefg hijk") for _ in range(n))


def test_pairs_of_a_hot_window_in_blocks(spark):
    rng = random.Random(3)
    postings = [(h, a) for h in range(6) for a in rng.sample(range(60), rng.choice([2, 3, 30, 55]))]
    n = defaultdict(int)
    for h, _ in postings:
        n[h] += 1
    rows = spark.createDataFrame([(str(h), a, n[h]) for h, a in postings], "hash string, a long, n long").repartition(3)
    want = defaultdict(int)
    for h, a in postings:
        for g, b in postings:
            if h == g and a < b:
                want[a, b] += 1
    for block in (1, 4, 20, 1000):
        got = duplicates._pairs(rows, block).collect()
        assert len(got) == len(want) and {(r.a, r.b): r.n_shared for r in got} == want


def test_classes_grow_with_texts(spark):
    rng = random.Random(5)
    common, sizes = passage(rng, 6000), {}
    for n in (300, 600):
        docs = spark.createDataFrame([(i, passage(rng, 400) + common + passage(rng, 400)) for i in range(n)] + [(9000, passage(rng, 3000)), (9001, None), (9002, "")], "id long, t string").repartition(4)
        got = duplicates.near_classes(docs, "id", F.col("t")).collect()
        sizes[n] = len(got)
        assert {r.class_id for r in got} == {0} and min(r.n_windows for r in got) >= 5
    assert sizes == {300: 300, 600: 600}
    links = duplicates.links_of(spark.createDataFrame([(7,), (9000,), (-1,)], "id long"), docs, "id", F.col("t")).collect()
    assert len(links) == 599 and {r.a for r in links} == {7} and {r.b for r in links} == set(range(600)) - {7}


def test_classes_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(tables, "HOT", 5)
    rng = random.Random(8)
    base = [passage(rng, 3000) for _ in range(6)]
    texts = []
    for i in range(40):
        x, y = rng.choice(base), rng.choice(base)
        texts.append(rng.choice([x, x[:1500] + passage(rng, 200), x[1500:] + y[:1500], passage(rng, 500), ""]))
    docs = spark.createDataFrame([(i * 3 % 40, t) for i, t in enumerate(texts)], "id long, t string").repartition(3)
    windows = {r.a: set(r.hashes) for r in duplicates.sampled_windows(docs, "id", F.col("t")).select(F.col("id").alias("a"), "hashes").collect()}
    windows = {i: w for i, w in windows.items() if w}
    want = {}
    for i, w in windows.items():
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for j, v in windows.items():
                if j not in seen and v & windows[x]:
                    seen.add(j)
                    todo.append(j)
        shared = sum(any(h in v for j, v in windows.items() if j != i) for h in w)
        if shared:
            want[i] = (min(seen), shared)
    assert {r.id: (r.class_id, r.n_windows) for r in duplicates.near_classes(docs, "id", F.col("t")).collect()} == want
    text = {r.id: r.t for r in docs.collect()}
    rep = {}
    for i in sorted(text):
        rep.setdefault(text[i], i)
    links = {(a, b): len(windows[a] & windows[b]) for a in windows for b in windows if a != b and windows[a] & windows[b] and (text[a] == text[b] or rep[text[b]] == b)}
    got = {(r.a, r.b): r.n_shared for r in duplicates.links_of(docs.select("id"), docs, "id", F.col("t")).collect()}
    assert got == links
    near = {(r.a, r.b): r.n_shared for r in duplicates.near(docs, "id", F.col("t")).collect()}
    assert near == {(a, b): n for (a, b), n in links.items() if (rep[text[a]] == a and text[a] == text[b] and a < b) or (rep[text[a]] == a and a < b and text[a] != text[b])}


def test_components(spark, monkeypatch):
    monkeypatch.setattr(tables, "HOT", 7)
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(500, 500)]
    root = {x: x for e in links for x in e}
    for _ in range(500):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = duplicates.components(spark.createDataFrame(links, "a long, least long").repartition(3))
    assert {r.node: r.root for r in got.collect()} == {x: r for x, r in root.items() if x != 500}


def test_join_evenly(spark, monkeypatch):
    monkeypatch.setattr(tables, "HOT", 10)
    rows = save(spark.range(1000).select("id", F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 100).alias("k")), "rows")
    keys = rows.groupBy("k").agg(F.count(F.lit(1)).alias("times"), F.max("id").alias("most"))
    got = tables.join_evenly(rows, keys, "k", "times", 1000)
    assert sorted(got.collect()) == sorted(rows.join(keys.drop("times"), "k").collect())
    assert tables.join_evenly(rows.limit(0), keys.limit(0), "k", "times", 0).count() == 0


def test_names_of_a_hot_base_are_cut_before_the_shuffle(spark):
    rows = spark.range(0, 100_000, 1, 8).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("b"), "id")).alias("b"))
    good, bad = tables.unique_names(rows, F.col("b"), "id")
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert good.where("url like 'hot%'").count() == 100 and bad.count() == 90_000 - 100 and good.count() + bad.count() == 100_000
    assert {r.url for r in good.where("id < 3").collect()} == {"b0.html", "hot.html", "hot_1.html"}


# -- nearest names -----------------------------------------------------------------------------------------------------------------------------------------


def test_nearest_agrees_with_all_pairs(spark):
    rng = random.Random(2)
    words = list({"".join(rng.choice("abcé𝄞 ") for _ in range(rng.randint(0, 9))) for _ in range(400)})
    names = ["".join(rng.choice("abcéx") for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, "", words[0]]
    n = spark.createDataFrame([(x, 1, "k") for x in names], "name string, part int, kind string")
    d = spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "w string")
    want = {x: min((distance.distance(x, w), w) for w in words) for x in names if x is not None}
    for options in ({"few": 0}, {"few": 0, "part": 37}, {}):
        got = distance.nearest_of(n, "name", d, "w", **options)
        assert {r.name: (r.distance, r.nearest) for r in got.collect() if r.name is not None} == want and got.count() == len(names)
        assert [(r.distance, r.nearest) for r in got.where("name is null").collect()] == [(None, None)]
    assert distance.nearest_of(n, "name", d.limit(0), "w").where("nearest is not null").count() == 0


def test_nearest_of_a_million_words(spark):
    words = spark.range(1_000_000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 14).alias("w"))
    names = spark.createDataFrame([(w[0],) for w in words.limit(3).collect()] + [("0123456789",), ("zz",)], "name string")
    got = distance.nearest_of(names, "name", words, "w")
    want = names.join(words.sample(0.02, 1), how="cross").groupBy("name").agg(F.min(F.levenshtein("name", "w")).alias("d"))
    some = {r.name: r.d for r in want.collect()}
    rows = got.collect()
    assert len(rows) == 5 and all(r.distance == distance.distance(r.name, r.nearest) <= some[r.name] for r in rows)
    assert [r.distance for r in rows[:3]].count(0) + sum(r.distance == 0 for r in rows[3:]) == 3


def test_nearest_asks_few_blocks():
    """Of 20 and of 200 blocks of words, a name meets as many: those alone that may hold a word as near."""
    rng, asked = random.Random(4), []
    for n in (20_000, 200_000):
        words = [f"Customer#{i:09d}" for i in range(n)]
        blocks = [(words[i], distance.common(words[i], words[j - 1]), 18, 18) for i, j in distance.cut(words, 1000)]
        tree = distance.Beginnings(blocks)
        assert n // 1000 <= len(blocks) <= n // 50 and sum(j - i for i, j in distance.cut(words, 1000)) == n
        names = [f"Supplier#{rng.randrange(n):09d}" for _ in range(300)]
        for at, x in distance._by_length(names):
            first = tree.nearby(x)
            assert all(tree.first[k] <= "Customer" + names[i][8:] < (tree.first + ["D"])[k + 1] for i, k in zip(at, first, strict=True))
            before = np.array([k + 1 for k in first])
            asked.append(sum(len(block) for _, block in tree.within(x, np.full(len(x), 5), before)))
    assert sum(asked) == 600


def test_nearest_in_blocks_by_brute_force():
    rng = random.Random(9)
    for part in (1, 3, 40):
        words = sorted({"".join(rng.choice("abé𝄞 ") for _ in range(rng.randint(0, 7))) for _ in range(200)})
        held = sorted(words[i:j] for i, j in distance.cut(words, part))
        assert sorted(w for ws in held for w in ws) == words and max(map(len, held)) <= part
        tree = distance.Beginnings([(ws[0], distance.common(ws[0], ws[-1]), min(map(len, ws)), max(map(len, ws))) for ws in held])
        names = ["".join(rng.choice("abéx") for _ in range(rng.randint(0, 9))) for _ in range(30)]
        best = {}
        for at, x in distance._by_length(names, 7):
            for i, k in zip(at, tree.nearby(x), strict=True):
                best[i] = distance.Words(held[k]).nearest(names[i])
            bound, before = (np.array(v) for v in zip(*((best[i][0], sum(f < best[i][1] for f in tree.first)) for i in at), strict=True))
            for name, block in tree.within(x, bound, before):
                for i, k in zip(at[name], block, strict=True):
                    best[i] = distance.Words(held[k]).nearest(names[i], best[i])
        assert all(best[i] == min((distance.distance(n, w), w) for w in words) for i, n in enumerate(names))


# -- dictionaries --------------------------------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [10**6, 10**7, 10**8])
def test_filter_passes_little_at_any_size(n):
    """What passes by chance depends on bits for each entry, and they don't grow fewer with the dictionary."""
    entries = 4 * n
    k = match.shares(entries, match.FILTER_BYTES)
    bits = match.filter_size(-(-entries // k))
    assert 1 << bits <= 8 * match.FILTER_BYTES and (1 << bits) * k >= match.BITS * entries
    # a filter filled like that one, of a size that a test can hold
    fill, small = -(-entries // k) / (1 << bits), 22
    rng = np.random.default_rng(1)
    map_ = np.zeros(1 << small - 3, np.uint8)
    for at in match.probes(rng.integers(0, 1 << 63, int(fill * (1 << small)), dtype=np.uint64) * np.uint64(2), small):
        np.bitwise_or.at(map_, at >> 3, (1 << (at & 7)).astype(np.uint8))
    f = match.Filter(map_, small, [3, 7, 8, 9, 10, 11, 13, 20, 30, 60])
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200_000))
    assert sum(1 for _ in f.places(text)) < 0.02 * len(text)


def test_filter_knows_its_keys(spark):
    rng = random.Random(6)
    keys = list({"".join(rng.choice("abé𝄞 ") for _ in range(rng.randint(1, 60))) for _ in range(500)})
    made = match.make_filter(spark.createDataFrame([(k,) for k in keys], "k string").repartition(3), 3000)
    for k in keys:
        assert (2, len(k)) in set(made.places("xx" + k + "yy"))
    assert list(made.places("")) == []


def test_dictionary_in_shares(spark):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abc d") for _ in range(n))
    docs = spark.createDataFrame([(i, text(400)) for i in range(30)] + [(98, None), (99, "")], "id long, t string")
    keys = spark.createDataFrame([(text(rng.choice([1, 3, 6, 7, 12, 13, 25])), i) for i in range(300)] + [("aaaa", 1), ("aaaa", 2)], "k string, v long")
    one = sorted(map(tuple, match.search(docs, "id", "t", keys, "k", "v").collect()))
    assert one and one == sorted(map(tuple, match.search(docs, "id", "t", keys, "k", "v", sent_bytes=0, filter_bytes=1 << 12).collect()))
    assert match.shares(10**9, match.FILTER_BYTES) > 1 == match.shares(10**5, match.FILTER_BYTES)


# -- memory ----------------------------------------------------------------------------------------------------------------------------------------------------


def test_texts_of_a_batch_are_not_held_together(monkeypatch):
    """What Python makes of a batch of 6 MB of texts comes in pieces of a megabyte of them."""
    docs = type("Docs", (), {"dtypes": [("id", "bigint"), ("t", "string")], "select": lambda self, *c: self, "where": lambda self, c: self, "mapInArrow": lambda self, f, schema: f})()
    text = "the quick <b>then</b> " * 500
    b = pa.RecordBatch.from_pydict({"id": list(range(600)), "t": [text] * 600})
    for normaliser in (None, match.law_view):
        rows = [x.num_rows for x in match.link(docs, "id", "t", {"the": "/", "then": "/"}, normaliser)(iter([b]))]
        assert sum(rows) == 600 and max(rows) * len(text) <= 1 << 20


def test_edges_move_as_plain_rows(spark):
    """The lists of a judgment's page are made where its edges arrive: no task makes parts of lists, sorts them and sends them with urls."""
    from vellum import catalog

    plan = catalog.QUERIES["judgment_page"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    plan = plan if "Exchange" in plan else catalog.QUERIES["judgment_page"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") >= 2
