"""Mixing, archives, the queries and the pipeline."""

import base64
import hashlib
import math

import duckdb
import pytest
from fixtures_llm import edge_texts, frame, near_texts
from pyspark.sql import functions as F

from vellum.llm import mixing, queries
from vellum.llm import warc_archive as warc

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(1, "u", "x"), (2, "u", "x"), (3, None, None), (4, "u", ""), (5, "a\r\nb WARC/1.1", "WARC/1.1 in WARC/1.0\r\n"), (6, "u", INNER), (7, "u", "pre" + INNER * 3 + "post WARC/1."), (None, "u", "x"), (8, "u", "é" * 1000), (8, "u", "é" * 1000), (9, "u", "WARC/1." * 50), (9, "u", "zz")]


def expected(rows, least=0):
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = i == top[h or ""] or len(raw) < least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else top[h or ""]))
    return sorted(map(str, out))


@pytest.mark.parametrize("split", [None, "300"])
@pytest.mark.parametrize("least", [0, 2])
def test_archives(spark, split, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = warc.round_trip(spark, pages.coalesce(1) if split else pages.repartition(3), least=least)
        assert sorted(map(str, map(tuple, got.collect()))) == expected(PAGES, least)
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(k)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


LONG_URLS = [
    (1, "u", "before"), (2, "http://x/" + "a" * 20000 + "WARC/1." + "b" * 20000, "long"), (3, "u", "after"), (4, "WARC/1.1 " + "c" * 9000 + "WARC/1." * 3 + "d" * 20000, "long" + INNER),
    (5, "u", "WARC/1.1\r\nA: " * 3000), (6, "u", "WARC/1.1\r\nA: b\r\n" + "e" * 20000 + "WARC/1.0\r\n: " + "f" * 20000), (7, "http://x/WARC/1.1" + "g" * 20000, "long"), (8, "u", "last"),
]


@pytest.mark.parametrize("split", [None, "5000", "300"])
def test_long_urls_with_magics(spark, split):
    pages = spark.createDataFrame(LONG_URLS, "page_id long, url string, html string")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert sorted(map(str, map(tuple, warc.round_trip(spark, pages.coalesce(1)).collect()))) == expected(LONG_URLS)
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(k)


def test_many_groups_are_joined(spark, monkeypatch):
    monkeypatch.setattr(warc, "SENT_GROUPS", 0)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    # Spark would send so small a table by itself
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warc.classify(spark, pages, "page_id", F.col("html"))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(map(str, map(tuple, warc.round_trip(spark, pages).collect()))) == expected(PAGES)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("sent", [0, 100_000])
def test_one_long_record_before_many(spark, monkeypatch, sent):
    """What stands behind a record with magics is no part of it; the result outlives the archive, a later table and the JVM's garbage."""
    from vellum.llm.scratch import save

    monkeypatch.setattr(warc, "SENT_CHUNKS", sent)
    rows = [(0, "u", "first WARC/1.1 in it")] + [(i, f"u{i}", f"page {i % 400} " * 20) for i in range(1, 2000)] + [(5000, "WARC/1." * 2000, "WARC/1.0\r\n" * 30000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"file": F.lit("f"), "record": F.lit(1), "__payload": F.lit("p"), "id": F.lit(2), "__top": F.lit(3)})
    got = warc.round_trip(spark, pages.coalesce(1))
    spark.sparkContext._jvm.System.gc()
    save(spark, spark.range(1), "later")
    assert sorted(map(str, map(tuple, got.collect()))) == expected(rows)


def test_lost_records_are_an_error(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    whole = warc.read
    monkeypatch.setattr(warc, "read", lambda s, folder: whole(s, folder).limit(3))
    with pytest.raises(RuntimeError, match="12 pages"):
        warc.round_trip(spark, pages)


def test_header():
    assert warc.header(b"1\r\nWARC-Type: response\r\nX: a\r\n b\r\nContent-Length: 2\r\n\r\nhi")[0][b"x"] == b"a b"
    assert warc.header(b"1\r\nno colon\r\n\r\n") is None and warc.header(b"1 in a text") is None and warc.header(b"1\r\nContent-Length: 2\r\n\r\n") is None


def test_mixing(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 else f"s{i % 5}", i) for i in range(600)] + [(None, None, None, 1), (7, "t7", "hot", 7), (9000, "", "none", 0), (9001, "x" * (1 << 20), "hot", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy long")
    a = mixing.mix(docs).collect()
    keys = [r.mix_key for r in a]
    assert keys == sorted(keys) and set(a[0].asDict()) == {"doc_id", "text", "source", "copy", "mix_key"}
    assert sorted(map(str, a)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert sorted(map(str, a)) == sorted(map(str, mixing.mix(docs, sent_bytes=0).collect()))
    named = mixing.mix(docs, copy_col="__mix_copy", key_col="__mix_key").select(*docs.columns).collect()
    assert len(named) == len(a) and {r.copy for r in named} <= {r[3] for r in rows}
    assert not any("hashpartitioning(source" in x for x in mixing.mix(docs)._jdf.queryExecution().executedPlan().toString().split("\n"))
    weights = spark.createDataFrame([("hot", 1.0), ("s0", 1.0), (None, 0.0)], "source string, weight double")
    b = mixing.mix(docs, weights=weights, total=4000).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in b}
    assert set(n) == {"hot", "s0"} and all(abs(x - 2000) < 6 * math.sqrt(2000) for x in n.values())
    assert mixing.mix(docs.limit(0)).count() == 0


def test_poisson(spark):
    for rate in (0.3, 4.0, 60.0):
        cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(rate)).alias("c")).first()[0]
        assert all(abs(c - sum(math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(i + 1))) < 1e-12 for i, c in enumerate(cdf[:100]))


@pytest.fixture
def small(spark, tmp_path):
    texts = near_texts(7)[:80] + edge_texts()
    docs = frame(spark, texts).drop("sig", "key", "cover")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


TURNS = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % 4}.") for c in range(30) for t in range(c % 6)] + [(40, None, None, None)]


def test_queries_give_every_row_whatever_else_there_is(spark, small, tmp_path_factory):
    """Further columns with names that operators use inside change nothing."""
    odd = str(tmp_path_factory.mktemp("odd"))
    for t in ("documents", "labels", "pages", "conversations"):
        rows = spark.read.parquet(f"{small}/{t}.parquet")
        own = {c: F.lit(c) for c in ("id", "text_", "key", "row", "n", "part", "seq", "host", "blocks", "place", "record", "file", "split", "conv", "sig", "cover", "__text", "__id", "class_id", "first", "__payload", "absent", "__copy", "depth", "stats") if c not in rows.columns}
        rows.withColumns(own).write.parquet(f"{odd}/{t}.parquet")
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    rows = {"op10_warc": len(PAGES), "op11_html_text": len(PAGES), "op12_prefix_trie": None, "op13_turn_repair": len({c for c, *_ in TURNS})}
    for name, f in queries.QUERIES.items():
        got = f(spark, small)
        one = sorted(map(str, map(tuple, got.collect())))
        if name != "op4_source_mixing":  # passes further columns on
            assert rows.get(name, n) in (None, len(one)), name
            assert one == sorted(map(str, map(tuple, f(spark, odd).select(*got.columns).collect()))), name


def test_sql_agrees(spark, small):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet/*.parquet'" + (" WHERE page_id NOT IN (8)" if t == "pages" else ""))
    got = queries.QUERIES["op4_source_mixing"](spark, small).select("doc_id", "copy", "mix_key").collect()
    want = con.execute(f"SELECT doc_id, copy, mix_key FROM ({queries.ORACLES['op4_source_mixing']})").fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    got = [tuple(r) for r in queries.QUERIES["op10_warc"](spark, small).collect() if r.page_id not in (8, None)]
    want = [r for r in con.execute(queries.ORACLES["op10_warc"]).fetchall() if r[0] is not None]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == names
            out.write.parquet(f"{small}/stage{i}")
            docs = spark.read.parquet(f"{small}/stage{i}")
    got = sorted(map(str, map(tuple, out.collect())))
    assert got == sorted(map(str, map(tuple, corpus_pipeline.run(spark, small).collect()))) and len(got) == docs.count()


def test_stages_with_odd_tables(spark, tmp_path):
    """Columns named like those the operators use, nulls in every column, repeated rows, long texts; and no rows at all."""
    import corpus_pipeline

    spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    texts = [" ".join(f"w{i}x{k % 37 if i % 2 else k}" for k in range(60)) + " bob (at) example [dot] com" for i in range(40)] + edge_texts() + ["long " + "é1 " * 50_000]
    own = {c: F.lit(c) for c in ("copy", "mix_key", "row", "n", "__vellum_k1", "__vellum_n", "sig", "key", "__text", "__id", "class_id", "first")}
    odd = frame(spark, texts).drop("sig", "key", "cover").withColumns(own)
    none = spark.createDataFrame([(None,) * 5], "doc_id long, text string, lang string, source string, n_chars long").withColumns(dict.fromkeys(own, F.lit(None).cast("string")))
    odd = odd.unionByName(odd.where("doc_id = 3")).unionByName(none).unionByName(none)
    for rows in (odd, odd.limit(0)):
        docs = rows
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == odd.columns, name
            out.write.parquet(f"{tmp_path}/{rows is odd}{i}")
            docs = spark.read.parquet(f"{tmp_path}/{rows is odd}{i}")
            assert docs.where("copy <> 'copy' or `__vellum_k1` <> '__vellum_k1' or first <> 'first'").isEmpty()
            assert (docs.count() > 0) == (rows is odd), name
            if name.startswith("n-gram"):
                assert docs.where("doc_id = 3").count() <= 1
            if name == "PII":
                assert docs.where(F.contains("text", F.lit("(at)"))).isEmpty()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert last.count() == docs.count()
