import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vellum.operators import duplicates, match, render, tables
from vellum.plans import build, courts
from vellum.sources import pages, sinks
from vellum.streaming import logs

COURTS = [("QB", "Court of Things"), ("CH", "Court of Matters")]
CATEGORIES = {"Here": ["CH", "QB"]}


def page(n, cited="", court="Court of Things", title=None):
    title = title or f"A{n} v B{n} [2001] QB {n} ({n} July 2001)"
    return f"""<html><head><title>{title}</title></head><body><table><tr><td align="left"><h1>{court}</h1></td></tr></table><small><i>http://x/{n}</i><br>Cite as: [2001] QB {n}, [2001] Shared 7</small>
<hr><p>As in {cited} and the Contempt of <i>Court</i> Act 1981, [2001] Q.B. {n}.</p><hr></body></html>"""


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for n in (1, 2, 3):
        (tmp_path / "in" / "deep" / f"{n}.html").write_text(page(n, f"[2001] QB {n + 1}", "Court of Thing"))
    (tmp_path / "in" / "bad.html").write_bytes(b"nothing")
    (tmp_path / "in" / "same.html").write_text(page(1))
    (tmp_path / "in" / "note.txt").write_text("no page")
    return tmp_path


def test_build(spark, corpus):
    laws = spark.createDataFrame([(1, "Contempt of Court Act 1981", "/law/1"), (2, "Contempt of court act 1981", "/law/2")], "legislationid long, title string, link string")
    b = build.run(spark, [str(corpus / "in")], str(corpus / "store"), legislation=laws, courts=COURTS, categories=CATEGORIES)
    m = b.metrics()
    assert m["pages"] == 5 and {k: v.count() for k, v in b.tables.items() if k == "judgments"} == {"judgments": 3}
    assert sorted((r.stage, r.key) for r in b.errors.where("stage = 'analyse'").collect()) == [("analyse", f"file:{corpus}/in/bad.html"), ("analyse", f"file:{corpus}/in/same.html")]
    name = {r.judgmentid: r.filename for r in b.tables["judgments"].collect()}
    refs = sorted((name[r.judgmentid], r.citationcode) for r in b.tables["crossreferences"].collect())
    assert refs == [("1.html", "[2001] QB 2"), ("2.html", "[2001] QB 3")]
    assert b.tables["lawreferences"].count() == 3
    laws = {r.judgmentid: r.legislationid for r in b.tables["lawreferences"].collect()}
    assert b.tables["lawreferences"].columns == ["judgmentid", "legislationid"] and laws == dict.fromkeys(name, 1)
    html = {r.path: r.html for r in b.whole_pages("judgments").collect()}
    assert len(html) == 3 and "/judgments/QB/2001/[2001]_QB_2.html" in html
    assert "Cases cited" in html["/judgments/QB/2001/[2001]_QB_1.html"] and "Cited by" not in html["/judgments/QB/2001/[2001]_QB_1.html"]
    assert '<a href="/law/1">Contempt' in html["/judgments/QB/2001/[2001]_QB_2.html"]
    assert [r.path for r in b.whole_pages("disambiguation").collect()] == ["/judgments/disambiguation_[2001]_Shared_7.html"]
    index = {r.path: r.html for r in b.whole_pages("indexes").collect()}
    assert index["/judgments/QB/index.html"].index("QB_3") < index["/judgments/QB/index.html"].index("QB_1") and "July 2001" in index["/judgments/QB/index.html"]
    assert index["index.html"].index("Court of Matters") < index["index.html"].index("Court of Things")
    sinks.save_page_blocks(b.pages["judgments"], f"file://{corpus}/out")
    assert (corpus / "out/judgments/QB/2001/[2001]_QB_1.html").read_text() == html["/judgments/QB/2001/[2001]_QB_1.html"]
    before = sorted(map(tuple, b.errors.collect()))
    again = build.run(spark, [], str(corpus / "store"), phases=("indexes",), courts=COURTS, categories=CATEGORIES)
    assert again.whole_pages("indexes").count() == 2 and sorted(map(tuple, again.errors.collect())) == before
    lines = [r.line for r in again.log(spark).collect()]
    assert "*** judgments: 3" in lines and any(x.startswith("[analyse] file:") for x in lines) and f"*** errors: {len(before)}" in lines
    now = sinks.publish(spark, f"file://{corpus}/out", f"file://{corpus}/live")
    assert sinks.current(spark, f"file://{corpus}/live") == now and not (corpus / "out").exists()
    assert (corpus / "live" / now.rpartition("/")[2] / "judgments/QB/2001/[2001]_QB_1.html").exists()


def test_files_of_one_name(spark, corpus):
    (corpus / "in" / "1.html").write_text(page(9))
    b = build.run(spark, [str(corpus / "in")], str(corpus / "store2"), courts=COURTS, categories=CATEGORIES)
    # deep/1.html has the name of another file, and so same.html, of the same source, isn't rejected
    assert b.tables["pages"].count() == 6 and b.tables["judgments"].count() == 4
    kept = {r.path for r in b.tables["judgments"].collect()}
    assert {f"file:{corpus}/in/1.html", f"file:{corpus}/in/same.html"} < kept and f"file:{corpus}/in/deep/1.html" not in kept
    assert b.whole_pages("judgments").count() == 4 and b.tables["bodies"].count() == 4
    assert {r.key for r in b.errors.where("stage = 'crossreference'").collect()} == {f"file:{corpus}/in/deep/1.html"}


def test_purge_includes_and_feeds(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for n in ("a.html", "deep/b.html", "c.txt", "new.html"):
        (tmp_path / n).write_text("x")
        if n != "new.html":
            os.utime(tmp_path / n, (1, 1))
    assert sinks.purge(spark, f"file://{tmp_path}", datetime(2001, 1, 1)) == 2 and sorted(p.name for p in tmp_path.rglob("*.*")) == ["c.txt", "new.html"]
    page = spark.createDataFrame([('a<esi:include src="/h" />b<esi:include src="/x"/>c',), ("none",), (None,)], "h string")
    assert [r[0] for r in page.select(render.includes(F.col("h"), {"/h": "<b>$1</b>"})).collect()] == ["a<b>$1</b>bc", "none", None]
    assert page.select(render.includes(F.col("h"), {})).first()[0] == "abc"
    link = '<feed xmlns="http://www.w3.org/2005/Atom">{}<entry><title> The {} Act</title><link rel="self" href="/{}"/><link rel="next" href="nowhere"/></entry></feed>'
    (tmp_path / "f").mkdir()
    at = f"file://{tmp_path}/f"
    for name, text in {"1976": link.format(f'<link rel="next" href="{at}/1976"/>', "A", "a"), "1977": link.format(f'<link rel="next" href="{at}/p2"/>', "B", "b"), "p2": link.format("", "C", "c"), "1978": "<feed/>"}.items():
        (tmp_path / "f" / name).write_text(text)
    got = pages.feeds(spark, at + "/%d", 1976, 1978)
    assert got.rdd.getNumPartitions() == 3 and sorted((r.title, r.link, r.year, r.page) for r in got.collect()) == [("A Act", "/a", 1976, 1), ("B Act", "/b", 1977, 1), ("C Act", "/c", 1977, 2)]
    with pytest.raises(Exception, match="1979"):
        pages.feeds(spark, at + "/%d", 1979, 1979).collect()


def test_pages_are_written_whole_or_not_at_all(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    old = spark.createDataFrame([("a.html", "old a"), ("deep/b.html", "old b")], "path string, html string")
    sinks.save_pages(old, out)
    files = lambda: {str(p.relative_to(tmp_path)): p.read_text() for p in tmp_path.rglob("*.html")}
    before = files()
    assert before == {"out/a.html": "old a", "out/deep/b.html": "old b"}
    broken = spark.range(200).repartition(8).select(F.concat("id", F.lit(".html")).alias("path"), F.when(F.col("id") == 150, F.raise_error(F.lit("no"))).otherwise(F.concat(F.lit("new"), "id")).alias("html"))
    with pytest.raises(Exception, match="no"):
        sinks.save_pages(broken.unionByName(old), out)
    assert files() == before and [p.name for p in tmp_path.iterdir()] == ["out"]
    sinks.save_pages(spark.createDataFrame([("a.html", "new a"), ("c.html", "é"), (None, "x"), ("d.html", None)], "path string, html string"), out)
    assert files() == {**before, "out/a.html": "new a", "out/c.html": "é"}
    sinks.save_pages(old.limit(0), out)
    blocks = spark.range(5000).select(F.concat((F.col("id") % 3).cast("string"), F.lit("/x.html")).alias("path"), F.struct(F.lit(0).alias("section"), (-F.col("id")).alias("n0")).alias("place"), F.concat("id", F.lit("\n")).alias("html"))
    sinks.save_page_blocks(blocks.repartition(7), out)
    assert files()["out/1/x.html"] == "".join(f"{i}\n" for i in range(4999, -1, -1) if i % 3 == 1)


def test_pages_in_archives(spark, tmp_path):
    out = f"file://{tmp_path}/packs"
    long = spark.range(4000).select(F.lit("/deep/é x.html").alias("path"), F.struct(F.lit(0).alias("section"), (-F.col("id")).alias("n0")).alias("place"), F.concat("id", F.lit("é\n")).alias("html"))
    many = spark.range(3000).select(F.concat(F.lit("/j/"), "id", F.lit(".html")).alias("path"), F.explode(F.array(*[F.struct(F.lit(x).alias("section"), F.lit(0).cast("bigint").alias("n0")) for x in (1, 0)])).alias("place"), F.col("id").cast("string").alias("html"))
    none = many.limit(2).withColumn("path", F.lit(None).cast("string")).unionByName(many.limit(2).withColumn("html", F.lit(None).cast("string")))
    blocks = many.withColumn("html", F.concat("place.section", F.lit(":"), "html", F.lit("|"))).unionByName(long).unionByName(none).repartition(5)
    want = {f"/j/{i}.html": f"0:{i}|1:{i}|" for i in range(3000)} | {"/deep/é x.html": "".join(f"{i}é\n" for i in range(3999, -1, -1))}
    sinks.save_packed_blocks(blocks, out)
    rows = pages.packed(spark, out).collect()
    assert len(rows) == 3001 and {r.path: r.content.decode() for r in rows} == want and {r.filename for r in rows} == {x.rpartition("/")[2] for x in want}
    assert 0 < len([p for p in tmp_path.rglob("*") if p.is_file() and p.suffix == ".zip"]) <= 4  # one for each task
    with pytest.raises(FileExistsError):
        sinks.save_packed_blocks(blocks, out)
    broken = many.withColumn("html", F.when(F.col("path") == "/j/1500.html", F.raise_error(F.lit("no"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="no"):
        sinks.save_packed_blocks(broken, f"{out}3")
    assert not list(tmp_path.glob("packs3*"))


def test_archives_end_and_go_on(tmp_path, monkeypatch):
    import zipfile

    monkeypatch.setattr(sinks, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 1, "taskAttemptId": lambda s: 2})())}))
    for name, pages_, bytes_ in (("a", 2, 1 << 20), ("b", 99, 5)):
        monkeypatch.setattr(sinks, "PACK_PAGES", pages_)
        monkeypatch.setattr(sinks, "PACK_BYTES", bytes_)
        writer = sinks._PackWriter(f"file://{tmp_path}/{name}")
        assert writer.write(iter([("p", "abc"), ("p", "def"), ("q", ""), ("r", "é"), ("s", "x")])).n == 4
        packs = [zipfile.ZipFile(p) for p in (tmp_path / name).rglob("*.zip")]
        assert sorted(len(p.namelist()) for p in packs) == {"a": [2, 2], "b": [1, 3]}[name]
        assert {n: p.read(n).decode() for p in packs for n in p.namelist()} == {"p": "abcdef", "q": "", "r": "é", "s": "x"}
        with pytest.raises(ValueError, match="archive"):
            writer.write(iter([("a\0b", "x")]))


def test_judgment_pages_are_not_a_file_each(spark):
    """A block of the disk for each judgment is more than all that is shuffled."""
    from vellum import catalog

    before, saved = sinks._commit, []
    sinks._commit = lambda rows, folder, *a: (before(rows, folder, *a), saved.append(folder))
    try:
        assert catalog.QUERIES["judgment_page_blocks"](spark, "/root/testdata/sf0.001").count() > 100
    finally:
        sinks._commit = before
    fs, p = sinks.file_system(spark, saved[0])
    assert fs.getContentSummary(p).getFileCount() <= 32


def test_pages_in_streams(spark, tmp_path):
    out = f"file://{tmp_path}/streams"
    long = spark.range(25000).select(F.lit("/deep/é x.html").alias("path"), (-F.col("id")).alias("n"), F.concat("id", F.lit("é\n")).alias("html"))
    many = spark.range(3000).select(F.concat(F.lit("/j/"), "id", F.lit(".html")).alias("path"), F.explode(F.array(*[F.lit(x).cast("bigint") for x in (1, 0)])).alias("n"), F.when(F.col("id") > 9, F.col("id").cast("string")).otherwise("").alias("html"))
    none = many.limit(2).withColumn("path", F.lit(None).cast("string")).unionByName(many.limit(2).withColumn("html", F.lit(None).cast("string")))
    rows = many.where("html <> ''").withColumn("html", F.concat("n", F.lit(":"), "html", F.lit("|"))).unionByName(many.where("html = ''")).unionByName(long).unionByName(none).repartition(3, "path").sortWithinPartitions("path", "n")
    want = {f"/j/{i}.html": f"0:{i}|1:{i}|" if i > 9 else "" for i in range(3000)} | {"/deep/é x.html": "".join(f"{i}é\n" for i in range(24999, -1, -1))}
    sinks.save_streams(rows, out)
    got = pages.streamed(spark, out).collect()
    assert len(got) == 3001 and {r.path: bytes(r.content).decode() for r in got} == want and {r.filename for r in got} == {x.rpartition("/")[2] for x in want}
    assert 0 < len([p for p in tmp_path.rglob("*") if p.suffix == ".arrows"]) <= 3
    with pytest.raises(FileExistsError):
        sinks.save_streams(rows, out)
    broken = rows.withColumn("html", F.when(F.col("path") == "/j/1500.html", F.raise_error(F.lit("no"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="no"):
        sinks.save_streams(broken, f"{out}2")
    assert not list(tmp_path.glob("streams2*"))
    # many pages of one kind take less than half of what entries of an archive do
    alike = spark.range(2000).select(F.concat(F.lit("/j/"), "id").alias("path"), F.struct(F.lit(0).alias("section")).alias("place"), F.concat(F.lit("<p>" + "a page like others, " * 5), "id").alias("html"))
    sinks.save_packed_blocks(alike, f"{out}3")
    sinks.save_streams(alike.repartition(3), f"{out}4")
    size = lambda x: sum(p.stat().st_size for p in (tmp_path / x).rglob("*.*") if p.suffix in (".zip", ".arrows"))
    assert size("streams4") * 2 < size("streams3")


def test_streams_end_and_go_on(tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sinks, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 1, "taskAttemptId": lambda s: 2})())}))
    rows = [("p", "abc"), ("p", "def"), ("q", ""), ("r", "é"), ("r", "r"), ("r", "s"), ("s", "x"), ("t", "")]
    for name, pages_, bytes_, step, ends in (("a", 2, 1 << 20, 1, [2, 2, 1]), ("b", 99, 1, 1, [1] * 5), ("c", 99, 1 << 20, 3, [5]), ("d", 1, 1 << 20, 2, [1, 2, 2])):
        monkeypatch.setattr(sinks, "PACK_PAGES", pages_)
        monkeypatch.setattr(sinks, "PACK_BYTES", bytes_)
        # rows before and after a batch's own are no part of it
        whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["path", "html"])
        batches = [whole.slice(i, step) for i in range(0, len(rows), step)] + [whole.slice(0, 0)]
        assert sinks._StreamWriter(f"file://{tmp_path}/{name}").write(iter(batches)).n == 5
        found = []
        for f in (tmp_path / name).rglob("*.arrows"):
            with pa.ipc.open_stream(f.read_bytes()) as stream:
                found.append([r for b in pages._whole(stream) for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)])
        assert sorted(map(len, found)) == sorted(ends)
        assert sorted((p, c.decode()) for x in found for p, c in x) == [("p", "abcdef"), ("q", ""), ("r", "érs"), ("s", "x"), ("t", "")]


def test_judgment_pages_leave_nothing_shuffled(spark):
    """What was shuffled for pages that are written is gone, and not on disk until the driver ends."""
    import time

    from vellum import catalog

    files = lambda: {f.getName() for f in _list(disks.getAllFiles()) if f.getName().startswith("shuffle_")}
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    _list = lambda xs: [xs.apply(i) for i in range(xs.size())]
    before = files()
    pages_ = catalog.QUERIES["judgment_page_blocks"](spark, "/root/testdata/sf0.001")
    left, until = files() - before, time.monotonic() + 20
    while left and time.monotonic() < until:
        time.sleep(0.5)
        left = files() - before
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert pages_.count() > 100


def test_judgment_pages_in_rounds(spark, tmp_path):
    from vellum.plans import archives

    j = spark.range(40).select(F.col("id").alias("judgmentid"), F.concat(F.lit("T<"), "id").alias("title"), F.expr("date_add(DATE'2001-01-20', CAST(id % 30 AS INT))").alias("date"), F.concat(F.lit("C"), F.col("id") % 3).alias("court"))
    j = j.withColumn("court_url", F.concat(F.lit("/c/"), "court", F.lit("/"))).withColumn("body", F.when(F.col("judgmentid") > 3, "<p>b</p>"))
    bridge = j.where("judgmentid > 5").select("judgmentid", F.explode(F.array(F.lit("y"), F.lit("x"))).alias("citationcode"))
    # judgments that others cite twice, and ids of no judgment on either side
    edges = j.where("judgmentid > 10").select("judgmentid", F.explode(F.array(F.col("judgmentid") % 4, F.lit(2).cast("bigint"), F.lit(77).cast("bigint"))).alias("id")).unionByName(spark.createDataFrame([(99, 1), (99, 98)], "judgmentid long, id long"))
    url = lambda x: F.concat(F.lit("/j/"), x.cast("string"))
    known = j.select(F.col("judgmentid").alias("id"), "date", "title", url(F.col("judgmentid")).alias("url"))

    def lists(pairs, name):
        return pairs.join(known, "id").groupBy("judgmentid").agg(F.sort_array(F.collect_list(F.struct("date", "id", "title", "url"))).alias(name))

    back = edges.select(F.col("id").alias("judgmentid"), F.col("judgmentid").alias("id"))
    want = sorted(map(tuple, render.judgment_pages(j.withColumn("url", url(F.col("judgmentid"))), tables.codes_of(bridge), lists(edges, "outgoing"), lists(back, "incoming")).collect()))
    assert "Cases cited" in want[5][1] and len(want) == 40
    for most, n in ((10**9, 1), (50, -(-(2 * edges.count() + 40) // 50))):
        out = f"file://{tmp_path}/{most}"
        assert archives.save_judgments(j, bridge, edges, out, url, most) == n
        assert sorted((r.path, bytes(r.content).decode()) for r in pages.streamed(spark, out).collect()) == want
        assert len({p.parent for p in tmp_path.rglob("*.arrows") if f"/{most}/" in str(p)}) == n
    assert archives.save_judgments(j.limit(0), bridge, edges, f"file://{tmp_path}/none", url) == 1
    assert pages.streamed(spark, f"file://{tmp_path}/none").count() == 0


def test_versions(spark, tmp_path):
    live, stage = f"file://{tmp_path}/live", f"file://{tmp_path}/stage"
    row = lambda x: spark.createDataFrame([("a.html", x)], "path string, html string")
    read = lambda: (tmp_path / "live" / sinks.current(spark, live).rpartition("/")[2] / "a.html").read_text()
    assert sinks.current(spark, live) is None
    for n in range(3):
        sinks.save_pages(row(str(n)), stage)
        sinks.publish(spark, stage, live)
        assert read() == str(n)
    assert len([p for p in (tmp_path / "live").iterdir() if p.name.startswith("v-")]) == 2
    with pytest.raises(FileNotFoundError):
        sinks.publish(spark, stage, live)
    assert read() == "2"
    # a stop before the pointer changes leaves the old state, and the next one goes through
    sinks.save_pages(row("3"), stage)
    point, sinks._point = sinks._point, lambda *a: (_ for _ in ()).throw(OSError("stopped"))
    try:
        with pytest.raises(OSError, match="stopped"):
            sinks.publish(spark, stage, live)
    finally:
        sinks._point = point
    assert read() == "2"
    sinks.save_pages(row("4"), stage)
    sinks.publish(spark, stage, live)
    assert read() == "4"
    sinks.roll_back(spark, live)
    assert read() == "2"


def test_build_ends_in_files(spark, corpus, capsys):
    from vellum.__main__ import main

    laws = corpus / "laws"
    laws.mkdir()
    (laws / "1981").write_text('<feed><entry><title>Contempt of Court Act 1981</title><link rel="self" href="/law/1"/></entry></feed>')
    out, live, store = (f"file://{corpus}/{x}" for x in ("out", "live", "store3"))
    args = [store, str(corpus / "in"), "--out", out, "--legislation", f"file://{laws}/%d", "--years", "1981", "1981"]
    b = main([*args, "--delete-db"], spark, courts=COURTS, categories=CATEGORIES, buckets=4)
    assert b.counts["judgments"] == 3 and len(list((corpus / "out").rglob("*.html"))) == 3 + 1 + 2
    assert list(b.seconds) == list(build.PHASES) and "*** convert took" in capsys.readouterr().out
    # what was written was counted in the same pass, so asking for the numbers runs nothing
    again = build.run(spark, [str(corpus / "in")], f"file://{corpus}/store4", legislation=pages.feeds(spark, f"file://{laws}/%d", 1981, 1981), courts=COURTS, categories=CATEGORIES, out=f"file://{corpus}/out4", buckets=4)
    spark.sparkContext.setJobGroup("numbers", "")
    n = again.metrics()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("numbers") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: v for k, v in n.items() if k in ("lawreferences", "judgments", "disambiguation", "indexes", "pages", "crossreferences", "courts")} == {"lawreferences": 3, "judgments": 3, "disambiguation": 1, "indexes": 2, "pages": 5, "crossreferences": 2, "courts": 2} and n == b.metrics()
    # a page that no build writes any more goes after the next conversion, and what is published is the whole
    (corpus / "out" / "judgments" / "stale.html").write_text("x")
    os.utime(corpus / "out" / "judgments" / "stale.html", (1, 1))
    b = main([*args, "--no-analyse", "--no-crossreference", "--delete-html", "--live", live], spark, courts=COURTS, categories=CATEGORIES)
    assert b.purged and not (corpus / "out").exists() and sinks.current(spark, live) == b.live
    names = {p.name for p in (corpus / "live").rglob("*.html")}
    assert len(names) == 5 and "stale.html" not in names
    with pytest.raises(ValueError):
        build.run(spark, [], store, live=live)
    with pytest.raises(SystemExit):
        main([store], spark)


def exchanges(df):
    """What the plan's exchanges read: scans of stored tables below an exchange that isn't a broadcast."""
    spark = df.sparkSession
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_tables_by_key(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        j = spark.range(300).select(F.col("id").alias("judgmentid"), F.current_date().alias("date"), F.concat(F.lit("t"), "id").alias("title"))
        codes = j.select("judgmentid", F.concat(F.lit("c"), F.col("judgmentid") % 90).alias("citationcode"))
        refs = j.select("judgmentid", F.concat(F.lit("c"), F.col("judgmentid") * 7 % 100).alias("citationcode"))
        stored = {}
        for name, rows, key in (("j", j, "judgmentid"), ("codes", codes, "judgmentid"), ("codes2", codes, "citationcode"), ("refs", refs, "citationcode")):
            sinks.save_by_key(rows, f"{tmp_path}/{name}", key, 4)
            stored[name] = sinks.load_by_key(spark, f"{tmp_path}/{name}", key)
        assert exchanges(tables.codes_of(stored["codes"])) == 0
        pairs = stored["refs"].join(stored["codes2"].withColumnRenamed("judgmentid", "target"), "citationcode")
        assert exchanges(pairs) == 0
        out = tables.outgoing(stored["refs"], stored["codes2"], stored["j"])
        assert exchanges(out) == 1  # the pairs alone, by target
        assert sorted(out.collect()) == sorted(tables.outgoing(refs, codes, j).collect())
        # in another session the layout is known again
        other = spark.newSession()
        name = sinks._table_name(f"{tmp_path}/codes/by=judgmentid-4")
        spark.sql(f"DROP TABLE {name}")
        assert exchanges(tables.codes_of(sinks.load_by_key(other, f"{tmp_path}/codes", "judgmentid"))) == 0
        with pytest.raises(FileNotFoundError):
            sinks.load_by_key(spark, f"{tmp_path}/codes", "citationcode")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_page_blocks_make_the_same_pages(spark):
    j = spark.range(40).select(F.col("id").alias("judgmentid"), F.concat(F.lit("T<"), "id").alias("title"), F.expr("date_add(DATE'2001-01-20', CAST(id % 30 AS INT))").alias("date"), F.concat(F.lit("/j/"), "id").alias("url"), F.concat(F.lit("C"), F.col("id") % 3).alias("court"))
    j = j.withColumn("court_url", F.concat(F.lit("/c/"), "court", F.lit("/"))).withColumn("body", F.when(F.col("judgmentid") > 3, "<p>b</p>"))
    codes = j.select("judgmentid", F.lit("x, y").alias("codes")).where("judgmentid > 5")
    edges = j.where("judgmentid > 10").select("judgmentid", F.explode(F.array(F.col("judgmentid") % 4, F.lit(2).cast("bigint"))).alias("id")).join(j.select(F.col("judgmentid").alias("id"), "date", "title", "url"), "id")
    lists = lambda name: edges.groupBy("judgmentid").agg(F.sort_array(F.collect_list(F.struct("date", "id", "title", "url"))).alias(name))
    want = sorted(map(tuple, render.judgment_pages(j, codes, lists("outgoing"), lists("incoming")).collect()))
    b = build.Build()
    items = edges.join(j.select("judgmentid", F.col("url").alias("path")), "judgmentid").select("path", "date", "id", "title", "url")
    b.pages["a"] = render.judgment_blocks(j, codes, items, items)
    assert sorted(map(tuple, b.whole_pages("a").collect())) == want
    months = j.groupBy("court", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.min("date").alias("day"), F.sort_array(F.collect_list(F.struct("date", "judgmentid", "title", "url")), asc=False).alias("rows"))
    months = months.select("court", "year", "month", F.date_format("day", "MMMM yyyy").alias("heading"), F.concat_ws("-", "year", "month").alias("anchor"), "rows")
    courts_ = j.select("court", "court_url").distinct()
    want = sorted(map(tuple, render.court_indexes(months, courts_).collect()))
    b.pages["b"] = render.court_blocks(j, courts_.unionByName(spark.createDataFrame([("none", "/c/none/")], courts_.schema)))
    assert sorted(map(tuple, b.whole_pages("b").collect())) == want
    assert b.pages["b"].agg(F.max(F.length("html"))).first()[0] < 150
    owners = j.select(F.concat(F.lit("[1] c/"), F.col("judgmentid") % 25).alias("citationcode"), "date", F.col("judgmentid").alias("id"), "title", F.when(F.col("judgmentid") % 25 != 3, F.col("url")).alias("url"))
    many = owners.groupBy("citationcode").agg(F.sort_array(F.collect_list(F.struct("date", "id", "title", "url")), asc=False).alias("rows")).where(F.size("rows") > 1)
    b.pages["c"] = render.disambiguation_blocks(owners)
    want = sorted(map(tuple, render.disambiguation_pages(many).collect()))
    assert len(want) == 14 and sorted(map(tuple, b.whole_pages("c").collect())) == want


def test_profile(spark, tmp_path):
    with build.profiled(spark, str(tmp_path)):
        spark.range(3).mapInArrow(lambda bs: bs, "id long").count()
    assert any(tmp_path.iterdir())


def test_phases():
    with pytest.raises(ValueError):
        build.check(("analyse", "convert"))
    with pytest.raises(ValueError):
        build.check(("nonsense",))


def test_courts():
    assert len(courts.COURTS) == 61 and len(courts.CATEGORIES) == 6
    assert sorted(s for ss in courts.CATEGORIES.values() for s in ss) == sorted(s for s, _ in courts.COURTS)


def test_explicit_files_and_feed(spark, corpus):
    assert [r.filename for r in pages.scan(spark, str(corpus / "in/bad.html")).collect()] == ["bad.html"]
    several = pages.scan(spark, str(corpus / "in/bad.html"), str(corpus / "in/deep"), str(corpus / "in/deep/1.html"), str(corpus / "in/bad.html"))
    assert sorted(r.filename for r in several.collect()) == ["1.html", "2.html", "3.html", "bad.html"]
    entry = '<entry><title>{}</title><link rel="alternate" href="/z"/><link rel="self" href="{}"/></entry>'
    for year, name, title in ((1990, "1-1850", "The A Act"), (1990, "part-aaaa2041-1", "The A Act"), (1991, "2099", "B Act"), (2012, "1", "C Act")):
        (corpus / f"feeds/year={year}").mkdir(parents=True, exist_ok=True)
        (corpus / f"feeds/year={year}/{name}.xml").write_text("<feed>" + entry.format(title, "/" + title[-5].lower()) + "</feed>")
    read = lambda *a, **k: sorted((r.title, r.link) for r in pages.feed(spark, *a, **k).collect())
    # digits in names of files say nothing, folders do if asked
    assert read(f"{corpus}/feeds") == read(f"{corpus}/feeds/*/*.xml") == [("A Act", "/a"), ("A Act", "/a"), ("B Act", "/b"), ("C Act", "/c")]
    assert read(f"{corpus}/feeds", years=(1990, 1990)) == [("A Act", "/a"), ("A Act", "/a")]
    with pytest.raises(ValueError):
        pages.feed(spark, f"{corpus}/feeds/*/*.xml", years=(1990, 1990))


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for n in range(1000):
        (tmp_path / ("deep" if n % 2 else "") / f"{n}.html").write_text(str(n))
    read = pages.scan(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism  # 32 otherwise, by so many files each
    assert sorted((r.filename, bytes(r.content)) for r in read.collect()) == sorted((f"{n}.html", str(n).encode()) for n in range(1000))


def test_search_of_large_dictionaries_agrees(spark):
    docs = spark.createDataFrame([(1, "abcabd xbc"), (2, ""), (3, None), (4, "bcd")], "id long, t string")
    keys = spark.createDataFrame([("ab", 1), ("abc", 2), ("bc", 3), ("bc", 4), ("bcd", 5)], "k string, v long")
    one = match.search(docs, "id", "t", keys, "k", "v")
    many = match.search(docs, "id", "t", keys, "k", "v", sent_bytes=0)
    rows = sorted(map(tuple, one.collect()))
    assert rows == sorted(map(tuple, many.collect()))
    assert rows == [(1, 0, 3, 2), (1, 1, 2, 3), (1, 1, 2, 4), (1, 3, 2, 1), (1, 8, 2, 3), (1, 8, 2, 4), (4, 0, 3, 5)]
    assert match.search(docs, "id", "t", keys.limit(0), "k", "v").count() == 0
    assert {r[0] for r in match.search(docs, "id", "t", keys, "k", "v", boundary=True).collect()} == {4}
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("ab é.<>B") for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.randint(0, 300))) for i in range(60)] + [(60, None), (61, text(50_000))], "id long, t string")
    keys = spark.createDataFrame([(text(rng.choice([1, 2, 3, 5, 6, 7, 9])), i) for i in range(200)] + [(None, 1), ("", 2)], "k string, v long")
    for options in ({}, {"boundary": True}, {"legacy_end": True}, {"normaliser": match.law_view}):
        one = sorted(map(tuple, match.search(docs, "id", "t", keys, "k", "v", **options).collect()))
        assert one and one == sorted(map(tuple, match.search(docs, "id", "t", keys, "k", "v", sent_bytes=0, **options).collect()))
    laws = tables.first_by(keys.where("k <> ''"), F.col("k"), "v").select("k", F.col("v").cast("string").alias("href"))
    one, two = (sorted(map(str, match.link_table(docs, "id", "t", laws, "k", "href", match.limp, sent_bytes=n).collect())) for n in (1 << 20, 0))
    assert one == two and len(one) == 62 and any("href" in r for r in one)
    assert match.link_table(docs, "id", "t", laws.limit(0), "k", "href").where("size(keys) > 0").count() == 0


def test_unique_names(spark):
    rows = spark.range(103).withColumn("b", F.lit("x"))
    good, bad = tables.unique_names(rows, F.col("b"), "id")
    names = {r.url for r in good.collect()}
    assert len(names) == 100 and {"x.html", "x_99.html"} <= names and bad.count() == 3


def test_duplicates(spark):
    docs = spark.createDataFrame([(i, ("ab" * 200 if i < 3 else f"{i} " * 300)) for i in range(6)] + [(9, None), (10, "")], "id long, t string")
    assert duplicates.totals(docs.where("t is not null"), "id", F.col("t")).first()[:] == (7, 5, 1)
    assert duplicates.groups(docs, "id", F.col("t")).count() == 3
    assert all(r.a < r.b for r in duplicates.near(docs, "id", F.col("t")).collect())
    rng = random.Random(1)
    p = "".join(rng.choice("abcdé ") for _ in range(3000))
    docs = spark.createDataFrame([(3, p), (1, p), (2, p), (5, "x" + p[:2000]), (6, p[1000:] + "y"), (7, None), (8, ""), (9, "abc")], "id long, t string")
    got = {(r.a, r.b): r.n_shared for r in duplicates.near(docs, "id", F.col("t")).collect()}
    want = {i: {p[at : at + 250] for at in range(len(p) - 249) if sum(((((ord(p[j]) * 131 + ord(p[j + 1])) * 131 + ord(p[j + 2])) * 131 + ord(p[j + 3])) % 2**31 * 1103515245 >> 15) % 65536 for j in range(at, at + 247)) % 512 == 0} for i, p in ((1, p), (5, "x" + p[:2000]), (6, p[1000:] + "y"))}
    assert got == {k: v for k, v in {(1, 2): len(want[1]), (1, 3): len(want[1]), (1, 5): len(want[1] & want[5]), (1, 6): len(want[1] & want[6]), (5, 6): len(want[5] & want[6])}.items() if v}


def test_stream(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs/a.log").write_text('GET HTTP/1.1" 500 1 "/" "b"\nGET HTTP/1.1" 200 1 "-" "-"\nGET HTTP/1.1" 200 1 "/" "b"\n')
    stream = logs.watch(spark, f"file://{tmp_path}/logs").withColumn("t", F.lit(datetime(2024, 1, 1)))
    q = logs.levels(stream, "t").writeStream.outputMode("complete").format("memory").queryName("levels").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(60)
    assert sorted((r.level, r.n) for r in spark.table("levels").collect()) == [("debug", 1), ("warning", 1)]
