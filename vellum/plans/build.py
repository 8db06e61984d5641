"""The whole build: from a folder of pages to tables, references and pages."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import distance, text
from ..operators import match, render, tables
from ..sources import pages as source
from ..sources import sinks
from ..sources.shared import save
from . import courts as configured

PHASES = ("analyse", "crossreference", "convert", "disambiguation", "indexes")


@dataclass
class Build:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    #: Pages in blocks (path, place, html) by kind.
    pages: dict[str, DataFrame] = field(default_factory=dict)
    errors: DataFrame | None = None
    #: Rows of tables and numbers of pages, as they were counted while they were written.
    counts: dict[str, int] = field(default_factory=dict)
    #: Seconds of each phase that ran.
    seconds: dict[str, float] = field(default_factory=dict)
    purged: int | None = None
    live: str | None = None

    def whole_pages(self, kind: str) -> DataFrame:
        """path, html of one kind of pages, a row for each. For pages of ordinary length; files are written from blocks."""
        rows = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "html"))), lambda b: b["html"]), "")
        return self.pages[kind].groupBy("path").agg(rows.alias("html"))

    def metrics(self) -> dict[str, int]:
        """How many rows each table and kind of page has, and how many errors there were. What was written was counted then; tables that were only read count their rows now, and pages that weren't written their beginnings."""
        for k, v in {**self.tables, **({"errors": self.errors} if self.errors is not None else {})}.items():
            if k not in self.counts:
                self.counts[k] = v.count()
        for k, v in self.pages.items():
            if k not in self.counts:
                self.counts[k] = v.where("place.section = 0").count()
        return dict(self.counts)

    def log(self, spark: SparkSession) -> DataFrame:
        """The lines of the build's log: errors, numbers, and what each phase took."""
        took = spark.createDataFrame([(f"*** {k} took {v:.1f} s",) for k, v in self.seconds.items()], "line string")
        return sinks.log_lines(self.errors, spark.createDataFrame(sorted(self.metrics().items()), "name string, n long")).unionByName(took)


def observed(rows: DataFrame, n=None) -> tuple[DataFrame, Observation]:
    """``rows``, and what counts them (or ``n``) in the pass that writes them."""
    o = Observation()
    return rows.observe(o, (F.count(F.lit(1)) if n is None else n).alias("n")), o


def check(phases: tuple[str, ...]) -> None:
    unknown = set(phases) - set(PHASES)
    if unknown:
        raise ValueError(f"unknown phases: {sorted(unknown)}")
    if "convert" in phases and "analyse" in phases and "crossreference" not in phases:
        raise ValueError("pages can't be converted from new tables without new references")


def run(
    spark: SparkSession, paths: list[str], store: str, phases: tuple[str, ...] = PHASES, legislation: DataFrame | None = None, courts: list[tuple[str, str]] | None = None, categories: dict[str, list[str]] | None = None,
    out: str | None = None, purge: bool = False, live: str | None = None, drop_store: bool = False, buckets: int = sinks.BUCKETS,
) -> Build:
    """Phases run in their fixed order; what a phase doesn't make anew is read from ``store``, a folder of Parquet tables. Each phase writes its tables there, so a later one, or a
    lost executor, never repeats an earlier one. legislation: legislationid, title, link. ``out``: a folder that each phase writes its pages to; ``purge``: after conversion, pages there that are older than it go; ``live``: at the end
    ``out`` becomes the live version there; ``drop_store``: begin with an empty store."""
    check(phases)
    if (purge or live) and out is None:
        raise ValueError("pages must be written somewhere to be purged or published")
    b, bad = Build(), []
    courts = configured.COURTS if courts is None else courts
    known = configured.frame(spark, courts, categories)
    if drop_store:
        sinks.drop(spark, store)

    def keep(name: str, rows: DataFrame) -> DataFrame:
        rows, n = observed(rows)
        sinks.save_table(rows, f"{store}/{name}")
        b.counts[name] = n.get["n"]
        return load(name)

    def load(name: str) -> DataFrame:
        b.tables[name] = spark.read.parquet(f"{store}/{name}")
        return b.tables[name]

    def by_key(name: str, key: str, rows: DataFrame | None = None) -> DataFrame:
        """The same table in the order that look-ups by a key want."""
        if rows is not None:
            sinks.save_by_key(rows, f"{store}/{name}_by_{key}", key, buckets)
        return sinks.load_by_key(spark, f"{store}/{name}_by_{key}", key)

    def emit(kind: str, blocks: DataFrame) -> None:
        b.pages[kind] = blocks
        if out is not None:
            rows, n = observed(blocks, F.count(F.when(F.col("place.section") == 0, 1)))
            sinks.save_page_blocks(rows, out)
            b.counts[kind] = n.get["n"]

    @contextmanager
    def phase(name: str) -> Iterator[None]:
        began = time.monotonic()
        yield
        b.seconds[name] = time.monotonic() - began

    if "analyse" in phases:
        with phase("analyse"):
            clean = keep("pages", source.analyse(source.scan(spark, *paths)))
            good = clean.where("error is null").select("path", "filename", "value.*")
            near = distance.nearest(good, "court_name", [n for _, n in courts], nearest_col="court")
            # read once for what is kept and once for each kind of error
            near = save(near.join(known.select(F.col("name").alias("court"), "short", "category"), "court"), "near")
            nameless = near.where("category is null").select("path", F.lit("no category has this court").alias("message"))
            near = near.where("category is not null")
            # a judgment is known by its file's name and by its source, wherever the file is
            near, twice = tables.one_per_key(near, "filename", "path")
            near, same_source = tables.one_per_key(near, "source_url", "path")
            # the code that extends "[year] COURT " most cheaply names the page
            target = F.concat(F.lit("["), F.year("date").cast("string"), F.lit("] "), F.col("short"), F.lit(" "))
            cost = distance.weighted_distance(1, 2, 2)
            best = near.select("path", target.alias("t"), F.explode("citations").alias("code")).withColumn("cost", cost("t", "code")).groupBy("path").agg(F.min(F.struct("cost", "code"))["code"].alias("code"))
            base = F.concat(F.lit("/judgments/"), "short", F.lit("/"), F.year("date").cast("string"), F.lit("/"), text.file_name(F.col("code")))
            # file names are all different here, so names can be told by them
            named, unnamed = tables.unique_names(save(near.join(best, "path"), "judgments"), base, "filename")
            judgments = keep("judgments", named.select(F.xxhash64("filename").alias("judgmentid"), "title", "date", F.xxhash64("short").alias("courtid"), "filename", "path", "source_url", "url", "citations", "parties"))
            bridge = judgments.select("judgmentid", F.explode("citations").alias("citationcode"))
            keep("citationcodes", tables.dimension(bridge, "citationcode", key="citationcodeid"))
            bridge = keep("judgmentcodes", tables.with_key(bridge, "citationcode", key="citationcodeid"))
            for key in ("judgmentid", "citationcode"):
                by_key("judgmentcodes", key, bridge)
            by_key("judgments", "judgmentid", judgments.select("judgmentid", "title", "date", "url", "courtid"))
            keep("parties", judgments.select("judgmentid", F.explode("parties").alias("p")).select("judgmentid", "p.position", "p.name"))
            keep("courts", known.select(F.xxhash64("short").alias("courtid"), "name", F.xxhash64("category").alias("courtcategoryid"), F.col("short").alias("abbreviated_name"), F.concat(F.lit("/judgments/"), "short", F.lit("/")).alias("url")))
            keep("courtcategories", tables.dimension(known.where("category is not null").select(F.col("category").alias("name")), "name", key="courtcategoryid"))
            bad.append(sinks.errors(clean, "analyse", F.col("path"), F.col("error")))
            bad += [sinks.errors(r, "analyse", F.col("path"), F.col("message")) for r in (nameless, twice, same_source, unnamed)]
    clean, judgments = load("pages"), load("judgments")
    load("judgmentcodes")
    urls, by_code, by_id = by_key("judgments", "judgmentid"), by_key("judgmentcodes", "citationcode"), by_key("judgmentcodes", "judgmentid")
    # pages that were rejected take no part in what follows
    ids = judgments.select("path", "judgmentid")

    if "crossreference" in phases:
        with phase("crossreference"):
            searched = clean.where("page is not null").select("path", text.search_text(F.col("page")).alias("t"))
            bad.append(sinks.errors(searched.join(ids, "path", "left_anti").withColumn("m", F.lit("no metadata")), "crossreference", F.col("path"), F.col("m")))
            dictionary = by_code.select("citationcode").distinct().withColumn("k", F.col("citationcode"))
            hits = match.hits(searched.join(ids, "path"), "judgmentid", "t", dictionary, "k", "citationcode")
            refs = keep("crossreferences", tables.with_key(tables.without_self(hits, by_code), "citationcode", key="citationcodeid"))
            by_key("crossreferences", "citationcode", refs)

    if "convert" in phases:
        with phase("convert"):
            began = datetime.now()
            load("crossreferences")
            refs = by_key("crossreferences", "citationcode")
            with_id = clean.where("page is not null").join(ids, "path").select("judgmentid", "page")
            if legislation is not None:
                laws = tables.first_by(legislation.select("legislationid", "link", text.violent(F.col("title"), True).alias("k")).where("k <> ''"), F.col("k"), "legislationid").select("k", "link", "legislationid")
                linked = save(match.link_table(with_id, "judgmentid", "page", laws, "k", "link", number_col="legislationid"), "linked")
                keep("lawreferences", linked.select("judgmentid", F.explode("ids").alias("legislationid")))
                with_id = linked.select("judgmentid", "page")
            body = keep("bodies", render.bodies(with_id, "judgmentid", "page"))
            bad.append(sinks.errors(body, "convert", F.col("judgmentid"), F.col("error")))
            court = load("courts").select("courtid", F.col("name").alias("court"), F.col("url").alias("court_url"))
            rows = urls.join(F.broadcast(court), "courtid").join(body.where("error is null").select("judgmentid", "body"), "judgmentid")
            here = rows.select("judgmentid", F.col("url").alias("path"))

            def items(edges: DataFrame, other: str) -> DataFrame:
                """Edges with the path of the page that they stand on; a judgment that very many cite is no task's alone."""
                edges = save(edges, "edges")
                times = edges.groupBy("judgmentid").agg(F.count(F.lit(1)).alias("times"))
                return tables.join_evenly(edges, here.join(times, "judgmentid"), "judgmentid", "times", edges.count()).select("path", "date", F.col(other).alias("id"), "title", "url")

            cited, citing = tables.outgoing(refs, by_code, urls, also=("url",)), tables.incoming(refs, by_code, urls, also=("url",))
            emit("judgments", render.judgment_blocks(rows, tables.codes_of(by_id), items(cited, "target"), items(citing, "source")))
            if purge:
                b.purged = sinks.purge(spark, out, began)

    if "disambiguation" in phases:
        with phase("disambiguation"):
            rows = save(by_code.join(urls, "judgmentid").select("citationcode", "date", F.col("judgmentid").alias("id"), "title", "url"), "owners")
            emit("disambiguation", render.disambiguation_blocks(rows))

    if "indexes" in phases:
        with phase("indexes"):
            court = load("courts").select("courtid", F.col("name").alias("court"), F.col("url").alias("court_url"))
            j = urls.join(F.broadcast(court), "courtid").select("court_url", "date", "judgmentid", "title", "url")
            emit("indexes", render.court_blocks(j, court.select("court", "court_url")).unionByName(render.whole_blocks(render.top_index(known))))

    # each phase replaces its own errors alone
    empty = spark.createDataFrame([], "stage string, key string, message string")
    every = reduce(DataFrame.unionByName, bad, empty)
    n_errors = []
    for stage in PHASES:
        if stage in phases:
            rows, n = observed(every.where(F.col("stage") == stage).drop("stage"))
            sinks.save_table(rows, f"{store}/errors/stage={stage}")
            n_errors.append(n.get["n"])
    if len(n_errors) == len(PHASES):
        b.counts["errors"] = sum(n_errors)
    b.errors = spark.read.schema("key string, message string, stage string").parquet(f"{store}/errors").select("stage", "key", "message")
    if live is not None:
        b.live = sinks.publish(spark, out, live)
    return b


@contextmanager
def profiled(spark: SparkSession, folder: str | None = None) -> Iterator[None]:
    """What the Python functions of the plans within cost, by Spark's own profiler: printed at the end, or written to ``folder``."""
    before = spark.conf.get("spark.sql.pyspark.udf.profiler", None)
    spark.conf.set("spark.sql.pyspark.udf.profiler", "perf")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.pyspark.udf.profiler") if before is None else spark.conf.set("spark.sql.pyspark.udf.profiler", before)
        spark.profile.dump(folder, type="perf") if folder else spark.profile.show(type="perf")
        spark.profile.clear(type="perf")
