"""python -m vellum STORE PATH...: a build from the command line, with a flag for each phase to be left out."""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from pyspark.sql import SparkSession

from .plans import build
from .sources import pages


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("vellum", description="Build tables and linked pages from a collection of judgments.")
    p.add_argument("store", help="folder of the tables")
    p.add_argument("paths", nargs="*", help="folders of pages, or pages")
    for name in build.PHASES:
        p.add_argument(f"--no-{name}", action="store_true", help=f"leave out the phase {name}")
    p.add_argument("--legislation", help="address of the feeds of laws, with %%d for the year; without it no laws are linked")
    p.add_argument("--years", nargs=2, type=int, default=(1801, 2011), help="first and last year of the feeds")
    p.add_argument("--out", help="folder that pages are written to")
    p.add_argument("--delete-html", action="store_true", help="delete pages in it that are older than this conversion")
    p.add_argument("--live", help="folder that the pages are published to at the end")
    p.add_argument("--delete-db", action="store_true", help="begin with an empty store")
    p.add_argument("--profile", metavar="FOLDER", help="write there what Python functions cost")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None, **options) -> build.Build:
    p = parser()
    a = p.parse_args(arguments)
    phases = tuple(n for n in build.PHASES if not getattr(a, f"no_{n}"))
    if "analyse" in phases and not a.paths:
        p.error("there are no pages to analyse")
    spark = spark or SparkSession.builder.appName("vellum").getOrCreate()
    laws = pages.feeds(spark, a.legislation, *a.years) if a.legislation else None
    with build.profiled(spark, a.profile) if a.profile else nullcontext():
        done = build.run(spark, a.paths, a.store, phases, laws, out=a.out, purge=a.delete_html, live=a.live, drop_store=a.delete_db, **options)
        for r in done.log(spark).toLocalIterator():
            print(r.line)
    return done


if __name__ == "__main__":
    main()
