"""Pages of judgments in archives, made in rounds, so that only a round's share of what is shuffled for them lies on disk at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import render, tables
from ..sources import sinks
from ..sources.shared import shuffles_freed

#: So many rows of pages a round shuffles, but for a page that has more. A row takes some 50 bytes of disk.
ROUND = 1 << 27


def save_judgments(judgments: DataFrame, bridge: DataFrame, edges: DataFrame, folder: str, url: Callable[[Column], Column], most: int | None = None) -> int:
    """Write the pages of ``render.judgment_pages`` into streams below a folder (``pages.streamed`` reads them), and say in how many rounds. judgments: judgmentid, title, date, court, court_url, body; bridge: judgmentid, citationcode; edges: judgmentid, id (``tables.resolved``). The
    tables are read once for each round, so they should be stored. Pages are dealt over rounds by their ids."""
    spark = judgments.sparkSession
    fs, p = sinks.file_system(spark, folder)
    fs.mkdirs(p)
    with shuffles_freed(spark):
        n = -(-(2 * edges.count() + judgments.count()) // (most or ROUND)) or 1
        for r in range(n):
            share = (F.pmod(F.xxhash64("judgmentid"), F.lit(n)) == r) if n > 1 else F.lit(True)
            cited = edges.select("judgmentid", F.lit(1).alias("section"), "id").where(share)
            citing = edges.select(F.col("id").alias("judgmentid"), F.lit(2).alias("section"), F.col("judgmentid").alias("id")).where(share)
            rows = render.judgment_rows(judgments.where(share), tables.codes_of(bridge.where(share)), cited.unionByName(citing), judgments, url)
            sinks.save_streams(rows, f"{folder.rstrip('/')}/{r}")
    return n
