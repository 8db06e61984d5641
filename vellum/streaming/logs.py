"""The same rules over streams: access logs as they grow, and new pages as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import titles


def classified(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines with their level, those to drop left out. Works on a stream as on a table, since it looks at one line at a time."""
    return lines.withColumn("level", titles.log_level(F.col(line_col))).where("level is not null")


def watch(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the lines of all log files in ``folder``."""
    return spark.readStream.text(folder)


def levels(lines: DataFrame, time_col: str, window: str = "1 hour", late: str = "10 minutes", line_col: str = "value") -> DataFrame:
    """Numbers of lines by window of time and level; lines later than ``late`` are left out."""
    rows = classified(lines, line_col).withWatermark(time_col, late)
    return rows.groupBy(F.window(time_col, window).alias("w"), "level").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "level", "n")
