"""The relational side: dimensions, look-ups, names, and what was rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text


def dimension(rows: DataFrame, *cols: str, key: str) -> DataFrame:
    """The distinct values of ``cols`` with a key that depends on the values alone: a 64-bit hash, so no numbering in one place is needed."""
    return rows.select(*cols).distinct().select(F.xxhash64(*cols).alias(key), *cols)


def with_key(rows: DataFrame, *cols: str, key: str) -> DataFrame:
    """Rows with the key of their dimension; the dimension itself needn't be joined."""
    return rows.withColumn(key, F.xxhash64(*cols))


def without_match(rows: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    return rows.join(other, on, "left_anti")


#: A key counts as hot if more than one row in so many has it, so there are never more hot keys than that.
HOT = 10_000


def join_evenly(rows: DataFrame, per_key: DataFrame, on: str, times: str, total: int) -> DataFrame:
    """``rows`` (``total`` of them) with what ``per_key`` has for their key: one row for each key, ``times`` saying how many of the rows have it (dropped). Hot keys are sent to every task, HOT of them
    at most, and their rows stay where they are; the rest meet by a shuffle, in which no key has more than one row in HOT. What ``per_key`` holds for a key must be of bounded size."""
    most = max(total // HOT, 1)
    hot, cold = per_key.where(F.col(times) > most).drop(times), per_key.where(F.col(times) <= most).drop(times)
    rest = rows.join(F.broadcast(hot.select(on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


def first_by(rows: DataFrame, key: Column, *order: str) -> DataFrame:
    """Of the rows with the same key the first."""
    return rows.withColumn("__key", key).withColumn("__n", F.row_number().over(W.partitionBy("__key").orderBy(*order))).where("__n = 1").drop("__key", "__n")


def unique_names(rows: DataFrame, base: Column, order: str, name_col: str = "url", most: int = 99) -> tuple[DataFrame, DataFrame]:
    """Rows with a name of their own, base.html or base_1.html up to base_99.html, given in order of ``order``, which no two rows share; and the rows for which no name was left. Each task passes on the first rows of
    a base alone, so a base that very many rows have isn't sorted in one place; the others are those that aren't among the named."""
    named = rows.withColumn("__base", base).withColumn("__n", F.row_number().over(W.partitionBy("__base").orderBy(order))).where(F.col("__n") <= most + 1)
    suffix = F.when(F.col("__n") > 1, F.concat(F.lit("_"), (F.col("__n") - 1).cast("string"))).otherwise("")
    good = named.withColumn(name_col, F.concat("__base", suffix, F.lit(".html"))).drop("__base", "__n")
    bad = rows.join(named.select(order), order, "left_anti").withColumn("message", F.lit("can't give this a file name"))
    return good, bad


def one_per_key(rows: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and the later ones as rejected."""
    n = rows.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(order)))
    return n.where("__n = 1").drop("__n"), n.where("__n > 1").drop("__n").withColumn("message", F.lit(f"another has this {key}"))


def codes_of(bridge: DataFrame, id_col: str = "judgmentid", code_col: str = "citationcode", out: str = "codes") -> DataFrame:
    """Each judgment's codes in order, joined by commas."""
    return bridge.groupBy(id_col).agg(F.array_join(F.sort_array(F.collect_list(code_col)), ", ").alias(out))


def ambiguous(bridge: DataFrame, id_col: str = "judgmentid", code_col: str = "citationcode") -> DataFrame:
    """Codes that more than one judgment has: code, n, the ids in order joined by commas, and the name of the page that tells them apart."""
    many = bridge.groupBy(code_col).agg(F.count(id_col).alias("n"), F.sort_array(F.collect_list(id_col)).alias("__ids")).where("n > 1")
    return many.select(code_col, "n", F.array_join(F.transform("__ids", lambda i: i.cast("string")), ",").alias("ids"), text.disambiguation_file(F.col(code_col)).alias("file"))


def without_self(refs: DataFrame, bridge: DataFrame, id_col: str = "judgmentid", code_col: str = "citationcode") -> DataFrame:
    """References other than those of a judgment to a code of its own."""
    return refs.join(bridge.select(id_col, code_col), [id_col, code_col], "left_anti")


def outgoing(refs: DataFrame, bridge: DataFrame, judgments: DataFrame, distinct: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """judgmentid, target, date, title and what ``also`` names of the target: which judgments each cites. A code that several have counts for all of them, and one that is cited by two of its codes
    comes twice unless ``distinct`` is set."""
    target = bridge.select("citationcode", F.col("judgmentid").alias("target"))
    out = refs.select("judgmentid", "citationcode").join(target, "citationcode").join(judgments.select(F.col("judgmentid").alias("target"), "date", "title", *also), "target")
    out = out.select("judgmentid", "target", "date", "title", *also)
    return out.distinct() if distinct else out


def incoming(refs: DataFrame, bridge: DataFrame, judgments: DataFrame, distinct: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """judgmentid, source, date, title and what ``also`` names of the source: which judgments cite each."""
    own = bridge.select("citationcode", "judgmentid")
    cites = refs.select(F.col("judgmentid").alias("source"), "citationcode")
    out = cites.join(own, "citationcode").join(judgments.select(F.col("judgmentid").alias("source"), "date", "title", *also), "source").select("judgmentid", "source", "date", "title", *also)
    return out.distinct() if distinct else out


def resolved(refs: DataFrame, bridge: DataFrame) -> DataFrame:
    """judgmentid, id: what ``outgoing`` and ``incoming`` are of, as ids alone."""
    return refs.select("judgmentid", "citationcode").join(bridge.select("citationcode", F.col("judgmentid").alias("id")), "citationcode").select("judgmentid", "id")


def listed(edges: DataFrame, other: str, out: str) -> DataFrame:
    """A judgment's edges in order of date and id, as an array."""
    return edges.groupBy("judgmentid").agg(F.transform(F.sort_array(F.collect_list(F.struct("date", other, "title"))), lambda e: F.struct(e[other].alias("id"), e["date"].alias("date"), e["title"].alias("title"))).alias(out))


def by_month(judgments: DataFrame, court_col: str = "court") -> DataFrame:
    """Per court and month: its heading, id, n, and the judgments newest first."""
    d = F.col("date")
    g = judgments.groupBy(court_col, F.year(d).alias("year"), F.month(d).alias("month")).agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("__day"), F.sort_array(F.collect_list(F.struct("date", F.negative("judgmentid").alias("k"), "title")), asc=False).alias("rows"))
    return g.select(court_col, "year", "month", F.date_format("__day", "MMMM yyyy").alias("heading"), F.concat(F.col("year").cast("string"), F.lit("-"), F.col("month").cast("string")).alias("anchor"), "n", "rows")
