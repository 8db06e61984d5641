"""Relations and pages in the shape of the engine's own, derived from the star schema, so that its operators can be run at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import folder  # noqa: F401 - queries take it from here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a judgment: its nation is the court, its customer and market segment are the parties; it has a code of its own and one that
    others may share."""
    o, c, n, r = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    date = F.to_date("o_orderdate")
    year = F.year(date).cast("string")
    neutral = F.concat(F.lit("["), year, F.lit("] "), "n_name", F.lit(" "), F.col("o_orderkey").cast("string"))
    second = F.concat(F.lit("["), year, F.lit("] "), "c_mktsegment", F.lit(" "), (F.col("o_orderkey") % 500).cast("string"))
    title = F.concat("c_name", F.lit(" & Co v. "), "c_mktsegment", F.lit(" Ltd "), neutral, F.lit(" ("), F.date_format(date, "d MMMM yyyy"), F.lit(")"))
    return j.select(F.col("o_orderkey").alias("judgmentid"), date.alias("date"), F.col("n_name").alias("court"), F.col("r_name").alias("category"), title.alias("title"), neutral.alias("neutral"), second.alias("second"))


def codes(j: DataFrame) -> DataFrame:
    """judgmentid, citationcode: the codes of each judgment."""
    return j.select("judgmentid", F.explode(F.array("neutral", "second")).alias("citationcode"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """judgmentid, citedid: distinct pairs of an order and a part's key taken for an order, and each order with itself, as a page always holds its own code."""
    cited = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("judgmentid"), F.col("l_partkey").alias("citedid")).distinct()
    own = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("judgmentid"), F.col("o_orderkey").alias("citedid"))
    return cited.unionByName(own)


#: A judgment's page, with what a build looks for: {title}, {court}, {source}, {codes}, {body} and, in the head, {meta}. It has CRLF line ends, a control character and some text in front.
PAGE = (
    '\ufeff junk <html>\r\n<head>{meta}<title>{title}</title></head><body><table><tr><td align="left"><h1>{court}</h1></td></tr></table><small><i>{source}</i><br>Cite as: {codes}</small>'
    '<hr><p>caf\u00e9\x02 {body}</p><p>&nbsp;</p><ul><li><a href="x">one<li>two</li></a></li></ul><hr>end</body></html>'
)


def filled(template: str, **values: Column) -> Column:
    """A template with columns in place of names in braces."""
    out = []
    for i, part in enumerate(template.replace("}", "{").split("{")):
        out.append(values[part] if i % 2 else F.lit(part))
    return F.concat(*out)


def filled_sql(template: str, **values: str) -> str:
    """The same in SQL."""
    quoted = ["||".join([f"chr({ord(c)})" if c < " " else "'" + c.replace("'", "''") + "'" for c in _runs(part)] or ["''"]) if i % 2 == 0 else values[part] for i, part in enumerate(template.replace("}", "{").split("{"))]
    return "(" + "||".join(quoted) + ")"


def _runs(text: str) -> list[str]:
    """A text cut around its control characters."""
    out = [""]
    for c in text:
        if ord(c) < 32:
            out += [c, ""]
        else:
            out[-1] += c
    return [x for x in out if x]


def files(j: DataFrame) -> DataFrame:
    """A file for each judgment: path, filename and content, in turn as UTF-8, as UTF-16 with a mark, as ISO 8859-1 that the page declares, and as UTF-8 with a mark."""
    n = F.col("judgmentid") % 4
    html = filled(PAGE, meta=F.when(n == 2, '<meta charset="iso-8859-1">').otherwise(""), title=F.replace("title", F.lit("&"), F.lit("&amp;")), court=F.col("court"), source=F.concat(F.lit("http://example.org/"), F.col("judgmentid").cast("string")), codes=F.concat("neutral", F.lit(", "), "second"), body=F.concat("category", F.lit(" &amp; more.")))
    plain = F.translate(html, "\ufeff", "")
    content = F.when(n == 1, F.encode(plain, "UTF-16")).when(n == 2, F.encode(plain, "ISO-8859-1")).when(n == 3, F.encode(html, "UTF-8")).otherwise(F.encode(plain, "UTF-8"))
    name = F.concat(F.col("judgmentid").cast("string"), F.lit(".html"))
    return j.select(F.concat(F.lit("/"), name).alias("path"), name.alias("filename"), content.alias("content"))


#: The same in SQL, to be put in front of a query.
SQL = """
WITH j AS (
    SELECT o_orderkey AS judgmentid, o_orderdate::DATE AS date, n_name AS court, r_name AS category,
        '[' || year(o_orderdate) || '] ' || n_name || ' ' || o_orderkey AS neutral, '[' || year(o_orderdate) || '] ' || c_mktsegment || ' ' || (o_orderkey % 500) AS second,
        c_name || ' & Co v. ' || c_mktsegment || ' Ltd [' || year(o_orderdate) || '] ' || n_name || ' ' || o_orderkey || ' (' || strftime(o_orderdate, '%-d %B %Y') || ')' AS title
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
codes AS (SELECT judgmentid, unnest([neutral, second]) AS citationcode FROM j),
x AS (SELECT DISTINCT l_orderkey AS judgmentid, l_partkey AS citedid FROM lineitem UNION ALL SELECT o_orderkey, o_orderkey FROM orders)
"""
