"""Pages from rows: judgments, pages that tell ambiguous codes apart, and indexes. All are expressions; only the repair of a page's body is Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import decode, html
from ..functions.text import disambiguation_file, escaped
from ..sources.shared import pieces, thrifty
from .tables import join_evenly


def page(title: Column, *body: Column) -> Column:
    return F.concat(F.lit("<!DOCTYPE html>\n<html><head><title>"), escaped(title), F.lit("</title></head>\n<body>\n"), *body, F.lit("\n</body></html>\n"))


def anchor(href: Column, label: Column) -> Column:
    return F.concat(F.lit('<a href="'), escaped(href), F.lit('">'), escaped(label), F.lit("</a>"))


def listing(items: Column, heading: str) -> Column:
    """A heading and a list of items, which are HTML; nothing for an empty or null array."""
    lines = F.array_join(F.transform(items, lambda i: F.concat(F.lit("<li>"), i, F.lit("</li>"))), "\n")
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, F.concat(F.lit(f"<h2>{heading}</h2>\n<ul>\n"), lines, F.lit("\n</ul>\n"))).otherwise("")


def bodies(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Per page: the repaired opinion as HTML (the children of its body), whether lists were mended and empty blocks removed, or an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            rows = []
            for text in b.column(1).to_pylist():
                try:
                    body = html.opinion(html.parse(text or ""))
                    mended, emptied = html.mend_lists(body), html.empty_blocks_to_breaks(body)
                    rows.append(("".join(c.html() if isinstance(c, html.Node) else html.escape(c, quote=False) for c in body.children), mended, emptied, None))
                except decode.ConversionError as e:
                    rows.append((None, None, None, str(e)))
                except Exception as e:  # noqa: BLE001 - like any other failure of a page
                    rows.append((None, None, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.bool_(), pa.string()), strict=True))], [id_col, "body", "mended", "emptied", "error"])

    return pages.select(id_col, html_col).mapInArrow(thrifty(run), f"`{id_col}` {dict(pages.dtypes)[id_col]}, body string, mended boolean, emptied boolean, error string")


def judgment_pages(judgments: DataFrame, codes: DataFrame, outgoing: DataFrame, incoming: DataFrame) -> DataFrame:
    """path, html. judgments: judgmentid, title, date, court, court_url, url, body; codes: judgmentid, codes; the lists: judgmentid and an array of id, date, title, url."""
    link = lambda e: anchor(e["url"], F.concat(e["title"], F.lit(" ("), e["date"].cast("string"), F.lit(")")))
    rows = judgments.join(codes, "judgmentid", "left").join(outgoing, "judgmentid", "left").join(incoming, "judgmentid", "left")
    head = F.concat(F.lit("<h1>"), escaped(F.col("title")), F.lit("</h1>\n<p>"), F.col("date").cast("string"), F.lit(" "), escaped(F.coalesce("codes", F.lit(""))), F.lit("</p>\n<p>"), anchor(F.col("court_url"), F.col("court")), F.lit("</p>\n"))
    lists = F.concat(listing(F.transform("outgoing", link), "Cases cited"), listing(F.transform("incoming", link), "Cited by"))
    return rows.select(F.col("url").alias("path"), page(F.col("title"), head, F.coalesce("body", F.lit("")), lists).alias("html"))


def _blocks(rows: DataFrame, path: Column, section: int, html: Column, *order: Column) -> DataFrame:
    """Blocks of pages: path, place (section, then up to four numbers) and html."""
    numbers = [c.cast("bigint") for c in order] + [F.lit(0).cast("bigint")] * (4 - len(order))
    return rows.select(path.alias("path"), F.struct(F.lit(section).alias("section"), *(n.alias(f"n{i}") for i, n in enumerate(numbers))).alias("place"), html.alias("html"))


_HEAD = "<!DOCTYPE html>\n<html><head><title>"
_FOOT = "\n</body></html>\n"


def _opening(title: Column) -> Column:
    return F.concat(F.lit(_HEAD), escaped(title), F.lit("</title></head>\n<body>\n"))


def _item(href: Column, label: Column) -> Column:
    return F.concat(F.lit("<li>"), anchor(href, label), F.lit("</li>\n"))


def _list_blocks(items: DataFrame, section: int, heading: str) -> DataFrame:
    """A heading, the items (path, date, id, title, url) in order of date and id, and the end of the list, for each path that has any."""
    some = items.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    label = F.concat("title", F.lit(" ("), F.col("date").cast("string"), F.lit(")"))
    first = _blocks(some, F.col("path"), section, F.lit(f"<h2>{heading}</h2>\n<ul>\n"))
    return first.unionByName(_blocks(items, F.col("path"), section + 1, _item(F.col("url"), label), F.unix_date("date"), F.col("id"))).unionByName(_blocks(some, F.col("path"), section + 2, F.lit("</ul>\n")))


def judgment_rows(judgments: DataFrame, codes: DataFrame, items: DataFrame, others: DataFrame, url: Callable[[Column], Column]) -> DataFrame:
    """The pages of ``judgment_pages`` in blocks, path and html, all of a page in one task and in order. What moves to a page's task is a row for each item, without markup: it is rendered there, and a list begins and ends where the section of rows does.
    items: judgmentid (whose page it stands on), section (1: cited there, 2: citing), id; those on pages of no judgment are left out. others: judgmentid, date, title of ids. url: of an id. No row and no task holds a whole page."""
    top = judgments.join(codes, "judgmentid", "left").select("judgmentid", F.lit(0).alias("section"), F.lit(None).cast("bigint").alias("id"), "date", "title", "codes", "court", "court_url", "body")
    none = {c: F.lit(None).cast("string") for c in ("codes", "court", "court_url", "body")}
    items = items.join(others.select(F.col("judgmentid").alias("id"), "date", "title"), "id").withColumns(none)
    w = W.partitionBy("judgmentid").orderBy("section", F.unix_date("date"), "id")
    begins = F.lag("section").over(w) != F.col("section")
    after = F.lead("section").over(w)
    # the row of the page itself comes first
    owned = F.first("section").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)) == 0
    rows = top.unionByName(items).withColumns({"begins": begins, "after": after, "owned": owned}).where("owned")
    date = F.col("date").cast("string")
    head = F.concat(F.lit("<h1>"), escaped(F.col("title")), F.lit("</h1>\n<p>"), date, F.lit(" "), escaped(F.coalesce("codes", F.lit(""))), F.lit("</p>\n<p>"), anchor(F.col("court_url"), F.col("court")), F.lit("</p>\n"))
    page_ = F.concat(_opening(F.col("title")), head, F.coalesce("body", F.lit("")))
    item = _item(url(F.col("id")), F.concat("title", F.lit(" ("), date, F.lit(")")))
    listed = F.concat(
        F.when(F.col("begins"), F.concat(F.lit("<h2>"), F.when(F.col("section") == 1, "Cases cited").otherwise("Cited by"), F.lit("</h2>\n<ul>\n"))).otherwise(""),
        F.coalesce(item, F.lit("")),
        F.when(F.col("after") == F.col("section"), "").otherwise("</ul>\n"),
    )
    html_ = F.concat(F.when(F.col("section") == 0, F.coalesce(page_, F.lit(""))).otherwise(listed), F.when(F.col("after").isNull(), _FOOT).otherwise(""))
    return rows.select(url(F.col("judgmentid")).alias("path"), html_.alias("html"))


def judgment_blocks(judgments: DataFrame, codes: DataFrame, outgoing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The pages of ``judgment_pages`` in blocks: path, place, html. The two lists have a row for each item: path of the page that it stands on, date, id, title, url; so a judgment that very many cite is no row of its own."""
    head = F.concat(F.lit("<h1>"), escaped(F.col("title")), F.lit("</h1>\n<p>"), F.col("date").cast("string"), F.lit(" "), escaped(F.coalesce("codes", F.lit(""))), F.lit("</p>\n<p>"), anchor(F.col("court_url"), F.col("court")), F.lit("</p>\n"))
    rows = judgments.join(codes, "judgmentid", "left")
    top = _blocks(rows, F.col("url"), 0, F.concat(_opening(F.col("title")), head, F.coalesce("body", F.lit(""))))
    end = _blocks(judgments, F.col("url"), 9, F.lit(_FOOT))
    return top.unionByName(_list_blocks(outgoing, 1, "Cases cited")).unionByName(_list_blocks(incoming, 4, "Cited by")).unionByName(end)


def court_blocks(judgments: DataFrame, courts: DataFrame) -> DataFrame:
    """The pages of ``court_indexes`` in blocks: path, place, html. judgments: court_url, date, judgmentid, title, url, a row each; courts: court, court_url. So a court of very many judgments is no row of its own."""
    path, year, month = F.concat("court_url", F.lit("index.html")), F.year("date"), F.month("date")
    with_ = courts.join(judgments.select("court_url").distinct(), "court_url", "left_semi")
    months = judgments.groupBy("court_url", year.alias("y"), month.alias("m")).agg(F.min("date").alias("day"))
    heading = F.concat(F.lit('<h2 id="'), F.col("y").cast("string"), F.lit("-"), F.col("m").cast("string"), F.lit('">'), F.date_format("day", "MMMM yyyy"), F.lit("</h2>\n<ul>\n"))
    # within the section of months: a heading, its judgments newest first, the end of the list
    when = F.col("y") * 12 + F.col("m")
    out = _blocks(with_, path, 0, _opening(F.col("court"))).unionByName(_blocks(with_, path, 2, F.lit(_FOOT)))
    out = out.unionByName(_blocks(months, path, 1, heading, -when, F.lit(0))).unionByName(_blocks(months, path, 1, F.lit("</ul>\n"), -when, F.lit(2)))
    return out.unionByName(_blocks(judgments, path, 1, _item(F.col("url"), F.col("title")), -(year * 12 + month), F.lit(1), -F.unix_date("date"), -F.col("judgmentid")))


def disambiguation_blocks(rows: DataFrame, prefix: str = "/judgments/") -> DataFrame:
    """The pages of ``disambiguation_pages`` in blocks, for codes that more than one judgment has. rows: citationcode, date, id, title, url, a row for each judgment and code; read several times."""
    n = rows.groupBy("citationcode").agg(F.count(F.lit(1)).alias("n"), F.count("url").alias("times")).where("n > 1 and times > 0").select("citationcode", "times")
    path = F.concat(F.lit(prefix), disambiguation_file(F.col("citationcode")))
    first = F.concat(_opening(F.col("citationcode")), F.lit("<h2>Judgments with this citation</h2>\n<ul>\n"))
    items = join_evenly(rows.where("url is not null"), n, "citationcode", "times", rows.count())
    out = _blocks(n, path, 0, first).unionByName(_blocks(n, path, 2, F.lit("</ul>\n" + _FOOT)))
    return out.unionByName(_blocks(items, path, 1, _item(F.col("url"), F.col("title")), -F.unix_date("date"), -F.col("id")))


def whole_blocks(pages: DataFrame) -> DataFrame:
    """Pages of one row each (path, html) as blocks."""
    return _blocks(pages, F.col("path"), 0, F.col("html"))


def disambiguation_pages(ambiguous: DataFrame, prefix: str = "/judgments/") -> DataFrame:
    """path, html. ambiguous: citationcode and rows, an array of date, id, title, url, newest first; codes none of whose judgments has a URL give no page."""
    items = F.transform(F.filter("rows", lambda r: r["url"].isNotNull()), lambda r: anchor(r["url"], r["title"]))
    return ambiguous.where(F.size(items) > 0).select(F.concat(F.lit(prefix), disambiguation_file(F.col("citationcode"))).alias("path"), page(F.col("citationcode"), listing(items, "Judgments with this citation")).alias("html"))


def court_indexes(months: DataFrame, courts: DataFrame) -> DataFrame:
    """path, html: a page per court with its judgments by month, newest first. months: as ``tables.by_month`` gives them, rows with a url; courts: court, court_url."""
    items = F.transform("rows", lambda r: F.concat(F.lit("<li>"), anchor(r["url"], r["title"]), F.lit("</li>")))
    block = F.concat(F.lit('<h2 id="'), "anchor", F.lit('">'), "heading", F.lit("</h2>\n<ul>\n"), F.array_join(items, "\n"), F.lit("\n</ul>\n"))
    one = months.select("court", F.struct((-F.col("year")).alias("y"), (-F.col("month")).alias("m"), block.alias("block")).alias("b"))
    pages = one.groupBy("court").agg(F.array_join(F.transform(F.sort_array(F.collect_list("b")), lambda x: x["block"]), "").alias("blocks"))
    return pages.join(courts, "court").select(F.concat("court_url", F.lit("index.html")).alias("path"), page(F.col("court"), F.col("blocks")).alias("html"))


def top_index(courts: DataFrame, path: str = "index.html") -> DataFrame:
    """path, html of the page that lists all configured courts by category, those without judgments too. courts: as ``plans.courts.frame`` gives them."""
    line = F.concat(F.lit('<div class="row">'), anchor(F.concat(F.lit("/judgments/"), "short", F.lit("/")), F.col("name")), F.lit("</div>\n"))
    block = courts.where("category is not null").groupBy("category_order", "category").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", line.alias("line")))), lambda x: x["line"]), "").alias("lines"))
    block = block.select(F.struct("category_order", F.concat(F.lit("<h2>"), escaped(F.col("category")), F.lit("</h2>\n"), "lines").alias("html")).alias("b"))
    return block.agg(F.array_join(F.transform(F.sort_array(F.collect_list("b")), lambda x: x["html"]), "").alias("all")).select(F.lit(path).alias("path"), page(F.lit("Courts"), F.col("all")).alias("html"))


def includes(html: Column, parts: dict[str, str]) -> Column:
    """A page with each <esi:include src="name" /> replaced by the part of that name, and those of other names by nothing. Parts aren't searched for includes themselves."""
    mark = "\x00"
    pieces = F.split(F.regexp_replace(html, r'<esi:include\s+src="([^"]*)"\s*/>', f"{mark}$1{mark}"), mark)
    named = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]) if parts else None
    # every other piece is a name
    part = lambda name: F.coalesce(named[name], F.lit("")) if parts else F.lit("")
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 0, p).otherwise(part(p))), "")
