"""Column expressions over titles, citations, pages and requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

YEAR = r"[\[(][12]\d{3}[\])]"


def page_title(html: Column) -> Column:
    """The text of the first title element before its first child, tidied; null if there is none."""
    return F.when(html.rlike("(?i)<title[^>]*>"), text.tidy_title(F.regexp_extract(html, "(?is)<title[^>]*>([^<]*)", 1)))


def host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/:?#]+)", 1)


def respelt_host(h: Column, wrong: str, right: str) -> Column:
    """The host that a misspelt one is redirected to; null where it is spelt well."""
    return F.when(F.contains(h, F.lit(wrong)), F.replace(h, F.lit(wrong), F.lit(right)))


def index_path(path: Column) -> Column:
    """A path without an extension of two to four characters gets index.html behind it."""
    return F.when(path.rlike(r"\.[A-Za-z0-9]{2,4}$"), path).otherwise(F.concat(path, F.when(F.endswith(path, F.lit("/")), "").otherwise("/"), F.lit("index.html")))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), 1)


def breaks_for_empty_blocks(html: Column) -> Column:
    """Paragraphs and quotes without anything in them become line breaks."""
    return F.regexp_replace(html, r"(?i)<(p|blockquote)(?: [^>]*)?>(?:[\s ]|&nbsp;)*</\1>", "<br/>")


def between_marks(html: Column, mark: str) -> Column:
    """What stands between the first and the last mark; empty with fewer than two marks."""
    parts = F.split(html, mark)
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 2, F.size(parts) - 2), mark)).otherwise("")


def year_part(title: Column) -> Column:
    """The title from its first year in square brackets on, semicolons as line feeds; null without one."""
    return F.when(title.rlike(r"\[[12]\d{3}\]"), F.translate(F.regexp_extract(title, r"(?s)(\[[12]\d{3}\].*)$", 1), ";", "\n"))


def party_list(title: Column) -> Column:
    """Structs of position and name. Position 1 is what stands after " v ", 2 what stands before it: this inversion is kept, since stored tables rely on it.
    The title is cut at its first [; " v. " counts as " v "; without " v " there are no parties. Names after it are split at a literal &amp;, names before it at &."""
    head = F.replace(F.substring_index(title, "[", 1), F.lit(" v. "), F.lit(" v "))
    at = F.instr(head, " v ")
    before, after = F.substr(head, F.lit(1), at - 1), F.substr(head, at + 3)

    def named(position: int, side: Column, mark: str) -> Column:
        return F.transform(F.split(side, mark), lambda n: F.struct(F.lit(position).alias("position"), text.stripped(n).alias("name")))

    return F.when(at > 0, F.concat(named(1, after, "&amp;"), named(2, before, "&")))


def date_candidates(title: Column) -> Column:
    """Texts in parentheses that may be dates, and the last three words of the title if they look like one."""
    last = F.regexp_extract(title, r"([0-9]+ [A-Za-z]+ [0-9]+)[^0-9]*$", 1)
    return F.concat(F.regexp_extract_all(title, F.lit(r"\W\(([^()]*)(?:$|\))"), 1), F.array(last))


def parsed_date(s: Column) -> Column:
    """A date from the usual ways to write one; what is missing of day and month counts as 1, so that results don't depend on the day of the run. Month first in 1/2/2001 unless the first is no month; years of two
    digits from 69 on are of the last century."""
    plain = F.to_date(F.try_to_timestamp(s, F.lit("d MMMM yyyy")))
    return F.coalesce(plain, once(_plain_words(s), lambda w: once(_full_year_last(w), _by_formats)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often ``use`` has it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _plain_words(s: Column) -> Column:
    """Numbers and months with single spaces between them."""
    s = F.regexp_replace(F.translate(F.trim(s), ",./-", "    "), "(?i)([0-9])(?:st|nd|rd|th)\\b", "$1")
    s = F.regexp_replace(s, r"(?i)\b((mon|tues|wednes|thurs|fri|satur|sun)day|mon|tue|wed|thu|fri|sat|sun|of|day)\b", " ")
    return F.regexp_replace(F.initcap(F.trim(F.regexp_replace(s, r"\s+", " "))), r"\bSept\b", "Sep")


def _full_year_last(s: Column) -> Column:
    """The year at the end, in four digits, and the month before the day where both are numbers."""
    s = F.regexp_replace(s, r"^(\d{4}) (\S+) (\d{1,2})$", "$2 $3 $1")
    s = F.regexp_replace(s, r"^(3[2-9]|[4-9]\d) ([A-Z]\S+) (\d{1,2})$", "$2 $3 $1")
    s = F.regexp_replace(s, r"^(\d{1,2} \S+|[A-Z]\S+ \d{1,2}) (69|[7-9]\d)$|^([A-Z]\S+) (69|[7-9]\d)$", "$1$3 19$2$4")
    s = F.regexp_replace(s, r"^(\d{1,2} \S+|[A-Z]\S+ \d{1,2}) (\d\d)$|^([A-Z]\S+) (3[2-9]|[4-9]\d)$", "$1$3 20$2$4")
    return F.regexp_replace(s, r"^(1[3-9]|[2-9]\d) (\d{1,2}) (\d{4})$", "$2 $1 $3")


def _by_formats(s: Column) -> Column:
    formats = ("d MMMM yyyy", "d MMM yyyy", "MMMM d yyyy", "MMM d yyyy", "M d yyyy", "MMMM yyyy", "MMM yyyy")
    tried = [F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in formats]
    return F.coalesce(*tried, F.when(s.rlike("^[12][0-9]{3}$"), F.to_date(F.try_to_timestamp(s, F.lit("yyyy")))))


def title_date(title: Column) -> Column:
    """The first candidate that is a date."""
    dates = F.transform(date_candidates(title), parsed_date)
    return F.element_at(F.concat(F.filter(dates, lambda d: d.isNotNull()), F.array(F.lit(None).cast("date"))), 1)


def log_level(line: Column) -> Column:
    """debug, or warning for requests over HTTP/1.1 that failed and don't come from a crawler; null for lines to drop, those without referrer and agent."""
    # Crawlers whose failures don't matter.
    crawlers = "Googlebot|bingbot|baidu|ahrefs|YandexBot"
    failed = line.rlike('HTTP/1.1" [45][0-9][0-9] ') & ~line.rlike(crawlers)
    return F.when(~F.contains(line, F.lit('"-" "-"')), F.when(failed, "warning").otherwise("debug"))
