"""Column expressions that clean and normalise text. All stay in the JVM and keep nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Control characters that are deleted: all below 0x20 but NUL, 0x04, tab, line feed and carriage return.
DELETED_CONTROLS = "".join(map(chr, [*range(0x01, 0x04), *range(0x05, 0x09), 0x0B, 0x0C, *range(0x0E, 0x20)]))


def limp(s: Column) -> Column:
    """Each run of characters that aren't ASCII letters or digits becomes a space; lower case."""
    return F.lower(F.regexp_replace(s, "[^A-Za-z0-9]+", " "))


def violent(s: Column, ascii_only: bool = False) -> Column:
    """Letters and digits alone, in lower case."""
    return F.lower(F.regexp_replace(s, "[^A-Za-z0-9]+" if ascii_only else r"[^\p{L}\p{N}]+", ""))


def without(s: Column, characters: str) -> Column:
    return F.translate(s, characters, "")


def single_spaces(s: Column) -> Column:
    """A run of white space becomes its first character."""
    return F.regexp_replace(s, r"(\s)\s+", "$1")


def without_tags(s: Column) -> Column:
    """Everything from a < to the next >, or to the end, goes."""
    return F.regexp_replace(s, "<[^>]*>?", "")


def plain(s: Column) -> Column:
    """Text of an HTML string: no tags, and the entities amp, lt, gt and nbsp decoded in one pass, so that &amp;lt; becomes &lt;."""
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(without_tags(s) if entity == "&lt;" else s, F.lit(entity), F.lit(character))
    return s


def stripped(s: Column, characters: str = r"\s ") -> Column:
    return F.regexp_replace(s, f"^[{characters}]+|[{characters}]+$", "")


def tidy_title(s: Column) -> Column:
    """No white space around it, line feeds as spaces, and spaces single."""
    return F.regexp_replace(F.translate(stripped(s), "\n", " "), "  +", " ")


def weak_citation(s: Column) -> Column:
    """A citation code with single spaces, without dots and apostrophes."""
    return F.translate(F.regexp_replace(s, "  +", " "), ".'", "")


def search_text(s: Column) -> Column:
    """A page's text as citation codes are searched in it: dots and apostrophes go, then tags and entities, then repeated white space."""
    return single_spaces(plain(without(s, ".'")))


def law_text(s: Column) -> Column:
    """A page's text as titles of laws are searched in it."""
    return violent(plain(s))


def file_name(code: Column) -> Column:
    """A code as part of a file name."""
    return F.replace(F.replace(code, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("__"))


def disambiguation_file(code: Column) -> Column:
    return F.concat(F.lit("disambiguation_"), file_name(code), F.lit(".html"))


def no_break_to_space(s: Column) -> Column:
    return F.translate(s, " ", " ")


def ascii_references(s: Column) -> Column:
    """Every character beyond ASCII as a numeric character reference."""
    return F.when(s.rlike("[^\\x00-\\x7f]"), F.array_join(F.transform(F.split(s, ""), lambda c: F.when(F.ascii(c) > 127, F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c)), "")).otherwise(s)


def unix_lines(s: Column) -> Column:
    """CR LF and lone CR as LF."""
    return F.translate(F.replace(s, F.lit("\r\n"), F.lit("\n")), "\r", "\n")


def without_controls(s: Column) -> Column:
    return F.translate(s, DELETED_CONTROLS, "")


def from_first_tag(s: Column) -> Column:
    """The text from the first < on; null if there is none."""
    return F.when(F.instr(s, "<") > 0, F.substr(s, F.instr(s, "<")))


def clean_page(s: Column) -> Column:
    return without_controls(unix_lines(from_first_tag(ascii_references(s))))


def escaped(s: Column) -> Column:
    """A text for use in HTML or in a quoted attribute."""
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")), s)


def without_typographic(s: Column, marks: dict[int, str]) -> Column:
    """Typographic marks replaced: ``marks`` as ``decode.smart_marks`` gives them."""
    return reduce(lambda x, m: F.replace(x, F.lit(chr(m[0])), F.lit(m[1])), sorted(marks.items()), s)
