"""Bytes of badly labelled pages to text, and on to clean ASCII HTML."""

from __future__ import annotations

import codecs
import re
from dataclasses import dataclass
from html.entities import codepoint2name

from .text import DELETED_CONTROLS

_BOMS = ((codecs.BOM_UTF32_LE, "utf-32le"), (codecs.BOM_UTF32_BE, "utf-32be"), (codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16le"), (codecs.BOM_UTF16_BE, "utf-16be"))
#: How "<?xm" begins in encodings whose characters aren't single ASCII bytes.
_SIGNATURES = ((b"\x4c\x6f\xa7\x94", "cp037"), (b"\x00\x3c\x00\x3f", "utf-16be"), (b"\x3c\x00\x3f\x00", "utf-16le"), (b"\x00\x00\x00\x3c", "utf-32be"), (b"\x3c\x00\x00\x00", "utf-32le"))
#: An encoding named by the XML declaration that a page begins with, or by the first meta element that has a charset.
_PROLOG = re.compile(r"<\?[^>]*?\bencoding\s*=\s*([\"'])(?P<name>[^\"']*)\1[^>]*\?>")
_META = re.compile(r"<\s*meta\b[^>]*?\bcharset\s*=\s*[\"']?(?P<name>[^\"'\s;>/]+)", re.I)
_WIDE = ("utf-16", "utf-32", "utf_16", "utf_32", "ucs-2", "ucs-4", "iso-10646-ucs-2", "iso-10646-ucs-4", "csunicode", "csucs4")
_DELETE = {ord(c): None for c in DELETED_CONTROLS}


class ConversionError(Exception):
    """A page that can't be processed; the message goes to the error table."""


@dataclass
class Decoded:
    text: str
    encoding: str
    replaced: bool  # whether malformed bytes gave way to replacement characters


def codec(name: str) -> str | None:
    """The Python codec of an encoding's name, common misnomers included. ISO 8859-1 in practice is its superset windows-1252."""
    name = {"macintosh": "mac-roman", "x-sjis": "shift-jis"}.get(name.lower(), name)
    for n in (name, name.replace("-", ""), name.replace("-", "_")):
        try:
            found = codecs.lookup(n).name
            return "cp1252" if found == "iso8859-1" else found
        except (LookupError, ValueError):
            continue
    return None


def sniffed(data: bytes) -> tuple[str, bytes, bool]:
    """What the first bytes say, the data without byte order mark, and whether there was one."""
    for bom, name in _BOMS:
        if data.startswith(bom):
            return name, data[len(bom) :], True
    for start, name in _SIGNATURES:
        if data.startswith(start):
            return name, data, False
    return "ascii", data, False


def declared(data: bytes, first: str) -> str | None:
    text = data.decode(first if first != "ascii" else "latin-1", "replace")
    m = _PROLOG.match(text) or _META.search(text)
    name = m["name"].strip().lower() if m else None
    return first if name and name in _WIDE and first.startswith(("utf-16", "utf-32")) else name


def decode(data: bytes, overrides: tuple[str, ...] = (), salvage: bool = True) -> Decoded:
    """Strict decoding in the order: overrides, declared, sniffed, UTF-8, windows-1252. If none fits, the first of those that were tried serves with replacement characters, ASCII and UTF-8
    only if they were declared or a byte order mark speaks for them."""
    first, body, marked = sniffed(data)
    said = declared(body, first)
    order = list(dict.fromkeys([*overrides, *([said] if said else []), first, "utf-8", "windows-1252"]))
    for name in order:
        c = codec(name)
        if c:
            try:
                return Decoded(body.decode(c), c, False)
            except (UnicodeDecodeError, ValueError):
                continue
    if salvage:
        for name in order:
            c = codec(name)
            if c is None or c == "ascii" and said != "ascii" or c == "utf-8" and said != "utf-8" and not marked:
                continue
            return Decoded(body.decode(c, "replace"), c, True)
    raise ConversionError("can't decode this file")


# What windows-1252 has at 0x91 to 0x97, and what stands for it in ASCII.
SMART = {"\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"', "\u2022": "*", "\u2013": "-", "\u2014": "--"}
#: The marks that windows-1252 has at 0x80 to 0x9F.
MARKS = "".join(bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0))


def smart_marks(to: str) -> dict[int, str]:
    """What stands for typographic marks: "ascii" for quotes, dots and dashes alone; "entities" (numeric where a mark has no name) or "references" for all of MARKS."""
    if to == "ascii":
        return str.maketrans(SMART)
    number = lambda c: f"#x{ord(c):X}"
    if to == "references":
        return str.maketrans({c: f"&{number(c)};" for c in MARKS})
    if to == "entities":
        return str.maketrans({c: f"&{codepoint2name.get(ord(c), number(c))};" for c in MARKS})
    raise ValueError(f"typographic marks can't be turned into {to}")


def without_smart_quotes(text: str, to: str = "ascii") -> str:
    """Typographic marks in ASCII. ``open_page`` does so on request only."""
    return text.translate(smart_marks(to))


def clean(text: str) -> str:
    """ASCII with numeric references, from the first tag on, with LF line ends and without control characters."""
    text = text.encode("ascii", "xmlcharrefreplace").decode("ascii")
    at = text.find("<")
    if at < 0:
        raise ConversionError("there is no HTML in this file")
    return text[at:].replace("\r\n", "\n").replace("\r", "\n").translate(_DELETE)


def open_page(data: bytes, smart_quotes: bool = True, to: str = "ascii") -> str:
    """The clean page; without ``smart_quotes`` typographic marks give way to what ``to`` says (``smart_marks``)."""
    text = decode(data).text
    return clean(text if smart_quotes else without_smart_quotes(text, to))
