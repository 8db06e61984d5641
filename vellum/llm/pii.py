"""Personal data in texts: plain identifiers, and identifiers in disguise, with their places in the source text.

Plain identifiers are found by four patterns. For the disguised ones a text goes through transducers, each of which
rewrites it and keeps, for every character it puts out, the span of source characters that it stands for:

* ``fold``: characters that look like ASCII ones become those, digits of any script become 0-9, and characters
  without width vanish;
* ``spell``: spelled digits become digits, also single ones and those among figures, "plus" before a digit becomes ``+``;
* ``undisguise``: "(at)", "[dot]", " at ... dot " and the like become ``@`` and ``.``.

The same patterns then run over the rewritten text, and what they find there in rewritten places is mapped back. Whether a
spelled digit beside a number belongs to it can't be told, so a text with such words is rewritten in several ways, the patterns
reject by length and Luhn, and findings that overlap become one span: a phone or card may take in a digit word that stands beside
it. One word again and again, without a figure, is no card.
Only texts with a trace of a disguise are rewritten.

Defined results: a null text counts as empty; an empty text has no spans and the digest of the empty string. Texts
are read whole. Plain spans of a kind never overlap, nor do disguised ones. Plain spans stay; a disguised span is dropped
only if it lies wholly within a plain one of its kind, and one that reaches beyond it is added. Repeated rows get equal results, an empty table an empty one. Only the named
columns are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .streams import thrifty

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """The pattern's leftmost matches that don't overlap. Every match has its @ behind a run of local characters, so
    it is tried there only, from the run's start or the last match's end."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def identifiers(text: str) -> dict[str, list[Span]]:
    """The plain identifiers of each kind."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if _DIGIT.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(y := x.lstrip("0")) < 4 and int(y or "0") <= 255 for x in m[0].split("."))]
        out["card"] = [m.span() for m in _CARD.finditer(text) if 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


class View:
    """A rewritten text; its character i stands for source characters start[i] to end[i]. changed[i]: it was rewritten."""

    def __init__(self, text: str, start: list[int] | None = None, end: list[int] | None = None, changed: list[bool] | None = None):
        self.text = text
        self.start = list(range(len(text))) if start is None else start
        self.end = list(range(1, len(text) + 1)) if end is None else end
        self.changed = [False] * len(text) if changed is None else changed

    def rewrite(self, edits: list[tuple[int, int, list[tuple[str, int, int]]]]) -> View:
        """edits: in order, a span of this view and what it becomes: characters, each with the part of this view that it
        stands for."""
        if not edits:
            return self
        text, start, end, changed, at = [], [], [], [], 0
        for a, b, chars in edits:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            changed += self.changed[at:a]
            for c, x, y in chars:
                text.append(c)
                start.append(self.start[x])
                end.append(self.end[y - 1])
                changed.append(True)
            at = b
        text.append(self.text[at:])
        return View("".join(text), start + self.start[at:], end + self.end[at:], changed + self.changed[at:])


# Letters of other scripts that look like ASCII letters, each followed by its look-alike.
LOOKALIKES = (
    "аaеeоoрpсcуyхxіiјjѕsһhԁdԛqԝwкkмmтt"
    "АAВBЕEІIЈJКKМMНHОOРPСCЅSТTУYХX"
    "οoνvιiκkρpυuαa"
    "ΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX"
)
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# Other marks and what they stand for.
MARKS = {"@": "＠﹫", ".": "․。．﹒", "-": "‐‑‒–—―−﹣－", "+": "＋﹢", " ": "      　"}
# Digits from zero to nine in four languages.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)


@cache
def folding() -> tuple[dict[str, str], re.Pattern[str]]:
    fold = {chr(c): str(unicodedata.decimal(chr(c))) for c in range(128, 0x1FBFA) if unicodedata.category(chr(c)) == "Nd"}
    fold |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
    fold |= dict(zip(LOOKALIKES[::2], LOOKALIKES[1::2], strict=True))
    fold |= {x: c for c, xs in MARKS.items() for x in xs} | dict.fromkeys(INVISIBLE, "")
    return fold, re.compile("[" + "".join(sorted(map(re.escape, fold))) + "]")


@cache
def spelled() -> tuple[dict[str, str], re.Pattern[str], re.Pattern[str], re.Pattern[str]]:
    """Of texts in lower case: the words' digits, one word, a run of them with the gaps to digits beside it, and a word that touches what a number is made of."""
    value = {w: str(i) for words in DIGIT_WORDS for i, w in enumerate(words.split())}
    some = "|".join(sorted(value, key=lambda w: (-len(w), w)))
    one = rf"(?<![^\W\d])(?:{some})(?![^\W\d])"
    run = re.compile(rf"(?P<left>(?<=[0-9])[ ,-]{{1,2}}|(?<=\+)[ ]{{1,2}})?(?P<words>{one}(?:[ ,-]{{1,2}}{one})*)(?P<right>[ ,-]{{1,2}}(?=[0-9]))?")
    touching = re.compile(rf"{one}(?:[ ().,-]{{0,3}}[0-9]|[ ().,-]{{1,3}}{one})|[0-9+][ ().,-]{{0,3}}{one}|\bplus\s+{one}")
    return value, re.compile(one), run, touching


def lower(text: str) -> str:
    """The text in lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(x := c.lower()) != 1 else x for c in text)


_DOT_WORD = re.compile(r"\bdot\b", re.I)
_DOT_AFTER = re.compile(r"\s+dot\b")
_WORD = re.compile(r"[^\W\d_]+")
_PLUS = re.compile(r"\bplus\s+(?=[0-9])", re.I)
# without the spaces around them, which would be tried again from each space of a long run
_AT = re.compile(r"[(\[{<]\s*(?:at|@)\s*[)\]}>]", re.I)
_DOT = re.compile(r"[(\[{<]\s*(?:dot|\.)\s*[)\]}>]", re.I)
_PLAIN_AT = re.compile(r"(?<=[A-Za-z0-9._%+-])\s+at\s+(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\s+dot\s+[A-Za-z0-9-])", re.I)
_PLAIN_DOT = re.compile(r"(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])", re.I)


def fold(v: View) -> View:
    table, found = folding()
    return v.rewrite([(m.start(), m.end(), [(c, m.start(), m.end()) for c in table[m[0]]]) for m in found.finditer(v.text)])


def spell(v: View, how: str) -> View:
    """``words``: words beside others, or next to "dot", become digits. ``inner``: words between digits do, and the gaps to these go.
    ``all``: all words do, and the gaps to digits beside them go."""
    value, one, run, _ = spelled()
    edits, low = [], lower(v.text)
    for m in run.finditer(low):
        a, b = m.span("words")
        words = [(value[w[0]], w.start(), w.end()) for w in one.finditer(low, a, b)]
        if how == "words":
            if len(words) > 1 or _DOT_AFTER.match(low, b) or low[max(0, a - 5) : a].endswith("dot ") and _DOT_WORD.match(low, a - 4):
                edits.append((a, b, words))
        elif how == "all" or low[max(0, m.start() - 1) : m.start()] in set("0123456789+") and low[m.end() : m.end() + 1] in set("0123456789"):
            edits.append((m.start(), m.end(), words))
    v = v.rewrite(edits)
    return v.rewrite([(m.start(), m.end(), [("+", m.start(), m.end())]) for m in _PLUS.finditer(v.text)])


def spaced(pattern: re.Pattern[str], text: str) -> Iterator[Span]:
    """The pattern's matches with the spaces around them."""
    end = 0
    for m in pattern.finditer(text):
        a, b = m.span()
        while a > end and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        yield a, b
        end = b


def undisguise(v: View) -> View:
    for pattern, c in ((_AT, "@"), (_DOT, ".")):
        v = v.rewrite([(a, b, [(c, a, b)]) for a, b in spaced(pattern, v.text)])
    for pattern, c in ((_PLAIN_AT, "@"), (_PLAIN_DOT, ".")):
        v = v.rewrite([(m.start(), m.end(), [(c, m.start(), m.end())]) for m in pattern.finditer(v.text)])
    return v


def suspicious(text: str) -> bool:
    """Whether a transducer could change anything that matters."""
    if not text.isascii():
        try:
            text.encode("latin-1")  # of whose characters only these two are folded
            if "\xa0" in text or "\xad" in text:
                return True
        except UnicodeEncodeError:
            if folding()[1].search(text):
                return True
    low = text.lower()
    if "dot" in low and _DOT_WORD.search(text) or "plus" in low and _PLUS.search(text):
        return True
    if _AT.search(text) or _DOT.search(text):
        return True
    words, _, _, touching = spelled()
    return not words.keys().isdisjoint(_WORD.findall(low)) and touching.search(low) is not None


def disguised(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Identifiers that show only in a rewritten text, as spans of ``text``."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if not suspicious(text):
        return out
    folded = fold(View(text))
    views = [folded]
    if spelled()[1].search(lower(folded.text)) or _PLUS.search(folded.text):
        # a word beside a number may belong to it or not, so each reading is searched
        views += [spell(folded, how) for how in ("words", "inner", "all")]
    for i, v in enumerate(map(undisguise, views)):
        for kind, spans in identifiers(v.text).items():
            for a, b in spans:
                s, e = v.start[a], v.end[b - 1]
                # characters that were left out leave no mark but a source that is longer
                if (e - s == b - a and not any(v.changed[a:b])) or i and kind == "card" and one_word(v, a, b):
                    continue
                # words beside a plain address are no part of it
                apart = i and kind in ("email", "ip")
                if not any((x < e and s < y) if apart else (x <= s and e <= y) for x, y in plain[kind]):
                    out[kind].append((s, e))
    return {k: merged(v) for k, v in out.items()}


def one_word(v: View, a: int, b: int) -> bool:
    """Whether a number is one digit word again and again, such as a row of null, and has no figure."""
    at = [i for i in range(a, b) if v.text[i] in "0123456789"]
    return all(v.changed[i] and v.text[i] == v.text[at[0]] for i in at)


def merged(spans: list[Span]) -> list[Span]:
    """The spans in order, those that overlap as one."""
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def find(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """The plain and the disguised identifiers of a text."""
    text = text or ""
    plain = identifiers(text)
    return plain, disguised(text, plain)


def joined(spans: dict[str, list[Span]]) -> str:
    """kind:start:end of all spans by start, then kind as listed."""
    rows = sorted((a, k, b) for k, kind in enumerate(KINDS) for a, b in spans[kind])
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in rows)


def redact(text: str | None) -> str | None:
    """The text with each identifier replaced by its kind in brackets; of overlapping ones the first names the whole."""
    if text is None:
        return None
    plain, more = find(text)
    rows = sorted((a, -b, k) for k, kind in enumerate(KINDS) for a, b in plain[kind] + more[kind])
    if not rows:
        return text
    out, at = [], 0
    for a, b, k in rows:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, -b)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the numbers of plain identifiers, the digest of their list, all spans, and the number of those
    that only the transducers brought to light."""

    @thrifty
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                plain, more = find(text)
                both = {k: plain[k] + more[k] for k in KINDS}
                rows.append((*(len(plain[k]) for k in KINDS), hashlib.sha256(joined(plain).encode()).hexdigest(), joined(both), sum(map(len, more.values()))))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string()), pa.array(cols[6], pa.int64())], [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(scan, f"`{id_col}` {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_disguised bigint")


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every identifier in ``text_col`` replaced, and the length column, where there is one, counted anew
    for texts that changed. Nothing is shuffled."""
    at = docs.columns.index(text_col)
    long_at = docs.columns.index(length_col) if length_col in docs.columns else None

    @thrifty
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(at).to_pylist()
            new = [redact(x) for x in old]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if long_at is not None:
                cols[long_at] = pa.array([n if x == y else len(y) for x, y, n in zip(old, new, cols[long_at].to_pylist(), strict=True)], b.schema.field(long_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(clean, docs.schema)


# where matches stand follows from their lengths and from what stands between them
_PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN (length({_DIGITS}) - i) % 2 = 0 THEN {_DIGITS}[i]::INT ELSE 2 * {_DIGITS}[i]::INT - CASE WHEN {_DIGITS}[i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
_GOOD = {"email": "true", "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR ('0' || right(x, 3))::INT > 255)) = 0", "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}", "phone": f"length({_DIGITS}) BETWEEN 10 AND 15"}
_FOUND = " UNION ALL ".join(
    f"""SELECT r, {k} AS kind, '{kind}' AS name, a, a + length(m) AS b FROM (SELECT r, l[i] AS m, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(l[1:i - 1], lambda x: length(x))), 0) AS a
    FROM (SELECT r, l, p, unnest(range(1, len(l) + 1)) AS i FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS l, string_split_regex(text, '{pattern}') AS p FROM t))) WHERE {_GOOD[kind]}"""
    for k, (kind, pattern) in enumerate(_PATTERNS.items())
)
#: The base counts and spans.
BASE_ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_FOUND}),
n AS (SELECT r, {", ".join(f"count(*) FILTER (name = '{k}') AS n_{k}" for k in KINDS)}, sha256(string_agg(name || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, kind)) AS base FROM f GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, coalesce(base, sha256('')) AS base_sha256 FROM t LEFT JOIN n USING (r)
"""
