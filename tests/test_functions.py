import random
from datetime import date

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.functions import citations, decode, distance, html, text, titles
from vellum.operators import match
from vellum.sources import pages, shared

PAGE = """<html><head><title>Smith &amp; Co v. Jones [2001] QB 62
 (25th July, 2001)</title></head><body><table><tr><td align="left"><h1>Court of Things</h1></td></tr></table>
<small><i>http://example.org/62.html</i><br>x<br>Cite as: [2001] Q.B.  62, [2001] 2 Things 5 (25 July 2001)</small><hr><p>kept</p><p>&nbsp;</p>
<ul><li><a href="x">a<li>b</li></a></li></ul><hr>gone<p>gone too</p></body></html>"""


def test_distance():
    cases = [("tiger", "tiger", 1, 1, 1, 0), ("tiger", "tier", 1, 1, 1, 1), ("tiger", "tigger", 1, 1, 1, 1), ("tiger", "tiler", 1, 1, 1, 1), ("tigger", "pooh", 1, 1, 1, 6), ("ergro", "underground", 10, 1, 1, 60), ("underground", "ergro", 1, 10, 1, 60)]
    for *args, want in cases:
        assert distance.distance(*args) == want


@given(st.text("ab", max_size=6), st.text("ab", max_size=6))
def test_distance_is_symmetric(a, b):
    assert distance.distance(a, b, 2, 2, 3) == distance.distance(b, a, 2, 2, 3)


@settings(max_examples=60)
@given(st.lists(st.tuples(st.text("abé𝄞", max_size=6), st.text("abé𝄞", max_size=6)), max_size=12), st.integers(0, 4), st.integers(0, 4), st.integers(0, 9))
def test_distances_of_many_pairs(pairs, i, d, s):
    assert distance.distances([a for a, _ in pairs], [b for _, b in pairs], i, d, s).tolist() == [distance.distance(a, b, i, d, s) for a, b in pairs]


def test_weighted_distance_as_function(spark):
    rows = spark.createDataFrame([("underground", "ergro"), (None, "x"), ("", "ab")], "a string, b string")
    assert [r[0] for r in rows.select(distance.weighted_distance(1, 10, 1)("a", "b")).collect()] == [60, None, 2]


ANIMALS = match.Dictionary({"badger": "grrrr", "cat": "miaow", "dog": "woof", "dogfish": "woof&glug", "fish": "glug"})


def test_search_reports_overlaps_and_replace_does_not():
    assert [m.key for m in ANIMALS.search("dogfish")] == ["dogfish", "fish"]
    assert ANIMALS.search("dogfish", legacy_end=True) == []
    got, keys = ANIMALS.replace("Dog, dogfish, badger, badgerfish, cat!", match.limp, lambda s, v: f"{{{s}:{v}}}")
    # a match takes in what stands up to the next character of the normalised text
    assert got == "{Dog:woof}, {dogfish:woof&glug}, {badger:grrrr}, {badger:grrrr}{fish:glug}, {cat:miaow}!"
    assert keys == ["dog", "dogfish", "badger", "badger", "fish", "cat"]
    assert list(ANIMALS) == sorted(ANIMALS) and len(ANIMALS) == 5 and ANIMALS["cat"] == "miaow"
    with pytest.raises(ValueError):
        match.Dictionary({})


@settings(max_examples=60)
@given(st.text("dogfish cat<>&;", max_size=40))
def test_replace_by_itself_changes_nothing(s):
    for n in (None, match.plain, match.law_view, match.citation_view):
        assert ANIMALS.replace(s, n, lambda source, _: source)[0] == s
    assert {m.start for m in ANIMALS.leftmost(s)} <= {m.start for m in ANIMALS.search(s)}


def test_links_go_over_tags():
    d = match.Dictionary({"contemptofcourtact1981": "/l"})
    assert d.replace("the <b>Contempt</b> of Court Act, 1981.", match.law_view, lambda s, v: f"[{s}]")[0] == "the <b>[Contempt</b> of Court Act, 1981.]"


def test_decoding():
    assert decode.decode("é".encode()).text == "é"
    assert decode.decode("<meta charset=iso-8859-1>“".encode("cp1252")).text.endswith("“")
    assert decode.decode("x".encode("utf-16")).text == "x"
    for declaration in ("<meta http-equiv='Content-Type' content='text/html; charset=iso-8859-1'>", '<META CHARSET="latin-1"/>', "<meta charset=ISO-8859-1 >", "<?xml version='1.0' encoding='iso-8859-1'?>"):
        assert decode.decode(declaration.encode() + b"\x93\xe9").text.endswith("\u201cé"), declaration
    assert decode.decode("<?xml version='1.0' encoding='utf-16'?>é".encode("utf-16")).text.endswith("é")
    assert decode.open_page("<p>\u201cx\u201d \u2013".encode(), smart_quotes=False) == '<p>"x" -' and "&#8220;" in decode.open_page("<p>\u201cx".encode())
    assert len(decode.MARKS) == 27 and decode.without_smart_quotes("\u20ac\u0192\u2026\u017d\u2019x", "entities") == "&euro;&fnof;&hellip;&#x17D;&rsquo;x"
    assert decode.without_smart_quotes("\u20ac\u2014é", "references") == "&#x20AC;&#x2014;é" and decode.open_page("<p>\u2122".encode(), False, "entities") == "<p>&trade;"
    with pytest.raises(ValueError):
        decode.smart_marks("latin")
    bad = decode.decode(b"<?xml encoding='utf-8'?>\xff\x81")
    assert bad.replaced and bad.encoding == "utf-8"
    assert decode.open_page("zzz<p>é\r\na\rb\x01\x04</p>".encode()) == "<p>&#233;\na\nb\x04</p>"
    with pytest.raises(decode.ConversionError):
        decode.open_page(b"no page")


def test_page():
    tree = html.parse(PAGE)
    title = html.title(tree)
    assert title == "Smith & Co v. Jones [2001] QB 62 (25th July, 2001)"
    assert html.source_url(tree) == "http://example.org/62.html" and html.court_name(tree) == "Court of Things"
    assert {citations.weak(c) for c in citations.find_citations(tree, title)} == {"[2001] QB 62", "[2001] 2 Things 5"}
    assert citations.find_date(tree, title) == date(2001, 7, 25)
    assert citations.parties(title) == [(1, "Jones"), (2, "Smith"), (2, "Co")]
    body = html.opinion(tree)
    assert html.mend_lists(body) and html.empty_blocks_to_breaks(body)
    assert "".join(body.html().split()) == "".join('<body><p>kept</p><br/><ul><li><a href="x">a</a></li><li>b</li></ul>gone</body>'.split())
    with pytest.raises(decode.ConversionError, match="title"):
        html.title(html.parse("<p>x</p>"))


def test_plain_pages_are_read_as_others():
    def tree(n):
        assert all(c.parent is n for c in n.elements)
        return n.tag, n.attrs, [tree(c) if isinstance(c, html.Node) else c for c in n.children]

    rng = random.Random(5)
    plain = ["<p>", "</p>", "<P class=x>", "<li>", "</li>", "<ul>", "</ul>", '<a href="x&amp;y">', "</a>", "<br>", "<br />", "<title>", "</title>", "t&amp;", "&nbsp", "&#233;", " x ", "<table>", "<tr>", "<td align='left'>", "<th>", "</table>", "<div/>", "<dl>", "<dt>", "<dd>", "<option>", "<a ID=x id=y/>"]
    odd = ["<", "a<b", "<!-- c -->", "<script>", "</script>", "<svg>", "<!DOCTYPE html>", "<a href=x/y>", "</br>", "</p/>"]
    n = 0
    for i in range(4000):
        page = "".join(rng.choice(plain if i % 3 else plain + odd) for _ in range(rng.randint(0, 14)))
        b = html._Builder()
        b.feed(page)
        b.close()
        got = html._parse_plain(page)
        n += got is not None
        assert tree(html.parse(page)) == tree(b.root) and (got is None or tree(got) == tree(b.root)), page
    assert n > 1500


def test_pages_go_in_batches():
    """Not each in a batch of its own, and not all at once."""
    content = [PAGE.encode(), b"", None, b"<p>x</p>"] * 1000
    b = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(4000)], "filename": ["x"] * 4000, "content": pa.array(content, pa.binary())})
    got = list(pages._read(True, iter([b])))
    assert len(got) == -(-sum(len(c or b"") for c in content) // shared.PIECE) and sum(x.num_rows for x in got) == 4000
    rows = got[0].slice(0, 4).to_pylist()
    assert rows[0]["value"] == pages.metadata(decode.open_page(PAGE.encode())) and rows[0]["error"] is None
    assert [(r["page"], r["value"], r["error"]) for r in rows[1:]] == [(None, None, "there is no HTML in this file")] * 2 + [("<p>x</p>", None, 'can\'t find element "title"')]
    # rows without content cost nothing
    assert sum(x.num_rows for x in shared.pieces(iter([b]), 2, 1)) == 4000 and max(x.num_rows for x in shared.pieces(iter([b]), 2, 1)) <= 3


@pytest.mark.parametrize(("s", "want"), [("25th July, 2001", date(2001, 7, 25)), ("March 1995", date(1995, 3, 1)), ("01/02/2001", date(2001, 1, 2)), ("1999", date(1999, 1, 1)), ("SCOTLAND", None), ("194d(3", None), ("QB", None), ("", None), ("31 February 2001", None),
    ("25 July 01", date(2001, 7, 25)), ("25/7/99", date(1999, 7, 25)), ("7/25/68", date(2068, 7, 25)), ("March 95", date(1995, 3, 1)), ("March 10", None), ("2001 July 25", date(2001, 7, 25)), ("2001/7/25", date(2001, 7, 25)), ("25.7.2001", date(2001, 7, 25)),
    ("2001-07-25", date(2001, 7, 25)), ("Wednesday, 25th day of July 2001", date(2001, 7, 25)), ("Sept 3, 1999", date(1999, 9, 3)), ("99 July 4", date(1999, 7, 4)), ("13/13/2001", None), ("25 July", None), ("July", None), ("62", None), ("9999", None), ("12", None)])
def test_dates(spark, s, want):
    assert citations.parse_date(s) == want
    assert spark.range(1).select(titles.parsed_date(F.lit(s))).first()[0] == want


def test_expressions(spark):
    def value(c):
        return spark.range(1).select(c.alias("v")).first()[0]

    assert value(text.plain(F.lit("a <b>x</b>&amp;lt; &nbsp;<!-- c --> y <z"))) == "a x&lt;   y "
    assert value(text.single_spaces(F.lit("a \n b\n\nc"))) == "a b\nc"
    assert value(text.ascii_references(F.lit("aé𝄞"))) == "a&#233;&#119070;"
    assert value(text.clean_page(F.lit("x<a>\r\n\x02\x04"))) == "<a>\n\x04"
    assert value(text.tidy_title(F.lit("  a\nb   c "))) == "a b c"
    assert value(titles.title_date(F.lit("X (SCOTLAND) [2001] Y 62 (25th July, 2001)"))) == date(2001, 7, 25)
    assert [tuple(p) for p in value(titles.party_list(F.lit("A & B v. C &amp; D [2001]")))] == [(1, "C"), (1, "D"), (2, "A"), (2, "B")]
    assert value(titles.party_list(F.lit("In re X"))) is None
    assert value(titles.index_path(F.lit("/a"))) == "/a/index.html" and value(titles.index_path(F.lit("/a.html"))) == "/a.html"
    assert value(titles.log_level(F.lit('x HTTP/1.1" 404 1 "/" "b"'))) == "warning" and value(titles.log_level(F.lit('x "-" "-"'))) is None
    assert value(text.limp(F.lit(None).cast("string"))) is None


def test_citations():
    assert citations.citation_set("see [2001] UKHL 62, [2001] 1 AC 5 (HL)\nshort") == {"[2001] UKHL 62", "[2001] 1 AC 5 (HL)", "short"}
    # a piece is measured without its date
    assert citations.citation_set("[2001] (25 July 2001)\n[2001] X (25 July 2001)\n(2001) 5 (1999) 66 (2000) 777") == {"[2001] X", "(2001) 5", "(1999) 66", "(2000) 777"}
    exact, spaced = (html.parse(f"<small><br>{lead}Cite as: [2001] AB 7</small>") for lead in ("", " "))
    assert citations.find_citations(exact, "T [1999] CD 8") == {"[2001] AB 7"} and citations.find_citations(spaced, "T [1999] CD 8; x") == {"[1999] CD 8", "x"}
    link = '<a title="Link to X version">l</a>{}<b>3 May 2001</b>'
    assert citations.find_date(html.parse(link.format(" (1 May 2001)")), "T") == date(2001, 5, 1) and citations.find_date(html.parse(link.format("1 May 2001")), "T") == date(2001, 5, 3)
    assert citations.find_date(html.parse("<font>x (2\xa0May 2001</font>"), "T 194d(3) (SCOTLAND)") == date(2001, 5, 2) and citations.find_date(html.parse(""), "T 4 May 2001 x") == date(2001, 5, 4)
    assert citations.without_date("[1999] X 5 (1999)") == "[1999] X 5" and citations.without_date("[1999] X (194)") == "[1999] X (194)"
