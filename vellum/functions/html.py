"""A small HTML tree, and what is read from a page with it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape, unescape
from html.parser import HTMLParser

from .decode import ConversionError

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("address blockquote center div dl fieldset form h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
#: An open element that a start tag closes, and what it doesn't look behind.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "a"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"})}


#: Text, and the tag behind it if it is one of the plain kind, which all rules for reading read alike.
_PLAIN = re.compile(r"""([^<]*+)(?:<(/?)([a-zA-Z][a-zA-Z0-9]*+)((?:[ \t\n\r\f]++[a-zA-Z][-a-zA-Z0-9:]*+(?:=(?:"[^"<>]*+"|'[^'<>]*+'|[-a-zA-Z0-9]++))?)*+)[ \t\n\r\f]*+(/?)>|\Z|(<))""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][-a-zA-Z0-9:]*+)(?:=(?:"([^"]*)"|'([^']*)'|([-a-zA-Z0-9]+)))?""")
#: What these hold isn't read as other text is.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext svg math".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], None

    def add(self, child: Node | str) -> None:
        if isinstance(child, Node):
            child.parent = self
        elif self.children and isinstance(self.children[-1], str):
            self.children[-1] += child
            return
        self.children.append(child)

    @property
    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    @property
    def text(self) -> str:
        """The text before the first child."""
        return self.children[0] if self.children and isinstance(self.children[0], str) else ""

    @property
    def tail(self) -> str:
        """The text behind the element, up to the next one."""
        siblings = self.parent.children if self.parent else []
        i = next((k for k, c in enumerate(siblings) if c is self), -1)
        return siblings[i + 1] if 0 <= i < len(siblings) - 1 and isinstance(siblings[i + 1], str) else ""

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def find(self, tag: str, inside: str | None = None, test: Callable[[Node], bool] = lambda n: True) -> Iterator[Node]:
        """Elements with this tag in document order; with ``inside``, direct children of such an element that passes ``test``."""
        for n in self.walk():
            if n.tag == tag and (inside is None or n.parent is not None and n.parent.tag == inside and test(n.parent)):
                yield n

    def html(self) -> str:
        inner = "".join(c.html() if isinstance(c, Node) else escape(c, quote=False) for c in self.children)
        if not self.tag:
            return inner
        attrs = "".join(f' {k}="{escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}/>" if self.tag in VOID else f"<{self.tag}{attrs}>{inner}</{self.tag}>"


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCKS and any(n.tag == "p" for n in self.open):
            self.handle_endtag("p")
        if tag in _CLOSES:
            closed, limits = _CLOSES[tag]
            for n in reversed(self.open):
                if n.tag in limits:
                    break
                if n.tag in closed:
                    self.handle_endtag(n.tag)
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].add(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].add(data)


def _parse_plain(html: str) -> Node | None:
    """The tree of a page all of whose tags are plain ones, as ``_Builder`` makes it; None for any other page."""
    root = Node("")
    open_, paragraphs, titled = [root], 0, False
    for text, ends, tag, attributes, closed, other in _PLAIN.findall(html):
        if other:
            return None
        if text:
            children = open_[-1].children
            if "&" in text:
                text = unescape(text)
            if children and isinstance(children[-1], str):
                children[-1] += text
            else:
                children.append(text)
        tag = tag.lower()
        if titled:
            # a title that holds text alone is read as any other element
            if tag != "title" or not ends:
                return None
            titled = False
        if not tag:
            break
        if closed and attributes and attributes[-1] not in "\"'":
            return None  # the stroke may belong to the value
        if ends:
            if attributes or closed:
                return None
            if open_[-1].tag == tag:
                open_.pop()
                paragraphs -= tag == "p"
            else:
                paragraphs -= _close(open_, tag)
            continue
        if tag in _RAW:
            if tag != "title" or closed:
                return None
            titled = True
        if paragraphs and tag in _BLOCKS:
            paragraphs -= _close(open_, "p")
        if tag in _CLOSES:
            these, limits = _CLOSES[tag]
            for x in reversed(open_):
                if x.tag in limits:
                    break
                if x.tag in these:
                    paragraphs -= _close(open_, x.tag)
                    break
        node = Node(tag, {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else None)
        up = node.parent = open_[-1]
        up.children.append(node)
        if tag not in VOID:
            open_.append(node)
            paragraphs += tag == "p"
            if closed:
                paragraphs -= _close(open_, tag)
    return root


def _close(open_: list[Node], tag: str) -> int:
    """Close the innermost open element with this tag, and all within it; how many paragraphs these were."""
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag == tag:
            n = sum(x.tag == "p" for x in open_[i:])
            del open_[i:]
            return n
    return 0


def parse(html: str) -> Node:
    plain = _parse_plain(html)
    if plain is not None:
        return plain
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


class Index:
    """The elements of a tree that doesn't change any more, by tag in document order."""

    def __init__(self, root: Node):
        self.by: dict[str, list[Node]] = {}
        for n in root.walk():
            self.by.setdefault(n.tag, []).append(n)

    def find(self, tag: str, inside: str | None = None, test: Callable[[Node], bool] = lambda n: True) -> Iterator[Node]:
        """As ``Node.find``."""
        return (n for n in self.by.get(tag, ()) if inside is None or n.parent is not None and n.parent.tag == inside and test(n.parent))


def extract(found: Iterator[Node], name: str) -> str:
    """The stripped text before the first child of the first element found."""
    n = next(found, None)
    if n is None:
        raise ConversionError(f'can\'t find element "{name}"')
    return n.text.strip()


def title(page: Node | Index) -> str:
    return re.sub("  +", " ", extract(page.find("title"), "title").replace("\n", " "))


def source_url(page: Node | Index) -> str:
    return extract(page.find("i", "small"), "small/i")


def court_name(page: Node | Index) -> str:
    return extract(page.find("h1", "td", lambda td: td.attrs.get("align") == "left"), "td/h1")


def opinion(page: Node) -> Node:
    """The page's body with only those of its direct children that stand between its first and its last rule; text directly in the body stays."""
    body = next(page.find("body"), None)
    if body is None:
        raise ConversionError("can't find the body")
    rules = [i for i, c in enumerate(body.children) if isinstance(c, Node) and c.tag == "hr"]
    first, last = (rules[0], rules[-1]) if len(rules) > 1 else (len(body.children), len(body.children))
    out = Node("body", body.attrs)
    for i, c in enumerate(body.children):
        if isinstance(c, str) or first < i < last:
            out.add(c)
    return out


def mend_lists(body: Node) -> bool:
    """A list item within a link within a list item moves behind the outer item, the first in the document first, until there is none. Whether there was one. A move can only make new ones of what moved, so a pass
    over those found is repeated while it finds any."""

    def misplaced(n: Node) -> bool:
        a = n.parent
        return a is not None and a.tag == "a" and a.parent is not None and a.parent.tag == "li" and a.parent.parent is not None

    mended = False
    while found := [n for n in body.find("li") if misplaced(n)]:
        for inner in found:
            if misplaced(inner):
                outer = inner.parent.parent
                inner.parent.children.remove(inner)
                siblings = outer.parent.children
                siblings.insert(next(i for i, c in enumerate(siblings) if c is outer) + 1, inner)
                inner.parent, mended = outer.parent, True
    return mended


def empty_blocks_to_breaks(body: Node) -> bool:
    """Paragraphs and quotes with neither elements nor text become line breaks. Whether there was one."""
    some = [n for n in body.walk() if n.tag in ("p", "blockquote") and not n.elements and not n.text.strip()]
    for n in some:
        n.tag, n.attrs, n.children = "br", {}, []
    return bool(some)
