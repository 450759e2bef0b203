"""The per-page markup helper: a small element tree over the standard library parser.

Selectors are chains of ``tag``, ``#id``, ``.class``, ``tag.class`` or ``tag[class=whole value]``, joined by
spaces (descendant) or ``>`` (child). Nothing here recurses, and every pass takes time in proportion to the page,
however deep its elements are nested.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
    "table ul".split()
)


@dataclass(frozen=True)
class Selectors:
    """Where the fields of a page are. Defaults suit pages with plain semantic markup."""

    title: str = "h1"
    content: str = "article"
    categories: str = "nav ul > li"
    footer: str = "footer"
    links: str = "nav"
    # The elements dropped from article text.
    remove: tuple[str, ...] = ("sup[class=reference]", "span[class=mw-editsection]", "table", "div")


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict
    parent: "Node | None" = None
    children: list = field(default_factory=list)  # Node or str

    def elements(self):
        return [c for c in self.children if isinstance(c, Node)]

    def walk(self):
        """The elements below, in document order."""
        stack = self.elements()[::-1]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(node.elements()[::-1])

    def text(self) -> str:
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item.tag not in ("script", "style"):
                stack.extend(item.children[::-1])
        return "".join(parts)

    def matches(self, part: str) -> bool:
        """An element of the right tag matches the rest of ``part``."""
        if part.startswith("#"):
            return self.attrs.get("id") == part[1:]
        if part.endswith("]"):
            return self.attrs.get("class") == part[:-1].partition("[class=")[2]
        name = part.partition(".")[2]
        return not name or name in (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {})
        self.depth: Counter = Counter()  # open elements by tag

    def _close(self, tag: str, stop: frozenset = frozenset()) -> None:
        if not self.depth[tag]:
            return
        node = self.open
        while node.parent is not None and node.tag not in stop:
            if node.tag == tag:
                while self.open is not node.parent:
                    self.depth[self.open.tag] -= 1
                    self.open = self.open.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close("p", frozenset(("button", "td", "th")))
        if tag == "li":
            self._close("li", frozenset(("ul", "ol")))
        node = Node(tag, dict(attrs), self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node
            self.depth[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.open.children.append(data)


@lru_cache
def _steps(selectors: tuple[str, ...]):
    """All steps of all selectors as bits. ``by_tag``: the steps an element of a tag may match ('' for any tag), as
    (bit, part, bit of the step before or 0, whether that must be the parent). ``last``: the last bit of each selector."""
    by_tag, last, bit = {}, [], 1
    for selector in selectors:
        words, before, child = selector.replace(">", " > ").split(), 0, False
        for word in words:
            if word == ">":
                child = True
                continue
            tag = "" if word.startswith("#") else word.partition("[")[0].partition(".")[0]
            by_tag.setdefault(tag, []).append((bit, word, before, child))
            before, child, bit = bit, False, bit << 1
        last.append(before)
    return by_tag, last


def select(root: Node, selectors: tuple[str, ...]) -> list[list[Node]]:
    """The elements below a page's ``root`` that match each of the selectors, in document order, from one walk. A walk carries
    down which steps the parent matches and which some element above does, as bits of an integer."""
    by_tag, last = _steps(selectors)
    found, wanted = [[] for _ in last], sum(set(last))
    anywhere = by_tag.get("", [])
    stack = [(c, 0, 0) for c in root.elements()[::-1]]
    while stack:
        node, parent, over = stack.pop()
        own = 0
        for bit, part, before, child in by_tag.get(node.tag, []) + anywhere if node.tag in by_tag else anywhere:
            if (not before or before & (parent if child else over)) and node.matches(part):
                own |= bit
        if own & wanted:
            for rows, bit in zip(found, last):
                if own & bit:
                    rows.append(node)
        below = over | own
        for c in node.children[::-1]:
            if isinstance(c, Node):
                stack.append((c, own, below))
    return found


def _trim(text: str) -> str:
    return text.strip("".join(map(chr, range(33))))


_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def _clean(content: Node, doomed: set[int]) -> None:
    """Drop the ``doomed`` elements (by identity) below ``content``, and every heading whose next element is a heading of its level."""
    stack = [content]
    while stack:
        node = stack.pop()
        if not node.children:
            continue
        elements = [c for c in node.children if isinstance(c, Node) and id(c) not in doomed]
        doomed.update(id(a) for a, b in zip(elements, elements[1:]) if a.tag == b.tag and a.tag in _HEADINGS)
        node.children = [c for c in node.children if id(c) not in doomed]
        stack.extend(c for c in elements if id(c) not in doomed)


def extract(html: str, rules: Selectors):
    """``found, title, content, categories, footer, hrefs`` of one page."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    wanted = (rules.title, rules.content, rules.categories, rules.footer, rules.links, *rules.remove)
    titles, contents, blocks, footers, links, *removed = select(builder.root, wanted)
    if not titles or not contents:
        return False, None, None, None, None, None
    content = contents[0]
    if rules.links == rules.content:
        links = [content]
    footer = footers[0] if footers else None
    name = " ".join(titles[0].text().split())
    _clean(content, {id(node) for nodes in removed for node in nodes})
    texts = [c.text() for c in content.elements()]
    body = "\n".join(_trim(t) for t in texts if t.strip())
    targets = [n.attrs["href"] for block in links for n in block.walk() if n.tag == "a" and n.attrs.get("href") is not None]
    return (
        True,
        name,
        body,
        [" ".join(b.text().split()) for b in blocks],
        footer.text() if footer is not None else None,
        targets,
    )
