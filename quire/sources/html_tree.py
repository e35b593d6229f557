"""A small HTML tree on the standard ``html.parser`` (no lxml/bs4 here).

Used inside ``mapInPandas`` tasks for markup that needs structure (the
dictionary extractor). Elements keep attributes in source order; text is
stored as ``str`` children. Void elements never take children, ``p``/``li``/
``tr``/``td`` close implicitly, stray end tags are ignored.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
         "section", "table", "ul"}
RAW = {"script", "style"}


class Comment(str):
    """A comment node (kept so rewrites can carry it over)."""


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict | None = None, parent: "Element | None" = None):
        self.tag = tag
        self.attrs = dict(attrs or {})
        self.children: list = []
        self.parent = parent

    # -- navigation -----------------------------------------------------------
    def elements(self):
        return [c for c in self.children if isinstance(c, Element)]

    def iter(self):
        """All descendant elements in document order (self excluded)."""
        stack = list(reversed(self.elements()))
        while stack:
            e = stack.pop()
            yield e
            stack.extend(reversed(e.elements()))

    def find_all(self, tag: str | None = None, cls: str | None = None, **attrs):
        for e in self.iter():
            if tag and e.tag != tag:
                continue
            if cls and cls not in (e.attrs.get("class") or "").split():
                continue
            if any(e.attrs.get(k) != v for k, v in attrs.items()):
                continue
            yield e

    def first(self, tag: str | None = None, cls: str | None = None, **attrs):
        return next(self.find_all(tag, cls, **attrs), None)

    def text_content(self) -> str:
        out = []
        for c in self.children:
            if isinstance(c, Element):
                out.append(c.text_content())
            elif not isinstance(c, Comment):
                out.append(c)
        return "".join(out)

    def own_text(self) -> str | None:
        """First direct text node (``text()`` in XPath terms)."""
        for c in self.children:
            if isinstance(c, str) and not isinstance(c, Comment):
                return c
        return None

    def append(self, child):
        if isinstance(child, Element):
            child.parent = self
        elif self.children and type(self.children[-1]) is str and type(child) is str:
            self.children[-1] = self.children[-1] + child
            return
        self.children.append(child)


def ancestors(e: Element):
    """Elements around ``e``, innermost first."""
    while (e := e.parent) is not None:
        yield e


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#document")
        self.stack = [self.root]

    def _close_to(self, tag: str, stop: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                del self.stack[i:]
                return
            if t in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._close_to("p", {"div", "article", "section", "td", "th", "li", "table", "body"})
        if tag == "li":
            self._close_to("li", {"ul", "ol"})
        elif tag == "tr":
            self._close_to("tr", {"table", "tbody", "thead", "tfoot"})
        elif tag in ("td", "th"):
            self._close_to("td", {"tr", "table"})
            self._close_to("th", {"tr", "table"})
        e = Element(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].append(e)
        if tag not in VOID:
            self.stack.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def updatepos(self, i, j):
        return j        # line and column are of no use here; the parser would count them for every token

    def handle_data(self, data):
        self.stack[-1].append(data)

    def handle_comment(self, data):
        self.stack[-1].append(Comment(data))


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _esc_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _esc_attr(s: str) -> str:
    return s.replace("&", "&amp;").replace('"', "&quot;")


def to_html(node, raw: bool = False) -> str:
    """Serialise a node the way an HTML serialiser does (void tags unclosed,
    script/style bodies verbatim)."""
    if isinstance(node, Comment):
        return f"<!--{node}-->"
    if isinstance(node, str):
        return node if raw else _esc_text(node)
    attrs = "".join(f' {k}="{_esc_attr(v)}"' for k, v in node.attrs.items())
    if node.tag in VOID:
        return f"<{node.tag}{attrs}>"
    inner = "".join(to_html(c, node.tag in RAW) for c in node.children)
    return f"<{node.tag}{attrs}>{inner}</{node.tag}>"


def select(root: Element, tag: str, cls: str | None = None) -> list[Element]:
    """``tag.cls`` CSS selection in document order."""
    return list(root.find_all(tag, cls))


def outer_html(e: Element) -> str:
    return to_html(e)
