"""Visible text of HTML pages, laid out as a text browser would.

Three steps: a tokenizer over one regular expression, a tree builder that
supplies implied end tags, and a renderer with visibility and layout rules
(block spacing with collapsing margins, list markers, indents, preformatted
text, and tables with columns aligned by display width). The page's style
sheets decide on visibility as far as their selectors name an element by tag,
class and id; combinators, pseudo-classes and media other than screens are not
followed. All visible text comes out; nothing is judged as boilerplate.
"""

from __future__ import annotations

import html as entities
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C

# Fixed values of the HTML standard.
VOID = {"area", "base", "basefont", "bgsound", "br", "col", "embed", "frame", "hr", "img", "input", "keygen", "link", "meta",
        "param", "source", "track", "wbr"}
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title"}
DECODED_RAW = {"textarea", "title"}
UNSEEN = {"head", "title", "script", "style", "template", "iframe", "noembed", "noframes", "datalist", "object", "audio",
          "video", "canvas", "colgroup", "map", "rp"}
# Inside svg and math: elements that are not rendered.
FOREIGN = {"svg": {"title", "desc", "defs", "metadata", "symbol"}, "math": {"annotation", "annotation-xml"}, "foreignobject": set()}
MARGIN = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "menu", "blockquote", "pre", "xmp", "table", "figure", "hr",
          "fieldset", "form", "dir", "listing", "plaintext"}
BLOCK = MARGIN | {"html", "body", "div", "section", "article", "aside", "header", "footer", "main", "nav", "address", "center",
                  "details", "summary", "dialog", "dt", "dd", "li", "figcaption", "legend", "hgroup", "search", "caption",
                  "tr", "td", "th", "thead", "tbody", "tfoot", "optgroup", "option", "frameset"}
CLOSES_P = MARGIN | {"address", "article", "aside", "center", "details", "dialog", "div", "figcaption", "footer", "header",
                     "hgroup", "main", "nav", "search", "section", "summary", "li", "dd", "dt"}
# start tag -> open elements it ends, looked for up to the nearest of the bounds
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
        "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
        "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}), "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
        "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}), "body": ({"head"}, set())}
ENDS["tbody"] = ENDS["tfoot"] = ENDS["thead"]
P_SCOPE = {"html", "table", "td", "th", "caption", "template", "button", "object", "marquee", "applet"}
HEAD_TAGS = {"base", "basefont", "bgsound", "link", "meta", "noframes", "script", "style", "template", "title", "noscript"}

DEPTH = 512          # deeper elements become siblings, as in browsers
CELL_WIDTH = 60      # a wider line of a cell is not padded for: it would blow up every row of its column
FRAMES = 20_000      # call depth the renderer may need for DEPTH levels

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|</>"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"""
    r"""(?P<attrs>(?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+|=)*+)>"""
    r"""|<(?P<broken>/?[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|(?P<text>[^<]++|<)""", re.S)
_ATTR = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)?))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
_FOREIGN_UNSEEN = set().union(*FOREIGN.values())
_UNQUOTED_END = re.compile(r"""=\s*[^\s"'>][^\s>]*\Z""")
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_CSS_RULE = re.compile(r"([^{}]*)\{([^{}]*)(?:\}|\Z)")
_CSS_MEDIA = re.compile(r"@media\s*((?:all|screen|\s|,|only)*)\{((?:[^{}]*\{[^{}]*\})*[^{}]*)(?:\}|\Z)", re.I)
_CSS_GROUP = re.compile(r"@[a-z-]+[^{};]*\{(?:[^{}]*\{[^{}]*\})*[^{}]*(?:\}|\Z)|@[^{};]*;", re.I)
_CSS_SIMPLE = re.compile(r"(\*|[a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NUMBER = re.compile(r"\s*([+-]?\d{1,9})")
# Stand-ins inside a run of text: line break, kept blank, kept tab.
_BREAK, _BLANK, _TAB = "\x00", "\x01", "\x02"
_KEEP = str.maketrans({"\n": _BREAK, " ": _BLANK, "\t": _TAB})
_GAP = None          # among lines: a blank line wanted here


class Node:
    __slots__ = ("tag", "attrs", "children", "sheets")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children, self.sheets = tag, attrs, [], []


def _attributes(raw: str) -> dict:
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(raw):
        value = next((v for v in values if v), "")
        out.setdefault(name.lower(), entities.unescape(value) if "&" in value else value)
    return out


def parse(page: str) -> Node:
    """Tree of the page; text nodes are strings."""
    for stand_in in (_BREAK, _BLANK, _TAB):
        page = page.replace(stand_in, "")
    root = Node("html", {})
    stack = [root]
    at, size = 0, len(page)

    def close(names: set, bounds: set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return close(names, bounds)
            if stack[i].tag in bounds:
                return None
        return None

    def foreign() -> str:
        """The nearest open svg, math or foreignObject."""
        return next((n.tag for n in reversed(stack) if n.tag in FOREIGN), "")

    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        text = m["text"]
        if text is not None:
            text = entities.unescape(text) if "&" in text else text
            if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
                del stack[-1]
            stack[-1].children.append(text)
            continue
        name = m["name"] or (m["broken"] or "").lstrip("/")
        if not name:
            continue                                     # comment, doctype, bogus
        name = name.lower()
        if m["end"] or (m["broken"] or "").startswith("/"):
            if name == "br":
                stack[-1].children.append(Node("br", {}))
            elif name not in ("html", "body"):           # what follows them still belongs to the body
                bounds = set() if name == "table" else {"table"} if name in ("tr", "thead", "tbody", "tfoot", "caption") else (
                    {"td", "th", "table", "caption"})
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == name:
                        del stack[i:]
                        break
                    if stack[i].tag in bounds:
                        break
            continue
        attrs = _attributes(m["attrs"]) if m["attrs"] and not m["attrs"].isspace() else {}
        if name == "html":
            continue
        if stack[-1].tag == "head" and name not in HEAD_TAGS:
            del stack[-1]
        if name in ENDS:
            close(*ENDS[name])
        if name in CLOSES_P:
            close({"p"}, P_SCOPE)
        node = Node(name, attrs)
        if name == "text" and foreign() == "svg":
            stack[-1].children.append(" ")               # labels stand apart
        elif name in _FOREIGN_UNSEEN and name in FOREIGN.get(foreign(), ()):
            attrs["hidden"] = ""
        stack[-1].children.append(node)
        if name in VOID:
            continue
        if m["attrs"] and m["attrs"].endswith("/") and not _UNQUOTED_END.search(m["attrs"]) and (
                name in ("svg", "math") or foreign() in ("svg", "math")):
            continue                                     # <path/> ends itself there
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            body = page[at:end.start()] if end else page[at:]
            node.children.append(entities.unescape(body) if name in DECODED_RAW else body)
            if name == "style" and attrs.get("media", "all").lower() in ("", "all", "screen"):
                root.sheets.append(body)
            at = page.find(">", end.end()) + 1 if end else size
            at = at or size
        elif name == "plaintext":
            node.children.append(page[at:])
            at = size
        elif len(stack) < DEPTH:
            stack.append(node)
    return root


def _style(attrs: dict) -> dict:
    out = {}
    for part in attrs.get("style", "").lower().split(";"):
        key, _, value = part.partition(":")
        out[key.strip()] = value.replace("!important", "").strip()
    return out


def visibility_rules(sheets: list[str]) -> list[tuple]:
    """(weight, tag, id, classes, property, value) of every display and
    visibility declaration behind a simple selector, lightest first."""
    css = _CSS_MEDIA.sub(r"\2", _CSS_COMMENT.sub(" ", "\n".join(sheets)))
    rules = []
    for selectors, body in _CSS_RULE.findall(_CSS_GROUP.sub(" ", css)):
        wanted = []
        for part in body.lower().split(";"):
            key, _, value = part.partition(":")
            if key.strip() in ("display", "visibility"):
                wanted.append((key.strip(), value.replace("!important", "").strip(), "!important" in value))
        if not wanted:
            continue
        for one in selectors.split(","):
            m = _CSS_SIMPLE.fullmatch(one.strip())
            if not m or not m[0]:
                continue
            names = re.findall(r"([.#])([\w-]+)", m[2] or "")
            ids, classes = [n for k, n in names if k == "#"], {n for k, n in names if k == "."}
            tag = "" if m[1] in (None, "*") else m[1].lower()
            for key, value, strong in wanted:
                weight = (strong, len(ids), len(classes), bool(tag), len(rules))
                rules.append((weight, tag, set(ids), classes, key, value))
    return sorted(rules, key=lambda r: r[0])


def _dress(root: Node) -> None:
    """Writes what the style sheets say on visibility into the elements' own
    styles: before them, or behind them where a sheet insists."""
    rules = visibility_rules(root.sheets)
    todo = [root] if rules else []
    while todo:
        node = todo.pop()
        todo += [c for c in node.children if not isinstance(c, str)]
        own, own_id = set(node.attrs.get("class", "").split()), {node.attrs.get("id", "")}
        hits = [(w, f"{key}:{value}") for w, tag, ids, classes, key, value in rules
                if (not tag or tag == node.tag) and ids <= own_id and classes <= own]
        if hits:
            before, behind = ([x for w, x in hits if w[0] == strong] for strong in (False, True))
            node.attrs["style"] = ";".join([*before, node.attrs.get("style", ""), *behind])


def _width(text: str) -> int:
    """Columns a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _free(spans: list[list[int]], col: int) -> int:
    """The first column from ``col`` on that no span (start, end, rows) holds."""
    for start, end, _ in spans:
        if start <= col < end:
            col = end
    return col


def _number(value: str | None, default: int) -> int:
    m = _NUMBER.match(value or "")
    return int(m[1]) if m else default


class Sink:
    """Lines of one block box. ``None`` among them asks for a blank line."""

    def __init__(self):
        self.lines: list[str | None] = []
        self.run: list[str] = []

    def flush(self) -> None:
        if self.run:
            for line in "".join(self.run).split(_BREAK):
                self.lines.append(_SPACE.sub(" ", line).strip(" "))
            # a break that only ends the block makes no line of its own
            if not self.lines[-1]:
                self.lines.pop()
            self.run = []

    def gap(self) -> None:
        self.flush()
        if self.lines and self.lines[-1] is not _GAP:
            self.lines.append(_GAP)

    def box(self, lines: list[str | None], first: str = "", rest: str = "") -> None:
        """Lines of an inner box, behind a marker and an indent."""
        self.flush()
        lead = first
        for line in lines:
            if line is _GAP:
                if self.lines and self.lines[-1] is not _GAP:
                    self.lines.append(_GAP)
            else:
                self.lines.append(lead + line if line else line)
                lead = rest if line or lead is rest else lead

    def done(self) -> list[str | None]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        start = 0
        while start < len(self.lines) and not self.lines[start]:
            start += 1
        return self.lines[start:]


def _render(node: Node, sink: Sink, pre: bool, seen: bool, depth: int) -> None:
    """Children of ``node`` into the sink; ``seen``: CSS visibility, inherited."""
    number = _number(node.attrs.get("start"), 1) if node.tag == "ol" else 0
    if node.tag == "ol" and "reversed" in node.attrs and "start" not in node.attrs:
        number = sum(1 for c in node.children if not isinstance(c, str) and c.tag == "li")
    closed = node.tag == "details" and "open" not in node.attrs
    for child in node.children:
        if isinstance(child, str):
            if seen and not closed:
                sink.run.append(child.replace("\r\n", "\n").translate(_KEEP) if pre else child)
            continue
        tag, attrs = child.tag, child.attrs
        if tag in UNSEEN or "hidden" in attrs or closed and tag != "summary" or tag == "dialog" and "open" not in attrs:
            continue
        style = _style(attrs) if "style" in attrs else {}
        if style.get("display") == "none":
            continue
        shown = {"visible": True, "hidden": False, "collapse": False}.get(style.get("visibility", ""), seen)
        if tag == "br":
            sink.run.append(_BREAK)
        elif tag == "wbr":
            pass
        elif tag == "input":
            if shown and attrs.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
                sink.run.append(f" {attrs.get('value', '')} ")
        elif tag == "hr":
            sink.gap()
        elif tag == "table":
            sink.gap()
            sink.box(_table(child, shown, depth))
            sink.gap()
        elif tag == "li":
            inner = Sink()
            _render(child, inner, pre, shown, depth + 1)
            if node.tag == "ol":
                number = _number(attrs.get("value"), number)
                mark = f"{number}. "
                number += -1 if "reversed" in node.attrs else 1
            else:
                mark = "* "
            sink.box(inner.done(), mark, " " * len(mark))
        elif tag in ("blockquote", "dd"):
            inner = Sink()
            _render(child, inner, pre, shown, depth + 1)
            sink.gap() if tag == "blockquote" else sink.flush()
            sink.box(inner.done(), "    ", "    ")
            sink.gap() if tag == "blockquote" else None
        elif tag in ("pre", "xmp", "listing", "plaintext", "textarea"):
            inner = Sink()
            kept = child.children
            if kept and isinstance(kept[0], str) and kept[0].startswith("\n"):
                child.children = [kept[0][1:], *kept[1:]]       # the parser drops a first line end
            _render(child, inner, True, shown, depth + 1)
            sink.gap()
            sink.box(inner.done())
            sink.gap()
        elif tag in BLOCK and style.get("display") not in ("inline", "inline-block"):
            spaced = tag in MARGIN and not (tag in ("ul", "ol", "menu", "dir") and node.tag in ("li", "ul", "ol", "menu", "dir"))
            sink.gap() if spaced else sink.flush()
            _render(child, sink, pre, shown, depth + 1)
            sink.gap() if spaced else sink.flush()
        elif style.get("display") in ("block", "flex", "grid", "list-item"):
            sink.flush()
            _render(child, sink, pre, shown, depth + 1)
            sink.flush()
        else:
            _render(child, sink, pre, shown, depth + 1)


def _rows(node: Node):
    """Captions and rows of a table; rows outside a section count as well."""
    loose = None
    for child in node.children:
        if isinstance(child, str):
            if child.strip(" \t\n\r\f"):
                yield "caption", Node("caption", {}), [child]
            continue
        style = _style(child.attrs) if "style" in child.attrs else {}
        if "hidden" in child.attrs or style.get("display") == "none" or style.get("visibility") == "collapse":
            continue
        if child.tag in ("thead", "tbody", "tfoot"):
            yield from _rows(child)
        elif child.tag == "tr":
            loose = None
            yield "row", child, child.children
        elif child.tag in ("td", "th"):
            if loose is None:
                loose = [child]
                yield "row", Node("tr", {}), loose
            else:
                loose.append(child)
        elif child.tag not in UNSEEN:
            yield "caption", child, None


def _held(spans: list[list[int]], new: list[list[int]]) -> list[list[int]]:
    """Spans left after a row, in order; neighbours that end together are one."""
    out: list[list[int]] = []
    for start, end, rows in sorted([*spans, *new]):
        if rows > 1:
            if out and out[-1][2] == rows - 1 and start <= out[-1][1]:
                out[-1][1] = max(out[-1][1], end)
            else:
                out.append([start, end, rows - 1])
    return out


def _table(table: Node, seen: bool, depth: int) -> list[str | None]:
    """Rows with cells in aligned columns, two blanks apart; spans keep their columns free."""
    out, grid = Sink(), []
    hanging: list[list[int]] = []            # columns held by cells of earlier rows, left to right
    for kind, node, children in list(_rows(table)):
        if kind == "caption":
            holder = Node("div", {})
            holder.children = [node] if children is None else children
            _render(holder, out, False, seen, depth + 1)
            out.flush()
            continue
        row, col, new = {}, 0, []
        for cell in children:
            if isinstance(cell, str):
                if not cell.strip(" \t\n\r\f"):
                    continue
                cell, text = Node("td", {}), cell
                cell.children = [text]
            if cell.tag in UNSEEN or "hidden" in cell.attrs or _style(cell.attrs).get("display") == "none":
                continue
            col = _free(hanging, col)
            inner = Sink()
            if cell.tag in ("td", "th"):
                shown = {"visible": True, "hidden": False}.get(_style(cell.attrs).get("visibility", ""), seen)
                _render(cell, inner, False, shown, depth + 1)
            else:
                holder = Node("td", {})
                holder.children = [cell]
                _render(holder, inner, False, seen, depth + 1)
            row[col] = [x or "" for x in inner.done()]
            wide = min(max(_number(cell.attrs.get("colspan"), 1), 1), 1000)
            tall = _number(cell.attrs.get("rowspan"), 1)
            tall = 65534 if tall == 0 else min(max(tall, 1), 65534)
            if tall > 1:
                new.append([col, col + wide, tall])
            row[col] = (row[col], wide)
            col += wide
        hanging = _held(hanging, new)
        grid.append(row)
    widths: dict[int, int] = {}
    for row in grid:
        for col, (lines, wide) in row.items():
            if wide == 1:
                longest = max((w for w in map(_width, lines) if w <= CELL_WIDTH), default=0)
                widths[col] = max(widths.get(col, 0), longest)
    places, total = {}, 0
    for col in sorted({c for row in grid for c in row}):
        places[col] = total
        total += widths.get(col, 0) + 2 if widths.get(col, 0) else 0
    for row in grid:
        for k in range(max((len(lines) for lines, _ in row.values()), default=0)):
            line = ""
            for col in sorted(row):
                lines, _ = row[col]
                if k < len(lines) and lines[k]:
                    wide = _width(line)
                    line += ("  " if wide + 2 > places[col] and line else " " * (places[col] - wide)) + lines[k]
            out.lines.append(line.rstrip(" "))
    return out.done()


def visible_text(page: str | None) -> str | None:
    """Rendered text of a page; null stays null."""
    if page is None:
        return None
    sys.setrecursionlimit(max(sys.getrecursionlimit(), FRAMES))
    root, sink = parse(page), Sink()
    _dress(root)
    _render(root, sink, False, True, 0)
    lines = ["" if x is _GAP else x for x in sink.done()]
    return "\n".join(lines).replace(_BLANK, " ").replace(_TAB, "\t").replace("\xa0", " ")


def extracted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text, n_lines: one row per input row.

    Null pages give null text and no lines, empty pages empty text. Elements
    nested over ``DEPTH`` deep become siblings; their text stays. Repeated rows
    are rendered as they come; other columns are not read.
    """
    C.prepare(pages.sparkSession)

    def run(batches):
        for pdf in batches:
            texts = [visible_text(h) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "text": pd.Series(texts, dtype=object),
                                "n_lines": [len(t.split("\n")) if t else 0 for t in texts]}).astype({"page_id": "Int64"})

    own = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{html_col}`").alias("html"))
    return own.mapInPandas(run, "page_id long, text string, n_lines long")
