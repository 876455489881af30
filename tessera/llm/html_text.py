"""HTML extraction by layout-aware rendering.

A tokenizer and a tree builder with implied end tags make a tree of the page; a renderer walks it and writes all visible
text: blocks on lines of their own with blank lines where browsers have margins, list items with bullets or numbers and
indented by depth, preformatted text as it is, and table cells aligned in columns, also where they span several columns
or rows. Neither recurses, so depth is no limit, and both take time in proportion to the page: a quote that never closes
makes the rest of the page be read without quotes, the open elements of each tag are looked up and not searched for,
indentation ends at INDENT levels, and tables within TABLES others are laid out as blocks.

Not visible: comments, head, scripts, styles, templates, what browsers with media support leave out (the content of
video, audio, canvas, object and iframe), definitions and annotations of SVG and MathML, and elements with `hidden`,
`display: none` or `visibility: hidden` in their style, hidden inputs and closed dialogs. There is no script engine, so
noscript shows.

Defined results: null and empty pages give the empty text; an empty table gives an empty result; repeated rows each
have a row; other columns are ignored. A page is worked on whole, in some hundred times its bytes if it is all tags.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, slices

#: Comments, character data, declarations, end tags and text; opening tags have a pattern of their own.
OTHER = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|[^<]++|<", re.DOTALL
)
QUOTED = re.compile(r"<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
UNQUOTED = re.compile(r"<([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
HIDING = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+(?:hidden|collapse)", re.IGNORECASE)
NUMBER = re.compile(r"\s*+(\d{1,5})")

#: Levels of lists and quotations that are indented, tables in tables that are aligned, columns a cell can span.
INDENT, TABLES, COLUMNS = 40, 16, 1000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes xmp".split())
RAW_WITH_ENTITIES = frozenset("title textarea".split())
UNSEEN = frozenset(
    "head script style template title iframe noembed noframes datalist audio video canvas object colgroup defs desc metadata annotation annotation-xml".split()
)
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr".split())
BLOCK = MARGIN | frozenset(
    "address article aside body center details dialog dd div dt fieldset figcaption footer form header html legend li main menu nav option section summary tr thead tbody tfoot caption text".split()
)
#: What an opening tag closes, and the ancestors beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
#: Opening these closes an open paragraph.
ENDS_P = BLOCK - {"body", "html", "option", "text", "tr", "thead", "tbody", "tfoot", "caption", "dt", "dd", "li"} | {"li", "dt", "dd"}
#: An end tag does not reach beyond these, unless it names one.
FENCES = frozenset({"table", "td", "th", "caption", "template", "html"})


#: End tags of these reach beyond a fence of another cell's content.
ROWS = frozenset({"tr", "tbody", "thead", "tfoot"})


class Element:
    __slots__ = ("tag", "children", "hidden", "start", "across", "down")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.hidden, self.start, self.across, self.down = tag, [], tag in UNSEEN, 1, 1, 1
        if attributes.strip():
            a = {k.lower(): html.unescape(v[1:-1] if v[:1] in "\"'" else v) for k, v in reversed(ATTRIBUTE.findall(attributes))}
            self.hidden |= "hidden" in a or bool(
                HIDING.search(a.get("style", ""))
            ) or tag == "input" and a.get("type", "").lower() == "hidden" or tag == "dialog" and "open" not in a
            if tag == "ol" and re.fullmatch(r"-?\d{1,9}", a.get("start", "")):
                self.start = int(a["start"])
            elif tag in ("td", "th"):
                if m := NUMBER.match(a.get("colspan", "")):
                    self.across = min(max(1, int(m[1])), COLUMNS)
                if m := NUMBER.match(a.get("rowspan", "")):
                    self.down = int(m[1]) or 1 << 16  # zero: all rows that follow
        elif tag == "dialog":
            self.hidden = True


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) in order, kind one of open, close, text, and raw for what is no markup."""
    at, last, quotes = 0, page.rfind(">"), True
    while at < len(page):
        if page[at] == "<" and page[at + 1 : at + 2].isalpha() and page[at + 1].isascii():
            m = None
            if at < last:
                m = QUOTED.match(page, at) if quotes else None
                if m is None:
                    quotes, m = False, UNQUOTED.match(page, at)
            if m is None:  # no tag ends from here on
                yield "text", "<", ""
                at += 1
                continue
            at = m.end()
            tag = m[1].lower()
            yield "open", tag, m[2]
            if tag in RAW or tag in RAW_WITH_ENTITIES:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.IGNORECASE).search(page, at)
                content = page[at : end.start() if end else len(page)]
                yield "raw", html.unescape(content) if tag in RAW_WITH_ENTITIES else content, ""
                at = end.end() if end else len(page)
            continue
        m = OTHER.match(page, at)
        at = m.end()
        if m[1]:
            yield "close", m[1].lower(), ""
        elif m[0].startswith("<![CDATA["):
            yield "text", m[0][9:].removesuffix("]]>"), ""
        elif m[0][:2] not in ("<!", "<?") or m[0] == "<":
            yield "text", html.unescape(m[0]), ""


def build(page: str) -> Element:
    """The tree of a page; missing end tags are implied, stray ones ignored."""
    root = Element("html")
    stack = [root]
    depths: dict[str, list[int]] = defaultdict(list, html=[0])  # where the open elements of each tag are in the stack

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            depths[stack.pop().tag].pop()

    def deepest(tags) -> int:
        return max((d[-1] for t in tags if (d := depths.get(t))), default=0)

    def close(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        """Close up to the outermost open element of tags that no element of stop encloses more closely."""
        fence = deepest(stop)
        found = [d[at] for t in tags if (d := depths.get(t)) and (at := bisect_right(d, fence)) < len(d)]
        if found:
            pop_to(min(found))

    for kind, name, attributes in tokens(page):
        if kind == "open":
            if name in ("html", "body") and depths.get(name):
                continue
            if name in CLOSES:
                close(*CLOSES[name])
            if name in BLOCK and name in ENDS_P and depths.get("p"):
                close({"p"}, FENCES | {"button"})
            if depths.get("head") and name not in ("title", "meta", "link", "base", "script", "style", "noscript", "template", "head"):
                if stack[-1].tag == "head":
                    pop_to(len(stack) - 1)
            node = Element(name, attributes)
            stack[-1].children.append(node)
            if name in VOID or name in RAW or name in RAW_WITH_ENTITIES or attributes.endswith("/") and depths.get("svg") or attributes.endswith("/") and name == "svg":
                continue
            depths[name].append(len(stack))
            stack.append(node)
        elif kind == "raw":
            stack[-1].children[-1].children.append(name)
        elif kind == "text":
            stack[-1].children.append(name)
        elif name == "p" and not depths.get("p"):
            stack[-1].children.append(Element("p"))
        elif name == "br":
            stack[-1].children.append(Element("br"))
        elif depths.get(name) and name not in ("html", "body"):
            depth = depths[name][-1]
            if name in FENCES or name in ROWS or deepest(FENCES) <= depth:
                pop_to(depth)
    return root


class Lines:
    """Text laid out in lines: collapsed white space, breaks, blank lines and indentation."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.blank = False
        self.indent = 0
        self.marker = ""

    def words(self, text: str) -> None:
        parts = text.split()
        if not parts:
            self.space |= bool(text)
            return
        if self.now and (self.space or text[0].isspace()):
            self.now.append(" ")
        self.now.append(" ".join(parts))
        self.space = text[-1].isspace()

    def flush(self) -> None:
        if self.now or self.marker:
            line = "".join(self.now)
            if line or self.marker:
                self.put(line)
        self.now, self.space = [], False

    def put(self, line: str) -> None:
        if self.blank and self.done:
            self.done.append("")
        self.blank = False
        pad = "  " * min(self.indent, INDENT)
        if self.marker:
            pad = pad[: max(0, len(pad) - len(self.marker))] + self.marker
            self.marker = ""
        self.done.append((pad + line).rstrip() if line else pad.rstrip())

    def newline(self) -> None:
        if self.now:
            self.flush()
        else:
            self.blank |= bool(self.done)

    def pre(self, text: str) -> None:
        first, *more = text.replace("\r\n", "\n").expandtabs(8).split("\n")
        self.now.append(first)
        for line in more:
            self.flush_pre()
            self.now.append(line)

    def flush_pre(self) -> None:
        self.put("".join(self.now))
        self.now, self.space = [], False

    def margin(self) -> None:
        self.flush()
        self.blank |= bool(self.done)


class Table:
    """Cells at their columns: a cell takes the next column that none from a row above reaches into."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.reach: dict[int, int] = {}  # column to the row up to which a cell from above takes it

    def row(self) -> None:
        self.rows.append([])

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        row, at = self.rows[-1], len(self.rows) - 1
        column = row[-1][0] + row[-1][1] if row else 0
        while self.reach.get(column, 0) > at:
            column += 1
        if down > 1:
            for k in range(column, column + across):
                self.reach[k] = at + down
        row.append((column, across, lines))

    def lines(self) -> Iterator[str]:
        rows = [r for r in self.rows if any(any(lines) for _, _, lines in r)]
        width: dict[int, int] = {}
        wide = []
        for r in rows:
            for column, across, lines in r:
                most = max(map(len, lines), default=0)
                if across == 1:
                    width[column] = max(width.get(column, 0), most)
                else:
                    wide.append((column, across, most))
        columns = sorted(width.keys() | {c for c, _, _ in wide})
        for column, across, most in wide:  # what a wide cell needs more goes to its last column
            inside = [c for c in columns if column <= c < column + across] if len(columns) <= COLUMNS else [column]
            lacking = most - sum(width.get(c, 0) + 2 for c in inside) + 2
            if lacking > 0:
                width[inside[-1]] = width.get(inside[-1], 0) + lacking
        begin, at = {}, 0
        for c in columns:
            begin[c] = at
            at += width.get(c, 0) + 2
        for r in rows:
            for n in range(max(len(lines) for _, _, lines in r)):
                line = ""
                for column, _, lines in r:
                    if n < len(lines) and lines[n]:
                        line = line.ljust(begin[column]) + lines[n]
                yield line


def render(root: Element) -> str:
    outs, tables, lists = [Lines()], [], []
    todo: list[tuple] = [(root, False)]
    pre = depth = 0
    while todo:
        node, closing = todo.pop()
        out = outs[-1]
        if isinstance(node, str):
            if pre:
                out.pre(node)
            else:
                out.words(node)
            continue
        tag = node.tag
        if not closing:
            if node.hidden:
                continue
            if tag == "br":
                out.newline()
                continue
            if tag == "table":
                out.margin()
                depth += 1
                if depth <= TABLES:
                    tables.append(Table())
            elif tag == "tr" and tables and depth <= TABLES:
                tables[-1].row()
            elif tag in ("td", "th") and tables:
                if depth <= TABLES:
                    outs.append(Lines())
                else:
                    out.flush()
            elif tag == "caption" and tables:
                out.flush()
            elif tag in ("ul", "ol", "menu"):
                if lists:
                    out.flush()
                else:
                    out.margin()
                lists.append([tag, node.start])
                out.indent += 1
            elif tag == "li":
                out.flush()
                kind = lists[-1] if lists else ["ul", 1]
                out.marker = f"{kind[1]}. " if kind[0] == "ol" else "* "
                kind[1] += 1
            elif tag == "dd":
                out.flush()
                out.indent += 1
            elif tag in MARGIN:
                out.margin()
                if tag == "blockquote":
                    out.indent += 1
            elif tag in BLOCK:
                out.flush()
            if tag == "pre":
                pre += 1
                if node.children and isinstance(node.children[0], str) and node.children[0].startswith("\n"):
                    node.children[0] = node.children[0][1:]
            elif tag == "q":
                out.words('"')
            todo.append((node, True))
            todo.extend((c, False) for c in reversed(node.children))
            continue
        if tag == "table":
            out.flush()
            if depth <= TABLES:
                for line in tables.pop().lines():
                    out.put(line)
            depth -= 1
            out.margin()
        elif tag in ("td", "th") and tables:
            if depth <= TABLES:
                cell = outs.pop()
                cell.flush()
                tables[-1].cell(cell.done, node.across, node.down)
            else:
                out.flush()
        elif tag in ("ul", "ol", "menu"):
            out.flush()
            lists.pop()
            out.indent -= 1
            if not lists:
                out.margin()
        elif tag == "pre":
            pre -= 1
            if out.now and not "".join(out.now):
                out.now = []
            out.margin()
        elif tag == "dd":
            out.flush()
            out.indent -= 1
        elif tag in MARGIN:
            out.margin()
            if tag == "blockquote":
                out.indent -= 1
        elif tag in BLOCK:
            out.flush()
        elif tag == "q":
            out.now.append('"')
    outs[0].flush()
    return "\n".join(outs[0].done).strip("\n")


def text_of(page: str | None) -> str:
    return render(build(page)) if page else ""


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html"):
        out = [text_of(p) for p in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """A row per page (page_id, url, html): page_id, url, text."""
    return pages.select(F.col("page_id").cast("long"), "url", "html").transform(in_arrow, texts, "page_id long, url string, text string")
