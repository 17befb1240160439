"""Layout-aware text of HTML pages (operator 1).

A page is cut into tags and text, a tree is built with the tags that HTML lets
authors leave out, and the tree is rendered: blocks on lines of their own,
blank lines around paragraphs, headings, lists and tables, list items with
their bullet or number, table cells aligned in columns, ``pre`` as it stands.
All text is emitted that a reader would see: not what sits in scripts, styles,
head, comments and templates, and not what ``hidden``, ``display: none`` or
``visibility: hidden`` hides, inline or by the page's own stylesheets. These
go through a small cascade (``css``): media blocks for a screen, source order,
specificity, ``!important``, inline styles, descendant and child selectors.

Pages are independent: one pass in Arrow batches, no shuffle. Walks use
explicit stacks, so deep nesting is no problem; only tables inside table cells
recurse, to ``NESTED`` levels, below which cells are rendered as blocks.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm import css
from pricewatch.llm import textscan as ts
from pricewatch.llm.settle import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("script style title head noscript template iframe noembed noframes datalist "
                   "object audio video canvas meta link base".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
                   "ol optgroup option p pre search section summary ul table caption tbody thead tfoot tr td th".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure menu dir".split())
ENDS_P = BLOCKS - frozenset("body html tbody thead tfoot tr td th caption option optgroup legend".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))
# an opened tag closes the open tags named first, up to but not through those named second
CLOSES = {
    "li": (("li",), LISTS), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("optgroup", "option"), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "caption", "colgroup"), ("table",)),
    "body": (("head",), ("html",)),
}
CLOSES["thead"] = CLOSES["tfoot"] = CLOSES["tbody"]
HEAD_TAGS = frozenset("title meta link base style script template noscript head html".split())
NESTED = 8

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "how")

    def __init__(self, tag, attrs=None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        self.how = None         # display: the subtree is gone; visibility: its text is, unless shown again; shown


def attributes(text: str) -> dict[str, str]:
    out = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(next((g for g in m.groups()[1:] if g is not None), "")))
    return out


def parse(page: str) -> tuple[Node, list[str]]:
    """The tree of a page and its stylesheets. Unclosed, stray and wrongly
    nested tags are repaired the way browsers do in common cases."""
    root, sheets = Node("#root"), []
    stack, count = [root], {}

    def pop():
        n = stack.pop()
        count[n.tag] -= 1

    def close(tags, stop):
        """Closes the outermost of ``tags`` that is open inside ``stop``."""
        if not any(count.get(t) for t in tags):
            return
        to = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in stop:
                break
            if stack[i].tag in tags:
                to = i
        while to is not None and len(stack) > to:
            pop()

    def text(s):
        if s:
            if count.get("head") and not s.isspace():
                close(("head",), ("html",))
            stack[-1].children.append(html.unescape(s) if "&" in s else s)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        slash, name, rest = (m[1], name.lower(), m[3]) if m[2] else (m[4], name.lower(), m[6])
        if slash:
            if name == "br":
                stack[-1].children.append(Node("br"))
            elif count.get(name):
                wall = () if name in ("table", "body", "html") else ("td", "th", "table") \
                    if name not in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else ("table",)
                place = next((i for i in range(len(stack) - 1, 0, -1)
                              if stack[i].tag == name or stack[i].tag in wall), 0)
                if place and stack[place].tag == name:
                    while len(stack) > place:
                        pop()
            elif name == "p":
                stack[-1].children.append(Node("p"))
            continue
        if name in ("html", "body") and count.get(name):
            continue
        if count.get("head") and name not in HEAD_TAGS:
            close(("head",), ("html",))
        if name in ENDS_P:
            close(("p",), ("td", "th", "table", "button", "caption"))
        if name in CLOSES:
            close(*CLOSES[name])
        if name in ("h1", "h2", "h3", "h4", "h5", "h6") and re.fullmatch("h[1-6]", stack[-1].tag):
            pop()
        node = Node(name, attributes(rest) if rest.strip() else None)
        stack[-1].children.append(node)
        if name in VOID or (rest.endswith("/") and name in ("svg", "math", "path", "g")):
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?|</{name}\Z", re.I).search(page, at)
            inner = page[at:stop.start() if stop else end]
            at = stop.end() if stop else end
            if name == "style":
                sheets.append(inner)
            elif name in ("textarea", "xmp"):
                node.children.append(html.unescape(inner) if name == "textarea" else inner)
            continue
        stack.append(node)
        count[name] = count.get(name, 0) + 1
    return root, sheets


def mark_hidden(root: Node, sheets: list[str]) -> None:
    """Sets ``how`` of all nodes by the cascade."""
    styles = css.Styles(sheets)
    todo = [(root, styles.begin())]
    while todo:
        node, above = todo.pop()
        found, inside = styles.of(node.tag, node.attrs, above)
        if node.tag in UNSEEN or node.tag == "input" or found.get("display") == "none":
            node.how = "display"
            continue
        see = found.get("visibility")
        node.how = {"hidden": "visibility", "collapse": "visibility", "visible": "shown"}.get(see)
        todo.extend((c, inside) for c in node.children if isinstance(c, Node))


class Page:
    """Lines being rendered."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.mark = ""              # a bullet that waits for its line
        self.indent = 0
        self.blank = False          # a blank line is due before the next line
        self.space = False

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s.startswith(" "):
            self.space, s = True, s[1:]
        if not s:
            return
        trail = s.endswith(" ")
        if self.space and self.line:
            self.line += " "
        self.line += s[:-1] if trail else s
        self.space = trail

    def flush(self, force: bool = False) -> None:
        if self.line or force:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            left = " " * self.indent
            if self.mark:
                left = " " * (self.indent - len(self.mark)) + self.mark
                self.mark = ""
            self.lines.append((left + self.line).rstrip())
        self.line, self.space = "", False

    def verbatim(self, s: str) -> None:
        parts = s.split("\n")
        for i, part in enumerate(parts):
            self.line += part.rstrip("\r")
            if i < len(parts) - 1:
                self.flush(force=True)


def width(s: str) -> int:
    """Columns on a fixed-width screen."""
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _number(text: str | None, default: int, most: int = 1000) -> int:
    m = re.match(r"\s*(-?\d{1,9})", text or "")
    return max(-most, min(most, int(m[1]))) if m else default


def render(node: Node, depth: int = 0) -> list[str]:
    """The lines of a tree."""
    page = Page()
    lists: list[list] = []              # (kind, next number)
    pre = 0
    todo: list = [(node, False, False)]     # (node or text, hidden, leaving)
    while todo:
        it, hidden, leaving = todo.pop()
        if isinstance(it, str):
            if hidden:
                continue
            if pre:
                page.verbatim(it)
            else:
                page.text(it)
            continue
        tag = it.tag
        if leaving:
            if tag == "pre":
                pre -= 1
            if tag in BLOCKS:
                page.flush()
            if tag in LISTS:
                lists.pop()
            if tag == "li" or tag == "dd" or tag == "blockquote":
                page.mark = ""
                page.indent -= hidden           # the indent is kept in this place
            if tag in SPACED and not (tag in LISTS and lists):
                page.blank = True
            elif tag in ("button", "select", "label"):
                page.space = True
            continue
        how = it.how
        if how == "display":
            continue
        hidden = True if how == "visibility" else False if how == "shown" else hidden
        if tag == "br":
            page.flush(force=not hidden)
            continue
        if tag == "hr":
            page.flush()
            page.blank = True
            continue
        if tag in BLOCKS:
            page.flush()
            if tag in SPACED and not (tag in LISTS and lists):
                page.blank = True
        children = it.children
        kept = hidden
        if tag in LISTS:
            lists.append([tag, _number(it.attrs.get("start"), 1)])
        elif tag == "li":
            ordered = lists and lists[-1][0] == "ol"
            if ordered:
                lists[-1][1] = _number(it.attrs.get("value"), lists[-1][1])
            mark = f"{lists[-1][1]}. " if ordered else "- "
            if ordered:
                lists[-1][1] += 1
            page.indent += len(mark)
            page.mark = mark if not hidden else ""
            kept = len(mark)
        elif tag in ("dd", "blockquote"):
            page.indent += 2
            kept = 2
        elif tag == "pre":
            pre += 1
            if children and isinstance(children[0], str) and children[0].startswith("\n"):
                children = [children[0][1:], *children[1:]]
        elif tag == "q" and not hidden:
            children = ["“", *children, "”"]
        elif tag == "details" and "open" not in it.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        elif tag == "table" and depth < NESTED:
            for line in _table(it, depth, hidden):
                page.line = line
                page.flush()
            page.blank = True
            continue
        elif tag in ("td", "th", "option"):
            page.space = True
        todo.append((it, kept, True))
        todo.extend((c, hidden, False) for c in reversed(children))
    page.flush()
    return page.lines


def _table(table_: Node, depth: int, hidden: bool) -> list[str]:
    """Caption, then rows with cells padded to their columns' widths."""
    before, rows = [], []
    todo = [(c, hidden) for c in reversed(table_.children)]
    while todo:
        it, unseen = todo.pop()
        if isinstance(it, str):
            if it.strip() and not unseen:           # stray text stands before the table
                before.append(" ".join(it.split()))
            continue
        how = it.how
        if how == "display":
            continue
        unseen = how == "visibility" or unseen and how != "shown"
        if it.tag == "tr":
            rows.append((it, unseen))
        elif it.tag in ("tbody", "thead", "tfoot"):
            todo.extend((c, unseen) for c in reversed(it.children))
        elif it.tag in ("td", "th"):                # a cell without its row
            rows.append((_inside("tr", [it]), unseen))
        elif it.tag not in ("colgroup", "col"):
            before.extend(_cell(it, depth, unseen))
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}                      # column: rows that a cell from above still fills
    spans: list[tuple[int, int, int]] = []
    for row, unseen in rows:
        line: dict[int, list[str]] = {}
        at = 0
        for cell in row.children:
            if isinstance(cell, str):
                if cell.strip() and not unseen:
                    before.append(" ".join(cell.split()))
                continue
            how = cell.how
            if how == "display":
                continue
            while taken.get(at):
                at += 1
            wide = max(1, _number(cell.attrs.get("colspan"), 1)) if cell.tag in ("td", "th") else 1
            high = max(1, _number(cell.attrs.get("rowspan"), 1)) if cell.tag in ("td", "th") else 1
            line[at] = _cell(cell, depth, how == "visibility" or unseen and how != "shown")
            if wide > 1:
                spans.append((len(grid), at, wide))
            for c in range(at, at + wide):
                if high > 1:
                    taken[c] = high
            at += wide
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        grid.append(line)
    across = {(r, c): w for r, c, w in spans}
    columns = max((c + 1 for line in grid for c in line), default=0)
    size = [0] * columns
    for r, line in enumerate(grid):
        for c, cell in line.items():
            if (r, c) not in across:
                size[c] = max([size[c], *map(width, cell)])
    for (r, c), wide in across.items():             # a wide cell stretches its last column
        inner = range(c, min(c + wide, columns))
        short = max([0, *map(width, grid[r][c])]) - sum(size[i] for i in inner) - 2 * (len(inner) - 1)
        if short > 0 and len(inner):
            size[inner[-1]] += short
    start = [sum(size[:c]) + 2 * c for c in range(columns)]
    out = list(before)
    for line in grid:
        for i in range(max((len(cell) for cell in line.values()), default=0)):
            text = ""
            for c, cell in sorted(line.items()):
                if i < len(cell) and cell[i]:
                    text += " " * max(start[c] - width(text), 2 if text else 0) + cell[i]
            out.append(text)
    return [line for line in out if line.strip()]


def _cell(cell: Node, depth: int, hidden: bool) -> list[str]:
    body = _inside("div", cell.children)
    if hidden:
        body.how = "visibility"
    return [line for line in render(body, depth + 1) if line]


def _inside(tag: str, children: list) -> Node:
    node = Node(tag)
    node.children = children
    return node


def page_text(page: str | None) -> str:
    """The visible text of a page; null and empty pages have the empty text."""
    if not page:
        return ""
    root, sheets = parse(page.replace("\r\n", "\n").replace("\0", ""))
    mark_hidden(root, sheets)
    return "\n".join(render(root))


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages``.

    Null and empty pages give the empty text; any other input is read as far
    as it can be (broken markup is repaired, what is no markup is text). Rows
    are independent, repeated ones give equal results, null ids and urls stay;
    other columns are ignored.
    """
    def run(batches):
        for piece in ts.slices(batches, "html"):
            texts = [page_text(t) for t in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col(column).cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))
