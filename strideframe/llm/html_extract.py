"""HTML to text by layout-aware rendering.

A tolerant tokenizer feeds a tree builder that knows implied end tags (p, li, td, tr, option, dt,
dd, head) and void elements; a renderer walks the tree and emits every visible text: blocks are set
apart by line breaks (paragraph-like ones by a blank line), list items get a bullet or number, and the
cells of a table are padded to column widths, over several lines if a cell has them. Hidden are head
matter, scripts, styles, templates, ``hidden`` attributes, ``display:none`` and ``visibility:hidden``
(but for children made visible again).

Every step costs in proportion to the page, however it is broken or nested: the places of open tags
are kept by name, so no end tag searches the stack, and nothing recurses. A table that holds tables
more than ``DEEP`` deep is taken as page layout: its cells become blocks. So do those of a table
whose columns would take more than ``AREA`` characters for each cell and character in it, as a tall cell beside very many others does.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
PLAIN = re.compile(r"[^'\">]*")
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp noembed noframes iframe".split())
ESCAPABLE = frozenset("textarea title".split())
UNSEEN = frozenset("head script style template noscript title iframe object svg math datalist meta link".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl hr article section figure".split())
BLOCK = APART | frozenset("html body div header footer main nav aside address form fieldset li dt dd tr caption figcaption details summary option center".split())
CELLS = ("td", "th")
GROUPS = ("tbody", "thead", "tfoot")
TABLE_ENDS = frozenset(("table", "tr", *GROUPS, "body", "html"))
#: a paragraph is ended by a block, unless one of these was opened inside it
HOLDS_P = ("td", "th", "li", "div", "table", "body", "article", "section")
#: an opening tag ends these open elements, up to the named boundary
IMPLIED = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", *CELLS), ("table",)), "td": (CELLS, ("tr", "table")), "th": (CELLS, ("tr", "table")), "option": (("option",), ("select",)), "tbody": ((*GROUPS, "tr", *CELLS), ("table",)), "thead": ((*GROUPS, "tr", *CELLS), ("table",)), "tfoot": ((*GROUPS, "tr", *CELLS), ("table",))}
DEEP = 3
WIDEST = 80
AREA = 128  # a table is laid out in columns while that takes up to so many characters for each cell and character it holds


class Node:
    __slots__ = ("tag", "attrs", "kids", "height")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids, self.height = tag, attrs, [], 0

    def values(self) -> dict[str, str]:
        if not self.attrs.strip():
            return {}
        return {k.lower(): v.strip("\"'").lower() for k, v in reversed(ATTR.findall(self.attrs))}


def _number(value: str | None, default: int, most: int) -> int:
    found = re.match(r"\s*(-?[0-9]{1,9})", value or "")
    return min(int(found[1]), most) if found else default


def tokens(markup: str):
    """(kind, name, rest): text, open or close; comments and declarations are left out.

    A tag ends at the first ``>`` outside quotes. Where a quote never closes, or no such ``>`` follows,
    quotes have no meaning from there on.
    """
    at, n, last = 0, len(markup), markup.rfind(">")
    quoted = {"'": markup.rfind("'"), '"': markup.rfind('"')}
    raw_end = None
    while at < n:
        if raw_end:
            found = re.compile(rf"</{raw_end}(?=[\s/>])", re.I).search(markup, at)
            end = found.start() if found else n
            yield "raw", raw_end, markup[at:end]
            at, raw_end = end, None
            continue
        if markup[at] != "<":
            end = markup.find("<", at)
            end = n if end < 0 else end
            yield "text", "", markup[at:end]
            at = end
            continue
        if markup.startswith("<!--", at):
            end = markup.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if at > last:  # no tag can end any more
            yield "text", "", markup[at:]
            return
        if markup[at + 1 : at + 2] in ("!", "?"):
            at = markup.find(">", at) + 1
            continue
        name = NAME.match(markup, at)
        if not name:
            yield "text", "", "<"
            at += 1
            continue
        end = PLAIN.match(markup, name.end()).end()
        while end < n and markup[end] != ">":
            quote = markup[end]
            close = markup.find(quote, end + 1) if quoted[quote] > end else -1
            end = PLAIN.match(markup, close + 1 if close >= 0 else end + 1).end()
        if end >= n:  # only inside quotes is there a >
            quoted = {"'": -1, '"': -1}
            end = markup.find(">", name.end())
        rest, tag = markup[name.end() : end], name[1].lower()
        at = end + 1
        if markup.startswith("</", name.start()):
            yield "close", tag, ""
        else:
            yield "open", tag, rest
            if tag in RAW or tag in ESCAPABLE:
                raw_end = tag


def parse(markup: str) -> Node:
    """The tree of a page; never fails."""
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = {}  # tag -> places in the stack

    def top(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def cut(i: int) -> None:
        while len(stack) > i:
            gone = stack.pop()
            places[gone.tag].pop()
            if gone.tag == "table" and (outer := top(("table",))):
                stack[outer].height = max(stack[outer].height, gone.height + 1)

    for kind, tag, rest in tokens(markup):
        if kind == "text":
            if stack[-1].tag == "head" and not rest.isspace():
                cut(len(stack) - 1)
            stack[-1].kids.append(entities.unescape(rest))
        elif kind == "raw":
            stack[-1].kids[-1].kids.append(entities.unescape(rest) if tag in ESCAPABLE else rest)
        elif kind == "close":
            i = top((tag,))
            if i and (tag in TABLE_ENDS or tag in CELLS or i > top((*CELLS, "table"))) and (tag == "table" or i > top(("table",)) or tag in ("body", "html")):
                cut(i)
        else:
            head = top(("head",))
            if head and tag not in IN_HEAD and tag != "head":
                cut(head)
            if tag in BLOCK and tag != "html" and (p := top(("p",))) > top(HOLDS_P):
                cut(p)
            if tag in IMPLIED:
                ends, stop = IMPLIED[tag]
                floor = top(stop)
                while (i := top(ends)) > floor:
                    cut(i)
            node = Node(tag, rest)
            stack[-1].kids.append(node)
            if tag not in VOID and tag not in RAW and tag not in ESCAPABLE and not (rest.endswith("/") and tag not in BLOCK):
                places.setdefault(tag, []).append(len(stack))
                stack.append(node)
    cut(1)
    return root


class _Page:
    """Text being laid out: breaks and spaces wait until the next word."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks, self.space, self.marker = 0, False, ""
        self.lists: list[list] = []  # open lists: [tag, next number]

    def feed(self, breaks: int) -> None:
        if not self.marker:
            self.breaks, self.space = max(self.breaks, breaks), False

    def put(self, word: str) -> None:
        if self.breaks and self.parts:
            self.parts.append("\n" * self.breaks)
        elif self.space and self.parts and not self.marker:
            self.parts.append(" ")
        if self.marker:
            self.parts.append(self.marker)
        self.parts.append(word)
        self.breaks, self.space, self.marker = 0, False, ""

    def text(self, raw: str, pre: bool) -> None:
        if pre:
            body = raw.rstrip("\n")
            if body:
                self.put(body)
            self.breaks += len(raw) - len(body)
            return
        words = raw.split()
        if not words:
            self.space = self.space or bool(raw)
            return
        self.space = self.space or raw[0].isspace()
        self.put(" ".join(words))
        self.space = raw[-1].isspace()

    def item(self, node: Node) -> None:
        depth, number = "  " * max(len(self.lists) - 1, 0), "- "
        if self.lists and self.lists[-1][0] == "ol":
            at = _number(node.values().get("value"), self.lists[-1][1], 10**9)
            number, self.lists[-1][1] = f"{at}. ", at + 1
        self.marker = depth + number

    def close_item(self) -> None:
        if self.marker:
            mark, self.marker = self.marker.rstrip(), ""
            self.put(mark)

    def done(self) -> str:
        return "".join(self.parts).strip("\n")


class _Table:
    """Cells of a table as they are rendered: rows of (text, columns, rows spanned)."""

    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []

    def lines(self) -> list[str]:
        placed, taken = [], {}  # taken: column -> row before which a cell above fills it
        widest, high = max(map(len, self.rows), default=0), len(self.rows)  # wider or longer spans cross nothing more
        budget = AREA * sum(len(text) + 1 for row in self.rows for text, _, _ in row)
        for at, row in enumerate(self.rows):
            out, c = [], 0
            for text, columns, rows in row:
                columns, rows = min(columns, widest), min(rows, high)
                while taken.get(c, 0) > at:
                    c += 1
                    budget -= 1
                out.append((c, columns, text.split("\n")))
                if rows > 1:
                    taken |= dict.fromkeys(range(c, c + columns), at + rows)
                c += columns
                budget -= columns
            placed.append(out)
            if budget < 0:
                return self.blocks()
        width: dict[int, int] = {}
        for row in placed:
            for c, columns, text in row:
                if columns == 1:
                    width[c] = max(width.get(c, 0), *(len(x) for x in text if len(x) <= WIDEST), 0)
        for row in placed:  # the room that all lines of the row take, to its last column
            last = max((c + columns for c, columns, _ in row), default=0)
            budget -= max((len(text) for _, _, text in row), default=0) * (sum(width.get(x, 0) for x in range(last)) + 2 * last)
            if budget < 0:
                return self.blocks()
        out = []
        for row in placed:
            if not any(any(text) for _, _, text in row):
                continue
            for k in range(max(len(text) for _, _, text in row)):
                line, column = "", 0
                for c, columns, text in row:
                    while column < c:  # a column that a cell above takes
                        line += " " * (width.get(column, 0) + 2)
                        column += 1
                    part = text[k] if k < len(text) else ""
                    room = sum(width.get(x, 0) for x in range(c, c + columns)) + 2 * (columns - 1)
                    line += part.ljust(room) + "  "
                    column = c + columns
                out.append(line.rstrip())
        return out


    def blocks(self) -> list[str]:
        return [line for row in self.rows for text, _, _ in row if text for line in text.split("\n")]


def render(root: Node) -> str:
    """Visible text with block spacing, lists and aligned table cells."""
    pages = [_Page()]
    work: list = [(root, False, True)]

    def table(node: Node, pre: bool, seen: bool) -> None:
        grid, steps, walk = _Table(), [], [(node, False)]
        rows: list[list[Node | str]] = []
        while walk:
            x, of_row = walk.pop()
            if isinstance(x, str):
                if x.strip():
                    rows.append([x])
            elif x is node or x.tag in GROUPS:
                walk.extend((kid, False) for kid in reversed(x.kids))
            elif x.tag == "tr":
                if not _gone(x):
                    rows.append([kid for kid in x.kids if not isinstance(kid, str) or kid.strip()])
            elif not _gone(x):
                rows.append([x])

        def begin():
            pages.append(_Page())

        def end(r, columns, spanned):
            grid.rows[r].append((pages.pop().done(), columns, spanned))

        for r, row in enumerate(rows):
            grid.rows.append([])
            for cell in row:
                v = cell.values() if isinstance(cell, Node) and cell.tag in CELLS else {}
                if isinstance(cell, Node) and _gone(cell):
                    continue
                spans = max(1, _number(v.get("colspan"), 1, 1000)), max(1, _number(v.get("rowspan"), 1, 65534))
                steps += [begin, (cell, pre, seen), lambda r=r, s=spans: end(r, *s)]

        def close():
            for line in grid.lines():
                pages[-1].feed(1)
                pages[-1].put(line)
            pages[-1].feed(2)

        work.append(close)
        work.extend(reversed(steps))

    while work:
        step = work.pop()
        if callable(step):
            step()
            continue
        node, pre, seen = step
        page = pages[-1]
        if isinstance(node, str):
            if seen:
                page.text(node, pre)
            continue
        tag = node.tag
        if tag == "br":
            page.breaks = min(page.breaks + 1, 2)
            page.space = False
            continue
        if tag == "hr":
            page.feed(2)
            continue
        if tag in VOID or _gone(node):
            continue
        style = node.values().get("style", "").replace(" ", "") if node.attrs else ""
        if "visibility:" in style:
            seen = "visibility:hidden" not in style and "visibility:collapse" not in style
        breaks = 2 if tag in APART else 1 if tag in BLOCK else 0
        if tag in ("ul", "ol") and page.lists or tag in (*CELLS, *GROUPS):
            breaks = 1
        if tag in CELLS and len(pages) > 1:
            breaks = 0
        if breaks:
            page.feed(breaks)
            work.append(lambda p=page, b=breaks: p.feed(b))
        if tag == "table" and node.height < DEEP:
            table(node, pre, seen)
            continue
        if tag == "li":
            page.item(node)
            work.append(page.close_item)
        elif tag in ("ul", "ol"):
            page.lists.append([tag, _number(node.values().get("start"), 1, 10**9)])
            work.append(lambda p=page: p.lists.pop())
        kids = node.kids
        if tag in ("pre", "textarea"):
            if kids and isinstance(kids[0], str) and kids[0].startswith("\n"):
                kids = [kids[0][1:], *kids[1:]]
            pre = True
        work.extend((kid, pre, seen) for kid in reversed(kids))
    return pages[0].done()


def _gone(node: Node) -> bool:
    if node.tag in UNSEEN:
        return True
    if not node.attrs:
        return False
    v = node.values()
    return "hidden" in v or "display:none" in v.get("style", "").replace(" ", "")


def html_to_text(markup: str | None) -> str:
    return render(parse(markup)) if markup else ""


def _extract(batches):
    for batch in batches:
        texts = [html_to_text(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pa.array([x.count("\n") + 1 if x else 0 for x in texts], pa.int64())], names=["id", "text", "n_chars", "n_lines"])


def html_extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: id_col, text, n_chars, n_lines.

    A null or empty page gives the empty text; broken markup never fails; repeated rows repeat; an
    empty table gives an empty result; other columns are ignored.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(_extract, f"id {kind}, text string, n_chars long, n_lines long").withColumnRenamed("id", id_col)
