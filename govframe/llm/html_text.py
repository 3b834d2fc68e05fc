"""Layout-aware HTML rendering: a tree builder with implied tags, visibility rules, and a block renderer.

``parse`` builds a tree: void elements, raw-text elements, and the end tags that authors leave out (``p`` before a
block, ``li``, ``dt``/``dd``, ``option``, table parts; a missing ``tr`` is added).  An open ``head`` ends at the first text
or tag that is no head matter.  SVG and MathML are told apart from HTML: there, elements can close themselves, and HTML tags
lead out again.  ``render`` walks the tree and emits all text that a browser would show.

Visible is everything but: head matter, scripts, styles, templates, fallback content, elements with
``hidden``, ``display:none`` or ``visibility:hidden`` (a descendant may be ``visible`` again; both also from the page's
``style`` elements, for selectors of a tag, classes and ids, by their strength), closed dialogs and the body of closed details; in SVG, all outside ``text`` and ``foreignObject``, titles and definitions (``use`` is not
followed); in MathML, annotations and phantoms.

Blocks, and each SVG ``text``, stand on lines of their own; formulas run inline; paragraphs, headings, lists, tables and the like are set off by one
blank line.  White space collapses outside ``pre`` and ``textarea``.  List items get ``- `` or their number and are
indented by nesting.  Table cells, at any depth, are padded to their column's width and parted by two spaces; the
lines of a cell stay below each other, and row and column spans keep their grid places.  A cell wider than its columns
moves the rest of its row to a line below, in their places.  Widths count East Asian wide characters as two columns and combining marks as none.

Bounds that keep the output in proportion to the page, and lose no text: indentation stops growing at
``DEEPEST`` levels; a table whose padding alone would be over ``PADDING`` times its text (and over ``PADDING_LEAST``
characters) has its cells set below each other; elements nested deeper than ``DEPTH`` become neighbours instead, but what is
hidden there stays hidden.  Style rules with combinators, attributes or pseudo-classes, or inside at-rules, are not followed.

An empty table gives no rows.  Null, empty and text-only pages: empty text, or the text itself.  Repeated rows are rendered again.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govframe.llm.common import map_texts

DEEPEST, DEPTH, PADDING, PADDING_LEAST = 24, 512, 64, 20_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset(
    "head script style template noscript title meta link base iframe noembed noframes object audio video canvas datalist area param source track rp".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption textarea xmp".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul hr".split())
CLOSES_P = BLOCKS - frozenset("body html li dd dt td th tr tbody thead tfoot caption option optgroup legend summary textarea".split())
LISTS = frozenset(("ul", "ol", "menu"))
HEAD_MATTER = frozenset("title meta link base basefont bgsound script style template noscript noframes".split())
#: Elements of SVG and MathML that are not drawn; those that hold HTML; HTML tags that end open SVG and MathML.
UNDRAWN = frozenset(
    "title desc defs metadata style script symbol clippath mask marker pattern filter lineargradient radialgradient annotation annotation-xml mphantom".split()
)
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext".split())
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub "
    "sup table tt u ul var".split()
)
#: A start tag ends open elements of the second group, looked for up to the third.
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "table", "td", "th"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tr": (frozenset(("td", "th", "tr", "caption")), frozenset(("tbody", "thead", "tfoot", "table"))),
    "tbody": (frozenset(("td", "th", "tr", "tbody", "thead", "tfoot", "caption")), frozenset(("table",))),
    "thead": (frozenset(("td", "th", "tr", "tbody", "thead", "tfoot", "caption")), frozenset(("table",))),
    "tfoot": (frozenset(("td", "th", "tr", "tbody", "thead", "tfoot", "caption")), frozenset(("table",))),
    "rt": (frozenset(("rt", "rp")), frozenset(("ruby",))),
    "rp": (frozenset(("rt", "rp")), frozenset(("ruby",))),
}

_TAG = re.compile(
    r"<!--(?:>|->|(?s:.*?)(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>"
)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")


_SAYS_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SAYS_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\s*(!\s*important)?", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_BRACE = re.compile(r"[{}]")
_SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][a-zA-Z_-][\w-]*)*)")


class Node:
    __slots__ = ("attrs", "children", "kind", "sunk", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], kind: str = ""):
        self.tag, self.attrs, self.children, self.kind = tag, attrs, [], kind
        self.sunk: dict[str, int] | None = None  # elements in this one that are too deep to be opened, by tag

    def holds_html(self) -> bool:
        """Whether HTML stands in this element, which is one of SVG or MathML."""
        if self.tag == "annotation-xml":
            return self.attrs.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")
        return self.tag in HOLDS_HTML


class Sheet:
    """What the ``style`` elements of a page say about display and visibility, for selectors of one tag, classes and ids.

    Selectors with combinators, attributes or pseudo-classes, and rules inside at-rules, are left out.
    """

    def __init__(self):
        self.rules: dict[str, list[tuple]] = {}  # by an id, a class or the tag of the selector
        self.n = 0

    def add(self, css: str) -> None:
        css, at = _COMMENT.sub(" ", css), 0
        while (brace := css.find("{", at)) >= 0:
            head = css[at:brace].rpartition(";")[2].strip()
            if head.startswith("@"):
                depth, at = 1, brace + 1
                while depth and (m := _BRACE.search(css, at)):
                    depth, at = depth + (1 if m.group() == "{" else -1), m.end()
                if depth:
                    return
                continue
            stop = css.find("}", brace)
            body, at = css[brace + 1 : stop if stop >= 0 else len(css)], stop + 1 if stop >= 0 else len(css)
            said = {name: m for name, m in (("display", _SAYS_DISPLAY.search(body)), ("visibility", _SAYS_VISIBILITY.search(body))) if m}
            for selector in head.split(",") if said else ():
                self._rule(selector.strip(), said)

    def _rule(self, selector: str, said: dict[str, re.Match]) -> None:
        m = _SIMPLE.fullmatch(selector)
        if not selector or m is None:
            return
        tag = "" if m.group(1) in (None, "*") else m.group(1).lower()
        parts = re.findall(r"[.#][^.#]+", m.group(2))
        ids, classes = [p[1:] for p in parts if p[0] == "#"], frozenset(p[1:] for p in parts if p[0] == ".")
        self.n += 1
        rank = (len(ids), len(classes), bool(tag), self.n)
        for name, says in said.items():
            entry = (name, bool(says.group(2)), rank, says.group(1).lower(), tag, frozenset(ids), classes)
            self.rules.setdefault(parts[0] if parts else tag or "*", []).append(entry)

    def says(self, node: Node) -> dict[str, tuple[bool, tuple, str]]:
        """Per property the strongest rule that fits: whether it is important, its rank, the value."""
        out: dict[str, tuple[bool, tuple, str]] = {}
        if not self.rules:
            return out
        classes, name = frozenset(node.attrs.get("class", "").split()), node.attrs.get("id")
        for key in ("*", node.tag, *(f".{c}" for c in classes), f"#{name}"):
            for prop, important, rank, value, tag, ids, wanted in self.rules.get(key, ()):
                if (not tag or tag == node.tag) and wanted <= classes and all(i == name for i in ids):
                    out[prop] = max(out.get(prop, (False, (), "")), (important, rank, value))
        return out


class Page(Node):
    """The root of a page's tree, with its style rules."""

    __slots__ = ("sheet",)

    def __init__(self):
        super().__init__("#root", {})
        self.sheet = Sheet()


def kind_in(parent: Node, tag: str) -> str:
    """What a new element is: svg, text (in SVG, from its text elements on), object (a foreignObject), math, or empty for HTML."""
    if tag in ("svg", "math"):
        return tag
    if not parent.kind or parent.holds_html():
        return ""
    if parent.kind == "svg" and tag in ("text", "foreignobject"):
        return "text" if tag == "text" else "object"
    return parent.kind


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag; the first of equal names holds."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text) if text and not text.isspace() else ():
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def closes_itself(text: str) -> bool:
    """Whether a start tag ends in a slash that is no part of an unquoted value."""
    if not text.endswith("/"):
        return False
    last = None
    for last in _ATTR.finditer(text):
        pass
    return last is None or last.group(4) is None or last.end() < len(text)


def parse(page: str) -> Page:
    """The tree of a page; its children are nodes and strings."""
    root = Page()
    stack = [root]
    begun = False  # a second head, or one after content, counts for nothing

    def text(s: str, raw: bool = False) -> None:
        nonlocal begun
        if s and stack[-1].kind != "svg":
            s = html.unescape(s) if "&" in s and not raw else s
            if (stack[-1].tag == "head" or not begun) and s.strip(" \t\n\r\f"):
                begun = True
                leave_head()
            stack[-1].children.append(s)

    def leave_head() -> None:
        if stack[-1].tag == "head":
            stack.pop()

    def opened(node: Node) -> None:
        """Open an element; one that is too deep is only counted, unless its content must be told from its neighbours'."""
        top = stack[-1]
        if len(stack) < DEPTH or opens_deep(root.sheet, top, node, len(stack)):
            stack.append(node)
        else:
            top.sunk = top.sunk or {}
            top.sunk[node.tag] = top.sunk.get(node.tag, 0) + 1

    def close(tags: frozenset[str], barrier: frozenset[str]) -> None:
        """End open elements of ``tags``, outermost first met before a barrier."""
        found = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                found = i
            elif stack[i].tag in barrier or (stack[i].kind and stack[i].holds_html()):
                break
        if found:
            del stack[found:]

    p_only, p_barrier = frozenset(("p",)), frozenset(("td", "th", "table", "button", "caption", "object", "#root"))
    at = 0
    lowered = None
    while True:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            return root
        text(page[at : m.start()])
        at = m.end()
        end, start = m.group(1), m.group(2)
        if end:
            end = end.lower()
            if stack[-1].sunk and stack[-1].sunk.get(end):
                stack[-1].sunk[end] -= 1
            elif end == "p" and not _open(stack, p_only, p_barrier):
                stack[-1].children.append(Node("p", {}))
            elif end == "br":
                leave_head()
                stack[-1].children.append(Node("br", {}))
            elif end not in ("html", "body"):
                close_end(stack, end)
            continue
        if not start:
            if stack[-1].kind and page.startswith("<![CDATA[", m.start()):
                stop = page.find("]]>", m.start() + 9)
                stop = len(page) if stop < 0 else stop
                text(page[m.start() + 9 : stop], raw=True)
                at = stop + 3
            continue
        tag = start.lower()
        if tag in ("html", "body") and any(n.tag == tag for n in stack[1:3]):
            continue
        attrs = attributes(m.group(3))
        kind = kind_in(stack[-1], tag)
        if kind and (tag in BREAKS_OUT or (tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size")))):
            while stack[-1].kind and not stack[-1].holds_html():
                stack.pop()
            kind = ""
        if tag in ("head", "html"):
            if begun:
                continue
            begun = tag == "head"
        elif tag not in HEAD_MATTER:
            begun = True
            leave_head()
        if kind:
            node = Node(tag, attrs, kind)
            stack[-1].children.append(node)
            if not closes_itself(m.group(3)):
                opened(node)
            continue
        if tag in CLOSES_P:
            close(p_only, p_barrier)
        if tag in IMPLIED_ENDS:
            close(*IMPLIED_ENDS[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            lowered = page.lower() if lowered is None and len(page.lower()) == len(page) else lowered
            stop = _raw_end(page, lowered, tag, at)
            body = page[at:stop]
            if tag == "style" and attrs.get("media", "all").strip().lower() in ("all", "screen", ""):
                root.sheet.add(body)
            if body:
                node.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            close_at = page.find(">", stop)
            at = len(page) if close_at < 0 else close_at + 1
            continue
        opened(node)


def opens_deep(sheet: Sheet, top: Node, node: Node, depth: int) -> bool:
    """Whether an element deeper than ``DEPTH`` is opened: a hidden one, so that its content stays hidden, and, up to
    twice the depth, elements of SVG and MathML and those that set their visibility."""
    if hides(top, sheet):
        return False
    return hides(node, sheet) or (depth < 2 * DEPTH and (bool(node.kind) or visibility(node, sheet) is not None))


def _raw_end(page: str, lowered: str | None, tag: str, at: int) -> int:
    if lowered is not None:
        stop = lowered.find(f"</{tag}", at)
    else:
        m = re.compile(f"</{tag}", re.I).search(page, at)
        stop = m.start() if m else -1
    return len(page) if stop < 0 else stop


def _open(stack: list[Node], tags: frozenset[str], barrier: frozenset[str]) -> bool:
    for node in reversed(stack):
        if node.tag in tags:
            return True
        if node.tag in barrier or (node.kind and node.holds_html()):
            return False
    return False


_CELL = frozenset(("td", "th", "table", "caption"))


def close_end(stack: list[Node], tag: str) -> None:
    """An end tag ends the nearest open element of its name; inside a table cell only table tags reach out of it."""
    reaches = tag in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "caption")
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].kind:
            if not reaches and tag not in ("svg", "math") and stack[i].holds_html():
                return
        elif stack[i].tag == "table" or (not reaches and stack[i].tag in _CELL):
            return


class Flow:
    """Lines of a block container; inline text gathers until a line ends."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.space = False  # collapsed white space is due before more text
        self.indent = 0
        self.marker: str | None = None
        self.gap = False  # a blank line is due before the next line

    def text(self, s: str, keep: bool) -> None:
        if keep:
            first, *rest = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.end(force=True)
                self._put(line)
            return
        words = _SPACE.sub(" ", s)
        if words == " ":
            self.space = bool(self.inline)
            return
        if words:
            if words[0] == " ":
                self.space = bool(self.inline)
                words = words[1:]
            tail = words[-1] == " "
            self._put(words[:-1] if tail else words)
            self.space = tail

    def _put(self, s: str) -> None:
        if s:
            if self.space and self.inline:
                self.inline.append(" ")
            self.space = False
            self.inline.append(s)

    def end(self, force: bool = False) -> None:
        """End the line; an empty one only counts when forced."""
        if self.inline or force:
            self.line("".join(self.inline))
            self.inline = []
        self.space = False

    def line(self, s: str) -> None:
        if self.gap and self.lines and self.lines[-1] != "":
            self.lines.append("")
        self.gap = False
        pad = "  " * min(self.indent, DEEPEST)
        if self.marker is not None:
            pad, self.marker = f"{pad[:-2]}{self.marker}", None
        self.lines.append(f"{pad}{s}".rstrip())

    def block(self, spaced: bool) -> None:
        self.end()
        self.gap = self.gap or spaced

    def done(self) -> list[str]:
        self.end()
        if self.marker is not None:
            self.line("")
        return self.lines


def _number(value: str | None, least: int, most: int, default: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(m.group(1)), least), most) if m else default


def columns_of(s: str) -> int:
    """Columns that a line takes on a terminal."""
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Aligned lines of rows of (lines, colspan, rowspan)."""
    busy: dict[int, int] = {}  # column -> rows below that a cell from above still holds
    placed: list[list[tuple[int, list[str], list[int]]]] = []
    width: dict[int, int] = {}
    for row in rows:
        column, cells = 0, []
        held = {c for c, n in busy.items() if n}
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
        for lines, across, down in row:
            while column in held:
                column += 1
            widths = list(map(columns_of, lines))
            cells.append((column, lines, widths))
            if across == 1:
                width[column] = max(width.get(column, 0), max(widths, default=0))
            if down > 1:
                busy.update(dict.fromkeys(range(column, column + across), down - 1))
            column += across
        placed.append(cells)
    starts, at = {}, 0
    for column in sorted({c for cells in placed for c, _, _ in cells} | set(width)):
        starts[column] = at
        at += width.get(column, 0) + 2

    # at most what alignment adds: every line of a cell from the left margin on
    text = sum(len(line) - line.count(" ") for cells in placed for _, lines, _ in cells for line in lines)
    padded = sum(starts[column] * sum(map(bool, lines)) for cells in placed for column, lines, _ in cells)
    if padded > max(PADDING_LEAST, PADDING * text):
        return [line for cells in placed for _, lines, _ in cells for line in lines]

    out = []
    for cells in placed:
        for i in range(max((len(lines) for _, lines, _ in cells), default=0)):
            line, reach = "", 0
            for column, lines, widths in cells:
                if i >= len(lines) or not lines[i]:
                    continue
                start = starts[column]
                if reach and reach + 2 > start:  # the cell before is wider than its columns
                    out.append(line.rstrip())
                    line, reach = "", 0
                line += " " * (start - reach) + lines[i]
                reach = start + widths[i]
            out.append(line.rstrip())
    return out


class _Table:
    def __init__(self):
        self.rows: list[list] = []
        self.loose: list[str] = []  # captions and text outside cells


def hides(node: Node, sheet: Sheet) -> bool:
    a = node.attrs
    if node.kind:
        if node.tag in UNDRAWN or a.get("display") == "none":
            return True
    elif node.tag in HIDDEN or "hidden" in a or (node.tag == "dialog" and "open" not in a) or (node.tag == "input"):
        return True
    return _stated(node, "display", _SAYS_DISPLAY, sheet) == "none"


def visibility(node: Node, sheet: Sheet) -> str | None:
    """The visibility that an element sets for itself and what it holds."""
    return _stated(node, "visibility", _SAYS_VISIBILITY, sheet)


def _stated(node: Node, prop: str, says: re.Pattern, sheet: Sheet) -> str | None:
    """The value of a property: the last of the inline style, unless an important rule of the sheet is against it; else the sheet's."""
    rule = sheet.says(node).get(prop) if sheet.rules else None
    inline = None
    for inline in says.finditer(node.attrs["style"]) if "style" in node.attrs else ():
        pass
    if inline is not None and (rule is None or not rule[0] or inline.group(2)):
        return inline.group(1).lower()
    return rule[2] if rule else None


def render(root: Page) -> tuple[list[str], int, int]:
    """Lines, tables and list items of a tree."""
    flows, tables, lists = [Flow()], [], []
    n_tables = n_items = 0
    todo: list[tuple] = [("in", root, True, False)]  # what, node or text, visible, keep white space
    while todo:
        what, node, shown, keep = todo.pop()
        flow = flows[-1]
        if what == "text":
            if shown:
                flow.text(node, keep)
            continue
        tag = node.tag if not node.kind else "div" if node.tag in ("text", "foreignobject") else "span"
        if what == "in":
            if hides(node, root.sheet):
                continue
            if (sets := visibility(node, root.sheet)) is not None:
                shown = sets == "visible"
            if tag == "br":
                if shown:
                    flow.end(force=True)
                continue
            if tag == "wbr":
                continue
            keep = keep or tag in ("pre", "textarea", "xmp")
            if tag in BLOCKS:
                flow.block(tag in SPACED and not (tag in LISTS and lists))
            if tag in LISTS:
                lists.append([tag, _number(node.attrs.get("start"), -(10**9), 10**9, 1)])
            elif tag == "li":
                n_items += shown
                if not lists:
                    lists.append(["ul", 1])
                    todo.append(("unlist", node, shown, keep))
                own = lists[-1]
                own[1] = _number(node.attrs.get("value"), -(10**9), 10**9, own[1])
                flow.done() if flow.marker is not None else None
                flow.indent += 1
                if shown:
                    flow.marker = f"{own[1]}. " if own[0] == "ol" else "- "
                own[1] += 1
            elif tag == "dd":
                flow.indent += 1
            elif tag == "table":
                n_tables += shown
                tables.append(_Table())
                todo.append(("table", node, shown, keep))
                flows.append(Flow())
                _children(todo, node, shown, keep)
                continue
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in ("td", "th") and tables and tables[-1].rows:
                flows.append(Flow())
                todo.append(("cell", node, shown, keep))
                _children(todo, node, shown, keep)
                continue
            elif tag == "hr" and shown:
                flow.gap = True
            if tag not in VOID:
                todo.append(("out", node, shown, keep))
                _children(todo, node, shown, keep)
            continue
        if what == "unlist":
            lists.pop()
        elif what == "cell":
            cell = flows.pop().done()
            tables[-1].rows[-1].append((cell, _number(node.attrs.get("colspan"), 1, 1000, 1), _number(node.attrs.get("rowspan"), 1, 65534, 1)))
        elif what == "table":
            loose, own, outer = flows.pop().done(), tables.pop(), flows[-1]
            for line in [*loose, *table_lines(own.rows)]:
                outer.line(line)
            outer.block(True)
        else:
            if tag in BLOCKS:
                flow.block(False)
            if tag in LISTS:
                lists.pop()
            if tag == "li":
                if flow.marker is not None:  # an empty item keeps its mark
                    flow.line("")
                flow.indent -= 1
            elif tag == "dd":
                flow.indent -= 1
            if tag in BLOCKS:
                flow.block(tag in SPACED and not (tag in LISTS and lists))
    return flows[0].done(), n_tables, n_items


def _children(todo: list[tuple], node: Node, shown: bool, keep: bool) -> None:
    children = node.children
    if node.tag == "details" and "open" not in node.attrs:
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    todo.extend(("text", c, shown, keep) if isinstance(c, str) else ("in", c, shown, keep) for c in reversed(children))


def page_text(page: str | None) -> tuple[str, int, int, int]:
    """Rendered text of a page, its lines with text, tables and list items."""
    if not page:
        return "", 0, 0, 0
    lines, tables, items = render(parse(page))
    while lines and not lines[-1]:
        lines.pop()
    start = next((i for i, line in enumerate(lines) if line), 0)
    lines = lines[start:]
    return "\n".join(lines), sum(map(bool, lines)), tables, items


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, text, n_chars, n_lines, n_tables, n_items."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for page, source in rows:
            text, lines, tables, items = page_text(source)
            yield page, text, len(text), lines, tables, items

    counts = [(n, "long", pa.int64()) for n in ("n_chars", "n_lines", "n_tables", "n_items")]
    kept = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return map_texts(kept, run, [("page_id", "long", pa.int64()), ("text", "string", pa.string()), *counts], "page_id", "html")
