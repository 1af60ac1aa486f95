"""HTML extraction by layout-aware rendering.

A tolerant tokenizer feeds a tree builder that supplies implied start and end
tags; a renderer walks the tree and emits the visible text: paragraphs and
blocks on lines of their own with blank lines where browsers leave space,
list items with markers and indentation, preformatted text as it stands, and
table cells in aligned columns.

Defined results: NULL and empty pages give the empty text; markup that is cut
off or nested wrongly is closed where it ends; repeated rows are rendered
alike; an empty table gives an empty result. A very long page is handled whole,
in time linear in its length: open elements are found by tag, however deep they
lie. Columns are aligned up to 60 letters; a longer cell stands whole and moves
the rest of its row. Spans count up to 100.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
NEVER_SHOWN = frozenset(
    "head script style title template noscript noembed noframes iframe object audio video canvas "
    "svg math datalist map rp area base link meta param source track".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option "
    "optgroup p pre search section select summary table caption textarea ul xmp".split())
CLOSE_P = BLOCKS - frozenset("body html caption option optgroup select textarea legend".split())
#: Blocks with a blank line before and after.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr menu dir".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
SECTIONS = frozenset("tbody thead tfoot".split())
CELLS = frozenset("td th".split())

#: Opening the key closes open elements of the first set, up to one of the second.
IMPLIED_END = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "caption", "colgroup", *CELLS]), frozenset(["table"])),
    "td": (CELLS, frozenset(["table", "tr"])),
    "th": (CELLS, frozenset(["table", "tr"])),
    **{s: (SECTIONS | CELLS | {"tr", "caption", "colgroup"}, frozenset(["table"])) for s in SECTIONS},
    **{h: (HEADINGS, BLOCKS - HEADINGS) for h in HEADINGS},
}
#: End tags do not reach out of these.
FENCES = frozenset(["table", "td", "th", "caption", "html"])

WIDEST_COLUMN = 60
MOST_SPAN = 100

# A quote opens a value right after "=" only; elsewhere it is a letter like any other.
_NAME = r"(?:=[^\s/>=]*|[^\s/>=]+)"
_ATTRS = r"(?:[\s/]++|" + _NAME + r"(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])[^\s>]*))?)*+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)(" + _ATTRS + r")>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile("(" + _NAME + r")(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.S)
_CLOSE = {tag: re.compile("</" + tag, re.I | re.A) for tag in RAW - {"plaintext"}}
_SPACE = re.compile(r"[ \t\n\f\r]+")
_HIDE = re.compile(r"display\s*:\s*none", re.I)
_UNSEEN = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(text: str) -> dict[str, str]:
    """Lower-case names; the first of repeated attributes counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def build_tree(html: str) -> Node:
    """The document tree, with implied tags supplied."""
    root = Node("#root", {})
    stack = [root]
    where: dict[str, list[int]] = defaultdict(list)  # places of the open elements of each tag

    def push(tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag not in VOID:
            where[tag].append(len(stack))
            stack.append(node)

    def close(place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        for node in stack[place:]:
            where[node.tag].pop()
        del stack[place:]

    def nearest(tags: frozenset[str]) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def close_through(tags: frozenset[str], stop: frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` above the nearest one of ``stop``."""
        inner = [w for w in map(where.get, tags) if w]
        if inner:
            limit = nearest(stop)
            found = [w[bisect_right(w, limit)] for w in inner if w[-1] > limit]
            if found:
                close(min(found))

    def start(tag: str, attrs: dict[str, str]) -> None:
        if tag in CLOSE_P:
            close_through(frozenset(["p"]), FENCES)
        if tag in IMPLIED_END:
            close_through(*IMPLIED_END[tag])
        if tag in CELLS and stack[-1].tag in SECTIONS | {"table"}:
            push("tr", {})
        push(tag, attrs)

    def end(tag: str) -> None:
        if tag == "br":
            push("br", {})
            return
        if tag == "p" and not where.get("p"):
            start("p", {})
        fences = FENCES - {tag} if tag in FENCES | SECTIONS | {"tr"} else FENCES
        if tag in ("table", "tr", *SECTIONS):
            fences = frozenset(["table"]) - {tag}
        if where.get(tag) and where[tag][-1] > nearest(fences - {tag}):
            close(where[tag][-1])

    at, size = 0, len(html)
    while at < size:
        lt = html.find("<", at)
        if lt != at:
            stack[-1].children.append(html[at:lt if lt >= 0 else size])
            if lt < 0:
                break
        m = _TAG.match(html, lt)
        if m is None:
            stack[-1].children.append("<")
            at = lt + 1
            continue
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        tag = name.lower()
        if m.group(1) or m.group(4):
            end(tag)
            continue
        rest = m.group(3) if m.group(2) else m.group(6)
        start(tag, attributes(rest) if rest.strip(" /\t\n") else {})
        if tag in RAW and stack[-1].tag == tag:
            # searched in the page itself: lower-casing can change its length
            ending = _CLOSE[tag].search(html, at) if tag in _CLOSE else None
            stack[-1].children.append(html[at:ending.start() if ending else size])
            at = ending.start() if ending else size
    return root


class Flow:
    """Lines of one block formatting context."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.cur: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def end_line(self) -> None:
        if self.cur:
            self._add("".join(self.cur).rstrip(" "))
        self.cur, self.space = [], False

    def _add(self, line: str) -> None:
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap = 0
        lead = self.indent
        if self.marker:
            lead = self.indent[:len(self.indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + line) if line else "")

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and not self.marker:
            self.gap = 1

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s[0] == " ":
            self.space, s = True, s[1:]
        if not s:
            return
        if self.space and self.cur:
            self.cur.append(" ")
        self.space = s[-1] == " "
        self.cur.append(s[:-1] if self.space else s)

    def break_line(self) -> None:
        if self.cur:
            self.end_line()
        elif self.lines and not self.gap:
            self._add("")

    def verbatim(self, s: str) -> None:
        first, *more = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        if first:
            self.cur.append(first)
        for line in more:
            self._add("".join(self.cur).rstrip())
            self.cur = [line] if line else []

    def result(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "")
    return min(MOST_SPAN, max(1, int(value))) if value.strip().isdecimal() else 1


class Table:
    """Cells of one table as it is walked; ``lines`` aligns them."""

    def __init__(self) -> None:
        self.rows: list[dict[int, tuple[int, list[str]]]] = []
        self.held: dict[int, int] = {}
        self.at = 0

    def row(self) -> None:
        self.held = {c: n - 1 for c, n in self.held.items() if n > 1}
        self.rows.append({})
        self.at = 0

    def cell(self, node: Node, lines: list[str]) -> None:
        if not self.rows:
            self.row()
        while self.at in self.held:
            self.at += 1
        cols, rows = _span(node, "colspan"), _span(node, "rowspan")
        self.rows[-1][self.at] = (cols, lines)
        if rows > 1:
            self.held.update({c: rows for c in range(self.at, self.at + cols)})
        self.at += cols

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            for c, (span, lines) in row.items():
                if span == 1:
                    longest = max(map(len, lines), default=0)
                    width[c] = min(WIDEST_COLUMN, max(width.get(c, 0), longest))
        out = []
        for row in self.rows:
            if not any(lines for _, lines in row.values()):
                continue
            for k in range(max(len(lines) for _, lines in row.values())):
                text, place = "", 0
                for c in range(max(row) + 1):
                    if c in row:
                        text = text.ljust(place) if len(text) < place else text + "  " * bool(text)
                        lines = row[c][1]
                        text += lines[k] if k < len(lines) else ""
                    if c in width:
                        place += width[c] + 2
                out.append(text.rstrip())
        return out


def _shown(node: Node) -> bool:
    if node.tag in NEVER_SHOWN or "hidden" in node.attrs:
        return False
    if node.tag == "dialog" and "open" not in node.attrs:
        return False
    if node.tag == "input":
        return False
    return not _HIDE.search(node.attrs.get("style", ""))


def render(root: Node) -> str:
    """The visible text of a tree; walks with a stack of its own, so depth does not matter."""
    flow = Flow()
    flows: list[Flow] = [flow]
    tables: list[Table] = []
    lists: list[list] = []
    todo: list[tuple] = [("in", root, True, False)]
    while todo:
        step, node, seen, pre = todo.pop()
        if step == "text":
            if seen and node:
                text = unescape(node)
                flow.verbatim(text) if pre else flow.text(text)
            continue
        if step == "in":
            tag = node.tag
            if not _shown(node):
                continue
            state = _UNSEEN.search(node.attrs.get("style", ""))
            if state:
                seen = state.group(1).lower() == "visible"
            pre = pre or tag in ("pre", "textarea", "xmp")
            if tag == "br":
                flow.break_line()
                continue
            if tag in BLOCKS:
                flow.block(tag in SPACED and not (tag in LISTS and lists))
            kept = None
            if tag in LISTS:
                start = node.attrs.get("start", "")
                lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif tag == "li":
                kept = flow.indent
                marker = "- "
                if lists and lists[-1][0]:
                    value = node.attrs.get("value", "")
                    if re.fullmatch(r"-?\d{1,9}", value):
                        lists[-1][1] = int(value)
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                flow.indent += " " * len(marker)
                flow.marker = marker
            elif tag in ("blockquote", "dd"):
                kept = flow.indent
                flow.indent += "    "
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in CELLS and tables:
                flow = Flow()
                flows.append(flow)
                kept = lists
                lists = []
            todo.append(("out", (node, kept), seen, pre))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            if tag in ("pre", "textarea") and children and isinstance(children[0], str) \
                    and children[0][:1] == "\n":
                children = [children[0][1:], *children[1:]]
            todo += [("text" if isinstance(c, str) else "in", c, seen, pre) for c in reversed(children)]
            continue
        node, kept = node
        tag = node.tag
        if tag in CELLS and tables:
            lines = flow.result()
            flows.pop()
            flow, lists = flows[-1], kept
            tables[-1].cell(node, lines)
            continue
        if tag in BLOCKS:
            flow.end_line()
        if tag in LISTS and lists:
            lists.pop()
        elif tag in ("li", "blockquote", "dd"):
            flow.indent, flow.marker = kept, ""
        elif tag == "table":
            for line in tables.pop().lines():
                flow._add(line)
        if tag in BLOCKS:
            flow.block(tag in SPACED and not (tag in LISTS and lists))
    return "\n".join(flow.result())


def html_to_text(html: str | None) -> str:
    return render(build_tree(html)) if html else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text, n_chars of every whole page."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [html_to_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array(texts, pa.string())],
                                             names=["page_id", "text"])

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    return (rows.mapInArrow(run, "page_id long, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
