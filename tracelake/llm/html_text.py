"""Visible text of web pages, laid out as a browser would place it: blocks, lists and aligned table cells."""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape
from itertools import zip_longest

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import small_batches

# Elements of HTML by how they are parsed and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head title script style template noscript noembed noframes iframe datalist area param source track object audio video canvas svg math".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset".split())
BLOCK = SPACED | frozenset("html body div section article aside header footer nav main address form li dt dd tr td th thead tbody tfoot caption center details summary dialog figcaption legend menu option optgroup select hgroup search dir".split())
CLOSES_P = BLOCK - frozenset("html body tr td th thead tbody tfoot caption option optgroup select".split())
LISTS = frozenset("ul ol menu dir".split())
#: What a start tag closes, and where looking for it stops.
IMPLIED_END = {
    "li": (("li",), LISTS), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("optgroup",), ("select", "datalist")),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr", "caption", "colgroup"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)), "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)), "body": (("head",), ("html",)),
}
HEADED = frozenset("html head title base link meta style script noscript template".split())
TOKEN = regex.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:!|\?|/[^a-zA-Z>])[^>]*(?:>|\Z)|</>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)", regex.DOTALL)
ATTRIBUTE = regex.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RULE = regex.compile(r"([^{}]+)\{([^{}]*)\}")
SIMPLE = regex.compile(r"([a-zA-Z][\w-]*)?(?:([.#])([\w-]+))?")
BLANKS = regex.compile(r"[ \t\n\r\f]+")


class Element:
    """A node of the tree; ``children`` holds elements and texts in order."""

    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: dict[str, str]) -> None:
        self.name, self.attrs, self.children = name, attrs, []


def parse(html: str) -> Element:
    """Tree of a page. Missing html, head and body are implied, and so are the ends of paragraphs, items, cells and rows; an
    end tag closes what was left open inside its element, and one without its element is ignored."""
    root = Element("html", {})
    body = None
    open_: list[Element] = [root]

    def close(names, stops=()) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].name in names:
                del open_[i:]
                return
            if open_[i].name in stops:
                return

    def push(name: str, attrs: dict[str, str]) -> Element:
        child = Element(name, attrs)
        open_[-1].children.append(child)
        open_.append(child)
        return child

    def text(value: str) -> None:
        nonlocal body
        if value:
            if body is None and len(open_) == 1 and not value.isspace():
                body = push("body", {})
            if open_[-1].name not in ("html", "table", "tbody", "thead", "tfoot", "tr") or not value.isspace():
                open_[-1].children.append(value)

    at = 0
    while at < len(html):
        found = TOKEN.search(html, at)
        if not found:
            text(unescape(html[at:]))
            break
        text(unescape(html[at : found.start()]))
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["end"]:
            if name == "br":
                open_[-1].children.append(Element("br", {}))
            elif name == "p" and not any(e.name == "p" for e in open_):
                open_[-1].children.append(Element("p", {}))
            elif name not in ("html", "body"):
                close((name,), () if name in BLOCK or name in ("head", "template") else BLOCK)
            continue
        attrs = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(found["attrs"] or "")}
        if name in ("html", "body") and (name == "html" or body is not None):
            (root if name == "html" else body).attrs.update(attrs)
            continue
        if name not in HEADED and body is None:
            close(("head",))
            body = push("body", attrs if name == "body" else {})
            if name == "body":
                continue
        if name in CLOSES_P:
            close(("p",), ("td", "th", "caption", "button", "template"))
        if name in IMPLIED_END:
            close(*IMPLIED_END[name])
        if name in ("td", "th") and open_[-1].name in ("table", "thead", "tbody", "tfoot"):
            push("tr", {})
        element = push(name, attrs)
        if name in VOID:
            open_.pop()
        elif name in RAW:
            ended = regex.compile(rf"</{regex.escape(name)}(?=[\s/>])[^>]*>?", regex.I).search(html, at)
            raw = html[at : ended.start() if ended else len(html)]
            element.children.append(unescape(raw) if name in ("title", "textarea") else raw)
            open_.pop()
            at = ended.end() if ended else len(html)
    return root


def _sheet_rules(root: Element) -> list[tuple[str, str, str, bool | None, bool | None]]:
    """Rules of the page's style elements that show or hide by one simple selector: (tag, sign, name, displayed, visible)."""
    rules, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.name == "style":
            for selectors, body in RULE.findall("".join(c for c in node.children if isinstance(c, str))):
                shown = _declared(body)
                for selector in selectors.split(",") if shown != (None, None) else ():
                    simple = SIMPLE.fullmatch(selector.strip())
                    if simple and selector.strip():
                        rules.append(((simple[1] or "").lower(), simple[2] or "", simple[3] or "", *shown))
        todo.extend(reversed([c for c in node.children if isinstance(c, Element)]))
    return rules


def _declared(style: str) -> tuple[bool | None, bool | None]:
    """Whether declarations display the element, and whether they make it visible; None where they say nothing."""
    found = {}
    for part in style.lower().split(";"):
        key, _, value = part.partition(":")
        found[key.strip()] = value.replace("!important", "").strip()
    display = found["display"] != "none" if "display" in found else None
    return display, (found["visibility"] == "visible" if "visibility" in found else None)


def _shown(node: Element, parent: Element | None, rules: list, visible: bool) -> tuple[bool, bool]:
    """Whether the element is displayed at all, and whether its own text is visible (which children may change back)."""
    attrs = node.attrs
    displayed = node.name not in UNSEEN and "hidden" not in attrs and not (node.name == "dialog" and "open" not in attrs)
    if parent is not None and parent.name == "details" and "open" not in parent.attrs and node.name != "summary":
        displayed = False
    for tag, sign, name, display, sight in rules:
        own = attrs.get("class", "").split() if sign == "." else [attrs.get("id")]
        if (not tag or tag == node.name) and (not sign or name in own):
            displayed = displayed if display is None or node.name in UNSEEN else display
            visible = visible if sight is None else sight
    if "style" in attrs:
        display, sight = _declared(attrs["style"])
        displayed = displayed if display is None or node.name in UNSEEN else display
        visible = visible if sight is None else sight
    return displayed, visible


class _Flow:
    """Lines of a block container. ``indent`` is put before each line, ``marker`` before the next one."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = False
        self.raw = False
        self.indent = 0
        self.marker = ""

    def write(self, text: str, pre: bool) -> None:
        self.raw |= pre
        if pre:
            first, *others = text.split("\n")
            self.now.append(first)
            for line in others:
                self.flush(keep=True)
                self.raw = True
                self.now.append(line)
        else:
            self.now.append(BLANKS.sub(" ", text))

    def flush(self, keep: bool = False) -> None:
        """End the line; ``keep`` keeps it even if it is empty. Preformatted text keeps its blanks."""
        line = "".join(self.now)
        line = line.rstrip() if self.raw else BLANKS.sub(" ", line).strip(" ")
        self.now.clear()
        self.raw = False
        if line or keep:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if self.blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self.blank = False
        for line in lines:
            lead = " " * (self.indent - len(self.marker)) + self.marker
            self.marker = ""
            self.lines.append((lead + line).replace("\xa0", " ").rstrip())

    def finish(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.taken: dict[tuple[int, int], bool] = {}
        self.captions: list[str] = []

    def add(self, attrs: dict[str, str], lines: list[str]) -> None:
        if not self.rows:
            self.rows.append([])
        row, column = len(self.rows) - 1, 0
        while (row, column) in self.taken:
            column += 1
        wide, tall = _number(attrs.get("colspan"), 100), _number(attrs.get("rowspan"), 1000)
        for r in range(row, row + tall):
            for c in range(column, column + wide):
                self.taken[r, c] = True
        self.rows[row].append((column, wide, lines))

    def render(self) -> list[str]:
        """Rows with their columns aligned, two blanks apart; a cell over several columns widens the last of them."""
        widths: dict[int, int] = {}
        for spans in (False, True):
            for column, wide, lines in (cell for row in self.rows for cell in row if (cell[1] > 1) == spans):
                need = max(map(len, lines), default=0)
                have = sum(widths.get(c, 0) + 2 for c in range(column, column + wide - 1))
                last = column + wide - 1
                widths[last] = max(widths.get(last, 0), need - have)
        starts = [0]
        for c in range(max(widths, default=-1) + 1):
            starts.append(starts[-1] + widths.get(c, 0) + (2 if widths.get(c, 0) else 0))
        out = list(self.captions)
        for row in self.rows:
            for parts in zip_longest(*[lines for _, _, lines in row], fillvalue=""):
                line = ""
                for (column, _, _), part in zip(row, parts, strict=True):
                    if part:
                        line = line.ljust(starts[column]) + part
                out.append(line.rstrip())
        return out


def _number(value: str | None, most: int) -> int:
    return min(max(int(value), 1), most) if value and value.strip().isascii() and value.strip().isdigit() else 1


def render(html: str | None) -> str:
    """Visible text of a page. Blocks start lines, those with margins (paragraphs, headings, lists, tables) stand between
    blank lines, items have bullets or numbers and indents, cells are aligned in columns, ``pre`` keeps its blanks."""
    root = parse(html or "")
    rules = _sheet_rules(root)
    flows, tables, lists = [_Flow()], [], []
    todo: list = [(root, None, True, False)]
    while todo:
        node, parent, visible, pre = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if visible and not (parent.name == "details" and "open" not in parent.attrs):
                flow.write(node, pre)
            continue
        if parent == "end":
            _end(node, flows, tables, lists)
            continue
        shown, visible = _shown(node, parent, rules, visible)
        if not shown:
            continue
        name = node.name
        if name == "br":
            flow.flush(keep=True) if flow.now else flow.put([""])
            continue
        if name in BLOCK:
            flow.flush()
            flow.blank |= name in SPACED and not (name in LISTS and lists)
        if name in LISTS:
            lists.append([name, _number(node.attrs.get("start"), 1 << 30)])
            flow.indent += 2
        elif name == "li" and lists:
            flow.marker = "- "
            if lists[-1][0] == "ol":
                lists[-1][1] = _number(node.attrs["value"], 1 << 30) if "value" in node.attrs else lists[-1][1]
                flow.marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
        elif name in ("dd", "blockquote"):
            flow.indent += 2
        elif name == "table":
            tables.append(_Table())
        elif name == "tr" and tables:
            tables[-1].rows.append([])
        elif name in ("td", "th", "caption") and tables:
            flows.append(_Flow())
        pre = pre or name in ("pre", "textarea")
        todo.append((node, "end", visible, pre))
        todo.extend((child, node, visible, pre) for child in reversed(node.children))
    return "\n".join(flows[0].finish())


def _end(node: Element, flows: list[_Flow], tables: list[_Table], lists: list) -> None:
    name = node.name
    if name in ("td", "th", "caption") and tables:
        lines = flows.pop().finish()
        tables[-1].captions.extend(lines) if name == "caption" else tables[-1].add(node.attrs, lines)
        return
    flow = flows[-1]
    if name in BLOCK:
        flow.flush()
        flow.blank |= name in SPACED and not (name in LISTS and len(lists) > 1)
    if name in LISTS:
        lists.pop()
        flow.indent -= 2
    elif name == "li":
        flow.marker = ""
    elif name in ("dd", "blockquote"):
        flow.indent -= 2
    elif name == "table":
        lines = tables.pop().render()
        if lines:
            flow.blank = True
            flow.put(lines)
            flow.blank = True


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(h) for h in batch.column("__html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(texts, pa.string())], ["__id", "text"])


def page_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col`` and ``text`` of every page: all its visible text.

    Hidden are the head, scripts, styles, templates, embedded media, elements with ``hidden`` or a style that hides them
    (their own or a simple rule of the page), closed details and dialogs. Null and empty pages give an empty text; a
    repeated row gets a row each; other columns are ignored. Pages are read whole, whatever their length or nesting.
    """
    rows = pages.select(F.col(id_col).alias("__id"), F.col(html_col).alias("__html"))
    done = small_batches(rows).mapInArrow(_rendered, f"__id {pages.schema[id_col].dataType.simpleString()}, text string")
    return done.withColumnRenamed("__id", id_col)
