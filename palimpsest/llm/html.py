"""Visible text of HTML pages, laid out as lines.

A tree is built from the tags, with those that authors leave out put in: paragraphs end where blocks begin, list items
and table parts where the next ones do. The tree is then rendered: hidden elements are left out, white
space collapses, blocks stand on lines of their own with blank lines where a browser has margins, list items carry markers, and
cells of a table stand in columns. Neither step recurses, so depth is no limit.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palimpsest.llm import words as W

# Fixed sets of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section "
    "summary table caption thead tbody tfoot tr td th ul xmp".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr listing menu ol p pre table ul xmp".split())
HIDDEN = frozenset(
    "area audio base basefont canvas col colgroup datalist embed head iframe link meta noembed noframes object param rp script "
    "source style template title track video".split()
)
# Not shown inside drawings and formulas.
HIDDEN_IN = {
    "svg": frozenset("clippath defs desc lineargradient marker mask metadata pattern radialgradient symbol".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
# Inputs that do not show their value as text.
NO_VALUE = frozenset("checkbox color file hidden image password radio range".split())
BUTTONS = frozenset("button reset submit".split())
ENDS_P = BLOCK - frozenset("body html li dd dt caption thead tbody tfoot tr td th option optgroup".split()) | {"li", "dd", "dt"}
# A start tag ends open elements of these names, looking no further up than the borders beside them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"thead", "tbody", "tfoot", "table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes script style template title head html".split())
# So that output stays linear, list items deeper than this keep their markers at this indent, and a table deeper than this lends
# its rows to the one around it.
DEEPEST = 12
# A table's padding is at most this many blanks a cell and this many for each of its characters.
PER_CELL, PER_CHARACTER = 256, 8
# Width of the screen that rules for media are held against, in pixels.
SCREEN = 1280

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_OTHER_SPACE = re.compile(r"[\t\n\r\f]|  ")
_BRACE = re.compile(r"[{};]")
_AT = re.compile(r"@([\w-]*)(.*)", re.S)
_FEATURE = re.compile(r"(min|max)-width\s*:\s*(\d+(?:\.\d+)?)\s*(px|em|rem)\Z")
_SELECTOR = re.compile(r"[.#]?[\w-]+\Z")


_PLAIN: dict[str, str] = {}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


class _Builder:
    """The open elements and how tags change them."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        self.names: dict[str, int] = {"html": 1}
        self.styles: list[Node] = []

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head" and text.strip():
            self.pop()
        if self.open[-1].tag in ("pre", "listing") and not self.open[-1].children:
            text = text.removeprefix("\r").removeprefix("\n")  # a line break right behind the tag is no text
        self.open[-1].children.append(text)

    def pop(self) -> None:
        self.names[self.open.pop().tag] -= 1

    def pop_through(self, names, borders) -> None:
        """Ends the open elements up to the outermost of the names below the nearest border, if one is open."""
        if not any(self.names.get(n) for n in names):
            return
        at = None
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in names:
                at = k
            if tag in borders:
                break
        if at is not None:
            while len(self.open) > at:
                self.pop()

    def start(self, tag: str, source: str, closed: bool) -> None:
        attrs = _attributes(source) if source else {}
        if tag == "html":
            return
        if self.names.get("head") and tag not in HEAD_ONLY:
            self.pop_through({"head"}, set())
        if tag == "body" and self.names.get("body"):
            return
        if tag in ENDS_P and self.names.get("p"):
            self.pop_through({"p"}, {"td", "th", "caption", "button", "table", "template"})
        if tag in IMPLIED:
            names, borders = IMPLIED[tag]
            # A table inside a cell is a border for its parts; so is a cell for lists and definitions.
            self.pop_through(names, borders if "table" in borders else borders | {"td", "th", "table"})
        if tag in ("td", "th") and self.names.get("table") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.push(Node("tr", {}))
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag == "style":
            self.styles.append(node)
        # A tag closes itself in drawings and formulas only.
        if tag not in VOID and not (closed and (tag in HIDDEN_IN or self.names.get("svg") or self.names.get("math"))):
            self.open.append(node)
            self.names[tag] = self.names.get(tag, 0) + 1

    def push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.names[node.tag] = self.names.get(node.tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
        elif tag == "p" and not self.names.get("p"):
            self.open[-1].children.append(Node("p", {}))
        elif self.names.get(tag) and tag not in ("html", "body"):
            inner = tag not in ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption")
            self.pop_last(tag, {"td", "th", "caption", "template"} if inner else ({"table"} if tag != "table" else set()))

    def pop_last(self, tag: str, borders) -> None:
        """Ends the innermost open element of the name, unless a border lies before it."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                while len(self.open) > k:
                    self.pop()
                return
            if self.open[k].tag in borders:
                return


def parse(source: str) -> Node:
    """The tree of a page; never fails, whatever the tags."""
    return _parse(source).root


def _parse(source: str) -> _Builder:
    builder = _Builder()
    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            builder.text(entities.unescape(source[at:]))
            break
        if m.start() > at:
            builder.text(entities.unescape(source[at : m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            builder.end(tag)
            continue
        rest = (m[3] if m[2] else m[6]) or ""
        builder.start(tag, rest, rest.rstrip().endswith("/"))
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            stop = close.start() if close else n
            raw = source[at:stop]
            if tag == "textarea":
                raw = entities.unescape(raw)
            if raw and builder.open[-1].tag == tag:
                builder.open[-1].children.append(raw)
            builder.end(tag)
            at = close.end() if close else n
        elif tag == "plaintext":
            builder.text(source[at:])
            break
    return builder


def _declared(style: str) -> dict[str, str]:
    out = {}
    for part in style.lower().split(";"):
        key, _, value = part.partition(":")
        out[key.strip()] = value.replace("!important", "").strip()
    return out


def _on_screen(media: str) -> bool:
    """Whether a list of media queries holds for a plain wide screen: its type and its width are known, no other feature."""

    def holds(part: str) -> bool:
        if part == "all" or part == "screen":
            return True
        m = _FEATURE.match(part.strip("() \t\r\n\f"))
        if m is None:
            return "orientation" in part and "landscape" in part
        width = float(m[2]) * (1 if m[3] == "px" else 16)
        return width <= SCREEN if m[1] == "min" else width >= SCREEN

    for one in media.lower().split(","):
        one = one.strip().removeprefix("only ").strip()
        turned = one.startswith("not ")
        parts = [x.strip() for x in re.split(r"\sand\b", one.removeprefix("not "))]
        if one and all(map(holds, parts)) != turned:
            return True
    return not media.strip()


def _sheet(styles: list[Node]) -> dict[str, dict[str, str]]:
    """What rules of the page's style elements say about display and visibility; simple selectors only.

    Rules inside @media count where it holds, those inside @layer always, those inside other @ blocks never.
    """
    out: dict[str, dict[str, str]] = {}
    for node in styles:
        if not _on_screen(node.attrs.get("media", "")):
            continue
        text = re.sub(r"/\*.*?(?:\*/|\Z)", "", "".join(c for c in node.children if isinstance(c, str)), flags=re.S)
        # Whether rules count, by open block; the selectors of the rule that is open, if one is.
        counts: list[bool] = [True]
        rule: str | None = None
        at = 0
        text += "}"  # the end of the sheet ends the last rule
        for m in _BRACE.finditer(text):
            part = text[at : m.start()].strip()
            if m[0] == ";":
                if rule is None:
                    at = m.end()  # a statement such as @import
                continue
            at = m.end()
            if m[0] == "}":
                if rule is not None and counts[-1]:
                    wanted = {k: v for k, v in _declared(part).items() if k in ("display", "visibility")}
                    for selector in rule.split(",") if wanted else ():
                        selector = selector.strip()
                        if _SELECTOR.match(selector):
                            out.setdefault(selector.lower(), {}).update(wanted)
                if rule is not None or len(counts) > 1:
                    counts.pop()
                rule = None
            elif part.startswith("@"):
                name, rest = _AT.match(part).groups()
                name = name.lower()
                counts.append(counts[-1] and (name == "layer" or name == "media" and _on_screen(rest)))
            else:
                counts.append(counts[-1] and rule is None)
                rule = part
    return out


class _Flow:
    """Lines under construction."""

    __slots__ = ("lines", "line", "gap", "space", "mark")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False
        self.space = False
        # Markers of list items that the next text stands behind.
        self.mark = ""

    def word(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.put(first)
            for part in rest:
                self.flush(True)
                self.put(part)
            return
        if _OTHER_SPACE.search(text):
            text = _SPACE.sub(" ", text)
        if text[:1] == " ":
            self.space = True
            text = text[1:]
        if not text:
            return
        if self.space and self.line:
            self.line.append(" ")
        self.space = text[-1] == " "
        self.put(text[:-1] if self.space else text)

    def put(self, text: str) -> None:
        if text:
            if self.gap and self.lines and not self.line:
                self.lines.append("")
            self.gap = False
            if self.mark:
                self.line.append(self.mark)
                self.mark = ""
            self.line.append(text)

    def flush(self, always: bool = False) -> None:
        """Ends the line; an empty one counts only where a line break asks for it."""
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        elif always and self.lines:
            self.lines.append("")
        self.space = False

    def block(self, spaced: bool) -> None:
        self.flush()
        self.gap = self.gap or spaced

    def add(self, lines: list[str]) -> None:
        self.flush()
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            if self.mark:
                lines = [self.mark + lines[0], *lines[1:]]
                self.mark = ""
            self.lines.extend(lines)

    def done(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _table(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table: cells of a column start at one place; a cell over several columns takes the first's.

    A column is as wide as its widest line, unless that many blanks in every line are more than the table may hold (PER_CELL,
    PER_CHARACTER); it is then as wide as the widest line that fits, and longer ones stand out.
    """
    placed: list[dict[int, list[str]]] = []
    busy: dict[int, int] = {}
    for row in rows:
        cells: dict[int, list[str]] = {}
        at = 0
        taken = {c for c, left in busy.items() if left > 0}
        held = {c: left - 1 for c, left in busy.items() if left > 1}
        for lines, columns, down in row:
            while at in taken:
                at += 1
            cells[at] = lines
            if down > 1:
                for c in range(at, at + columns):
                    held[c] = down - 1
            at += columns
        busy = held
        placed.append(cells)
    lengths: dict[int, list[int]] = {}
    blanks = height = 0
    for cells in placed:
        height += max((len(x) for x in cells.values()), default=0)
        for c, lines in cells.items():
            lengths.setdefault(c, []).extend(map(len, lines))
            blanks += PER_CELL + PER_CHARACTER * sum(len(x) - x.count(" ") for x in lines)
    width: dict[int, int] = {}
    for c in sorted(lengths):
        width[c] = next((n for n in sorted(lengths[c], reverse=True) if n * height <= blanks), 0)
        blanks -= width[c] * height
    columns = sorted(width)
    out = []
    for cells in placed:
        if not any(cells.values()):
            continue
        for k in range(max(len(x) for x in cells.values())):
            parts = []
            for c in columns:
                if c <= max(cells):
                    lines = cells.get(c, [])
                    parts.append((lines[k] if k < len(lines) else "").ljust(width[c]))
            out.append(" | ".join(parts).rstrip())
    return out


def _number(value: str | None, least: int, most: int, other: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(m[1]), least), most) if m else other


class _Renderer:
    def __init__(self, sheet: dict[str, dict[str, str]]):
        self.sheet = sheet
        self.flows = [_Flow()]
        self.lists: list[list] = []
        self.tables: list[list] = []

    def style(self, node: Node) -> dict[str, str]:
        out: dict[str, str] = {}
        if self.sheet:
            keys = [node.tag, *("." + c for c in node.attrs.get("class", "").lower().split()), "#" + node.attrs.get("id", "").lower()]
            for key in keys:
                out.update(self.sheet.get(key, ()))
        if "hidden" in node.attrs:
            out["display"] = "none"
        if "style" in node.attrs:
            out.update(_declared(node.attrs["style"]))
        return out

    def enter(self, node: Node, display: str, shown: bool) -> None:
        tag, flow = node.tag, self.flows[-1]
        if tag == "br":
            flow.flush(True)
            return
        if tag == "input":
            kind = node.attrs.get("type", "").lower().strip()
            value = node.attrs.get("value") or ("" if kind in BUTTONS else node.attrs.get("placeholder", ""))
            if shown and value and kind not in NO_VALUE:
                flow.word(" " + value + " ", False)
            return
        if tag in BLOCK or display in ("block", "list-item", "flex", "grid", "table"):
            nested = tag in ("ul", "ol", "menu", "dir") and bool(self.lists)
            flow.block(tag in SPACED and not nested)
        if tag in ("ul", "menu", "dir"):
            self.lists.append([None, len(self.flows)])
        elif tag == "ol":
            self.lists.append([_number(node.attrs.get("start"), -(10**9), 10**9, 1), len(self.flows)])
        elif tag in ("li", "dd", "blockquote"):
            if len(self.flows) <= DEEPEST:
                self.flows.append(_Flow())
            elif tag == "li":
                flow.mark += self.marker(node)
        elif tag == "table" and len(self.tables) < DEEPEST:
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.flows.append(_Flow())

    def marker(self, node: Node) -> str:
        """The marker of a list item, whose list counts on."""
        if not self.lists or self.lists[-1][0] is None:
            return "- "
        number = _number(node.attrs.get("value"), -(10**9), 10**9, self.lists[-1][0])
        self.lists[-1][0] = number + 1
        return f"{number}. "

    def leave(self, node: Node, display: str, opened: int) -> None:
        tag = node.tag
        if tag in ("br", "input"):
            return
        if tag in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
        elif tag in ("li", "dd", "blockquote") and len(self.flows) > opened:
            lines = self.flows.pop().done()
            marker = self.marker(node) if tag == "li" else "  "
            pad = " " * len(marker)
            head = marker if tag == "li" else pad
            self.flows[-1].add([(pad if k else head) + x if x else "" for k, x in enumerate(lines)])
        elif tag == "li":
            self.flows[-1].mark = ""  # an item without text has no marker
        elif tag in ("td", "th") and len(self.flows) > opened:
            lines = self.flows.pop().done()
            cell = (lines, _number(node.attrs.get("colspan"), 1, 1000, 1), _number(node.attrs.get("rowspan"), 1, 65534, 1))
            self.tables[-1][-1].append(cell)
        elif tag == "table" and opened < 0:
            self.flows[-1].add(_table(self.tables.pop()))
        if tag in BLOCK or display in ("block", "list-item", "flex", "grid", "table"):
            nested = tag in ("ul", "ol", "menu", "dir") and bool(self.lists)
            self.flows[-1].block(tag in SPACED and not nested)


def render(source: str | None) -> str | None:
    """The visible text of a page as lines; null for null, empty for a page without any."""
    if source is None:
        return None
    built = _parse(source)
    root = built.root
    r = _Renderer(_sheet(built.styles))
    by_tag = r.sheet.get
    chosen: dict[int, Node | None] = {}
    # (node, next child, pre, visible, display, mark, inside): mark is the depth of flows before, -1 for a table of its own; inside
    # is the drawing or formula around.
    stack: list[list] = [[root, 0, False, True, "", 0, ""]]
    while stack:
        frame = stack[-1]
        node, at, pre, visible, display, mark, inside = frame
        if at >= len(node.children):
            stack.pop()
            if node is not root:
                r.leave(node, display, mark)
            continue
        frame[1] += 1
        child = node.children[at]
        if isinstance(child, str):
            closed = node.tag == "details" and "open" not in node.attrs
            if visible and not closed and not (node.tag in ("table", "tr", "thead", "tbody", "tfoot", "select") and not child.strip()):
                r.flows[-1].word(child, pre)
            continue
        if child.tag in HIDDEN or inside and child.tag in HIDDEN_IN[inside]:
            continue
        style = r.style(child) if child.attrs else by_tag(child.tag) or _PLAIN
        if style.get("display") == "none" or child.tag == "dialog" and "open" not in child.attrs:
            continue
        if node.tag == "details" and "open" not in node.attrs and child.tag != "summary":
            continue
        if child.tag == "option":
            if id(node) not in chosen:
                chosen[id(node)] = _selected(node)
            if child is not chosen[id(node)]:
                continue
        shown = style.get("visibility", "visible" if visible else "hidden") not in ("hidden", "collapse")
        keeps = pre or child.tag in ("pre", "textarea", "listing", "xmp", "plaintext") or style.get("white-space", "").startswith("pre")
        mark = -1 if child.tag == "table" and len(r.tables) < DEEPEST else len(r.flows)
        display = style.get("display", "")
        r.enter(child, display, shown)
        if child.tag == "text" and inside == "svg":
            r.flows[-1].word(" ", False)  # texts of a drawing stand apart
        stack.append([child, 0, keeps, shown, display, mark, child.tag if child.tag in HIDDEN_IN else inside])
    return "\n".join(r.flows[0].done())


def _selected(parent: Node) -> Node | None:
    """The option a closed list shows: the first selected one, or the first."""
    options = [c for c in parent.children if isinstance(c, Node) and c.tag == "option"]
    return next((o for o in options if "selected" in o.attrs), options[0] if options else None)


def extract(pages: DataFrame, html: str = "html", out: str = "visible_text") -> DataFrame:
    """All columns of the pages with their visible text; a column named `out` is replaced.

    Null pages have null text, empty ones and those without visible text an empty one. Repeated rows give equal rows, and no
    rows none. Visible is what a browser without scripts shows: not the head, scripts, styles, templates and
    media; not elements with `hidden`, `display: none` or `visibility: hidden` in their style or in simple rules (one tag, class or id)
    of the page's style elements that hold on a screen 1,280 pixels wide; of closed details the summary, of a list of options the
    chosen one; texts of drawings and formulas; values of inputs, or else what stands in for them.
    Cells line up whatever their width, as long as a table's padding is at most 256 blanks a cell and 8 a character. List items
    deeper than 12 keep their markers, at the indent of the twelfth; cells of a table deeper than 12 are cells of the one around it.
    A task holds one page at a time, with its tree.
    """
    pages = pages.drop(out)
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, html):
            texts = [render(v.as_py()) for v in batch.column(html)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())]))
