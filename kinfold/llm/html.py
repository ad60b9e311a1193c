"""HTML to text by layout-aware rendering.

A tree builder supplies the tags that HTML lets authors leave out; a renderer walks the
tree and writes what a reader would see: blocks on lines of their own, blank lines round
paragraphs, bullets and numbers, preformatted text as it is, and table cells in columns,
spans of rows and columns included. Both are loops over explicit stacks, so nesting has no
limit, and both take time in proportion to the page: the tokenizer never reads a stretch
twice, and the builder knows the places of each kind of open element. Only layout is
bounded (``MAX_INDENT`` and the constants after it); text never is.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from html import unescape
from unicodedata import combining, east_asian_width

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "script style head template noscript iframe noembed noframes object datalist audio video canvas title "
    "defs desc metadata symbol clippath mask annotation annotation-xml".split()
)
#: Inputs whose value is shown as text.
SHOWN_INPUTS = frozenset("text search email url tel number date time month week datetime-local submit button reset".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td textarea tfoot "
    "th thead tr ul xmp".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir pre xmp blockquote figure table fieldset".split())
LISTS = frozenset("ul ol menu dir".split())
VERBATIM = frozenset("pre textarea xmp".split())
#: A start tag closes open elements of these kinds above the borders: the innermost one, or (True) all of them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}, False), "dt": ({"dt", "dd"}, {"dl"}, False), "dd": ({"dt", "dd"}, {"dl"}, False),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}, True), "td": ({"td", "th", "caption"}, {"tr", "table"}, False),
    "th": ({"td", "th", "caption"}, {"tr", "table"}, False), "option": ({"option"}, {"select", "datalist"}, False),
    "optgroup": ({"option", "optgroup"}, {"select"}, True), "body": ({"head"}, set(), False),
}
for _t in ("thead", "tbody", "tfoot"):
    CLOSES[_t] = ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}, True)
_IN_HEAD = frozenset("html head title base link meta style script noscript template".split())
_ENDS_P = BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "html", "body", "textarea"}
_KEEPS_P = ("table", "td", "th", "button")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_GONE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_STYLED = re.compile(r"(?:display|visibility)\s*:", re.I)
_RULE = re.compile(r"@[^{};]*[{;]|([^{}@]+)\{([^{}]*)\}|\}")
_SIMPLE = re.compile(r"[a-z][a-z0-9]*|[a-z0-9]*[.#][\w-]+", re.I)
#: Layout only: deeper lists are indented no further, deeper tables are blocks, wider cells are not padded to, rows run over.
MAX_INDENT, MAX_TABLES, MAX_CELL, MAX_ROW, MAX_RUNNING = 64, 8, 60, 1000, 200


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []

    def hidden(self, rules: dict[str, bool]) -> bool:
        a, tag = self.attrs, self.tag
        if tag in HIDDEN or "hidden" in a or (tag == "dialog" and "open" not in a) or ("style" in a and _GONE.search(a["style"])):
            return True
        if not rules:
            return False
        names = ["#" + a["id"]] if "id" in a else []
        names += ["." + c for c in a.get("class", "").split()]
        return any(rules.get(n) or rules.get(tag + n) for n in ["", *names])


def style_rules(css: str) -> dict[str, bool]:
    """Simple selectors (element, class, id, element with either) to whether they hide; the last rule of each counts.

    Blocks of at-rules are passed over, but for ``@media screen`` and ``@media all``.
    """
    out: dict[str, bool] = {}
    blocks: list[bool] = []  # per open at-block, whether its rules hold
    for m in _RULE.finditer(re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)):
        if m[0] == "}":
            if blocks:
                blocks.pop()
        elif m[0].startswith("@"):
            if m[0].endswith("{"):
                blocks.append(m[0][1:-1].split() in (["media", "screen"], ["media", "all"]))
        elif all(blocks) and _STYLED.search(m[2]):
            for selector in m[1].split(","):
                if _SIMPLE.fullmatch(selector.strip()):
                    out[selector.strip()] = bool(_GONE.search(m[2]))
    return out


def tokens(html: str):
    """Texts as they stand, and tags as (name, closing, attributes as text, end); in order, without comments.

    Sending a position back makes the next token start there (raw text is skipped so). A
    tag ends at the first ``>`` outside quotes; once quotes are found that never close, at
    the first ``>``. What never ends is text.
    """
    at, n, loose, seen = 0, len(html), False, 0
    while at < n:
        lt = html.find("<", seen)
        if lt < 0:
            break
        after = html[lt + 1 : lt + 2]
        if after == "!" or after == "?":
            if html.startswith("!--", lt + 1):
                end = html.find("-->", lt + 4)
                end = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                end = n if end < 0 else end + 1
            if lt > at:
                yield html[at:lt]
            at = seen = end
            continue
        name = _NAME.match(html, lt + 1)
        if not name:
            seen = lt + 1
            continue
        end = -1 if loose else _REST.match(html, name.end()).end()
        if end < 0 or end >= n or html[end] != ">":
            loose = True
            end = html.find(">", name.end())
            if end < 0:
                break
        if lt > at:
            yield html[at:lt]
        at = seen = end + 1
        back = yield (name[1].lower(), after == "/", html[name.end() : end], at)
        if back is not None:
            at = seen = back
            yield ""
    if at < n:
        yield html[at:]


def parse(html: str) -> Node:
    """The tree of a page; every text, however broken, has one. Hiding rules of its style sheets are in ``attrs``."""
    root = Node("html", {})
    rules: dict[str, bool] = {}
    stack = [root]
    places: dict[str, list[int]] = {"html": [0]}  # of each open tag in the stack, ascending

    def last(tag: str) -> int:
        at = places.get(tag)
        return at[-1] if at else -1

    def close(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().tag].pop()

    def put(node: Node) -> None:
        stack[-1].children.append(node)
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    source = tokens(html)
    for token in source:
        if isinstance(token, str):
            if token:
                if stack[-1].tag == "head" and token.strip():
                    close(len(stack) - 1)
                stack[-1].children.append(unescape(token))
            continue
        tag, closing, rest, at = token
        if closing:
            k = last(tag)
            if k < 0:
                if tag in ("p", "br"):
                    stack[-1].children.append(Node(tag, {}))
            elif k and (tag == "table" or last("table") <= k):  # a table keeps what closes outside it
                close(k)
            continue
        if last("head") >= 0 and tag not in _IN_HEAD:
            close(last("head"))
        if tag in _ENDS_P and (k := last("p")) >= 0 and max(map(last, _KEEPS_P)) < k:
            close(k)
        if tag in CLOSES:
            kinds, borders, every = CLOSES[tag]
            border = max([0, *map(last, borders)])
            if every:
                above = [p[i] for x in kinds if (p := places.get(x)) and (i := bisect_right(p, border)) < len(p)]
                if above:
                    close(min(above))
            elif (k := max(map(last, kinds))) > border:
                close(k)
        if tag in ("td", "th") and last("table") >= 0 and last("tr") < last("table"):
            put(Node("tr", {}))
        attrs = {a[0].lower(): unescape(a[1] or a[2] or a[3] or "") for a in _ATTR.findall(rest)} if rest else {}
        if tag in ("html", "body") and last(tag) >= 0:
            continue
        node = Node(tag, attrs)
        if tag in RAW:
            stack[-1].children.append(node)
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            raw = html[at : end.start() if end else len(html)]
            node.children.append(unescape(raw) if tag in ("textarea", "title") else raw)
            if tag == "style":
                rules |= style_rules(raw)
            source.send(end.end() if end else len(html))
        elif tag in VOID:
            stack[-1].children.append(node)
        else:
            put(node)
    root.attrs["rules"] = rules
    return root


def width(text: str) -> int:
    """Columns that a text takes: wide characters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


class _Box:
    """Lines of one column of text: the page, or one table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.marker = False, ""
        self.indent = 0

    def write(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.split("\n")
            self.parts.append(first)
            for x in rest:
                self.end(pre)
                self.parts.append(x)
        else:
            self.parts.append(re.sub(r"[ \t\n\f\r]+", " ", text))

    def end(self, pre: bool = False) -> None:
        line = "".join(self.parts)
        line = line.rstrip() if pre else re.sub(" +", " ", line).strip()
        self.parts = []
        if line or (pre and self.lines):
            if self.gap and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = False
            lead = " " * min(self.indent, MAX_INDENT)
            if self.marker:
                lead, self.marker = lead[: -len(self.marker)] + self.marker if len(lead) >= len(self.marker) else self.marker, ""
            self.lines.append((lead + line).rstrip())

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines).strip("\n")


def _number(text: str | None, most: int) -> int:
    """A span attribute, 1 unless it is a number; at most what HTML allows."""
    return min(int(text[:9]), most) if text and text.isascii() and text.isdecimal() else 1


class _Table:
    """Cells by row and column. Cells that run down from rows above keep their columns free."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.running: list[tuple[int, int, int]] = []  # first column, the one after the last, the row after the last

    def row(self) -> None:
        now = len(self.rows)
        self.rows.append([])
        if any(r[2] <= now for r in self.running):
            self.running = [r for r in self.running if r[2] > now]
        self.column = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        now = len(self.rows) - 1
        for a, b, until in self.running:
            if a <= self.column < b and until > now:
                self.column = b
        self.rows[-1].append((self.column, across, lines))
        if down > 1 and len(self.running) < MAX_RUNNING:
            # it holds from the next row on; sorted, so one pass finds the next free column
            self.running = sorted([*self.running, (self.column, self.column + across, now + down)])
        self.column += across

    def lines(self) -> list[str]:
        starts = sorted({c for r in self.rows for c, _, _ in r})
        need: dict[tuple[int, int], int] = {}  # by the columns a cell takes, of those where any cell begins
        for r in self.rows:
            for c, across, text in r:
                span = (bisect_left(starts, c), bisect_left(starts, c + across))
                need[span] = max([need.get(span, 0), *(min(width(t), MAX_CELL) for t in text)])
        wide = dict.fromkeys(starts, 0)
        for (a, b), n in sorted(need.items(), key=lambda x: x[0][1] - x[0][0]):
            if b - a == 1:
                wide[starts[a]] = n
            elif n:  # what a spanning cell needs beyond its columns widens the last of them
                wide[starts[b - 1]] += max(0, n - sum(wide[starts[k]] + 3 for k in range(a, b)) + 3)
        begin, at = {}, 0
        for c in starts:
            begin[c] = min(at, MAX_ROW)
            at += wide[c] + 3
        out = []
        for r in self.rows:
            for k in range(max((len(t) for _, _, t in r), default=0)):
                line, size = [], 0
                for c, _, text in r:
                    if c != starts[0]:
                        line.append(" " * (begin[c] - 3 - size) + " | ")
                        size = max(size, begin[c] - 3) + 3
                    part = text[k] if k < len(text) else ""
                    line.append(part)
                    size += width(part)
                line = "".join(line).rstrip()
                if line.strip(" |"):
                    out.append(line)
        return out


def render(root: Node) -> str:
    """The visible text of a tree."""
    page = _Box()
    boxes, tables, lists = [page], [], []
    pre = skipped = 0
    rules = root.attrs.get("rules", {})
    work: list = [("in", root)]
    while work:
        what, x = work.pop()
        box = boxes[-1]
        if isinstance(x, str):
            box.write(x, pre > 0)
            continue
        tag = x.tag
        if what == "in":
            if x.hidden(rules):
                continue
            if tag == "br":
                box.end(pre > 0)
                continue
            if tag == "input":
                if x.attrs.get("type", "text").lower() in SHOWN_INPUTS:
                    box.write(f" {x.attrs.get('value', '')} ", False)
                continue
            if tag in BLOCK:
                box.end()
                box.gap |= tag in SPACED and not lists and not (tag == "table" and tables)
            grid = tables and not skipped
            if tag == "table":
                if len(tables) < MAX_TABLES:
                    tables.append(_Table())
                else:
                    skipped += 1
            elif tag == "tr" and grid:
                tables[-1].row()
            elif tag in ("td", "th") and grid:
                if not tables[-1].rows:
                    tables[-1].row()
                boxes.append(_Box())
            elif tag in LISTS:
                start = x.attrs.get("start", "1")
                lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                box.marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                box.indent += len(box.marker)
                x.attrs = {"width": len(box.marker)}
            elif tag in ("blockquote", "dd"):
                box.indent += 2
            pre += tag in VERBATIM
            work.append(("out", x))
            shown = x.children
            if tag == "details" and "open" not in x.attrs:
                shown = [c for c in shown if isinstance(c, Node) and c.tag == "summary"][:1]
            work.extend(("in", c) for c in reversed(shown))
            continue
        grid = tables and not skipped
        if tag in ("td", "th") and grid:
            cell = boxes.pop().text().split("\n") if len(boxes) > 1 else []
            across = max(1, _number(x.attrs.get("colspan"), 1000))
            down = _number(x.attrs.get("rowspan"), 65534) or 65534  # 0: as far as the table goes
            tables[-1].cell([t for t in cell if t], across, down)
            continue
        if tag in VERBATIM:
            box.end(True)
            pre -= 1
        if tag == "table" and skipped:
            skipped -= 1
        elif tag == "table":
            box.end()
            for line in tables.pop().lines():
                box.parts.append(line)
                box.end(True)
        if tag in BLOCK:
            box.end()
            if tag in LISTS:
                lists.pop()
            box.gap |= tag in SPACED and not lists
        if tag == "li":
            box.indent -= x.attrs["width"]
            box.marker = ""
        elif tag in ("blockquote", "dd"):
            box.indent -= 2
    return page.text()


def extract(html: str | None) -> str:
    """Visible text of a page; null and empty give none."""
    return render(parse(html)) if html else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) per row; repeated rows repeat, an empty table gives none. No shuffle.

    Null and empty pages have no text. A very long page is rendered in one task, in time
    and memory in proportion to its length; other columns are not read.
    """
    import pyarrow as pa

    def run(batches):
        for b in batches:
            texts = [extract(h.as_py()).encode("utf-8", "replace") for h in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["page_id", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, text string")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` as text."""
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "text", F.length("text").alias("n_chars"))
