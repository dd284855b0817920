"""HTML extraction by layout-aware rendering: a tree with implied tags, visibility rules, blocks, lists and aligned tables."""

from __future__ import annotations

import html
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


#: Element names by their role in HTML.
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title xmp iframe noembed noframes noscript")
NEVER = _set("head script style template noscript title meta link base iframe object audio video canvas svg math datalist noembed noframes area map")
CLOSES_P = _set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul li dd dt"
)
SPACED = _set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu")
BLOCKS = SPACED | CLOSES_P | _set("html body tr td th thead tbody tfoot caption li dt dd option optgroup legend search")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
#: Which open elements a start tag closes, and what stops the search for them.
IMPLIED = {
    "li": (_set("li"), _set("ul ol menu dir")),
    "dt": (_set("dt dd"), _set("dl")),
    "dd": (_set("dt dd"), _set("dl")),
    "option": (_set("option"), _set("select datalist")),
    "optgroup": (_set("option optgroup"), _set("select")),
    "td": (_set("td th"), _set("tr table")),
    "th": (_set("td th"), _set("tr table")),
    "tr": (_set("td th tr"), _set("table")),
    "tbody": (_set("td th tr thead tbody tfoot caption colgroup"), _set("table")),
    "thead": (_set("td th tr thead tbody tfoot caption colgroup"), _set("table")),
    "tfoot": (_set("td th tr thead tbody tfoot caption colgroup"), _set("table")),
}
BARRIER = _set("td th caption button object table")
#: Elements nested deeper become siblings at this depth; they know the element above them, which may hide them.
DEEPEST = 200

#: Attributes as the HTML tokenizer reads them: a quote opens a value only right after =, elsewhere it is a character like others.
ATTRIBUTE = re.compile(
    r"""([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"([^"]*+)"|'([^']*+)'|([^ \t\n\r\f"'>][^ \t\n\r\f>]*+)|(?=>|\Z))|(?![ \t\n\r\f]*+=))"""
)
TAG = re.compile(rf"""<(/?)([a-zA-Z][^ \t\n\r\f/>]*+)((?:[ \t\n\r\f/]++|{re.sub(r"\((?=\[)", "(?:", ATTRIBUTE.pattern)})*+)>""")
COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.S)
#: A selector of one element: a tag name or *, then classes and ids.
SIMPLE = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)\Z")
#: At-rules whose rules count as if they stood outside; those of @media only if it is for the screen.
GROUPS = _set("media supports layer container scope starting-style")
OTHER_MEDIA = _set("print speech aural braille embossed handheld projection tty tv")
WHITE = " \t\n\r\f"


class Node:
    __slots__ = ("above", "attributes", "children", "look", "name", "state")

    def __init__(self, name: str, attributes: dict[str, str], above: Node | None = None):
        self.name, self.attributes, self.children, self.above, self.state, self.look = name, attributes, [], above, None, None


class Stack(list):
    """Open elements, and how many of them have each name."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.count = Counter([root.name])

    def push(self, node: Node) -> None:
        self.append(node)
        self.count[node.name] += 1

    def cut(self, k: int) -> None:
        for n in self[k:]:
            self.count[n.name] -= 1
        del self[k:]

    def add(self, x: str | Node) -> None:
        """Puts a child into the open element; beyond DEEPEST beside it, text after other elements in a piece of its own."""
        if len(self) <= DEEPEST:
            self[-1].children.append(x)
            return
        into, top = self[DEEPEST - 1].children, self[-1]
        if isinstance(x, Node):
            x.above = top
            into.append(x)
        elif into and into[-1] is top:
            top.children.append(x)
        else:
            if not (into and isinstance(into[-1], Node) and into[-1].name == "" and into[-1].above is top):
                into.append(Node("", {}, top))
            into[-1].children.append(x)


def parse(source: str) -> tuple[Node, list[tuple]]:
    """Tree of a page, and the rules of its style sheets about display and visibility."""
    root = Node("html", {})
    stack, css, at, end = Stack(root), [], 0, len(source)
    while at < end:
        lt = source.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            stack.add(html.unescape(source[at:lt]))
        if lt == end:
            break
        at = lt
        nxt = source[lt + 1 : lt + 2]
        if source.startswith("<!--", lt):
            m = COMMENT.match(source, lt)
            at = m.end() if m else end
            continue
        if nxt in ("!", "?") or nxt == "/" and not ((c := source[lt + 2 : lt + 3]).isascii() and c.isalpha()):
            stop = source.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        if not (nxt.isascii() and nxt.isalpha() or nxt == "/"):
            stack.add("<")
            at = lt + 1
            continue
        m = TAG.match(source, lt)
        if m is None:  # an unfinished tag ends the page
            break
        at, name = m.end(), m[2].lower()
        if m[1]:
            _close(stack, name)
            continue
        attributes = {}
        for a in ATTRIBUTE.finditer(m[3]):
            attributes.setdefault(a[1].lower(), html.unescape(next((v for v in a.groups()[1:] if v is not None), "")))
        _imply(stack, name)
        if name in ("html", "body") and stack.count[name]:
            stack[-1 if name == "body" else 0].attributes.update(attributes)
            continue
        node = Node(name, attributes)
        stack.add(node)
        if name in VOID:
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            body = source[at : stop.start() if stop else end]
            at = stop.start() if stop else end
            if name == "style" and _on_screen(attributes.get("media", "")):
                css += rules(body)
            node.children.append(html.unescape(body) if name == "textarea" else body)
        stack.push(node)
    return root, css


def _close(stack: Stack, name: str) -> None:
    if not stack.count[name]:
        return
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == name:
            stack.cut(k)
            return
        if stack[k].name in BARRIER and name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html"):
            return
        if stack[k].name == "table" and name not in ("body", "html"):
            return


def _imply(stack: Stack, name: str) -> None:
    if name in IMPLIED and any(stack.count[n] for n in IMPLIED[name][0]):
        closes, stops = IMPLIED[name]
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in stops:
                break
            if stack[k].name in closes:
                stack.cut(k)
                if name in ("li", "dt", "dd"):
                    break
                _imply(stack, name)
                break
    if name in CLOSES_P and stack.count["p"]:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in BARRIER:
                break
            if stack[k].name == "p":
                stack.cut(k)
                break
    if name == "body" or name not in ("head", "html", "title", "meta", "link", "script", "style", "base", "template", "noscript"):
        if stack[-1].name == "head":
            stack.cut(len(stack) - 1)
    if name in HEADINGS and stack[-1].name in HEADINGS:
        stack.cut(len(stack) - 1)


def declared(text: str) -> dict[str, tuple[bool, str]]:
    """display and visibility of a list of declarations: whether important, and the value. Later ones win, important ones always."""
    out: dict[str, tuple[bool, str]] = {}
    for part in text.split(";"):
        name, colon, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if colon and name in ("display", "visibility"):
            value, mark, _ = value.partition("!")
            important = bool(mark) and part.lower().rstrip().endswith("important")
            if important >= out.get(name, (False, ""))[0]:
                out[name] = (important, value.strip())
    return out


def _on_screen(query: str) -> bool:
    """Whether a media query list holds on some screen; conditions about sizes and the like are taken to hold."""
    for part in query.lower().split(","):
        words = re.sub(r"\([^)]*\)", " ", part).split()
        kinds = [w for w in words if w not in ("only", "not", "and", "or")]
        refused = bool(words) and words[0] == "not"
        kind = kinds[0] if kinds else "all"
        if not kinds or (kind not in OTHER_MEDIA) != refused:
            return True
    return False


def rules(css: str) -> list[tuple[str, tuple[str, ...], int, dict[str, tuple[bool, str]]]]:
    """Of a style sheet the rules with simple selectors about display or visibility: tag (or empty), classes and ids, specificity,
    declarations; in their order. Groups such as @media are entered if they are for the screen, other at-rules left out."""
    css, out, at, depth_skipped = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S), [], 0, 0
    for m in re.finditer(r"[{};]", css):
        head, at = css[at : m.start()].strip(), m.end()
        if depth_skipped:  # inside an at-rule that doesn't count
            depth_skipped += {"{": 1, "}": -1}.get(m[0], 0)
        elif m[0] == "{":
            if head.startswith("@"):
                name = re.match(r"@([\w-]*)", head)[1].lower()
                query = head[1 + len(name) :]
                no = name not in GROUPS or name == "media" and not _on_screen(query) or name == "supports" and query.strip().lower().startswith("not")
                depth_skipped = int(no)
            else:
                end = css.find("}", m.end())
                body = declared(css[m.end() : end if end >= 0 else len(css)])
                for part in head.split(",") if body else ():
                    s = SIMPLE.match(part.strip())
                    if s and part.strip():
                        names = tuple(re.findall(r"[.#][\w-]+", s[2]))
                        tag = "" if s[1] in (None, "*") else s[1].lower()
                        ids = sum(n[0] == "#" for n in names)
                        out.append((tag, names, ids * 1_000_000 + (len(names) - ids) * 1000 + bool(tag), body))
    return out


class Page:
    """Lines of one block. Margins of neighbours collapse into one blank line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = self.gap = False

    def text(self, s: str) -> None:
        parts = re.split(r"[ \t\n\r\f]+", s)
        for k, w in enumerate(parts):
            if k:
                self.space = True
            if w:
                self._open()
                if self.space and self.now:
                    self.now.append(" ")
                self.now.append(w)
                self.space = False

    def _open(self) -> None:
        if not self.now and self.gap and self.lines:
            self.lines.append("")
        self.gap = False if not self.now else self.gap

    def end(self, gap: bool = False) -> None:
        if self.now:
            self.lines.append("".join(self.now))
            self.now = []
        self.space = False
        self.gap |= gap

    def newline(self) -> None:
        if self.now:
            self.end()
        elif self.lines and self.lines[-1] != "":
            self.gap = True

    def block(self, lines: list[str], first: str = "", rest: str = "") -> None:
        self.end()
        if lines:
            self._open()
            self.lines += [(first if k == 0 else rest if x else "") + x for k, x in enumerate(lines)]

    def done(self) -> list[str]:
        self.end()
        lines = [x.replace("\xa0", " ").rstrip() for x in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


class Renderer:
    def __init__(self, css: list[tuple]):
        self.css = css

    def look(self, node: Node) -> tuple[str | None, str | None]:
        """display and visibility as declared for an element: important ones win, then its own style, then specificity, then order."""
        if node.look is None:
            best: dict[str, tuple] = {}
            if self.css:
                have = {"." + c for c in node.attributes.get("class", "").split()}
                if "id" in node.attributes:
                    have.add("#" + node.attributes["id"])
                for place, (tag, names, weight, body) in enumerate(self.css):
                    if (not tag or tag == node.name) and all(n in have for n in names):
                        for p, (important, value) in body.items():
                            best[p] = max(best.get(p, ()), (important, False, weight, place, value))
            if "style" in node.attributes:
                for p, (important, value) in declared(node.attributes["style"]).items():
                    best[p] = max(best.get(p, ()), (important, True, 0, 0, value))
            node.look = tuple(best[p][-1] if p in best else None for p in ("display", "visibility"))
        return node.look

    def shown(self, node: Node, seen: bool | None) -> bool | None:
        """Visibility of an element within one that is seen or not."""
        v = self.look(node)[1]
        return True if v == "visible" else False if v in ("hidden", "collapse") else seen

    def inherited(self, node: Node | None) -> tuple[bool, bool | None]:
        """Whether an element beyond DEEPEST or one of those above it there is gone or shut, and its visibility if they set it."""
        todo = []
        while node is not None and node.state is None:
            todo.append(node)
            node = node.above
        state = node.state if node is not None else (False, None)
        for x in reversed(todo):
            seen = self.shown(x, state[1])
            up = x.above
            shut = up is not None and "open" not in up.attributes and (up.name == "dialog" or up.name == "details" and x.name != "summary")
            state = x.state = (state[0] or shut or self.hidden(x), seen)
        return state

    def gone(self, node: Node) -> bool:
        return self.hidden(node) or node.above is not None and self.inherited(node)[0]

    def hidden(self, node: Node) -> bool:
        if node.name in NEVER:
            return True
        display = self.look(node)[0]
        return "hidden" in node.attributes if display is None else display == "none"

    def lines(self, nodes: list, seen: bool, pre: bool = False) -> list[str]:
        page = Page()
        self.flow(nodes, page, seen, pre)
        return page.done()

    def flow(self, nodes: list, page: Page, seen: bool, pre: bool) -> None:
        for x in nodes:
            if isinstance(x, str):
                if seen and pre:
                    for k, part in enumerate(x.expandtabs(8).split("\n")):
                        if k:
                            page._open()
                            page.lines.append("".join(page.now))
                            page.now = []
                        if part:
                            page._open()
                            page.now.append(part)
                elif seen:
                    page.text(x)
            elif not self.gone(x):
                self.element(x, page, seen, pre)

    def element(self, x: Node, page: Page, seen: bool, pre: bool) -> None:
        name = x.name
        if x.above is not None and (above := self.inherited(x)[1]) is not None:
            seen = above
        seen = self.shown(x, seen)
        if name == "br":
            page.newline()
        elif name == "input":
            kind = x.attributes.get("type", "text").lower()
            if seen and kind not in ("hidden", "password", "checkbox", "radio", "file", "image", "color", "range"):
                page.text(" " + x.attributes.get("value", "") + " ")
        elif name == "select":
            page.text(" ")
            self.flow(self.options(x), page, seen, pre)
            page.text(" ")
        elif name == "details" and "open" not in x.attributes:
            page.end()
            self.flow([c for c in x.children if isinstance(c, Node) and c.name == "summary"][:1], page, seen, pre)
            page.end()
        elif name == "dialog" and "open" not in x.attributes:
            pass
        elif name == "q":
            page.text('"') if seen else None
            self.flow(x.children, page, seen, pre)
            page.text('"') if seen else None
        elif name in ("ul", "ol", "menu", "dir"):
            page.end(gap=True)
            page.block(self.items(x, seen))
            page.end(gap=True)
        elif name == "li":
            page.block(self.lines(x.children, seen), "- ", "  ")
        elif name == "dd" or name == "blockquote":
            page.end(gap=name == "blockquote")
            page.block(self.lines(x.children, seen), "    ", "    ")
            page.end(gap=name == "blockquote")
        elif name == "table":
            page.end(gap=True)
            page.block(self.table(x, seen))
            page.end(gap=True)
        elif name in ("pre", "textarea", "listing"):
            page.end(gap=True)
            children = list(x.children)
            if children and isinstance(children[0], str) and children[0].startswith("\n"):
                children[0] = children[0][1:]
            page.block(self.lines(children, seen, pre=True))
            page.end(gap=True)
        elif name in BLOCKS:
            page.end(gap=name in SPACED)
            self.flow(x.children, page, seen, pre)
            page.end(gap=name in SPACED)
        else:
            self.flow(x.children, page, seen, pre)

    def options(self, x: Node) -> list:
        every = [c for c in self.inside(x, _set("optgroup")) if c.name == "option"]
        if "multiple" in x.attributes:
            return every
        return [c for c in every if "selected" in c.attributes][-1:] or every[:1]

    def inside(self, x: Node, through: frozenset[str]) -> list[Node]:
        out = []
        for c in x.children:
            if isinstance(c, Node) and not self.gone(c):
                out += self.inside(c, through) if c.name in through else [c]
        return out

    def items(self, x: Node, seen: bool) -> list[str]:
        page, place = Page(), _number(x.attributes.get("start"), 1)
        for c in x.children:
            if isinstance(c, Node) and c.name == "li" and not self.gone(c):
                shown = self.shown(c, seen)
                place = _number(c.attributes.get("value"), place)
                sign = f"{place}. " if x.name == "ol" else "- "
                place += 1
                lines = self.lines(c.children, shown)
                if lines or shown and x.name == "ol":
                    page.block(lines or [""], sign, " " * len(sign))
            else:
                nested = isinstance(c, Node) and c.name in ("ul", "ol", "menu", "dir")
                lines = self.lines([c], seen)
                page.block(lines, "  " if nested else "", "  " if nested else "")
        return page.done()

    def stray(self, x: Node) -> list[str]:
        """Text directly in rows and groups of rows, which stands before the table."""
        out = []
        for c in x.children:
            if isinstance(c, str):
                out += [c] if c.strip(WHITE) else []
            elif x.name != "tr" and c.name == "tr" and not self.gone(c):
                out += self.stray(c)
        return out

    def table(self, x: Node, seen: bool) -> list[str]:
        out, rows = [], []
        loose: list = []
        for c in x.children:
            if isinstance(c, str):
                loose += [c] if c.strip(WHITE) else []
            elif self.gone(c) or c.name in ("colgroup", "col"):
                continue
            elif c.name in ("tr", "thead", "tbody", "tfoot"):
                loose += self.stray(c)
            elif c.name == "caption" or c.name not in ("tr", "td", "th", "thead", "tbody", "tfoot"):
                loose.append(c)
        out += self.lines(loose, seen)
        cells: list[Node] = []
        groups = [c for c in x.children if isinstance(c, Node) and not self.gone(c)]
        groups.sort(key=lambda c: {"thead": 0, "tfoot": 2}.get(c.name, 1))
        for c in groups:
            if c.name in ("td", "th"):
                cells.append(c)
            else:
                if cells:
                    rows.append(cells)
                    cells = []
                if c.name == "tr":
                    rows.append(self.inside(c, frozenset()))
                elif c.name in ("thead", "tbody", "tfoot"):
                    for r in self.inside(c, frozenset()):
                        if r.name == "tr":
                            rows.append(self.inside(r, frozenset()))
                        else:
                            rows.append([r])
        if cells:
            rows.append(cells)
        grid, held = [], {}  # held: columns that a cell from above still covers
        for row in rows:
            line, at = [], 0
            for c in row:
                while held.get(at, 0) > 0:
                    at += 1
                wide = min(max(_number(c.attributes.get("colspan"), 1), 1), 1000)
                tall = min(max(_number(c.attributes.get("rowspan"), 1), 1), 65534)
                line.append((at, wide, self.lines(c.children, self.shown(c, seen))))
                for k in range(at, at + wide):
                    held[k] = tall
                at += wide
            grid.append(line)
            held = {k: v - 1 for k, v in held.items() if v > 1}
        return out + align(grid)


def align(grid: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Rows of cells (column, columns covered, lines) as text: columns start at the same place, two blanks apart."""
    width: dict[int, int] = {}
    for row in grid:
        for at, wide, lines in row:
            if wide == 1:
                width[at] = max(width.get(at, 0), max(map(len, lines), default=0))
    for row in grid:
        for at, wide, lines in row:
            have = sum(width.get(k, 0) for k in range(at, at + wide)) + 2 * (wide - 1)
            if wide > 1 and (more := max(map(len, lines), default=0) - have) > 0:
                width[at + wide - 1] = width.get(at + wide - 1, 0) + more
    columns = sorted(width)
    start, x = {}, 0
    for k in range((columns[-1] + 1) if columns else 0):
        start[k] = x
        x += width.get(k, 0) + (2 if width.get(k, 0) else 0)
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            text = ""
            for at, _, lines in row:
                if k < len(lines) and lines[k]:
                    text = text.ljust(start.get(at, 0)) + lines[k]
            out.append(text.rstrip())
    return out


def _number(text: str | None, default: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", text or "")
    return int(m[1]) if m else default


def render(source: str | None) -> str | None:
    """All visible text of a page."""
    if source is None:
        return None
    root, css = parse(source)
    return "\n".join(Renderer(css).lines([root], True))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text, n_chars of every page: all its visible text as laid out; one pass without a shuffle.

    Blocks stand on lines of their own, with a blank line around paragraphs, headings, lists, tables and the like; list items get
    bullets or numbers, table cells aligned columns. Scripts, styles, head, hidden elements (hidden attribute, display:none,
    visibility:hidden; style sheets count where a selector names one element by tag, classes and ids, in the cascade's order, for the
    screen), closed details and templates are left out. Missing end tags are implied
    as in HTML. Null pages give a null text with 0 characters, empty ones an empty text; repeated pages come back each.
    """

    small_batches(pages.sparkSession)

    def run(batches):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEEPEST))
        for batch in batches:
            texts = [render(x) for x in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([len(x or "") for x in texts], pa.int64())],
                ["page_id", "text", "n_chars"],
            )

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, text string, n_chars long"
    )
