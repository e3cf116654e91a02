"""Visible text of web pages, laid out as a page shows it.

A tree is built from the tags, with the start and end tags that HTML lets authors leave
out. Visibility rules drop what a browser would not show. What is left is written with
block spacing, list markers and aligned table cells. Both steps keep their own stacks,
so nesting may be as deep as the page makes it.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.selectors import Matcher, comma_parts

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
HIDDEN = frozenset(
    "script style head title template noscript noframes noembed iframe datalist audio video canvas "
    "object map".split()
)
# Blocks with an empty line around them, and blocks on lines of their own.
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr article section nav "
    "header footer aside main details form menu".split()
)
BLOCKS = SPACED | frozenset(
    "html body div li dt dd address center caption tr figcaption legend summary option "
    "thead tbody tfoot optgroup".split()
)
CLOSES_P = SPACED | frozenset("div address center dir dd dt li summary figcaption".split())
# Start tags that end an open element of the same kind, up to the given container.
CLOSES_LIKE = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "datalist"])),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
}
IN_HEAD = frozenset("base link meta title style script noscript template".split())
# An end tag does not reach out of these.
SCOPES = frozenset("table td th caption button object template html".split())
MAX_SPAN = 1000  # the limit HTML itself sets for columns

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|$) | <[!?][^>]*(?:>|$)
    | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)
      (?P<attrs>(?>(?:[^>"']|"[^"]*"|'[^']*')*+(?=>)|[^>]*+))>""",
    re.VERBOSE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_CSS = re.compile(r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[{};]""", re.DOTALL)
_WIDTH = re.compile(r"\(\s*(min|max)-width\s*:\s*([0-9.]+)\s*(px|em|rem)\s*\)")
# The page is shown on a screen of this many pixels across.
SCREEN_WIDTH = 1280


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class TreeBuilder:
    """Elements as they are opened and closed, with implied tags put in."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # where each tag is open, innermost last

    def _push(self, tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(node)
        return node

    def _pop(self, to: int) -> None:
        while len(self.open) > to:
            self.places[self.open.pop().tag].pop()

    def _innermost(self, tags: frozenset[str]) -> int:
        """The place of the innermost open one of ``tags``; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _close(self, tags: frozenset[str], until: frozenset[str]) -> None:
        """Ends the innermost of ``tags`` with all inside it, unless ``until`` is inside it."""
        place = self._innermost(tags)
        if place and place >= self._innermost(until):
            self._pop(place)

    def _open_p(self) -> bool:
        place = self._innermost(frozenset(["p"]))
        return bool(place) and place >= self._innermost(SCOPES)

    def start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        if tag in ("html", "body"):
            bodies = self.places.get("body")
            node = self.root if tag == "html" else self.open[bodies[0]] if bodies else None
            if tag == "body" and node is None:
                self._close(frozenset(["head"]), frozenset())
                node = self._push("body", {})
            for name, value in attrs.items():
                node.attrs.setdefault(name, value)
            return
        if tag == "head":
            if len(self.open) == 1:
                self._push(tag, attrs)
            return
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._pop(len(self.open) - 1)  # the head ends where content begins
        if tag in CLOSES_P:
            self._close(frozenset(["p"]), SCOPES)
        if tag[0] == "h" and tag[1:].isdigit() and self.open[-1].tag[0] == "h" and self.open[-1].tag[1:].isdigit():
            self._pop(len(self.open) - 1)
        if tag in CLOSES_LIKE:
            self._close(*CLOSES_LIKE[tag])
            if tag in ("tbody", "thead", "tfoot"):
                self._close(frozenset(["tr"]), frozenset(["table"]))
        if tag in ("td", "th") and self.places.get("table") and self.open[-1].tag != "tr":
            self._push("tr", {})
        self._push(tag, attrs)
        if closed or tag in VOID:
            self._pop(len(self.open) - 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {}, True)
        elif tag == "p" and not self._open_p():
            self.start("p", {}, True)
        elif tag in ("html", "body"):
            pass  # what follows them still belongs to the body
        else:
            heading = tag[0] == "h" and tag[1:].isdigit()
            names = frozenset(f"h{i}" for i in range(1, 7)) if heading else frozenset([tag])
            self._close(names, frozenset() if tag in SCOPES | {"tr", "tbody", "thead", "tfoot"} else SCOPES)

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head":
            if not text.strip():
                return
            self._pop(len(self.open) - 1)
        self.open[-1].children.append(text)


def parse(source: str) -> Node:
    """The tree of a page; tags left out are implied, stray ones ignored."""
    builder = TreeBuilder()
    at, last = 0, source.rfind(">")
    while at < len(source):
        match = _TOKEN.search(source, at) if at <= last or source.find("<!", at) >= 0 else None
        if match is None:
            builder.text(html.unescape(source[at:]))
            break
        if match.start() > at:
            builder.text(html.unescape(source[at : match.start()]))
        at = match.end()
        if match["name"] is None:
            continue
        tag = match["name"].lower()
        if match["end"]:
            builder.end(tag)
            continue
        closed = match["attrs"].endswith("/")
        builder.start(tag, _attributes(match["attrs"]), closed)
        if tag in RAW_TEXT and not closed:
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(source, at)
            content = source[at : close.start() if close else len(source)]
            builder.text(html.unescape(content) if tag in ("textarea", "title") else content)
            builder._close(frozenset([tag]), frozenset())
            at = source.find(">", close.start()) + 1 if close else len(source)
            if close and at == 0:
                at = len(source)
    return builder.root


def css_blocks(sheet: str) -> Iterator[tuple[str, str]]:
    """Preludes and contents of the outer blocks of a style sheet."""
    depth = start = body = 0
    prelude = ""
    for match in _CSS.finditer(sheet):
        mark = match[0]
        if mark == "{":
            if not depth:
                prelude, body = sheet[start : match.start()].strip(), match.end()
            depth += 1
        elif mark == "}":
            depth = max(depth - 1, 0)
            if not depth:
                if body:
                    yield prelude, sheet[body : match.start()]
                start, body = match.end(), 0
        elif mark == ";" and not depth:
            start = match.end()
    if depth:
        yield prelude, sheet[body:]


def on_screen(media: str) -> bool:
    """Whether a media query list holds on a wide screen; features not known do not hold."""

    def holds(part: str) -> bool:
        if part in ("all", "screen"):
            return True
        width = _WIDTH.fullmatch(part)
        if not width:
            return False
        pixels = float(width[2].strip(".") or 0) * (1 if width[3] == "px" else 16)
        return SCREEN_WIDTH >= pixels if width[1] == "min" else SCREEN_WIDTH <= pixels

    def query(text: str) -> bool:
        if text.startswith("not "):
            return not query(text[4:].strip())
        return all(holds(part.strip()) for part in text.removeprefix("only ").split(" and "))

    return not media.strip() or any(query(" ".join(q.split())) for q in media.lower().split(","))


def _declarations(body: str) -> Iterator[tuple[str, str, bool]]:
    """``display`` and ``visibility`` of a block, and whether they are important."""
    if "{" in body:  # rules nested in a rule are left out
        depth, start, kept = 0, 0, []
        for match in _CSS.finditer(body):
            if match[0] == "{":
                depth += 1
            elif match[0] == "}":
                depth -= 1
                start = match.end() if depth <= 0 else start
            elif match[0] == ";" and depth <= 0:
                kept.append(body[start : match.start()])
                start = match.end()
        body = ";".join([*kept, body[start:] if depth <= 0 else ""])
    for declaration in body.split(";"):
        name, colon, value = declaration.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if colon and name in ("display", "visibility"):
            value, mark, important = value.partition("!")
            if value.strip() and (not mark or important.strip() == "important"):
                yield name, value.strip(), bool(mark)


class Styles:
    """What a page's style sheets say about ``display`` and ``visibility``.

    Selectors may chain tags, classes, ids, attributes, ``:not()``, ``:is()``, ``:where()``
    and the place among siblings by all combinators; others are left out.
    """

    def __init__(self, root: Node):
        self.rules = Matcher()
        self.shows = False  # something may be visible inside what is not
        self.order = 0
        stack: list[Node] = [root]
        while stack:
            node = stack.pop()
            if node.tag == "style" and on_screen(node.attrs.get("media", "")):
                self._read("".join(c for c in node.children if isinstance(c, str)))
            if "style" in node.attrs:
                self._note(_declarations(node.attrs["style"]))
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
        self.found = self.rules.matches(root) if self.rules.steps else {}

    def _note(self, found) -> list:
        found = list(found)
        self.shows |= any(name == "visibility" and value == "visible" for name, value, _ in found)
        return found

    def _read(self, sheet: str) -> None:
        sheet = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", sheet, flags=re.S)
        open_blocks = [css_blocks(sheet)]
        while open_blocks:
            block = next(open_blocks[-1], None)
            if block is None:
                open_blocks.pop()
                continue
            prelude, body = block
            if prelude.startswith("@"):
                name, _, condition = prelude[1:].replace("(", " (", 1).partition(" ")
                condition = condition.strip().lower()
                if (
                    (name.lower() == "media" and on_screen(condition))
                    or (name.lower() == "supports" and not condition.startswith("not"))
                    or name.lower() == "layer"
                ):
                    open_blocks.append(css_blocks(body))
                continue
            found = self._note(_declarations(body)) if re.search("display|visibility", body, re.I) else ()
            for selector in comma_parts(prelude) if found else ():
                self.order += 1
                self.rules.add(selector, (self.order, found))

    def of(self, node: Node) -> tuple[str, str]:
        """``display`` and ``visibility`` of an element, empty where nothing is said."""
        inline = node.attrs.get("style")
        said = self.found.get(id(node), ())
        if not said and not inline:
            return "", ""
        best: dict[str, tuple] = {}
        for rank, (order, found) in said:
            for place, (name, value, important) in enumerate(found):
                weight = (important, False, rank, order, place)
                best[name] = max(best.get(name, (weight, value)), (weight, value))
        for place, (name, value, important) in enumerate(_declarations(inline or "")):
            weight = (important, True, (0, 0, 0), 0, place)
            best[name] = max(best.get(name, (weight, value)), (weight, value))
        return tuple(best[n][1] if n in best else "" for n in ("display", "visibility"))


def displayed(node: Node, display: str) -> bool:
    if node.tag in HIDDEN or node.tag == "input":
        return False
    if display:
        return display != "none"
    return "hidden" not in node.attrs and (node.tag != "dialog" or "open" in node.attrs)


class Flow:
    """Lines of text; remembers the gap due before the next line."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indents: list[str] = []
        self.marker = ""
        self.gap = 0
        self.space = False
        self.preserve = 0

    def text(self, text: str) -> None:
        if self.preserve:
            first, *rest = text.replace("\r\n", "\n").expandtabs(8).split("\n")
            self._put(first)
            for line in rest:
                self.line_break()
                self._put(line)
            return
        words = _SPACES.split(text)
        for i, word in enumerate(words):
            if i and self.parts:
                self.space = True
            if word:
                self._put(word)

    def _put(self, text: str) -> None:
        if text:
            if self.space:
                self.parts.append(" ")
            self.parts.append(text)
        self.space = False

    def line_break(self) -> None:
        self._flush(keep_empty=True)

    def block(self, gap: int) -> None:
        """Ends the line; at least ``gap`` empty lines come before the next one."""
        self._flush(keep_empty=False)
        self.gap = max(self.gap, gap)

    def raw(self, lines: list[str]) -> None:
        for line in lines:
            self.parts = [line]
            self._flush(keep_empty=True)

    def _flush(self, keep_empty: bool) -> None:
        line = "".join(self.parts)
        self.parts, self.space = [], False
        if not line and not self.marker and not keep_empty:
            return
        if not line and not self.lines:
            return
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        indent = "".join(self.indents)
        if self.marker:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((indent + line).rstrip())

    def finish(self) -> list[str]:
        self.block(0)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1
        for c in text
    )


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "1").strip()
    return min(max(int(value), 1), MAX_SPAN) if value.isascii() and value.isdigit() else 1


_BAR = " | "


def layout_table(rows: list[list[tuple[Node, list[str]]]]) -> list[str]:
    """Cells side by side, padded so that the columns of all rows line up."""
    grid: list[dict[int, tuple[list[str], int]]] = []
    held: dict[int, int] = {}  # rows that a cell above still covers, by column
    for row in rows:
        placed: dict[int, tuple[list[str], int]] = {}
        column = 0
        covered = dict(held)
        held = {c: n - 1 for c, n in held.items() if n > 1}
        for node, lines in row:
            while column in covered:
                column += 1
            across, down = _span(node, "colspan"), _span(node, "rowspan")
            placed[column] = (lines, across)
            if down > 1:
                held.update({c: down - 1 for c in range(column, column + across)})
            column += across
        grid.append(placed)
    starts = sorted({c for row in grid for c, (lines, _) in row.items() if lines})
    widths = dict.fromkeys(starts, 0)
    for row in grid:
        for c, (lines, across) in row.items():
            if lines and not any(c < s < c + across for s in starts):
                widths[c] = max(widths[c], max(map(_width, lines)))
    out: list[str] = []
    for row in grid:
        for k in range(max((len(lines) for lines, _ in row.values()), default=0)):
            parts, at = [], 0
            while at < len(starts):
                c = starts[at]
                lines, across = row.get(c, ([], 1))
                inner = [s for s in starts[at + 1 :] if s < c + across]
                room = widths[c] + sum(widths[s] + len(_BAR) for s in inner)
                cell = lines[k] if k < len(lines) else ""
                parts.append(cell + " " * max(room - _width(cell), 0))
                at += 1 + len(inner)
            out.append(_BAR.join(parts).rstrip())
    return out


def render(root: Node) -> str:
    """The page's visible text."""
    styles = Styles(root)
    flow = Flow()
    flows = [flow]
    tables: list[list[list[tuple[Node, list[str]]]]] = []
    lists: list[list] = []  # [ordered, next number]
    stack: list[tuple[Node | str, bool, bool]] = [(root, False, True)]
    while stack:
        node, leaving, seen = stack.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if seen:
                flow.text(node)
            continue
        tag = node.tag
        cell = tag in ("td", "th") and bool(tables) and bool(tables[-1])
        if not leaving:
            display, visibility = styles.of(node)
            if not displayed(node, display):
                continue
            if visibility in ("hidden", "collapse"):
                seen = False
            elif visibility in ("visible", "initial"):
                seen = True
            if not seen and not styles.shows:
                continue
            if tag == "br":
                if seen:
                    flow.line_break()
                continue
            if tag in BLOCKS:
                flow.block(1 if tag in SPACED and not (tag in ("ul", "ol", "menu") and lists) else 0)
            if tag == "hr":
                if seen:
                    flow.raw(["---"])
                flow.block(1)
                continue
            if tag in ("ul", "ol", "menu"):
                first = node.attrs.get("start", "1")
                lists.append([tag == "ol", int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1])
            elif tag == "li":
                ordered, number = lists[-1] if lists else (False, 1)
                if lists:
                    lists[-1][1] += 1
                marker = f"{number}. " if ordered else "- "
                flow.marker = marker if seen else ""
                flow.indents.append(" " * len(marker))
            elif tag in ("dd", "blockquote"):
                flow.indents.append("  ")
            elif tag in ("pre", "textarea"):
                flow.preserve += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif cell:
                flows.append(Flow())
            stack.append((node, True, seen))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            elif tag == "pre" and children and isinstance(children[0], str) and children[0].startswith("\n"):
                children = [children[0][1:], *children[1:]]
            elif tag in ("table", "tr", "thead", "tbody", "tfoot"):
                children = [c for c in children if isinstance(c, Node) or c.strip()]
            stack.extend((c, False, seen) for c in reversed(children))
            continue
        if cell:
            lines = flows.pop().finish()
            tables[-1][-1].append((node, lines))
            continue
        if tag == "table":
            flow.block(0)
            flow.raw(layout_table(tables.pop()))
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag == "li":
            flow.block(0)
            flow.indents.pop()
        if tag in BLOCKS:
            flow.block(1 if tag in SPACED and not (tag in ("ul", "ol", "menu") and lists) else 0)
        if tag in ("dd", "blockquote"):
            flow.indents.pop()
        elif tag in ("pre", "textarea"):
            flow.preserve -= 1
    return "\n".join(flows[0].finish())


def visible_text(source: str | None) -> str | None:
    return None if source is None else render(parse(source)) if source else ""


def rendered(source: Column) -> Column:
    """The visible text of a column of HTML."""

    @F.pandas_udf(T.StringType())
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([visible_text(p) for p in pages], dtype=object)

    return compute(source)


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All columns of ``pages`` with ``out_col``, the visible text of each page.

    A null page has null text, an empty one empty text, and so has a page without
    visible text. Pages are handled one by one where they are read, so repeated rows
    come out equal and nothing is shuffled; a column named ``out_col`` is replaced.
    """
    return pages.withColumn(out_col, rendered(F.col(f"`{html_col}`")))
