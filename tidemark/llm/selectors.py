"""Style sheet selectors, matched for a whole tree in one pass.

A selector is a chain of compounds. Each compound but the last has a bit; an element's
bits say which compounds end a matching chain there. The bits of the parent, of all
elements above, of the one before and of all before decide the next compound, so a page
takes time in proportion to its elements, however deep they are and however long chains
are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

_SIMPLE = re.compile(
    r"""(?P<tag>\*|[a-zA-Z][\w-]*)|(?P<name>[.#][\w-]+)
    |\[\s*(?P<attr>[\w-]+)\s*(?:(?P<how>[~|^$*]?=)\s*(?P<value>"[^"]*"|'[^']*'|[^\s\]"']+)\s*(?P<fold>[iIsS]?)\s*)?\]
    |:(?P<of>not|is|where)\((?P<inner>)|:(?P<pseudo>first-child|last-child|only-child|root)(?![\w(-])""",
    re.VERBOSE,
)
_COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")
_MARK = re.compile(r""""[^"]*"|'[^']*'|[()\[\],]""")
_DEEPEST = 4  # :not() inside :not() and so on; deeper ones are not read


class Place(NamedTuple):
    """Where an element stands among the elements of its parent."""

    number: int
    last: bool
    root: bool


class Compound(NamedTuple):
    tag: str
    names: frozenset[str]  # classes and ids with their mark
    tests: tuple[Callable, ...]
    rank: tuple[int, int, int]

    def fits(self, tags: tuple[str, ...], names: set[str], attrs: dict[str, str], place: Place) -> bool:
        return (
            (self.tag in ("", "*") or self.tag in tags)
            and self.names <= names
            and all(test(tags, names, attrs, place) for test in self.tests)
        )

    def key(self) -> str:
        """Something that every element it fits has."""
        return min(self.names, default=self.tag or "*")  # ids come ahead of classes


def comma_parts(text: str) -> Iterator[str]:
    """What stands between the outer commas."""
    depth = start = 0
    for mark in _MARK.finditer(text):
        if mark[0] in "([":
            depth += 1
        elif mark[0] in ")]":
            depth -= 1
        elif mark[0] == "," and not depth:
            yield text[start : mark.start()].strip()
            start = mark.end()
    yield text[start:].strip()


def _closing(text: str, at: int) -> int:
    """Where the parenthesis ends whose content begins at ``at``; -1 if it stays open."""
    depth = 1
    for mark in _MARK.finditer(text, at):
        depth += (mark[0] in "([") - (mark[0] in ")]")
        if not depth:
            return mark.start()
    return -1


def _attribute_test(attr: str, how: str | None, value: str, fold: bool) -> Callable:
    def same(text: str) -> str:
        return text.lower() if fold else text

    value = same(value)

    def test(tags, names, attrs, place) -> bool:
        if attr not in attrs or how is None:
            return attr in attrs
        found = same(attrs[attr])
        if how == "=":
            return found == value
        if how == "~=":
            return value in found.split()
        if how == "|=":
            return found == value or found.startswith(value + "-")
        if not value:
            return False
        return {"^=": found.startswith, "$=": found.endswith, "*=": found.__contains__}[how](value)

    return test


_PLACES = {
    "first-child": lambda tags, names, attrs, place: place.number == 0,
    "last-child": lambda tags, names, attrs, place: place.last,
    "only-child": lambda tags, names, attrs, place: place.number == 0 and place.last,
    "root": lambda tags, names, attrs, place: place.root,
}


def _any_test(options: list[Compound], wanted: bool) -> Callable:
    return lambda *element: any(option.fits(*element) for option in options) == wanted


def _compound(text: str, at: int, depth: int = 0) -> tuple[Compound | None, int]:
    """The compound that begins at ``at`` and its end; none if it is not known."""
    tag, names, tests, rank, begin = "", set(), [], [0, 0, 0], at
    while match := _SIMPLE.match(text, at):
        at = match.end()
        if match["tag"]:
            if match.start() > begin:
                return None, at
            tag = match["tag"].lower()
            rank[2] += tag != "*"
        elif match["name"]:
            names.add(match["name"])
            rank[match["name"][0] == "."] += 1
        elif match["attr"]:
            value = (match["value"] or "").strip("\"'")
            tests.append(_attribute_test(match["attr"].lower(), match["how"], value, match["fold"] in ("i", "I")))
            rank[1] += 1
        elif match["pseudo"]:
            tests.append(_PLACES[match["pseudo"]])
            rank[1] += 1
        else:
            end = _closing(text, at)
            options = []
            for inner in comma_parts(text[at:end]) if end >= 0 and depth < _DEEPEST else ():
                option, stop = _compound(inner, 0, depth + 1)
                if option is None or stop < len(inner):
                    return None, at
                options.append(option)
            if not options:
                return None, at
            tests.append(_any_test(options, match["of"] != "not"))
            if match["of"] != "where":
                rank = [a + b for a, b in zip(rank, max(option.rank for option in options))]
            at = end + 1
    if at == begin:
        return None, at
    return Compound(tag, frozenset(names), tuple(tests), tuple(rank)), at


def chain(selector: str) -> list[tuple[str, Compound]] | None:
    """The compounds of a selector, each with the combinator ahead of it; none if any
    part of it is not known."""
    steps, at, combinator = [], 0, ""
    while True:
        compound, at = _compound(selector, at)
        if compound is None:
            return None
        steps.append((combinator, compound))
        if at == len(selector):
            return steps
        gap = _COMBINATOR.match(selector, at)
        if not gap:
            return None
        combinator, at = gap[1] or " ", gap.end()


class Matcher:
    """Selectors with something to say, and what they say of each element of a tree."""

    def __init__(self):
        self.steps: dict[str, list] = {}  # by a name or tag that an element must have
        self.bits = 0

    def add(self, selector: str, said) -> None:
        """``said`` holds for what ``selector`` matches; unknown selectors match nothing."""
        steps = chain(selector)
        if not steps:
            return
        rank = tuple(map(sum, zip(*(compound.rank for _, compound in steps))))
        before = 0
        for combinator, compound in steps[:-1]:
            bit = 1 << self.bits
            self.bits += 1
            self.steps.setdefault(compound.key(), []).append((compound, combinator, before, bit, None))
            before = bit
        combinator, compound = steps[-1]
        self.steps.setdefault(compound.key(), []).append((compound, combinator, before, 0, (rank, said)))

    def matches(self, root) -> dict[int, list]:
        """``rank, said`` of all selectors that match, by the ``id`` of the tree's nodes."""
        found: dict[int, list] = {}
        implied = not any(getattr(c, "tag", "") == "body" for c in root.children)

        def ends(node, place: Place, own: dict[str, int]) -> int:
            """The bits of an element; ``own`` has the bits around it by combinator."""
            names = {f".{c}" for c in node.attrs.get("class", "").split()}
            if node.attrs.get("id"):
                names.add("#" + node.attrs["id"])
            tags = ("html", "body") if place.root and implied else (node.tag,)
            bits = 0
            for key in ("*", *tags, *names):
                for compound, combinator, before, bit, said in self.steps.get(key, ()):
                    if (not before or own[combinator] & before) and compound.fits(tags, names, node.attrs, place):
                        bits |= bit
                        if said:
                            found.setdefault(id(node), []).append(said)
            return bits

        nothing = {" ": 0, ">": 0, "+": 0, "~": 0}
        stack = [(root, ends(root, Place(0, True, True), nothing), 0)]
        while stack:
            node, bits, above = stack.pop()
            above |= bits
            inner = [child for child in node.children if not isinstance(child, str)]
            last = previous = 0
            for number, child in enumerate(inner):
                place = Place(number, number == len(inner) - 1, False)
                last = ends(child, place, {" ": above, ">": bits, "+": last, "~": previous})
                previous |= last
                stack.append((child, last, above))
        return found
