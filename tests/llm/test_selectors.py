"""Selectors against a plain definition, and what pages hide by them."""

import random

import pytest

from tidemark.llm import html_render
from tidemark.llm.selectors import Matcher, chain, comma_parts

BODY = (
    "<div class='nav a'><ul><li class=x data-h>one<li class='x b' data-h='k v-w'>two<li lang=en-GB>three</ul>"
    "<p>four</p><p class=x>five</p><span>six</span></div>"
)


@pytest.mark.parametrize(
    "selector, gone",
    [
        (".nav .x", "one two five"),
        ("ul>li.x", "one two"),
        ("ul > .x + li", "two three"),
        ("p ~ span", "six"),
        ("[data-h]", "one two"),
        ("[data-h='k v-w']", "two"),
        ("li[data-h~=k], [lang|='en']", "two three"),
        ("[data-h^=k][data-h$='w'][data-h*=' v']", "two"),
        ("[LANG='EN-gb' i]", "three"),
        ("p:first-child", ""),
        ("li:first-child, span:last-child", "one six"),
        (".x:not(.b)", "one five"),
        (".x:not(.b, p)", "one"),
        (":is(p, span):not([class])", "four six"),
        (":root p", "four five"),
        ("body > div > p", "four five"),
        (".x:hover, .nav::before, p:unknown", ""),
        (".nav >", ""),
        ("p,,", "four five"),
    ],
)
def test_hidden_by_selectors(selector, gone):
    shown = set(html_render.visible_text(f"<style>{selector}{{display:none}}</style>{BODY}").split())
    words = {"one", "two", "three", "four", "five", "six"}
    hidden = {w for w in words if not any(w in s for s in shown)}
    assert hidden == set(gone.split())


def test_specificity_counts_whole_chains():
    page = "<style>.a .b{display:none} p{display:block}</style><div class=a><p class=b>gone"
    assert html_render.visible_text(page) == ""
    page = "<style>#i .b{display:block} .a .b{display:none}</style><div class=a id=i><p class=b>seen"
    assert html_render.visible_text(page) == "seen"
    page = "<style>:where(#i) p{display:none} p.b{display:block}</style><div id=i><p class=b>seen"
    assert html_render.visible_text(page) == "seen"


def test_deep_and_odd_selectors():
    assert chain(":not(" * 3000) is None and chain("") is None and chain("a||b") is None
    assert list(comma_parts("a[x=','], :is(b, c) , d")) == ["a[x=',']", ":is(b, c)", "d"]
    page = "<style>" + "div " * 300 + "p{display:none}</style>" + "<div>" * 5000 + "<p>gone"
    assert html_render.visible_text(page) == ""


def plain_match(node, steps, parents):
    """Whether a chain ends at a node, by trying every way to follow it back."""
    combinator, compound = steps[-1]
    if compound.tag not in ("", "*", node.tag):
        return False
    if not compound.names <= {f".{c}" for c in node.attrs.get("class", "").split()}:
        return False
    if len(steps) == 1:
        return True
    parent = parents.get(id(node))
    ahead = []
    if parent is not None:
        ahead = parent.children[: next(i for i, c in enumerate(parent.children) if c is node)]
    if combinator == ">":
        options = [parent] if parent is not None else []
    elif combinator == "+":
        options = ahead[-1:]
    elif combinator == "~":
        options = ahead
    else:
        options = []
        while parent is not None:
            options.append(parent)
            parent = parents.get(id(parent))
    return any(plain_match(o, steps[:-1], parents) for o in options)


@pytest.mark.parametrize("seed", range(20))
def test_matches_equal_plain_definition(seed):
    rng = random.Random(seed)
    root = html_render.Node("html", {})
    root.children.append(html_render.Node("body", {}))
    nodes, parents = [root, root.children[0]], {id(root.children[0]): root}
    for _ in range(40):
        parent = rng.choice(nodes[1:])
        node = html_render.Node(rng.choice("ab"), {"class": rng.choice(["x", "y", "x y", ""])})
        parent.children.append(node)
        parents[id(node)] = parent
        nodes.append(node)
    matcher, selectors = Matcher(), []
    for number in range(30):
        parts = [rng.choice(["a", "b", ".x", ".y", "a.x", "*"]) for _ in range(rng.randint(1, 4))]
        text = parts[0] + "".join(rng.choice([" ", ">", "+", " ~ "]) + p for p in parts[1:])
        selectors.append(text)
        matcher.add(text, number)
    found = matcher.matches(root)
    for node in nodes:
        expected = {n for n, text in enumerate(selectors) if plain_match(node, chain(text), parents)}
        assert {said for _, said in found.get(id(node), ())} == expected
