"""Leaf blocks of a page: runs of text between the borders of block elements.

Tags are read in one pass, with the end tags that HTML lets authors leave out put in. Each block
knows its own element, what stands on the way up to the root (tags, and the words of class, id and
role), how much of it is linked, and which element its own one stands in. What is never shown
or only operates the page (scripts, styles, controls) gives no block.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

# What the HTML standard calls its elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN_TAGS = frozenset("noscript template select option optgroup datalist button svg canvas object audio video map".split())
#: A start tag on the left closes an open element of the right, unless one of the last stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"caption"}, {"table"}),
    "tfoot": ({"tbody", "thead"}, {"table"}),
}
CELLS = frozenset(("table", "td", "th", "caption"))

#: A tag, a comment, or another declaration. A quote counts only after an equals sign, and if it is closed.
MARKUP = re.compile(
    r"""<(?:(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*(?:"[^"]*"|'[^']*'|))*+)>|!--.*?(?:-->|\Z)|[!?/][^>]*+>)""", re.DOTALL
)
#: What begins like markup and has no end up to the end of the page.
UNENDED = re.compile(r"<[/!?A-Za-z]")
NAMED = re.compile(r"""\b(class|id|role|data-main|hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
#: Words of a name, also of one in camel case.
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NONE: frozenset[str] = frozenset()


class Element(NamedTuple):
    tag: str
    names: frozenset[str]
    number: int


class Block(NamedTuple):
    text: str
    tag: str
    names: frozenset[str]
    linked: float
    parent: int


def element_names(tag: str, attributes: str, known: frozenset[str] | None) -> set[str]:
    """The features that an element hands down to what it holds."""
    names = {"in:" + tag}
    if attributes:
        for match in NAMED.finditer(attributes):
            name = match[1].lower()
            value = match[2] or match[3] or match[4] or ""
            if name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
                names.add("word:hidden")
            elif name == "data-main":
                names.add("@main" if value == "1" else "@not")
            elif name != "style":
                names.update("word:" + word.lower() for word in PARTS.findall(value))
    return names if known is None else names & known


def leaf_blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """Blocks in the order of the page; ``known`` are the names worth keeping (all if None)."""
    blocks: list[Block] = []
    stack = [Element("", NONE, 0)]
    pieces: list[str] = []
    opened: Counter[str] = Counter()
    counted, link_level, unseen, linked = 0, 0, 0, 0
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                own, parent = stack[-1], stack[-2] if len(stack) > 1 else stack[-1]
                blocks.append(Block(text, own.tag, own.names, min(1.0, linked / len(text)), parent.number))
            pieces.clear()
        linked = 0

    def pop_to(level: int) -> None:
        nonlocal link_level, unseen
        for element in stack[level:]:
            opened[element.tag] -= 1
        del stack[level:]
        if link_level > level:
            link_level = 0
        if unseen > level:
            unseen = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not unseen:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if link_level:
                linked += len(" ".join(text.split()))

    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        match = MARKUP.match(page, start)
        if match is None:
            say(page[at:start])
            if UNENDED.match(page, start):
                break
            say("<")
            at = start + 1
            continue
        if start > at:
            say(page[at:start])
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "a":
                link_level = 0
            elif tag in BLOCK_TAGS or tag in UNSEEN_TAGS:
                flush()
                level = len(stack) - 1 if opened[tag] > 0 else 0
                while level and stack[level].tag != tag and (tag in CELLS or stack[level].tag not in CELLS or tag in ("tr", "tbody", "thead", "tfoot")):
                    level -= 1
                if level and stack[level].tag == tag:
                    pop_to(level)
            continue
        if tag in RAW_TAGS:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if end is None:
                break
            at = end.start()
            continue
        if tag in ("br", "wbr"):
            if tag == "br" and not unseen:
                pieces.append(" ")
            continue
        if tag == "a":
            link_level = len(stack) if "href" in match[3].lower() else 0
            continue
        if tag not in BLOCK_TAGS and tag not in UNSEEN_TAGS:
            continue
        flush()
        if tag in BLOCK_TAGS and stack[-1].tag == "p":
            pop_to(len(stack) - 1)
        if tag in CLOSES:
            closed, borders = CLOSES[tag]
            level = len(stack) - 1 if sum(map(opened.__getitem__, closed)) else 0
            while level and stack[level].tag not in closed and stack[level].tag not in borders:
                level -= 1
            if level and stack[level].tag in closed:
                while stack[level - 1].tag in closed:
                    level -= 1
                pop_to(level)
        if tag in VOID_TAGS:
            continue
        counted += 1
        names = element_names(tag, match[3], known)
        opened[tag] += 1
        above = stack[-1].names
        stack.append(Element(tag, above if names <= above else above | names, counted))
        if tag in UNSEEN_TAGS and not unseen:
            unseen = len(stack)
    flush()
    return blocks
