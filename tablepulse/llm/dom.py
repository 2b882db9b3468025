"""A small HTML tree: what the main-text model needs to know of a page.

Tags open, close and imply each other as browsers do it for common markup; broken or
cut off markup never fails. Contents of scripts, styles and the like are no text.
"""

from __future__ import annotations

import html
import re

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>"  # a quote that is never closed ends with the tag
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?=/?[A-Za-z])[^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of the markup language.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes".split())
SILENT = frozenset(
    "head script style noscript template svg math iframe object canvas audio video select "
    "button textarea title option datalist map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCKS - frozenset("body dd dt html legend li summary td th tr tbody thead tfoot".split())
#: A new element of this kind ends an open one of these kinds, unless a bound is between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_BOUNDS = frozenset("table td th caption button object html".split())


class Node:
    """An element: its parent's number, tag, attribute words, depth."""

    __slots__ = ("parent", "tag", "words", "depth", "silent")

    def __init__(self, parent: int, tag: str, words: str, depth: int, silent: bool):
        self.parent, self.tag, self.words = parent, tag, words
        self.depth, self.silent = depth, silent


def _attribute_words(written: str) -> str:
    """Class, id, role and the like in lower case; whether the element is hidden."""
    words = []
    for name, a, b, c in _ATTRIBUTE.findall(written):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role", "itemprop", "aria-label", "data-role"):
            words.append(value)
        elif (
            name == "hidden"
            or (name == "aria-hidden" and value == "true")
            or (name == "style" and "display:none" in value.replace(" ", ""))
        ):
            words.append("hidden")
    return " ".join(words)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements in page order, the first one the page itself; and events in page order.

    An event is (element, text) for text that is not silent, with character references
    decoded, (element, "") where a block begins or ends, and a blank for a line break.
    """
    nodes = [Node(-1, "#page", "", 0, False)]
    stack = [0]
    opened = {"#page": 1}  # how many elements of a tag are on the stack
    events: list[tuple[int, str]] = []

    def leave(size: int) -> None:
        while len(stack) > size:
            if nodes[stack[-1]].tag in BLOCKS:
                events.append((stack[-1], ""))
            opened[nodes[stack.pop()].tag] -= 1

    def close(tags, bounds) -> None:
        if not any(opened.get(tag) for tag in tags):
            return
        for place in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[place]].tag
            if tag in tags:
                leave(place)
                return
            if tag in bounds:
                return

    def text(start: int, end: int) -> None:
        if end > start and not nodes[stack[-1]].silent:
            events.append((stack[-1], html.unescape(page[start:end])))

    at = 0
    while found := _TOKEN.search(page, at):
        text(at, found.start())
        at = found.end()
        ending, name, written = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        tag = (name or "").lower()
        if not tag:
            continue
        if ending:
            close({tag}, ())
            continue
        if tag in CLOSES_P:
            close({"p"}, P_BOUNDS)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag == "body":
            close({"head"}, ())
        top = stack[-1]
        silent = nodes[top].silent or tag in SILENT
        if tag in VOID:
            if not silent and tag in ("br", "hr"):
                events.append((top, " " if tag == "br" else ""))
            continue
        words = _attribute_words(written) if written else ""
        nodes.append(Node(top, tag, words, nodes[top].depth + 1, silent))
        stack.append(len(nodes) - 1)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in BLOCKS:
            events.append((stack[-1], ""))
        if tag in RAW and not written.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    text(at, len(page))
    leave(0)
    return nodes, events
