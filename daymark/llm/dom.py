"""A tolerant reader of HTML into a small tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# What a tag holds: a quote opens a value only behind an equals sign and if it is closed; others are letters.
_INSIDE = r"""(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_INSIDE})(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"[ \t\n\r\f\v   ]+")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
# Elements with markup inside, left out as a whole.
EXCLUDED = frozenset("noscript template svg".split())
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}
_EXCLUDING = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(RAW))})(?=[\s/>]).*?(?:</\1(?=[\s/>])|\Z)"
    rf"|<(/?)({'|'.join(sorted(EXCLUDED))})(?=[\s/>])({_INSIDE})>",
    re.S | re.I | re.A,
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# What opening one of these ends, if it is open nearer than a limit.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LIMITS = frozenset("ul ol dl table select body html article section main div".split())


@dataclass
class Node:
    tag: str
    attributes: dict[str, str]
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)


def _excluded_ends(text: str) -> dict[int, int]:
    """Where each excluded element that is closed ends, by the place behind its opening tag."""
    opened, ends = {tag: [] for tag in EXCLUDED}, {}
    for m in _EXCLUDING.finditer(text):
        if m[3] is None:
            continue
        own = opened[m[3].lower()]
        if not m[2]:
            if not m[4].endswith("/"):
                own.append(m.end())
        elif own:
            ends[own.pop()] = m.end()
    return ends


def parse(text: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Nodes in page order (the first is the root), and pieces (node, text) in page order.

    A piece without text marks where a block begins or ends. Text of scripts, styles and
    other raw elements, comments and tags cut off by the end of the page are left out, a raw
    element that is not closed up to the end, as in HTML. An svg, template or noscript
    is left out if it is closed; an unclosed one takes nothing with it.
    """
    nodes, pieces = [Node("#root", {}, -1, 0)], []
    stack, at, open_tags = [0], 0, Counter()
    ends = None
    while True:
        m = _TOKEN.search(text, at)
        end = m.start() if m else len(text)
        if end > at:
            pieces.append((stack[-1], html.unescape(text[at:end])))
        if not m:
            return nodes, pieces
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            # Without an open element of this kind the end tag is stray.
            for k in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if nodes[stack[k]].tag == tag:
                    if tag not in INLINE or any(nodes[n].tag not in INLINE for n in stack[k:]):
                        pieces.append((stack[k], None))
                    _close_from(k, stack, nodes, open_tags)
                    break
            continue
        if tag not in INLINE:
            _end_implied(tag, stack, nodes, open_tags)
            pieces.append((stack[-1], None))
        attributes = {a[0].lower(): a[1].strip("\"'") for a in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        parent = stack[-1]
        nodes.append(Node(tag, attributes, parent, len(stack)))
        number = len(nodes) - 1
        nodes[parent].children.append(number)
        if tag == "br":
            pieces.append((parent, " "))
        if tag in VOID or m[3].endswith("/") and (tag in RAW or tag in EXCLUDED):
            continue
        if tag in EXCLUDED:
            ends = _excluded_ends(text) if ends is None else ends
            at = ends.get(at, at)
            continue
        if tag in RAW:
            closing = _CLOSE[tag].search(text, at)
            if not closing:
                return nodes, pieces
            close = closing.start()
            gone = text.find(">", close)
            at = gone + 1 if gone >= 0 else len(text)
            continue
        stack.append(number)
        open_tags[tag] += 1


def _close_from(k: int, stack: list[int], nodes: list[Node], open_tags: Counter) -> None:
    """End the element at place k of the stack and all within it."""
    open_tags.subtract(nodes[n].tag for n in stack[k:])
    del stack[k:]


def _end_implied(tag: str, stack: list[int], nodes: list[Node], open_tags: Counter) -> None:
    """A block ends an open paragraph; a list item, cell or row ends the one before."""
    for k in range(len(stack) - 1, 0, -1):
        name = nodes[stack[k]].tag
        if name == "p" or name in _ENDS.get(tag, ()):
            _close_from(k, stack, nodes, open_tags)
            if name == "p" and tag in _ENDS:
                continue
            return
        if name in _LIMITS and name not in _ENDS.get(tag, ()):
            return


def blocks(pieces: list[tuple[int, str | None]], chosen: list[bool]) -> str:
    """The text of the chosen nodes: one line per block, white space as one space."""
    lines, line = [], []
    for node, text in [*pieces, (0, None)]:
        if text is None:
            if line:
                joined = _SPACE.sub(" ", "".join(line)).strip()
                if joined:
                    lines.append(joined)
                line = []
        elif chosen[node]:
            line.append(text)
    return "\n".join(lines)
