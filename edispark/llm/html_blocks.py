"""Leaf blocks of a page: runs of inline content with the block elements around them.

A small tokenizer follows the rules of HTML that matter for blocks: elements without content, raw
text elements, paragraphs and list or table items that end where the next begins, end tags without a
start. Comments, scripts, styles and other elements that show no text give none, and do not
part the text they stand in; elements this module does not know are inline, as in a browser.

A block points to its innermost element, an element to the one around it, so pages share their paths
and take time in proportion to their length, whatever their depth.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content up to their own end tag is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements without text of the page: code, controls of forms, pictures.
SILENT = frozenset("script style textarea title iframe noembed noframes template noscript svg select option datalist head".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul xmp head".split()
)
#: Which open element a start tag ends, and where the search for it stops.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_SCOPE = frozenset("table td th caption button object".split()) | (SILENT - {"head"})
_NAMED = re.compile(r"(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)


def is_block(tag: str) -> bool:
    """Known block elements, and elements of a page's own, which are its containers."""
    return tag in BLOCK or "-" in tag


class Node:
    """A block element: its tag, its attributes and the element around it."""

    __slots__ = ("tag", "attrs", "up", "state")

    def __init__(self, tag: str, attrs: str, up: Node | None):
        self.tag, self.attrs, self.up, self.state = tag, attrs, up, None


@dataclass
class Block:
    node: Node | None  # the innermost block element around it
    text: str
    linked: int  # characters of the text inside links
    buttons: int  # inside buttons or labels


class _Open:
    """An element of the stack; an inline one may be closed before those it holds."""

    __slots__ = ("tag", "node", "closed")

    def __init__(self, tag: str, node: Node | None):
        self.tag, self.node, self.closed = tag, node, False


class _Page:
    def __init__(self):
        self.out: list[Block] = []
        self.stack: list[_Open] = []
        self.places: dict[str, list[int]] = {}  # where each tag is open, outermost first
        self.blocks: list[int] = []  # where block elements are open
        self.silent: list[int] = []
        self.text: list[str] = []
        self.linked = self.buttons = 0

    def last(self, tags) -> int:
        """The place of the innermost open element of some tags; -1 without one."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def flush(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            if words:
                at = self.silent[0] - 1 if self.silent else len(self.stack) - 1
                self.out.append(Block(self.stack[at].node if at >= 0 else None, words, self.linked, self.buttons))
            self.text.clear()
        self.linked = self.buttons = 0

    def add(self, raw: str) -> None:
        if self.silent or not raw:
            return
        plain = unescape(raw) if "&" in raw else raw
        self.text.append(plain)
        if self.places.get("a"):
            self.linked += len(plain)
        if self.places.get("button") or self.places.get("label"):
            self.buttons += len(plain)

    def push(self, tag: str, attrs: str) -> None:
        at, up = len(self.stack), self.stack[-1].node if self.stack else None
        self.stack.append(_Open(tag, Node(tag, attrs, up) if is_block(tag) else up))
        self.places.setdefault(tag, []).append(at)
        if is_block(tag):
            self.blocks.append(at)
        if tag in SILENT:
            self.silent.append(at)

    def cut(self, at: int) -> None:
        """Close all elements from a place of the stack on."""
        while len(self.stack) > at:
            e = self.stack.pop()
            if not e.closed:
                self.places[e.tag].pop()
            k = len(self.stack)
            for open_ in (self.blocks, self.silent):
                if open_ and open_[-1] == k:
                    open_.pop()

    def close_to(self, tags, stops=frozenset()) -> None:
        """Close up to the innermost of some elements, if one is open inside any of ``stops``."""
        at = self.last(tags)
        if at >= 0 and at > self.last(stops):
            self.cut(at)

    def begin(self, tag: str, attrs: str) -> None:
        if is_block(tag):
            if not self.silent:
                self.flush()
            if tag in _ENDS:
                self.close_to(*_ENDS[tag])
            elif tag == "body" and self.silent:
                self.close_to({"head"})
            if tag not in ("html", "body", "head"):
                self.close_to({"p"}, _SCOPE)
        if tag in VOID:
            return
        if tag == "a":
            self.close_to({"a"}, _SCOPE)
        self.push(tag, attrs)

    def end(self, tag: str) -> None:
        at = self.last((tag,))
        if is_block(tag):
            # an end tag inside something silent ends nothing of the text around that, unless it closes it too
            if not self.silent or 0 <= at < self.silent[0]:
                self.flush()
            if at >= 0:
                self.cut(at)
        elif tag in SILENT:
            if at >= 0:
                self.cut(at)
        elif at >= 0 and at > (self.blocks[-1] if self.blocks else -1):
            # an inline end tag does not reach out of its block, and leaves inner inline elements open
            if at == len(self.stack) - 1:
                self.cut(at)
            else:
                self.stack[at].closed = True
                self.places[tag].pop()


def blocks(html: str) -> list[Block]:
    page = _Page()
    at, raw_until = 0, None
    n = len(html)
    while at < n:
        if raw_until:
            end = re.compile(rf"</{re.escape(raw_until)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            raw_until = None
            if end is None:
                break
            page.cut(len(page.stack) - 1)
            at = end.end()
            continue
        m = _TAG.search(html, at)
        if m is None:
            page.add(html[at:])
            break
        if m.start() > at:
            page.add(html[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            page.end(tag)
        elif tag == "br":
            page.add(" ")
        else:
            attrs = m[3] or m[6] or ""
            page.begin(tag, attrs)
            if tag in RAW:
                raw_until = tag
            elif tag in SILENT and attrs.endswith("/"):
                page.cut(len(page.stack) - 1)
    page.flush()
    return page.out


def named(attrs: str) -> list[tuple[str, str]]:
    """(name, value) of the attributes that say what an element is for."""
    return [(m[1].lower(), (m[2] or "").strip("\"'").lower()) for m in _NAMED.finditer(attrs)]
