"""A small reader of HTML as it comes: a tree of block elements and runs of text, tolerant of missing and stray tags."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html import unescape

# A quote opens a value right after "=" only; any other one is an ordinary character of the tag.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*"|'[^']*')?|["'])*+)>?""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|\s|["'])(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Elements whose content is never text of a page, and those whose content holds no tags.
DROPPED = frozenset("head script style template select option button textarea datalist".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body p div section article main nav header footer aside ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3"
    " h4 h5 h6 blockquote pre form fieldset legend figure figcaption address details summary center menu dialog hgroup hr".split()
)
# What an element closes when it begins: the open element, up to the nearest of the others.
CLOSES = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr", "table thead tbody tfoot"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot", "table"),
    "tbody": ("thead tbody tfoot", "table"),
    "tfoot": ("thead tbody tfoot", "table"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
IN_P = frozenset("td th li dd dt div section article main body table blockquote".split())

_tokens: dict[str, tuple[str, ...]] = {}


def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """Lower-case words of the attributes that name what an element is for."""
    known = _tokens.get(attributes)
    if known is None:
        known = tuple(t.lower() for value in ATTRIBUTE.findall(attributes) for t in TOKEN.findall(value))
        if len(_tokens) < 20_000 and len(attributes) < 500:
            _tokens[attributes] = known
    return known


class Page:
    """Nodes in page order. Elements have a tag and attribute tokens; runs have a text and no tag.

    ``ends`` is the index after the last node below each one, ``links`` the characters of a run inside links.
    """

    def __init__(self, html: str):
        self.parents: list[int] = [-1]
        self.tags: list[str] = ["#root"]
        self.tokens: list[tuple[str, ...]] = [()]
        self.texts: list[str] = [""]
        self.links: list[int] = [0]
        self.depths: list[int] = [0]
        self.ends: list[int] = [0]
        self.open = [0]
        # How many elements of each tag are open, so that no one is looked for in vain.
        self.opened = Counter()
        self.pieces: list[str] = []
        self.linked = 0
        self.in_link = False
        self.read(html)
        self.finish_run()
        while self.open:
            self.ends[self.open.pop()] = len(self.tags)

    def add(self, tag: str, tokens: tuple[str, ...], text: str, linked: int) -> int:
        parent = self.open[-1]
        self.parents.append(parent)
        self.tags.append(tag)
        self.tokens.append(tokens)
        self.texts.append(text)
        self.links.append(linked)
        self.depths.append(self.depths[parent] + 1)
        self.ends.append(len(self.tags))
        return len(self.tags) - 1

    def finish_run(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.add("", (), text, min(self.linked, len(text)))
            self.pieces, self.linked = [], 0

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append(unescape(raw) if "&" in raw else raw)
            if self.in_link:
                self.linked += len(raw)

    def close_to(self, depth: int) -> None:
        self.finish_run()
        while len(self.open) > depth:
            node = self.open.pop()
            self.ends[node] = len(self.tags)
            self.opened[self.tags[node]] -= 1
        self.in_link = False

    def close(self, tag: str) -> None:
        for k in range(len(self.open) - 1 if self.opened[tag] else 0, 0, -1):
            if self.tags[self.open[k]] == tag:
                self.close_to(k)
                return
        if tag == "p":  # the end of a paragraph that is not open still parts what is around it
            self.finish_run()

    def begin(self, tag: str, attributes: str) -> None:
        self.finish_run()
        for k in range(len(self.open) - 1 if self.opened["p"] else 0, 0, -1):
            here = self.tags[self.open[k]]
            if here == "p":
                self.close_to(k)
            if here in IN_P or here == "p":
                break
        if tag in CLOSES:
            own, until = CLOSES[tag]
            for k in range(len(self.open) - 1 if any(self.opened[t] for t in own) else 0, 0, -1):
                here = self.tags[self.open[k]]
                if here in own:
                    self.close_to(k)
                if here in own or here in until:
                    break
        if tag != "hr":
            self.open.append(self.add(tag, attribute_tokens(attributes) if "=" in attributes else (), "", 0))
            self.opened[tag] += 1

    def read(self, html: str) -> None:
        at, search, ends = 0, TAG.search, None
        while True:
            found = search(html, at)
            if found is None:
                self.text(html[at:])
                return
            if found.start() > at:
                self.text(html[at : found.start()])
            at = found.end()
            closing, opening = found.group(1), found.group(2)
            if closing:
                tag = closing.lower()
                if tag in BLOCKS:
                    self.close(tag)
                elif tag == "a":
                    self.in_link = False
                continue
            if not opening:
                continue
            tag = opening.lower()
            if tag in DROPPED or tag in RAW:
                if not found.group(3).endswith("/") or tag in RAW:
                    ends = Ends(html) if ends is None else ends
                    at = ends.after_element(at, tag, self.tags[self.open[-1]])
            elif tag in BLOCKS:
                self.begin(tag, found.group(3))
            elif tag == "br":
                self.text(" ")
            elif tag == "a":
                self.in_link = True


class Ends:
    """Where elements of a page end. Each thing is searched for once, from the left to the right, however many elements ask."""

    def __init__(self, html: str):
        lower = html.lower()
        # A change of length by lower case would move places; such letters are rare, and tags in upper case with them.
        self.html = html if len(lower) != len(html) else lower
        self.next: dict[str, int] = {}
        self.marks: dict[str, tuple[list[int], list[int], dict[int, list[int]]]] = {}

    def find(self, what: str, at: int) -> int:
        """As ``str.find``, for places that do not go back."""
        known = self.next.get(what)
        if known is None or 0 <= known < at:
            self.next[what] = known = self.html.find(what, at)
        return known

    def end_of_parent(self, at: int, stop: int, parent: str) -> int:
        """Where the block that is open at ``at`` is closed before ``stop``, or -1. A paragraph is closed by the next one, too.

        Its closing tag is the first one that takes the depth below that at ``at``, so it is the next place of that depth.
        """
        if parent not in self.marks:
            places, depths, by_depth, depth = [], [], {}, 0
            for found in re.compile(rf"<(/?){re.escape(parent)}(?=[\s/>])").finditer(self.html):
                depth += -1 if found[1] or parent == "p" else 1
                by_depth.setdefault(depth, []).append(len(places))
                places.append(found.start())
                depths.append(depth)
            self.marks[parent] = places, depths, by_depth
        places, depths, by_depth = self.marks[parent]
        first = bisect_left(places, at)
        lower = by_depth.get((depths[first - 1] if first else 0) - 1, [])
        k = bisect_left(lower, first)
        return places[lower[k]] if k < len(lower) and places[lower[k]] < stop else -1

    def after_element(self, at: int, tag: str, parent: str) -> int:
        """Where the element that was opened before ``at`` ends; an element that nothing closes ends where it began.

        One that is not closed before its parent block is, ends with that block. A head without an end goes up to the body, raw
        text without one to the end of the page.
        """
        end = self.find(f"</{tag}", at)
        if tag == "head":
            body = self.find("<body", at)
            end = body if end < 0 or 0 <= body < end else end
            if end == body and end >= 0:
                return end
        if tag not in RAW and tag != "head" and parent in BLOCKS:
            closed = self.end_of_parent(at, len(self.html) if end < 0 else end, parent)
            if closed >= 0:
                return closed
        if end < 0:
            return len(self.html) if tag in RAW else at
        close = self.html.find(">", end)
        return len(self.html) if close < 0 else close + 1
