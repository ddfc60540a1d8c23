"""Elements and text blocks of an HTML page, as flat lists.

``parse`` never fails and never recurses: end tags that match nothing are ignored, elements that stay open end with their
parent, and the end tags that HTML lets one leave out (``p``, ``li``, table cells ...) are implied by what follows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

#: HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is no text of the page: nothing of it is read.
SILENT = frozenset("head script style template noscript title textarea svg math iframe object audio video canvas select option datalist button".split())
#: What follows up to the end tag is no markup.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
#: Part of a line of text; every other element starts a block and ends one.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
#: A start tag ends open elements: the first of these that is open, looked for up to one of those in the second list.
_ENDS = {
    **{t: (frozenset(["p"]), frozenset(["button", "td", "th", "caption", "table", "object", "template"])) for t in
       ("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
        "hr main menu nav ol p pre search section summary table ul").split()},
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset()),
}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_PARTS = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")


@dataclass
class Page:
    """Nodes in page order; 0 is the page itself. A block is a leaf: a run of text of one element that no block element interrupts."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    names: list[str] = field(default_factory=lambda: [""])  # of class, id and role, as written
    text: list[str | None] = field(default_factory=lambda: [None])  # of blocks
    linked: list[int] = field(default_factory=lambda: [0])  # characters of a block inside links


def words_of_names(names: str) -> list[str]:
    """The letters of class names and ids, in words: ``siteFooter nav-2`` -> site, footer, nav."""
    split = re.sub(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ])", " ", names)
    return [w.lower() for w in _PARTS.findall(split.replace("_", " "))]


def parse(html: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements that aren't inline, and their nodes
    silent = 0  # open elements of no text
    open_: Counter = Counter()  # open elements by tag: the stack is searched only for what is in it
    inline: list[str] = []
    run: list[str] = []
    run_linked, links = 0, 0
    parent, tag, names, text, linked = page.parent, page.tag, page.names, page.text, page.linked

    def flush() -> None:
        nonlocal run_linked
        if run:
            whole = _SPACE.sub(" ", unescape("".join(run))).strip()
            if whole:
                parent.append(stack[-1][1]), tag.append("#text"), names.append(""), text.append(whole), linked.append(run_linked)
            run.clear()
            run_linked = 0

    def read(piece: str) -> None:
        nonlocal run_linked
        if piece and not silent:
            run.append(piece)
            if links:
                run_linked += len(piece)

    def close(upto: int) -> None:
        nonlocal silent, links
        flush()
        while len(stack) > upto:
            gone = stack.pop()[0]
            silent -= gone in SILENT
            open_[gone] -= 1
        links = 0
        inline.clear()

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            read(html[at:])
            break
        read(html[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            if name in INLINE:
                if name == "br":
                    read(" ")
                elif name in inline:
                    while inline.pop() != name:
                        pass
                    links = inline.count("a")
            elif open_[name]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        close(i)
                        break
            continue
        if name in INLINE:
            if name in VOID:
                if name == "br":
                    read(" ")
            elif not m.group(3).endswith("/"):
                inline.append(name)
                links += name == "a"
            continue
        flush()
        if name in _ENDS and any(open_[t] for t in _ENDS[name][0]):
            first, stop = _ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in first:
                    close(i)
                    break
                if stack[i][0] in stop:
                    break
        attributes = m.group(3)
        if name in VOID:
            continue
        parent.append(stack[-1][1]), tag.append(name), text.append(None), linked.append(0)
        names.append(" ".join(a or b or c for _, a, b, c in _NAMES.findall(attributes)) if "=" in attributes else "")
        stack.append((name, len(tag) - 1))
        silent += name in SILENT
        open_[name] += 1
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else n
    close(1)
    return page
