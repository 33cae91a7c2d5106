"""Leaf blocks of a web page: its texts between block boundaries, each with the path of its tags."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements that do not end a block, that have no end tag, whose content is not text,
# and those that end an open paragraph or an open item of the same list.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template textarea title head svg math iframe object select".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
               "th": ("tr", "table"), "option": ("select",)}

TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)"""
                 r"""(?P<attributes>(?:[^>"']|"[^"]*"|'[^']*')*+)>|[!?/][^>]*>)""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")


@dataclass
class Leaf:
    path: tuple[str, ...]
    text: str
    linked: float = 0.0
    parts: list = field(default_factory=list)


def names_of(attributes: str) -> tuple[str, ...]:
    found = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower()
    return tuple("." + x for x in PART.findall(found))


def leaves(page: str) -> list[Leaf]:
    """Blocks in page order, references decoded and white space as single blanks; no empty ones."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    out: list[Leaf] = []
    parts: list[tuple[str, bool]] = []
    state = {"silent": 0, "link": 0}

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                size = sum(len(p) for p, _ in parts)
                links = sum(len(p) for p, linked in parts if linked)
                path = tuple(x for name, more in stack if name not in INLINE for x in (name, *more))
                out.append(Leaf(path, text, links / max(size, 1)))
            parts.clear()

    def drop(n: int) -> None:
        for name, _ in stack[n:]:
            state["silent"] -= name in SILENT
            state["link"] -= name == "a"
        del stack[n:]

    def close(name: str, within: tuple[str, ...] = ()) -> None:
        for n in range(len(stack) - 1, -1, -1):
            if stack[n][0] == name:
                drop(n)
                return
            if stack[n][0] in within:
                return

    at, n = 0, len(page)
    while at < n:
        next_ = page.find("<", at)
        if next_ < 0:
            next_ = n
        if next_ > at and not state["silent"]:
            parts.append((page[at:next_], state["link"] > 0))
        if next_ == n:
            break
        match = TAG.match(page, next_)
        if not match:
            end = page.find(">", next_)
            if page[next_ + 1:next_ + 2].isalpha() or page[next_ + 1:next_ + 2] in ("/", "!"):
                at = n if end < 0 else end + 1  # a tag that is cut off, or with an open quote
            else:
                if not state["silent"]:
                    parts.append(("<", state["link"] > 0))
                at = next_ + 1
            continue
        at = match.end()
        name = match["name"]
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            end_block()
        if match["close"]:
            close(name)
            continue
        if name == "br":
            parts.append((" ", False))
        if name in VOID or match["attributes"].endswith("/") and name not in INLINE and name not in SILENT:
            continue
        if name not in INLINE:
            close("p", ("div", "article", "section", "td", "li", "blockquote", "body"))
            if name in ENDS_ITSELF:
                close(name, ENDS_ITSELF[name])
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        stack.append((name, names_of(match["attributes"]) if name not in INLINE else ()))
        state["silent"] += name in SILENT
        state["link"] += name == "a"
        if name == "body":
            state["silent"] = 0  # a head that was never closed
    end_block()
    return out
