"""Web pages cut into leaf blocks: runs of text between block boundaries, with their tag paths."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Element names as the HTML standard groups them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
EMBEDDED = frozenset("noscript template iframe svg math object audio video canvas".split())  # may stand in a paragraph
FOREIGN = frozenset("svg math".split())  # in these a tag may close itself
CLOSES_SAME = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}

COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # <!--> and <!---> are empty ones
VALUE = r"=\s*(?:\"[^\"]*\"|'[^']*')(?=[\s/>])"  # a quote counts right after =, and closed where a value may end
TOKEN = re.compile(rf"{COMMENT}|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:{VALUE}|[^>])*)(?:>|\Z)", re.S)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # element names from the root, then the words of their classes, ids and roles
    text: str
    links: int  # characters of the text inside links


def _marks(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    return tuple(w for m in MARKS.finditer(attributes) for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower()))


def blocks(page: str) -> list[Block]:
    """All blocks of ``page`` in order, character references decoded and white space made single.

    Scripts, styles and comments are no text; a tag that the page breaks off in is dropped. A quote within an unquoted value is
    part of it, and one that is never closed ends with its tag, so neither swallows text.
    """
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, found, at, in_link = 0, [], 0, 0
    path: tuple[str, ...] | None = None

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                names = tuple(n for n, _ in stack if n not in INLINE)
                marks = tuple(f".{w}" for _, own in stack for w in own)
                found.append(Block(names + marks, text, min(linked, len(text))))
            parts.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if in_link:
                linked += len(text)

    while True:
        tag = TOKEN.search(page, at)
        add(page[at : tag.start()] if tag else page[at:])
        if not tag:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if not tag[0].endswith(">"):
            break
        if tag[1]:
            if name in INLINE:
                if name == "a":
                    in_link = 0
                continue
            flush()
            names = [n for n, _ in stack]
            if name in names:
                del stack[len(names) - 1 - names[::-1].index(name) :]
                in_link = 0
            continue
        if name == "br":
            add(" ")
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name == "a":
                in_link = 1
            continue
        flush()
        if name in VOID:
            continue
        in_link = 0
        names = [n for n, _ in stack]
        if tag[3].endswith("/") and FOREIGN & {name, *names}:
            continue
        if "p" in names:
            last = len(names) - 1 - names[::-1].index("p")
            if not EMBEDDED & {name, *names[last:]}:
                del stack[last:]
        elif name in CLOSES_SAME and name in names:
            last = len(names) - 1 - names[::-1].index(name)
            if not set(names[last:]) & CLOSES_SAME[name]:
                del stack[last:]
        stack.append((name, _marks(tag[3])))
    flush()
    return found
