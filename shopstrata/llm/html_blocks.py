"""Leaf blocks of a page: pieces of text between block-level tags, with the tags above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements that stand in a line of text, and elements without an end tag.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object".split())
#: Elements whose start ends an open paragraph or an element of their own kind.
ALONE = frozenset("p li dt dd option tr td th".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
_HOOK = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"\shidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


@dataclass
class Block:
    text: str
    path: list[tuple[str, str]]
    linked: int

    def above(self) -> list[tuple[str, str]]:
        return self.path


def blocks(page: str) -> list[Block]:
    """Blocks in page order, without the text of scripts and styles; unclosed and cut-off tags are tolerated."""
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(text, list(stack), min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(name: str) -> None:
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == name:
                del stack[at:]
                return

    at = 0
    while True:
        token = _TOKEN.search(page, at)
        piece = page[at : token.start() if token else len(page)]
        if piece:
            plain = html.unescape(piece)
            parts.append(plain)
            if in_link:
                linked += len(plain.strip())
        if not token:
            break
        at = token.end()
        ending, name, rest, shut = token.groups()
        if name is None or not shut:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = not ending
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        in_link = False
        if ending:
            close(name)
            continue
        if name in RAW:
            if not rest.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if name in ALONE and stack and stack[-1][0] == name:
            stack.pop()
        hooks = " ".join(x.strip("\"'") for x in _HOOK.findall(rest)).lower() if rest else ""
        stack.append((name, hooks + (" hidden" if rest and _HIDDEN.search(rest) else "")))
    flush()
    return found
