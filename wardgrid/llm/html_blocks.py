"""Blocks of text of a web page in page order, with the tags and class names they stand in."""

from __future__ import annotations

import re
from functools import cache
from html import unescape
from typing import NamedTuple

_MARK = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*>|</?[a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\">])*+>", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea "
    "tfoot th thead tr ul button".split()
)
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
#: An element that ends itself early does so only inside the nearest of these.
SCOPE = frozenset("ul ol dl table tbody thead tfoot select article section div main body html nav header footer aside form blockquote".split())


class Block(NamedTuple):
    path: tuple[str, ...]  # names of the open elements and the words of their classes, outermost first
    text: str
    linked: float  # share of the text inside links


@cache
def _hidden_end(name: str) -> re.Pattern:
    return re.compile(f"</{name}\\s*>", re.I)


@cache
def _next_block() -> re.Pattern:
    return re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)


def _labels(tag: str, name: str) -> tuple[str, ...]:
    found = [name]
    for groups in _NAMED.findall(tag) if " " in tag else ():
        for word in re.split(r"[\s_-]+", "".join(groups)):
            found += ["." + p.lower() for p in _PART.findall(word)]
    return tuple(found)


def blocks(html: str | None) -> list[Block]:
    page = html or ""
    found: list[Block] = []
    names: list[str] = []
    labels: list[tuple[str, ...]] = []
    texts: list[str] = []
    unclosed: set[str] = set()  # hidden elements with no end tag in the rest of the page
    linked = at = 0

    def finish() -> None:
        nonlocal linked
        text = " ".join("".join(texts).split())
        if text:
            found.append(Block(tuple(x for group in labels for x in group), text, min(1.0, linked / len(text))))
        texts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        text = unescape(text) if "&" in text else text
        if text:
            texts.append(text)
            if "a" in names:
                linked += len(text.strip())

    while mark := _MARK.search(page, at):
        add(page[at : mark.start()])
        at, tag = mark.end(), mark[0]
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        if tag[1] == "/":
            if name in names:
                if name in BLOCK:
                    finish()
                cut = len(names) - 1 - names[::-1].index(name)
                del names[cut:], labels[cut:]
            elif name == "p":
                finish()
            continue
        if name in HIDDEN:
            if not tag.endswith("/>"):
                if name not in unclosed and (end := _hidden_end(name).search(page, at)):
                    at = end.end()
                else:  # without its end tag an element hides what is left of its block, no more
                    unclosed.add(name)
                    end = _next_block().search(page, at)
                    at = end.start() if end else len(page)
            continue
        if name in BLOCK:
            finish()
            closing = ("p " + CLOSES.get(name, "")).split()
            for i in range(len(names) - 1, -1, -1):
                if names[i] in closing:
                    del names[i:], labels[i:]
                    break
                if names[i] in SCOPE:
                    break
        elif name in ("br", "wbr"):
            texts.append(" " if name == "br" else "")
        if name not in VOID and not tag.endswith("/>"):
            names.append(name)
            labels.append(_labels(tag, name))
    add(page[at:])
    finish()
    return found
