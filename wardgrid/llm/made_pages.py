"""Labelled pages to learn from: many ways in which sites wrap articles and what stands around them.

The rules below make the pages, so that no label has to be guessed from given ones. Words are invented.
"""

from __future__ import annotations

import random

#: Names that sites give to what is not the article; each may come as an element, a class or an id.
AROUND = (
    "nav menu header footer sidebar aside ad ads advert advertisement banner sponsor sponsored promo cookie consent notice alert "
    "popup modal newsletter subscribe signup login search form share social related recommended trending breadcrumb pagination "
    "pager widget toolbar comment comments discussion reply copyright legal tags disclaimer masthead navbar topbar promotion overlay gdpr"
).split()
ELEMENTS = ("nav", "header", "footer", "aside", "form")
WITHIN = ("article", "main", "section")
BODY = "article content post entry story text body main page page-content article-body post-content entry-content story-body".split()
SYLLABLES = "an be ca do el fi go ha in ka lo mi no or pa ra so ti un ve wa sch ion ent über é ça ñol".split()


def _words(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + rng.choice([".", ".", "", "!", " &amp; more", "***"])


def _around(rng: random.Random) -> list[tuple[str, bool]]:
    name = rng.choice(AROUND)
    lines = []
    if rng.random() < 0.25:
        element = rng.choice(ELEMENTS)
        opened, closed = f"<{element}>" if rng.random() < 0.6 else f'<{element} class="{name}">', f"</{element}>"
    else:
        key = rng.choice(("class", "class", "id"))
        value = rng.choice((name, f"{name}-{rng.choice(('box', 'wrap', 'main', 'top', 'content'))}", f"site-{name}", f"{name} block"))
        opened, closed = f'<div {key}="{value}">', "</div>"
    lines.append((opened, False))
    shape = rng.random()
    if shape < 0.35:
        lines.append(("<ul>", False))
        lines += [(f'<li><a href="/x">{_words(rng, rng.randint(1, 3))}</a></li>', False) for _ in range(rng.randint(2, 8))]
        lines.append(("</ul>", False))
    elif shape < 0.6:
        lines.append((_words(rng, rng.randint(2, 14)), False))
    else:
        if rng.random() < 0.4:
            lines.append((f"<h3>{_words(rng, 2)}</h3>", False))
        lines += [(f"<p>{_words(rng, rng.randint(3, 40))}</p>", False) for _ in range(rng.randint(1, 4))]
    lines.append((closed, False))
    return lines


def _article(rng: random.Random) -> list[tuple[str, bool]]:
    lines = []
    shape = rng.random()
    if shape < 0.5:
        opened, closed = "<article>", "</article>"
    elif shape < 0.6:
        opened, closed = f'<{rng.choice(WITHIN)} class="{rng.choice(BODY)}">', ""
    elif shape < 0.9:
        opened, closed = f'<div {rng.choice(("class", "id"))}="{rng.choice(BODY)}">', "</div>"
    else:
        opened, closed = "<main>", "</main>"
    lines.append((opened, False))
    if rng.random() < 0.15:
        lines.append((f"<header><h1>{_words(rng, 6)}</h1></header>", True))
    elif rng.random() < 0.9:
        lines.append((f"<h1>{_words(rng, rng.randint(1, 9))}</h1>", True))
    for _ in range(rng.randint(1, 14)):
        kind = rng.random()
        length = rng.choice((1, 2, 4, 12, 30, 60, 120))
        if kind < 0.7:
            lines.append((f"<p>{_words(rng, length)}</p>", True))
        elif kind < 0.76:
            lines.append((f"<p><b>{_words(rng, length)}<br>", True))
        elif kind < 0.82:
            lines.append((f"<h2>{_words(rng, 4)}</h2>", True))
        elif kind < 0.88:
            lines.append(("<blockquote>" + _words(rng, length) + "</blockquote>", True))
        elif kind < 0.93:
            lines.append((f"<ul><li>{_words(rng, 5)}</li><li>{_words(rng, 7)}</li></ul>", True))
        elif kind < 0.95:
            lines.append((f"<table><tr><td>{_words(rng, 3)}</td><td>{_words(rng, 2)}</td></tr></table>", True))
        else:
            lines += _around(rng)
    lines.append((closed, False))
    return lines


def page(rng: random.Random) -> list[tuple[str, bool]]:
    """Pieces of a page and whether the blocks that begin in each belong to the article."""
    lines = [("<!DOCTYPE html><html><head><title>x</title></head><body>", False)]
    if rng.random() < 0.4:
        lines.append((f'<div class="{rng.choice(("wrapper", "container", "site", "page", "layout"))}">', False))
    for _ in range(rng.randint(0, 4)):
        lines += _around(rng)
    lines += _article(rng)
    for _ in range(rng.randint(0, 5)):
        lines += _around(rng)
    if rng.random() < 0.7:
        lines.append((f"<footer>{_words(rng, rng.randint(2, 12))}</footer>", False))
    return [*lines, ("</body></html>", False)]
