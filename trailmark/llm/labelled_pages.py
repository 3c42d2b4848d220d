"""Labelled pages for the extraction model, put together from parts of usual page layouts.

Each part is a piece of markup whose leaf blocks share one label. Pages differ in layout, in the names of classes, in
what stands around the article, and in the length of texts, so that no single feature decides alone.
"""

from __future__ import annotations

import random

from trailmark.llm.html import Block, leaf_blocks

_SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi no ka el an or is ut".split()
_MARK = "\u0001"  # starts every text of content; dropped from the blocks


def _word(r: random.Random) -> str:
    return "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))


def _words(r: random.Random, low: int, high: int) -> str:
    return " ".join(_word(r) for _ in range(r.randint(low, high)))


def _sentence(r: random.Random, low: int = 1, high: int = 25) -> str:
    return _words(r, low, high).capitalize() + r.choice([".", ".", ".", "!", "?", "", " ***", " %%%"])


def _text(r: random.Random) -> str:
    return " ".join(_sentence(r) for _ in range(r.choice([1, 1, 1, 2, 3, 6, 12])))


def _links(r: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/{_word(r)}">{_words(r, 1, 3)}</a></li>' for _ in range(n))


def _menu(r: random.Random) -> str:
    body = f"<ul>{_links(r, r.randint(2, 8))}</ul>"
    return r.choice(
        [
            f"<nav>{body}</nav>",
            f'<div class="{r.choice(["nav", "menu", "navbar", "navigation", "breadcrumbs"])}">{body}</div>',
            f'<ul id="{r.choice(["menu", "nav", "topnav"])}">{_links(r, 4)}</ul>',
        ]
    )


def _header(r: random.Random) -> str:
    inner = r.choice([f"<h1>{_words(r, 1, 3)}</h1>", f"<p>{_words(r, 1, 6)}</p>", f"<div>{_words(r, 1, 5)}</div>"])
    return r.choice([f"<header>{inner}</header>", f'<div class="{r.choice(["header", "masthead", "banner"])}">{inner}</div>'])


def _advert(r: random.Random) -> str:
    name = r.choice(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot"])
    tag = r.choice(["div", "div", "aside", "section"])
    inner = r.choice([_text(r), f"<p>{_text(r)}</p>", f'<a href="/x">{_sentence(r)}</a>'])
    return f'<{tag} class="{name}">{inner}</{tag}>'


def _notice(r: random.Random) -> str:
    name = r.choice(["cookie", "cookie-notice", "consent", "notice", "alert", "gdpr", "popup", "modal", "newsletter"])
    return f'<div {r.choice(["class", "id"])}="{name}"><p>{_text(r)}</p></div>'


def _sidebar(r: random.Random) -> str:
    inner = r.choice([f"<ul>{_links(r, 5)}</ul>", f"<p>{_text(r)}</p>", f"<h3>{_words(r, 1, 3)}</h3><p>{_text(r)}</p>"])
    return r.choice(
        [f"<aside>{inner}</aside>", f'<div class="{r.choice(["sidebar", "widget", "related", "recommended", "share"])}">{inner}</div>']
    )


def _form(r: random.Random) -> str:
    return f'<form action="/s"><p>{_text(r)}</p><label>{_words(r, 1, 3)}</label><input name="q"></form>'


def _comments(r: random.Random) -> str:
    items = "".join(
        f'<div class="{r.choice(["comment", "reply", "comment-body"])}"><p>{_text(r)}</p></div>' for _ in range(r.randint(1, 4))
    )
    head = r.choice(["", f"<h2>{_words(r, 1, 2)}</h2>"])
    tag = r.choice(["section", "div", "ol"])
    return f'<{tag} {r.choice(["class", "id"])}="{r.choice(["comments", "comment-list", "discussion", "responses", "replies"])}">{head}{items}</{tag}>'


def _footer(r: random.Random) -> str:
    inner = r.choice(
        [f"&copy; {_word(r)}.example.com &middot; {_text(r)}", f"<p>&copy; {_words(r, 1, 4)}</p>", f"<p>{_text(r)}</p><ul>{_links(r, 3)}</ul>"]
    )
    return r.choice([f"<footer>{inner}</footer>", f'<div class="footer">{inner}</div>', f'<div id="footer">{inner}</div>'])


def _article(r: random.Random) -> str:
    """Blocks of content, each marked; now and then something foreign between them."""
    def marked(x: str) -> str:
        return _MARK + x

    parts = [f"<h1>{marked(_sentence(r, 1, 12))}</h1>"]
    if r.random() < 0.3:
        parts = [f"<header>{parts[0]}</header>"]
    if r.random() < 0.15:
        parts = []
    for _ in range(r.choice([1, 2, 4, 8, 14])):
        kind = r.random()
        if kind < 0.55:
            parts.append(f"<p>{marked(_text(r))}</p>")
        elif kind < 0.65:
            parts.append(f"<p><b>{marked(_sentence(r))}<br><p>{marked(_text(r))}</p>")
        elif kind < 0.72:
            parts.append(f"<h{r.randint(2, 4)}>{marked(_words(r, 1, 8))}</h2>")
        elif kind < 0.78:
            parts.append("<ul>" + "".join(f"<li>{marked(_sentence(r, 1, 8))}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.82:
            parts.append(f"<blockquote><p>{marked(_text(r))}</p></blockquote>")
        elif kind < 0.85:
            parts.append(f"<pre>{marked(_text(r))}</pre>")
        elif kind < 0.88:
            parts.append(f"<table><tr><td>{marked(_words(r, 1, 3))}</td><td>{marked(_words(r, 1, 3))}</td></tr></table>")
        elif kind < 0.92:
            parts.append(f'<p>{marked(_text(r))} <a href="/x">{_words(r, 1, 4)}</a> {_text(r)}</p>')
        elif kind < 0.94:
            parts.append(_advert(r))
        elif kind < 0.96:
            parts.append(_sidebar(r))
        elif kind < 0.97:
            parts.append(_form(r))
        else:
            parts.append(f"<p>{marked(_words(r, 1, 3))}</p>")
    body = "".join(parts)
    return r.choice(
        [
            f"<article>{body}</article>",
            f"<article>{body}</article>",
            f"<main>{body}</main>",
            f"<main><article>{body}</article></main>",
            f'<div class="{r.choice(["content", "post", "entry-content", "article", "article-body", "post-body", "story"])}">{body}</div>',
            f'<div id="{r.choice(["content", "main", "main-content", "article"])}">{body}</div>',
            f'<main><section class="{r.choice(["text", "body", "entry"])}">{body}</section></main>',
        ]
    )


def labelled_page(r: random.Random) -> tuple[list[Block], list[int]]:
    before = [f(r) for f in (_menu, _header, _advert, _notice, _form, _sidebar) if r.random() < 0.5]
    after = [f(r) for f in (_sidebar, _comments, _advert, _notice, _form, _menu) if r.random() < 0.35]
    r.shuffle(before)
    r.shuffle(after)
    body = "".join([*before, _article(r), *after, _footer(r) if r.random() < 0.9 else ""])
    if r.random() < 0.3:
        body = f'<div {r.choice(["class", "id"])}="{r.choice(["wrapper", "page", "container", "site"])}">{body}</div>'
    found = leaf_blocks(f"<!DOCTYPE html><html><head><title>{_word(r)}</title></head><body>{body}</body></html>")
    labels = [int(_MARK in b.text) for b in found]
    return [Block(b.path, b.text.replace(_MARK, "") or "x", b.linked) for b in found], labels


def labelled_pages(n: int = 500, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """n pages with at least one block each, the same for the same seed."""
    r = random.Random(seed)
    out: list[tuple[list[Block], list[int]]] = []
    while len(out) < n:
        page = labelled_page(r)
        if page[0]:
            out.append(page)
    return out
