"""Labelled pages for the extraction model, made from a rule.

Each page is a layout of labelled regions. Regions take their tags, their id or class names and
their kind of text at random from short lists, with a fixed seed: articles in semantic, generic or
old-style mark-up among menus, headers, footers, sidebars, notices, adverts, forms and comments.
"""

from __future__ import annotations

import random

PAGES = 800

MAIN_NAMES = ["content", "article", "post", "entry", "story", "main", "text", "body", "article-body", "post-content", "entry-content", "page-content", ""]
OTHER = {
    "nav": (["nav", "div", "ul"], ["nav", "menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "top-menu", "links", "tabs", "pagination", "skip"]),
    "header": (["header", "div"], ["header", "masthead", "banner", "site-header", "logo", "top", "branding", "tagline"]),
    "footer": (["footer", "div"], ["footer", "bottom", "site-footer", "copyright", "legal", "colophon"]),
    "aside": (["aside", "div"], ["sidebar", "widget", "related", "aside", "recommended", "popular", "trending", "teaser", "more", "tags", "rail"]),
    "notice": (["div", "section", "aside"], ["cookie", "consent", "notice", "banner", "popup", "modal", "alert", "newsletter", "subscribe", "paywall", "gdpr", "disclaimer", "overlay"]),
    "ad": (["div", "aside", "section"], ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adbox"]),
    "form": (["form", "div"], ["search", "login", "form", "signup", "contact", "subscribe"]),
    "comments": (["section", "div", "ol"], ["comments", "comment", "comment-list", "discussion", "replies", "responses", "reviews", "disqus"]),
    "share": (["div", "ul"], ["share", "social", "sharing", "toolbar", "buttons", "follow"]),
}
SYLLABLES = "an be co da el fi ga ho in ja ka lo mi na on pa re sa to un ve wi za er st".split()


def _words(r: random.Random, low: int, high: int) -> str:
    words = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
    for k in range(len(words)):
        if r.random() < 0.1:
            words[k] += r.choice([".", ",", ".", ",", "***", "!!", "###", "&amp;"])
    style = r.random()
    text = " ".join(words)
    return text.upper() if style < 0.06 else text.capitalize() + (r.choice([".", ".", "", "!"]))


def _attributes(r: random.Random, names: list[str], must: bool) -> str:
    name = r.choice(names)
    if not name or not must and r.random() < 0.35:
        return ""
    extra = r.choice(["", "", " clearfix", " row", " box", " inner", " block-3"])
    return f' {r.choice(["class", "class", "id"])}="{name}{extra}"'


def _main(r: random.Random) -> tuple[str, list[str]]:
    tag = r.choice(["article", "article", "main", "div", "section", "td", "div"])
    out, labels = [], []
    longest = r.choice([6, 15, 40, 90, 90])  # short articles happen

    def add(mark: str, text: str) -> None:
        out.append(mark.replace("~", text))
        labels.append("main")

    if r.random() < 0.8:
        add(r.choice(["<h1>~</h1>", "<h1 class=title>~</h1>", "<h2>~</h2>", "<header><h1>~</h1></header>"]), _words(r, 1, 12))
    if r.random() < 0.15:
        add('<p class="lead">~</p>', _words(r, 8, 40))
    for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9])):
        kind = r.random()
        if kind < 0.7:
            add(r.choice(["<p>~</p>", "<p>~", "<p><b>~</b></p>", "<p>~<br>", "<div>~</div>"]), _words(r, 1, longest))
        elif kind < 0.78:
            add(r.choice(["<h2>~</h2>", "<h3>~</h3>"]), _words(r, 1, 8))
        elif kind < 0.86:
            out.append("<ul>")
            for _ in range(r.randint(2, 4)):
                add("<li>~</li>", _words(r, 2, 25))
            out.append("</ul>")
        elif kind < 0.9:
            add("<blockquote>~</blockquote>", _words(r, 5, 40))
        elif kind < 0.94:
            out.append("<table><tr>")
            for _ in range(3):
                add("<td>~</td>", _words(r, 1, 3))
            out.append("</table>")
        elif kind < 0.97:
            add("<pre>~</pre>", _words(r, 3, 20))
        else:
            add("<p>~ <a href='/x'>link</a></p>", _words(r, 6, 30))
        if r.random() < 0.04:
            inner, own = _other(r, r.choice(["ad", "share", "aside", "notice"]))
            out.append(inner)
            labels.extend(own)
    for kind, often in (("share", 0.15), ("comments", 0.3), ("aside", 0.2), ("notice", 0.15), ("form", 0.15), ("ad", 0.1)):
        if r.random() < often:
            inner, own = _other(r, kind)
            out.append(inner)
            labels.extend(own)
    must = tag in ("div", "section", "td")
    names = MAIN_NAMES[:-1] if must else MAIN_NAMES
    body = "".join(out)
    if r.random() < 0.1:
        return body, labels  # straight in the page
    if tag == "td":
        return f"<table><tr><td{_attributes(r, names, r.random() < 0.8)}>{body}</td></tr></table>", labels
    return f"<{tag}{_attributes(r, names, must)}>{body}</{tag}>", labels


def _other(r: random.Random, kind: str) -> tuple[str, list[str]]:
    tags, names = OTHER[kind]
    tag = r.choice(tags)
    semantic = tag in ("nav", "header", "footer", "aside", "form")
    out, count = [], 0
    wordy = r.choice([1, 1, 2, 4])

    def add(mark: str, text: str) -> None:
        nonlocal count
        out.append(mark.replace("~", text))
        count += 1

    if kind in ("nav", "share") or kind == "footer" and r.random() < 0.4:
        inner = r.random() < 0.7 and tag != "ul"
        out.append("<ul>" if inner else "")
        for _ in range(r.randint(2, 7)):
            add(r.choice(["<li><a href='/a'>~</a></li>", "<li>~</li>"]), _words(r, 1, 3))
        out.append("</ul>" if inner else "")
    elif kind == "comments":
        if r.random() < 0.7:
            add("<h3>~</h3>", r.choice(["Comments", "3 comments", "Kommentare", _words(r, 1, 2)]))
        for _ in range(r.randint(1, 5)):
            add(r.choice(["<p>~</p>", '<div class="comment"><p>~</p></div>', "<li>~</li>", '<div class="comment-body">~</div>', '<article class="comment"><p>~</p></article>']), _words(r, 2, 30 * wordy))
    elif kind == "form":
        add("<label>~</label><input name=q>", _words(r, 1, 4))
        if r.random() < 0.4:
            add("<p>~</p>", _words(r, 3, 12))
    else:
        if r.random() < 0.4 and kind in ("aside", "notice"):
            add("<h3>~</h3>", _words(r, 1, 4))
        for _ in range(r.randint(1, 3)):
            if kind == "footer":
                add(r.choice(["<p>~</p>", "<div>~</div>", "~<br><div></div>"]), r.choice(["&copy; ", "© ", ""]) + _words(r, 2, 15 * wordy))
            elif kind == "header":
                add(r.choice(["<div>~</div>", "<h1>~</h1>", "<p>~</p>", "<a href='/'>~</a><div></div>"]), _words(r, 1, 6))
            else:
                add(r.choice(["<p>~</p>", "<div>~</div>", "<li><a href='/b'>~</a></li>", "<p><a href='/c'>~</a></p>", "~<div></div>"]), _words(r, 2, 25 * wordy))
    body = "".join(out)
    return f"<{tag}{_attributes(r, names, not semantic)}>{body}</{tag}>", ["other"] * count


def labelled_pages(count: int = PAGES, seed: int = 11) -> list[tuple[str, list[str]]]:
    """(page, label of each of its blocks: main or other)."""
    r = random.Random(seed)
    pages = []
    for _ in range(count):
        before = [k for k in ("notice", "header", "nav", "ad", "form") if r.random() < 0.55]
        after = [k for k in ("share", "comments", "aside", "ad", "nav", "form", "footer") if r.random() < 0.45]
        r.shuffle(before)
        parts, labels = [], []
        for kind in before:
            part, own = _other(r, kind)
            parts.append(part)
            labels += own
        if r.random() < 0.97:
            part, own = _main(r)
            parts.append(part)
            labels += own
        for kind in after:
            part, own = _other(r, kind)
            parts.append(part)
            labels += own
        body = "".join(parts)
        if r.random() < 0.06:
            body, labels = _words(r, 3, 60), ["main"]  # no mark-up at all
            if r.random() < 0.5:
                body, labels = "".join(f"<p>{_words(r, 3, 40)}</p>" for _ in range(3)), ["main"] * 3
        if r.random() < 0.4:
            wrap = r.choice(["wrapper", "page", "container", "site", "layout"])
            body = f'<div class="{wrap}">{body}</div>'
        pages.append((f"<html><head><title>{_words(r, 1, 6)}</title></head><body>{body}</body></html>", labels))
    return pages
