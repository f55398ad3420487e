"""Labelled pages that the block model is trained on.

Pages are drawn from a grammar of layouts seen on the web: a main part in various wrappings,
and menus, headers, notices, adverts, sidebars, forms, reader comments and footers around
and inside it. Every leaf block comes with its label. The words are drawn at random, so
what can be learned is markup, shape and position, not vocabulary.
"""

from __future__ import annotations

import random

SYLLABLES = "al an be da de en er es fo ga he in ka la le li ma mi na no on or pa ra re sa se so ta te ti to un ve vi wa".split()

#: Words of class and id attributes by part of the page (values in use on the web).
NAMES = {
    "content": "content article post entry story main body text article-body post-content entry-content page single prose".split(),
    "nav": "nav menu navbar navigation main-menu topnav links breadcrumb breadcrumbs pagination toc".split(),
    "header": "header masthead top banner branding site-header logo topbar".split(),
    "footer": "footer bottom colophon site-footer copyright legal imprint".split(),
    "sidebar": "sidebar side aside widget related recommended trending popular rail secondary more-stories".split(),
    "ad": "ad ads advert advertisement sponsored sponsor promo banner-ad dfp adsbox teaser-ad".split(),
    "notice": "cookie cookies consent gdpr notice alert banner popup modal overlay privacy newsletter paywall".split(),
    "form": "form search login signup subscribe newsletter contact comment-form".split(),
    "comments": "comments comment replies discussion respond disqus responses thread reader-comments".split(),
    "share": "share social sharing follow buttons tags meta byline tools".split(),
    "neutral": "wrapper container row col inner box section block module item wrap clearfix left right".split(),
}


class Page:
    """A page that is being written: its markup, and the label of every leaf block."""

    def __init__(self, rng: random.Random) -> None:
        self.rng, self.parts, self.labels = rng, [], []

    def words(self, low: int, high: int, linked: bool = False) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            word = "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))
            if self.rng.random() < 0.06:
                word = f"<b>{word}</b>"
            if linked and self.rng.random() < 0.05:
                word = f'<a href="/{word}">{word}</a>'
            out.append(word + self.rng.choice(("", "", "", "", "", "", ",", ".")))
        if self.rng.random() < 0.03:
            out = [f"{w} |" for w in out]
        return " ".join(out).capitalize() + self.rng.choice((".", ".", ".", "", "?", "!"))

    def attribute(self, part: str) -> str:
        rng = self.rng
        if rng.random() < 0.15:
            part = "neutral"
        name = rng.choice(NAMES[part])
        if rng.random() < 0.3:
            name += rng.choice(("-1", " ", "-box", "_wrap", " col", "-area"))
        return f' {rng.choice(("class", "class", "id"))}="{name.strip()}"'

    def leaf(self, tag: str, inner: str, label: int) -> None:
        self.parts.append(f"<{tag}>{inner}</{tag}>")
        self.labels.append(label)

    def open(self, tag: str, attribute: str = "") -> None:
        self.parts.append(f"<{tag}{attribute}>")

    def close(self, tag: str) -> None:
        self.parts.append(f"</{tag}>")

    def link_list(self, low: int, high: int, tag: str = "ul") -> None:
        self.open(tag)
        for _ in range(self.rng.randint(low, high)):
            self.leaf("li", f'<a href="/x">{self.words(1, 4)}</a>', 0)
        self.close(tag)


def _menu(page: Page) -> None:
    tag = page.rng.choice(("nav", "nav", "div", "header"))
    page.open(tag, page.attribute("nav") if tag == "div" or page.rng.random() < 0.4 else "")
    page.link_list(2, 9)
    page.close(tag)


def _header(page: Page) -> None:
    tag = page.rng.choice(("header", "div"))
    page.open(tag, page.attribute("header"))
    page.leaf(page.rng.choice(("div", "p", "h2")), f'<a href="/">{page.words(1, 3)}</a>', 0)
    if page.rng.random() < 0.5:
        page.leaf("p", page.words(2, 8), 0)
    page.close(tag)


def _plain(page: Page, part: str, tags: tuple[str, ...], low: int, high: int) -> None:
    tag = page.rng.choice(tags)
    page.open(tag, page.attribute(part))
    if page.rng.random() < 0.4:  # text directly inside
        page.parts.append(page.words(low, high))
        page.labels.append(0)
    else:
        for _ in range(page.rng.randint(1, 3)):
            page.leaf(page.rng.choice(("p", "div", "h3")), page.words(low, high), 0)
    page.close(tag)


def _sidebar(page: Page) -> None:
    tag = page.rng.choice(("aside", "aside", "div", "section"))
    page.open(tag, page.attribute("sidebar") if tag != "aside" or page.rng.random() < 0.5 else "")
    page.leaf(page.rng.choice(("h3", "h4", "div")), page.words(1, 3), 0)
    if page.rng.random() < 0.6:
        page.link_list(2, 7)
    for _ in range(page.rng.randint(0, 2)):
        page.leaf("p", page.words(5, 40), 0)
    page.close(tag)


def _form(page: Page) -> None:
    page.open("form", page.attribute("form") if page.rng.random() < 0.5 else "")
    for _ in range(page.rng.randint(1, 3)):
        page.leaf(page.rng.choice(("p", "div", "legend")), page.words(1, 10), 0)
        page.parts.append('<input type="text" name="q">')
    page.close("form")


def _comments(page: Page) -> None:
    tag = page.rng.choice(("section", "div", "ol", "ul"))
    page.open(tag, f' {page.rng.choice(("id", "class"))}="{page.rng.choice(NAMES["comments"])}"')
    item = "li" if tag in ("ol", "ul") else page.rng.choice(("div", "article", "section"))
    for _ in range(page.rng.randint(1, 5)):
        page.open(item, page.attribute("comments") if page.rng.random() < 0.6 else "")
        page.leaf("h4", page.words(1, 2), 0)
        for _ in range(page.rng.randint(1, 2)):
            page.leaf("p", page.words(4, 70), 0)
        page.close(item)
    page.close(tag)


def _footer(page: Page) -> None:
    tag = page.rng.choice(("footer", "footer", "div"))
    page.open(tag, page.attribute("footer") if tag == "div" or page.rng.random() < 0.4 else "")
    if page.rng.random() < 0.5:
        page.link_list(2, 6)
        page.leaf("p", f"&copy; {page.words(1, 12)}", 0)
    else:
        page.parts.append(f"&copy; {page.words(1, 4)} &middot; {page.words(4, 12)}")
        page.labels.append(0)
    page.close(tag)


def _noise_inside(page: Page) -> None:
    kind = page.rng.random()
    if kind < 0.35:
        _plain(page, "ad", ("div", "aside"), 2, 20)
    elif kind < 0.55:
        page.open("div", page.attribute("share"))
        page.link_list(2, 5)
        page.close("div")
    elif kind < 0.7:
        _form(page)
    elif kind < 0.85:
        _sidebar(page)
    else:
        _plain(page, "notice", ("div",), 4, 25)


def _article(page: Page) -> None:
    rng = page.rng
    kind = rng.random()
    wrap = []
    if kind < 0.45:
        wrap.append(("article", page.attribute("content") if rng.random() < 0.3 else ""))
    elif kind < 0.6:
        wrap.append(("main", ""))
    else:
        wrap.append((rng.choice(("div", "section", "td")), page.attribute("content")))
    if rng.random() < 0.3:
        wrap.insert(0, ("main", ""))
    if rng.random() < 0.3:
        wrap.append(("div", page.attribute(rng.choice(("content", "neutral")))))
    for tag, attribute in wrap:
        page.open(tag, attribute)
    if rng.random() < 0.85:
        page.leaf("h1", page.words(1, 14), 1)
    if rng.random() < 0.3:  # a paragraph that is never closed
        page.parts.append(f"<p><b>{page.words(3, 20)}<br>")
        page.labels.append(1)
    for _ in range(rng.randint(0, 14)):
        kind = rng.random()
        if kind < 0.68:
            low, high = rng.choice(((1, 6), (6, 25), (20, 90), (60, 200)))
            page.leaf("p", page.words(low, high, linked=True), 1)
        elif kind < 0.76:
            page.leaf(rng.choice(("h2", "h3")), page.words(1, 8), 1)
        elif kind < 0.83:
            tag = rng.choice(("ul", "ol"))
            page.open(tag)
            for _ in range(rng.randint(1, 6)):
                page.leaf("li", page.words(2, 25, linked=True), 1)
            page.close(tag)
        elif kind < 0.87:
            page.open("blockquote")
            page.leaf("p", page.words(5, 50), 1)
            page.close("blockquote")
        elif kind < 0.9:
            page.leaf(rng.choice(("pre", "blockquote", "div")), page.words(3, 40), 1)
        elif kind < 0.93:
            page.open("table")
            for _ in range(rng.randint(1, 3)):
                page.open("tr")
                for _ in range(rng.randint(1, 3)):
                    page.leaf("td", page.words(1, 8), 1)
                page.close("tr")
            page.close("table")
        else:
            _noise_inside(page)
    for tag, _ in reversed(wrap):
        page.close(tag)


def labelled_page(seed: int) -> tuple[str, list[int]]:
    """(html, the labels of its leaf blocks in order: 1 is main text)."""
    page = Page(random.Random(seed))
    rng = page.rng
    page.parts.append("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>")
    if rng.random() < 0.1:  # nothing but the main text
        _article(page)
        page.parts.append("</body></html>")
        return "".join(page.parts), page.labels
    box = rng.random() < 0.4
    if box:
        page.open("div", page.attribute("neutral"))
    for part, chance in ((_header, 0.4), (_menu, 0.8)):
        if rng.random() < chance:
            part(page)
    if rng.random() < 0.3:
        _plain(page, "notice", ("div", "section", "dialog"), 4, 30)
    if rng.random() < 0.5:
        _plain(page, "ad", ("div", "aside"), 2, 25)
    sidebar = rng.random()
    if sidebar < 0.2:
        _sidebar(page)
    _article(page)
    if rng.random() < 0.3:
        _plain(page, "ad", ("div", "aside"), 2, 25)
    if 0.2 <= sidebar < 0.5:
        _sidebar(page)
    if rng.random() < 0.4:
        _comments(page)
    if rng.random() < 0.3:
        _form(page)
    if rng.random() < 0.85:
        _footer(page)
    if box:
        page.close("div")
    page.parts.append("<script>var x='<p>no</p>';</script></body></html>")
    return "".join(page.parts), page.labels


def labelled_pages(count: int, seed: int = 0) -> list[tuple[str, list[int]]]:
    return [labelled_page(seed + i) for i in range(count)]
