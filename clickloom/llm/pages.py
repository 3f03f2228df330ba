"""Labelled pages to train on: a grammar of page layouts, drawn from with a fixed seed.

Every run of text has words of its own, so a text tells whether it is main text.
"""

from __future__ import annotations

import random

PAGES = 700
SYLLABLES = "an be chi do el fra gu ho is ka lo mi no or pe qui ra sto tu ver".split()
TOP = ["nav", 'div class="nav"', 'div id="menu"', 'div class="navbar topbar"', 'ul class="menu"', 'header',
       'div role="navigation"', 'div class="breadcrumb"', 'div id="header"', 'div class="site-header"']
NOTICE = ['div class="cookie-banner"', 'div id="cookie-notice"', 'div class="notice"', 'div class="alert"',
          'div role="alert"', 'div class="consent"', 'div class="popup modal"', 'dialog', 'div class="message banner"']
ADVERT = ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'aside class="promo"',
          'div id="ad-top"', 'div class="sponsored"', 'section class="sponsor"', 'ins class="adsbygoogle"']
SIDE = ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="related"', 'section class="related-posts"',
        'div class="widget"', 'div class="share social"', 'div class="tags"', 'div role="complementary"']
COMMENTS = ['div class="comments"', 'section id="comments"', 'div id="disqus comment-list"', 'ol class="commentlist"',
            'div class="comment"', 'section class="reader-comments"', 'div class="replies"', 'div class="discussion"']
FORM = ["form", 'form class="newsletter"', 'form id="search"', 'div class="newsletter signup"', 'div class="subscribe"']
FOOT = ["footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"', 'div role="contentinfo"']
MAIN = ["article", "main", 'div class="article"', 'div id="content"', 'div class="post"', 'div class="entry-content"',
        'section class="story"', 'div role="main"', 'div itemprop="articleBody"', 'div class="post-body"', "div", "section"]
# Values whose parts are words of the lists above, on elements around main text.
BENIGN = ["ad-free", "no-sidebar", "has-comments", "with-menu", "menu-open", "nav-fixed", "header-small", "footer-none",
          "story-content", "no-ads", "share-enabled", "page-wrapper", "cookie-ok", "text-alert-free", "col-8"]
HIDE = ["hidden", 'style="display:none"', 'style="color:red; visibility:hidden"']


class _Maker:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.main: set[str] = set()

    def words(self, least: int, most: int) -> str:
        pick = self.draw.choice
        return " ".join(
            "".join(pick(SYLLABLES) for _ in range(self.draw.randint(1, 4)))
            for _ in range(self.draw.randint(least, most))
        )

    def sentences(self, least: int, most: int) -> str:
        return " ".join(
            self.words(3, 18).capitalize() + self.draw.choice([".", ".", ".", "!", "?", ""])
            for _ in range(self.draw.randint(least, most))
        )

    def line(self, main: bool) -> str:
        """A text of any length and look, so that looks alone decide little."""
        kind = self.draw.random()
        text = self.words(1, 8) if kind < 0.3 else self.sentences(1, 2) if kind < 0.6 else self.sentences(2, 9)
        text = text.upper() if self.draw.random() < 0.05 else text
        if main:
            self.main.add(text)
        return text

    def wrapped(self, opening: str, inner: str) -> str:
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    def links(self) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(self.draw.randint(2, 8))]
        if self.draw.random() < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " ".join(items)

    def texts(self, tags: list[str], number: int) -> str:
        return "".join(self.wrapped(self.draw.choice(tags), self.line(False)) for _ in range(number))

    def aside(self, openings: list[str]) -> str:
        opening = self.draw.choice(openings)
        kind = self.draw.random()
        if kind < 0.35:
            inner = self.line(False)
        elif kind < 0.7:
            inner = self.texts(["p", "p", "h3", "div", "li"], self.draw.randint(1, 4))
        else:
            inner = self.links()
        return self.wrapped(opening, inner)

    def comments(self) -> str:
        each = self.draw.choice(["p", 'div class="comment"', "li", 'article class="comment"', "blockquote"])
        inner = self.wrapped("h3", self.words(1, 3)) if self.draw.random() < 0.5 else ""
        inner += "".join(
            self.wrapped(each, self.line(False) if "class" not in each else self.wrapped("p", self.line(False)))
            for _ in range(self.draw.randint(1, 5))
        )
        return self.wrapped(self.draw.choice(COMMENTS), inner)

    def form(self) -> str:
        parts = ["<label>" + self.words(1, 4) + "</label>", "<button>" + self.words(1, 2) + "</button>",
                 "<p>" + self.line(False) + "</p>", "<select><option>" + self.words(1, 2) + "</option></select>"]
        return self.wrapped(self.draw.choice(FORM), "".join(self.draw.sample(parts, self.draw.randint(1, 4))))

    def body(self) -> str:
        draw = self.draw
        out = [self.wrapped(draw.choice(["h1", "h1", "h2"]), self.line(True))] if draw.random() < 0.9 else []
        for _ in range(draw.randint(0, 12)):
            kind, text = draw.random(), self.line(True)
            if kind < 0.6:
                out.append(f"<p>{text}</p>")
            elif kind < 0.68:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.74:
                out.append(f"<h2>{text}</h2>")
            elif kind < 0.8:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.88:
                out.append(f"<ul><li>{text}</li><li>{self.line(True)}</li></ul>")
            elif kind < 0.92:
                out.append(f"<pre>{text}</pre>")
            elif kind < 0.96:
                out.append(f"<table><tr><td>{text}</td><td>{self.line(True)}</td></tr></table>")
            else:
                out.append(f"<div>{text}</div>")
            # Adverts, boxes and forms stand inside articles too.
            if draw.random() < 0.06:
                out.append(draw.choice([lambda: self.aside(ADVERT), lambda: self.aside(SIDE), self.form])())
        return "".join(out)

    def neutral(self) -> str:
        """An opening that tells nothing: no attribute, one of drawn syllables, or one with a misleading part."""
        tag = self.draw.choice(["div", "div", "section", "td", "center"])
        kind = self.draw.random()
        if kind < 0.4:
            return tag
        value = self.words(1, 1) + str(self.draw.randint(1, 9)) if kind < 0.7 else self.draw.choice(BENIGN)
        return f'{tag} {self.draw.choice(["class", "id"])}="{value}"'

    def plain_page(self) -> str:
        """A page of few elements without telling classes: text, and links or notes around it."""
        draw = self.draw
        bits = [f"<p>{self.line(True)}</p>" for _ in range(draw.choice([1, 1, 2, 2, 3, 6, 10]))]
        if draw.random() < 0.4:
            bits.insert(0, f"<h1>{self.line(True)}</h1>")
        if draw.random() < 0.3:  # a part that opens on a click is text all the same
            bits.append(f"<div {draw.choice(HIDE)}><p>{self.line(True)}</p></div>")
        if draw.random() < 0.2:
            bits.insert(draw.randint(0, len(bits)), f'<div class="{draw.choice(BENIGN)}"><p>{self.line(True)}</p></div>')
        main = "".join(bits)
        for _ in range(draw.choice([0, 1, 1, 2])):
            main = self.wrapped(self.neutral(), main)
        menu = self.links() if draw.random() < 0.6 else ""
        menu = self.wrapped(draw.choice(["p", "div", "ul", "nav", "td"]), menu) if menu else ""
        foot = draw.choice(["", "", f"<p>© {draw.randint(1990, 2030)} {self.words(1, 4)}</p>", self.aside(FOOT)])
        if draw.random() < 0.25:
            main = f"<table><tr><td>{menu}</td><td>{main}</td></tr></table>"
            menu = ""
        behind = draw.choice(["", "", self.comments, self.form, lambda: self.aside(ADVERT)])
        return "<html><body>" + menu + main + (behind() if behind else "") + foot + "</body></html>"

    def page(self) -> str:
        draw = self.draw
        if draw.random() < 0.45:
            return self.plain_page()
        before = [self.aside(TOP) if draw.random() < 0.4 else self.wrapped(draw.choice(TOP), self.links())]
        before += [self.aside(x) for x in (NOTICE, ADVERT, SIDE, TOP) if draw.random() < 0.45]
        before += [self.form()] if draw.random() < 0.2 else []
        draw.shuffle(before)
        after = [self.aside(x) for x in (ADVERT, SIDE, NOTICE) if draw.random() < 0.4]
        after += [self.form()] if draw.random() < 0.25 else []
        after += [self.comments()] if draw.random() < 0.4 else []
        draw.shuffle(after)
        inside = self.body() + (self.comments() if draw.random() < 0.1 else "")
        main = self.wrapped(draw.choice(MAIN[:6] * 2 + MAIN), inside)
        if draw.random() < 0.25:
            main = self.wrapped(draw.choice(['div class="wrapper"', "main", 'div id="page"', 'div class="container"']), main)
        if draw.random() < 0.15:
            main = self.wrapped(f'{draw.choice(["div", "main"])} class="{draw.choice(BENIGN)}"', main)
        if draw.random() < 0.1:
            before.append(f"<div {draw.choice(HIDE)}>{self.line(False)}</div>")
        foot = self.aside(FOOT) if draw.random() < 0.9 else ""
        title = self.words(2, 8)
        return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>"
                + "".join(before) + main + "".join(after) + foot + "</body></html>")


def labelled_pages(number: int = PAGES, seed: int = 1) -> list[tuple[str, set[str]]]:
    """(page, texts of its main blocks) of `number` drawn pages."""
    out = []
    for i in range(number):
        maker = _Maker(seed * 100_003 + i)
        page = maker.page()
        out.append((page, maker.main))
    return out
