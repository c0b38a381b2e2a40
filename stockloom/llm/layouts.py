"""Labelled pages, laid out by rule from invented prose, on which the extractor of main texts is trained.

A page is a list of parts: the article, and around or inside it menus, notices, adverts, sidebars, forms, comments and so on.
Each part can be marked up in several ways (by elements, by class names, by ids, or hardly at all). Every block of text is
wrapped in a marker, so its label is known: 1 for the article, 0 for all else.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

MAIN, OTHER = 1, 0
_MARK = ("\ue000", "\ue001")  #: private characters in front of a text of either label
_SYLLABLES = "ba ri to men sal ve cor na di lu pe stra ün gé ço ła mi ner ati on the er in ou ch".split()
#: Ways to open a part: an element with attributes. ``{}`` is a plain element without a name.
WAYS = {
    "header": ["header", 'div id="header"', 'div class="site-header"', 'div class="masthead"', 'div class="topbar"', 'div class="page-header banner"', 'div class="logo"'],
    "nav": ["nav", 'div class="nav"', 'ul class="menu"', 'div id="navigation"', 'div class="breadcrumb"', 'div class="navbar main-menu"', 'div class="pagination"', "div role=\"navigation\""],
    "ad": ['div class="ad"', 'div class="ads"', 'aside class="advert"', 'div class="sponsored"', 'div class="promo banner"', 'div id="ad-top"', 'div class="advertisement"', 'ins class="adsbygoogle"', 'section class="sponsor-box"'],
    "notice": ['div class="cookie-notice"', 'div id="cookie-banner"', 'div class="alert"', 'div class="notice"', 'div class="consent"', 'div class="popup modal"', 'div role="alert"', 'div role="dialog"', 'div class="gdpr"', 'div class="paywall"', 'div class="disclaimer"'],
    "sidebar": ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', 'section class="recommended"', 'div class="related-posts"', 'div class="right-column widget-area"', 'div class="most-read"', 'div class="tags"', 'aside class="teaser"'],
    "form": ["form", 'form class="search"', 'form class="newsletter"', 'div class="subscribe"', 'form id="login"', 'div class="signup form"', 'form class="contact"'],
    "share": ['div class="share"', 'div class="social"', 'ul class="social-links"', 'div class="share-buttons"'],
    "comments": ['div class="comments"', 'section id="comments"', 'ol class="comment-list"', 'div id="disqus_thread"', 'section class="comments-area"', 'div class="comment"', 'div class="responses"', 'section class="reader-comments"', 'div class="discussion"', 'div class="replies"'],
    "footer": ["footer", 'div id="footer"', 'div class="footer"', 'div class="site-footer"', 'div class="copyright"', 'div class="legal"', 'div class="colophon"'],
}
ARTICLES = [
    "article", "main", "article", 'div class="content"', 'div id="content"', 'div class="post"', 'div class="entry-content"', 'div class="article-body"',
    'section class="story"', 'div class="post-content"', 'div class="text"', 'main id="main-content"', 'div class="article"', 'div role="main"', "div", 'article class="post entry"',
]
WRAPS = ["", "div", 'div class="container"', 'div id="page"', 'div class="wrapper"', 'div id="main"', "section", 'div class="row"', 'table', 'div class="layout"']
#: Fixed phrases of page furniture.
PHRASES = {
    "notice": ["We use cookies to improve your experience.", "This site uses cookies. Accept all", "Please enable JavaScript.", "Your consent matters to us and our partners, who store data on your device.", "You have read three free pages this month."],
    "footer": ["© 2024 {} All rights reserved.", "Copyright {}", "Terms of use", "Privacy policy", "© {} · {}", "Imprint and contact: {}"],
    "share": ["Share", "Tweet", "Share on Facebook", "Print", "E-mail"],
    "form": ["Subscribe to our newsletter", "Your e-mail address", "Search", "Log in", "Send", "Enter your name {}"],
    "ad": ["Advertisement", "Sponsored: {}", "Buy now and save", "{}", "Ad"],
    "sidebar": ["Related articles", "Most read", "You may also like {}", "Tags", "About us", "{}"],
    "comments": ["3 Comments", "Reply", "Posted by {} on 3 May 2021", "Leave a comment", "{}", "{} says:"],
    "header": ["{}", "Skip to content", "Welcome to {}"],
    "nav": ["Home", "{}", "News", "Contact", "About", "Next page"],
}


class _Layout:
    def __init__(self, drawn: random.Random):
        self.drawn = drawn

    def words(self, low: int, high: int) -> str:
        draw = self.drawn
        return " ".join("".join(draw.choices(_SYLLABLES, k=draw.randint(1, 4))) for _ in range(draw.randint(low, high)))

    def sentence(self) -> str:
        found = self.words(1, 18).capitalize()
        return found.replace(" ", ", ", 1) + self.drawn.choice("....?!") if self.drawn.random() < 0.3 else found + "."

    def prose(self, most: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(self.drawn.randint(1, most)))

    def text(self, text: str, label: int) -> str:
        return _MARK[label] + text

    def element(self, way: str, inner: str) -> str:
        way = way or "div"
        if self.drawn.random() < 0.12:  # a name that tells nothing
            way = f'div class="{self.words(1, 1)}"'
        name = way.split(" ")[0]
        if name == "table":
            return f"<table><tr><td>{inner}</td></tr></table>"
        return f"<{way}>{inner}</{name}>"

    def phrase(self, part: str) -> str:
        return self.drawn.choice(PHRASES[part]).replace("{}", self.words(1, 5).capitalize())

    def link(self, text: str, label: int = OTHER) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.text(text, label)}</a>'

    def furniture(self, part: str) -> str:
        draw = self.drawn
        many = draw.randint(1, 7)
        if part in ("nav", "share"):
            items = "".join(f"<li>{self.link(self.phrase(part) if draw.random() < 0.5 else self.words(1, 3))}</li>" for _ in range(many))
            inner = f"<ul>{items}</ul>" if draw.random() < 0.8 else items.replace("li>", "span>")
        elif part == "comments":
            inner = ""
            for _ in range(many):
                head = self.text(self.phrase(part), OTHER)
                inner += f'<div class="{draw.choice(["comment", "reply", "c"])}"><b>{head}</b><p>{self.text(self.prose(4), OTHER)}</p></div>'
            inner = f"<h3>{self.text(self.phrase(part), OTHER)}</h3>" + inner
        elif part == "form":
            fields = "".join(f"<label>{self.text(self.phrase(part), OTHER)}</label><input>" for _ in range(draw.randint(1, 3)))
            inner = (f"<p>{self.text(self.phrase(part), OTHER)}</p>" if draw.random() < 0.5 else "") + fields
        elif part == "sidebar" and draw.random() < 0.6:
            inner = f"<h3>{self.text(self.phrase(part), OTHER)}</h3><ul>" + "".join(
                f"<li>{self.link(self.words(3, 9))}</li>" for _ in range(many)) + "</ul>"
        else:
            said = self.phrase(part) if draw.random() < 0.6 else self.prose(3)
            inner = self.text(said, OTHER) if draw.random() < 0.5 else f"<p>{self.text(said, OTHER)}</p>"
            if part in ("footer", "header") and draw.random() < 0.5:
                inner += "".join(self.link(self.phrase(part)) + " | " for _ in range(draw.randint(1, 4)))
        return self.element(draw.choice(WAYS[part]), inner)

    def article(self) -> str:
        draw = self.drawn
        inner = ""
        if draw.random() < 0.8:
            title = f"<h1>{self.text(self.words(2, 10).capitalize(), MAIN)}</h1>"
            inner += f"<header>{title}</header>" if draw.random() < 0.15 else title
        for _ in range(draw.randint(1, 12)):
            kind = draw.random()
            if kind < 0.72:
                text = self.text(self.prose(), MAIN)
                if draw.random() < 0.3:
                    text += f' {draw.choice(["<em>", "<b>", "<a href=x>"])}{self.words(1, 3)}'
                    text += draw.choice(["</em>", "</b>", "</a>"]) + " " + self.words(1, 5)
                inner += draw.choice([f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>"])
            elif kind < 0.8:
                inner += f"<h{draw.randint(2, 4)}>{self.text(self.words(1, 6).capitalize(), MAIN)}</h2>"
            elif kind < 0.87:
                inner += "<ul>" + "".join(f"<li>{self.text(self.words(1, 12), MAIN)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>"
            elif kind < 0.9:
                inner += f"<blockquote>{self.text(self.prose(3), MAIN)}</blockquote>"
            elif kind < 0.92:
                inner += "<table>" + "".join(f"<tr><td>{self.text(self.words(1, 2), MAIN)}</td><td>{self.text(str(draw.randint(1, 999)), MAIN)}</td></tr>" for _ in range(3)) + "</table>"
            elif kind < 0.94:
                inner += f"<figure><img src=x><figcaption>{self.text(self.sentence(), MAIN)}</figcaption></figure>"
            elif kind < 0.96:
                inner += f"<pre>{self.text(self.words(2, 9), MAIN)}</pre>"
            else:
                inner += self.furniture(draw.choice(["ad", "share", "sidebar", "form", "notice"]))
        if draw.random() < 0.12:
            inner += self.furniture("comments")
        return self.element(draw.choice(ARTICLES), inner)

    def page(self) -> str:
        draw = self.drawn
        before = [self.furniture(p) for p in ("notice", "header", "nav", "ad", "form", "nav", "sidebar", "header") if draw.random() < 0.38]
        after = [self.furniture(p) for p in ("share", "ad", "comments", "sidebar", "form", "nav", "notice", "footer", "footer") if draw.random() < 0.4]
        draw.shuffle(before)
        body = self.article() if draw.random() < 0.96 else ""
        if draw.random() < 0.5 and after:
            body = self.element(draw.choice(WRAPS), body + after.pop(0))
        page = "".join(before) + self.element(draw.choice(WRAPS), body) + "".join(after)
        if draw.random() < 0.3:
            page = self.element(draw.choice(WRAPS), page)
        return f"<html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{page}</body></html>"


def labelled_pages(n: int, seed: int) -> Iterator[str]:
    """``n`` pages whose texts begin with a marker; the same for the same seed."""
    drawn = random.Random(seed)
    for _ in range(n):
        yield _Layout(drawn).page()


def label_of(text: str) -> int | None:
    """The label of a block by the first marker in it; null without one."""
    found = [c for c in text if c in _MARK]
    return _MARK.index(found[0]) if found else None


def unmarked(text: str) -> str:
    return text.replace(_MARK[0], "").replace(_MARK[1], "")
