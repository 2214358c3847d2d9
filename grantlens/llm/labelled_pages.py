"""Labelled pages to fit the extraction on: layouts of our own, filled with invented words.

A page is put together from parts (menus, notices, comments, ...) of which each has many usual
forms. ``data-main`` marks what belongs to the article (1) and what stands inside it but does not
(0); the attribute is never a feature. The same seed always gives the same pages.
"""

from __future__ import annotations

import random

SYLLABLES = "ka lo mi ter un vel sa dor in pra qui es tan mu re al so bri cen du for gal hi jo".split()
# What pages of many sites say and call their parts.
MENU_NAMES = "menu nav navigation navbar main-menu top-nav site-nav breadcrumb breadcrumbs tabs pagination pager toc".split()
HEAD_NAMES = "header site-header masthead branding logo topbar page-header banner-top".split()
FOOT_NAMES = "footer site-footer colophon legal copyright bottom page-footer credits".split()
SIDE_NAMES = "sidebar side rail widget widget-area secondary related popular trending archive tag-cloud recommended right-column see-also".split()
NOTICE_NAMES = "cookie cookie-notice consent gdpr notice alert modal popup overlay paywall disclaimer cookie-banner message privacy-banner".split()
AD_NAMES = "ad ads advert advertisement sponsor sponsored promo promotion adsense ad-slot banner commercial".split()
FORM_NAMES = "search search-form newsletter subscribe login signup contact-form register newsletter-signup".split()
SHARE_NAMES = "share social sharing follow share-buttons social-links tools print".split()
COMMENT_NAMES = "comments comment-list commentlist discussion responses replies disqus reader-comments comment feedback".split()
MAIN_NAMES = "content main-content post post-content entry entry-content article article-body story story-body body text page-content post-body".split()
LINK_WORDS = "Home News Sport About Contact Archive Shop Blog Help Login Register Privacy Terms Team Jobs Events Media Map Next Previous Impressum Inicio Accueil Kontakt".split()
NOTICES = (
    "We use cookies to make this site work.", "This site uses cookies. By going on you agree.", "Accept all cookies", "Your privacy matters to us.",
    "Sign up to read on.", "Wir verwenden Cookies.", "Ce site utilise des cookies.", "Este sitio usa cookies.", "Please turn on JavaScript.",
)
OWNERS = ("© {} {}. All rights reserved.", "Copyright {} {}", "© {} {}", "© {} {} · {}", "(c) {} {}, all rights reserved")


class Page:
    """Draws the parts of one page."""

    def __init__(self, seed: int) -> None:
        self.draw = random.Random(seed)
        self.named = self.draw.random() < 0.75  # whether parts say what they are by class
        self.modern = self.draw.random() < 0.6  # or by the newer elements
        self.closed = self.draw.random() < 0.8  # or end tags are left out
        self.loud = self.draw.random() < 0.15

    def one(self, *items):
        return self.draw.choice(items)

    def some(self, least: int, most: int, make) -> str:
        return "".join(make() for _ in range(self.draw.randint(least, most)))

    def word(self) -> str:
        return "".join(self.draw.choice(SYLLABLES) for _ in range(self.draw.randint(1, 3)))

    def words(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.draw.randint(least, most)))

    def sentence(self) -> str:
        text = self.words(1, 16).capitalize()
        if self.draw.random() < 0.3:
            text = text.replace(" ", ", ", 1)
        text = text.upper() + "!!" if self.loud and self.draw.random() < 0.5 else text
        return text + self.one(".", ".", ".", ".", "!", "?")

    def sentences(self, least: int, most: int) -> str:
        return " ".join(self.sentence() for _ in range(self.draw.randint(least, most)))

    def link(self) -> str:
        return f'<a href="/{self.word()}">{self.one(self.one(*LINK_WORDS), self.word(), self.words(1, 4).capitalize())}</a>'

    def named_as(self, names: list[str]) -> str:
        if not self.named:
            return ""
        name = self.draw.choice(names)
        name = self.one(name, name, name, f"{name} {self.word()}", f"c-{name}", name.replace("-", "_"), name.title().replace("-", ""))
        return f' {self.one("class", "class", "id")}="{name}"'

    def box(self, tags: str, names: list[str], inside: str, marked: str = "") -> str:
        tag = self.draw.choice(tags.split()) if self.modern else "div"
        return f"<{tag}{self.named_as(names)}{marked}>{inside}</{tag}>\n"

    def end(self, tag: str) -> str:
        return f"</{tag}>" if self.closed or self.draw.random() < 0.3 else ""

    def paragraph(self) -> str:
        text = self.sentences(1, self.one(1, 2, 4, 7))
        if self.draw.random() < 0.25:
            text = f"<{(tag := self.one('b', 'em', 'strong', 'span'))}>{text}</{tag}> {self.sentence()}"
        elif self.draw.random() < 0.2:
            text += f' <a href="#">{self.words(1, 5)}</a> {self.sentence()}'
        elif self.draw.random() < 0.1:
            text = f"<b>{text}<br>"
        return f"<p>{text}{self.end('p')}\n"

    def links(self) -> str:
        return "<ul>" + self.some(2, 8, lambda: f"<li>{self.link()}{self.end('li')}") + "</ul>"

    def menu(self) -> str:
        inside = self.one(self.links(), self.some(2, 6, lambda: self.link() + self.one(" ", " | ", " · ")), self.some(2, 5, lambda: f"<div>{self.link()}</div>"))
        return self.box("nav nav nav div header", MENU_NAMES, inside)

    def head(self) -> str:
        inside = self.one(f"<a href='/'>{self.words(1, 3).title()}</a>", f"<h1>{self.words(1, 3).title()}</h1>", f"<div>{self.words(1, 2).title()}</div><p>{self.words(2, 7).capitalize()}</p>")
        return self.box("header", HEAD_NAMES, inside + (self.menu() if self.draw.random() < 0.4 else ""))

    def foot(self) -> str:
        owner = self.draw.choice(OWNERS).format(self.draw.randint(1998, 2025), self.words(1, 3).title(), self.words(1, 4))
        inside = self.one(owner, f"<p>{owner}</p>", f"{self.links()}<p>{owner}</p>", f"{owner} {self.sentence()}", f"&copy; {self.word()}.example &middot; {self.sentences(1, 2)}")
        return self.box("footer", FOOT_NAMES, inside)

    def side(self) -> str:
        part = lambda: f"<h3>{self.words(1, 3).capitalize()}</h3>" + self.one(self.links(), f"<p>{self.sentences(1, 2)}</p>", f"<div>{self.link()}</div>")
        return self.box("aside aside div section", SIDE_NAMES, self.some(1, 3, part))

    def notice(self, marked: str = "") -> str:
        inside = self.one(f"<p>{self.draw.choice(NOTICES)} {self.link()}</p>", self.draw.choice(NOTICES), f"<p>{self.draw.choice(NOTICES)}</p><p>{self.sentence()}</p><button>OK</button>")
        return self.box("div div div aside section dialog", NOTICE_NAMES, inside, marked)

    def advert(self, marked: str = "") -> str:
        named, self.named = self.named, True  # nothing else tells an advert from the article
        most = self.one(2, 3, 6)
        inside = self.one(
            self.sentences(1, most), f"<p>{self.sentences(1, most)}</p>", f"<a href='/'>{self.sentence()}</a>", f"<h4>{self.words(1, 4)}</h4><p>{self.sentences(1, most)}</p>"
        )
        text = self.box("div div div aside", AD_NAMES, inside, marked)
        self.named = named
        return text

    def form(self, marked: str = "") -> str:
        inside = f"<form><label>{self.words(1, 3).capitalize()}</label> <input> <p>{self.words(2, 8)}</p><button>{self.word()}</button></form>"
        return self.box("div section", FORM_NAMES, inside, marked)

    def share(self, marked: str = "") -> str:
        return self.box("div ul", SHARE_NAMES, self.one("Share: ", "Share this", "") + self.some(2, 5, lambda: f"<a href='#'>{self.word()}</a> "), marked)

    def comments(self, marked: str = "") -> str:
        title = self.one("Comments", f"{self.draw.randint(2, 90)} comments", "Leave a comment", "Reader comments", "Discussion", "Responses", "Kommentare", "Commentaires", "Comentarios")
        level = self.one("h2", "h3", "h4")
        one = lambda: self.one(
            f"<div class='comment'><b>{self.word()}</b> says:<p>{self.sentences(1, 4)}</p></div>",
            f"<li><p>{self.sentences(1, 4)}</p><a href='#'>Reply</a></li>",
            f"<article class='comment'><p>{self.sentences(1, 3)}</p></article>",
        )
        named, self.named = self.named, True
        text = self.box("section section div ol", COMMENT_NAMES, f"<{level}>{title}</{level}>" + self.some(1, 5, one), marked)
        self.named = named
        return text

    def passage(self) -> str:
        """Something else than a paragraph in an article."""
        return self.one(
            f"<h2>{self.words(1, 6).capitalize()}</h2>", f"<h3>{self.words(1, 5).capitalize()}</h3>", f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>",
            f"<blockquote>{self.sentences(1, 2)}</blockquote>", "<ul>" + self.some(2, 6, lambda: f"<li>{self.one(self.words(1, 8), self.sentence())}{self.end('li')}") + "</ul>",
            "<ol>" + self.some(2, 5, lambda: f"<li>{self.sentence()}</li>") + "</ol>", f"<pre>{self.words(3, 20)}</pre>",
            f"<figure><img><figcaption>{self.words(2, 9)}</figcaption></figure>",
            "<table>" + self.some(1, 4, lambda: f"<tr><td>{self.words(1, 3)}<td>{self.draw.randint(1, 999)}</tr>") + "</table>",
            f"<dl><dt>{self.word()}<dd>{self.sentence()}</dl>", f"<div>{self.sentences(1, 4)}</div>", f"<p>{self.word().capitalize()}.</p>",
        )

    def inset(self) -> str:
        """What stands inside an article without belonging to it."""
        return self.one(self.advert, self.advert, self.share, self.notice, self.form)(' data-main="0"')

    def article(self) -> str:
        parts = [f"<h1>{self.words(1, 9).capitalize()}</h1>\n" if self.draw.random() < 0.8 else ""]
        if parts[0] and self.modern and self.draw.random() < 0.2:
            parts[0] = f"<header>{parts[0]}</header>"
        for _ in range(self.one(1, 2, 4, 8, 14)):
            parts.append(self.paragraph())
            if self.draw.random() < 0.3:
                parts.append(self.passage())
            if self.draw.random() < 0.2:
                parts.append(self.inset())
        if self.draw.random() < 0.15:
            parts.append(self.comments(' data-main="0"'))
        inside = "".join(parts)
        tag = self.one("article", "article", "main", "section") if self.modern else self.one("div", "div", "td")
        names = self.named_as(MAIN_NAMES) if not self.modern or self.draw.random() < 0.5 else ""
        if tag == "td":
            return f'<table><tr><td{names} data-main="1">{inside}</table>'
        return f'<{tag}{names} data-main="1">{inside}</{tag}>\n'

    def text(self) -> str:
        before = [part() for part in (self.notice, self.head, self.menu, self.menu, self.advert, self.form, self.side) if self.draw.random() < 0.45]
        after = [part() for part in (self.share, self.comments, self.comments, self.side, self.side, self.advert, self.form, self.notice, self.foot, self.foot) if self.draw.random() < 0.4]
        title = f"<title>{self.words(1, 6)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script>"
        inside = "".join(before) + self.article() + "".join(after)
        if self.draw.random() < 0.4:
            inside = f'<div class="{self.one("wrapper", "container", "page", "site", "row", "layout")}">{inside}</div>'
        return f"<!DOCTYPE html><html><head>{title}</head><body>{inside}" + self.one("</body></html>", "")


def labelled_pages(count: int, seed: int = 0) -> list[str]:
    return [Page(seed * 1_000_003 + k).text() for k in range(count)]
