"""Pages in many layouts, made of given texts, whose main text is known: what the trees of HTML extraction learn from."""

from __future__ import annotations

import random
from collections.abc import Sequence
from html import escape

# Stands before every block of main text, in a character of private use.
MARK = ""
SEED = 7
PROSE_CHARS = 60

# Names that pages give to their parts.
CONTENT = "article-body content entry-content post-content main-content story-body post article__text page-content entry prose text".split()
NOTICES = "cookie-notice cookie-banner consent gdpr-banner alert newsletter-signup subscribe-box site-notice popup modal".split()
ADVERTS = "ad ads advert ad-slot sponsored promo advertisement ad-banner adsbygoogle banner-ad".split()
SIDES = "sidebar widget related related-posts side-bar trending popular-posts rail recommended secondary".split()
COMMENTS = "comments comment-list commentlist comments-area discussion reader-comments responses disqus_thread".split()
MENUS = "menu main-menu nav navbar breadcrumbs topnav tabs pagination site-nav".split()
HEADERS = "site-header masthead topbar header branding page-header".split()
FOOTERS = "site-footer footer page-footer colophon copyright legal bottom".split()
PLAIN = "box a1 row col wrap c-12 block inner x grid container u-mt".split()


class Layout:
    """Draws one page; ``prose`` are long texts and ``short`` short ones, told apart by nothing else."""

    def __init__(self, rng: random.Random, prose: Sequence[str], short: Sequence[str]):
        self.rng, self.prose, self.short = rng, prose, short

    def text(self, long: float = 1.0) -> str:
        pool = self.prose if self.rng.random() < long else self.short
        return escape(self.rng.choice(pool)[: self.rng.choice((200, 400, 2000))])

    def brief(self) -> str:
        return escape(" ".join(self.rng.choice(self.short).split()[: self.rng.randint(1, 6)]))

    def named(self, tag: str, names: Sequence[str], inner: str, vague: float = 0.0) -> str:
        if self.rng.random() < vague:
            names = PLAIN
        where = self.rng.choice(("class", "class", "id"))
        name = self.rng.choice(names) + self.rng.choice(("", "", f" {self.rng.choice(PLAIN)}", f"-{self.rng.randint(1, 9)}"))
        return f'<{tag} {where}="{name}">{inner}</{tag}>'

    def wrapped(self, inner: str) -> str:
        for _ in range(self.rng.choice((0, 0, 0, 1, 1, 2))):
            inner = f"<div>{inner}</div>" if self.rng.random() < 0.5 else self.named("div", PLAIN, inner)
        return inner

    def links(self, low: int, high: int, prose: float = 0.0) -> str:
        found = [f'<a href="/{k}">{self.text() if self.rng.random() < prose else self.brief()}</a>' for k in range(self.rng.randint(low, high))]
        form = self.rng.randrange(3)
        if form == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in found) + "</ul>"
        return " | ".join(found) if form == 1 else "".join(f"<div>{x}</div>" for x in found)

    # Parts that are not main text.

    def menu(self) -> str:
        inner = self.links(3, 9)
        return self.rng.choice((f"<nav>{inner}</nav>", self.named("nav", MENUS, inner), self.named("div", MENUS, inner), self.named("ul", MENUS, inner)))

    def header(self) -> str:
        inner = self.rng.choice((f"<h1>{self.brief()}</h1>", f"<p>{self.brief()}</p>", self.links(1, 3), f"<div>{self.text(0.5)}</div>"))
        inner += self.menu() if self.rng.random() < 0.5 else ""
        return self.named("header", HEADERS, inner, 0.4) if self.rng.random() < 0.6 else self.named("div", HEADERS, inner)

    def footer(self) -> str:
        inner = self.rng.choice((f"&copy; {self.text(0.5)}", f"<p>&copy; {self.brief()}</p>{self.links(2, 6)}", f"<p>{self.text(0.6)}</p>"))
        return self.rng.choice((f"<footer>{inner}</footer>", self.named("footer", FOOTERS, inner, 0.3), self.named("div", FOOTERS, inner)))

    def side(self) -> str:
        inner = f"<h3>{self.brief()}</h3>" if self.rng.random() < 0.6 else ""
        inner += self.rng.choice((self.links(2, 8, 0.3), f"<p>{self.text(0.6)}</p>" * self.rng.randint(1, 3), f"{self.text(0.5)}"))
        return self.rng.choice((f"<aside>{inner}</aside>", self.named("aside", SIDES, inner, 0.4), self.named("div", SIDES, inner), self.named("section", SIDES, inner)))

    def notice(self) -> str:
        inner = self.rng.choice((f"<p>{self.text(0.6)}</p>", self.text(0.6), f"<p>{self.text(0.4)}</p><a href=\"/p\">{self.brief()}</a>"))
        return self.named(self.rng.choice(("div", "section", "aside", "p")), NOTICES, inner)

    def advert(self) -> str:
        inner = self.rng.choice((self.text(0.6), f"<p>{self.text(0.6)}</p>", f'<a href="/ad">{self.text(0.6)}</a>', f"<h4>{self.brief()}</h4><p>{self.text()}</p>"))
        return self.named(self.rng.choice(("div", "div", "aside", "section", "p")), ADVERTS, inner)

    def form(self) -> str:
        inner = f"<label>{self.brief()}</label><input name=q>" + self.rng.choice(("", f"<p>{self.text(0.5)}</p>", f"<div>{self.brief()}</div>"))
        inner += f"<button>{self.brief()}</button>"
        return self.rng.choice((f"<form>{inner}</form>", self.named("form", ("search", "login-form", "signup", "contact-form"), inner, 0.3)))

    def comments(self) -> str:
        many = self.rng.randint(1, 6)
        one = lambda: self.rng.choice((f"<p>{self.text(0.7)}</p>", self.text(0.7), f"<b>{self.brief()}</b><p>{self.text(0.8)}</p><p>{self.text()}</p>"))
        form = self.rng.randrange(4)
        if form == 0:
            inner = "".join(f'<div class="comment">{one()}</div>' for _ in range(many))
        elif form == 1:
            inner = "<ol>" + "".join(f"<li>{one()}</li>" for _ in range(many)) + "</ol>"
        elif form == 2:
            inner = "".join(f'<article class="comment">{one()}</article>' for _ in range(many))
        else:
            inner = "".join(f"<p>{self.text(0.7)}</p>" for _ in range(many))
        inner = (f"<h{self.rng.choice('234')}>{self.brief()}</h3>" if self.rng.random() < 0.5 else "") + inner
        return self.named(self.rng.choice(("div", "section", "section", "ul")), COMMENTS, inner)

    # Main text.

    def block(self) -> str:
        text = lambda long=1.0: MARK + self.text(long)
        form = self.rng.random()
        if form < 0.62:
            inner = text(0.85)
            if self.rng.random() < 0.25:
                inner += f' <a href="/x">{self.brief()}</a> <b>{self.brief()}</b><br>'
            return f"<p>{inner}" + ("</p>" if self.rng.random() < 0.9 else "")
        if form < 0.70:
            return f"<h{self.rng.choice('23')}>{MARK}{self.brief()}</h3>"
        if form < 0.77:
            kind = self.rng.choice(("ul", "ol"))
            return f"<{kind}>" + "".join(f"<li>{text(0.5)}</li>" for _ in range(self.rng.randint(2, 5))) + f"</{kind}>"
        if form < 0.83:
            return f"<blockquote>{self.rng.choice((text(), f'<p>{text()}</p>'))}</blockquote>"
        if form < 0.92:
            return f"<div>{text(0.9)}</div>"
        if form < 0.96:
            return f"<pre>{text(0.7)}</pre>"
        return "<table>" + "".join(f"<tr><td>{MARK}{self.brief()}</td><td>{MARK}{self.brief()}</td></tr>" for _ in range(self.rng.randint(2, 4))) + "</table>"

    def article(self) -> str:
        title = f"<h1>{MARK}{self.brief()} {self.brief()}</h1>"
        title = f"<header>{title}</header>" if self.rng.random() < 0.15 else title
        parts = [self.block() for _ in range(self.rng.choice((1, 1, 2, 3, 4, 6, 9, 14)))]
        for part, chance in ((self.advert, 0.15), (self.side, 0.12), (self.notice, 0.07), (self.menu, 0.05), (self.form, 0.05)):
            if self.rng.random() < chance:
                parts.insert(self.rng.randint(0, len(parts)), part())
        if self.rng.random() < 0.15:
            parts.append(self.named("div", ("share", "social", "share-buttons"), self.links(2, 4)))
        if self.rng.random() < 0.12:
            parts.append(self.comments())
        inner = (title if self.rng.random() < 0.8 else "") + "".join(parts)
        form = self.rng.random()
        if form < 0.35:
            return f"<article>{self.wrapped(inner)}</article>"
        if form < 0.5:
            return f"<main>{self.wrapped(inner)}</main>"
        if form < 0.6:
            return f"<main><article>{inner}</article></main>"
        if form < 0.85:
            return self.named(self.rng.choice(("div", "div", "section", "article", "main")), CONTENT, self.wrapped(inner), 0.15)
        if form < 0.9:
            return f"<table><tr><td>{inner}</td></tr></table>"
        return inner

    def page(self) -> str:
        before = [p() for p, chance in ((self.header, 0.5), (self.menu, 0.7), (self.notice, 0.25), (self.advert, 0.4), (self.form, 0.2), (self.side, 0.15)) if self.rng.random() < chance]
        after = [p() for p, chance in ((self.side, 0.4), (self.comments, 0.4), (self.advert, 0.2), (self.notice, 0.2), (self.form, 0.2), (self.menu, 0.1)) if self.rng.random() < chance]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        after += [self.footer()] if self.rng.random() < 0.8 else []
        body = "".join([*before, self.article(), *after])
        return f"<html><head><title>{self.brief()}</title></head><body>{self.wrapped(body)}</body></html>"


def laid_out(texts: Sequence[str], count: int, seed: int = SEED) -> list[str]:
    """``count`` pages made of ``texts``; without texts, of a stand-in."""
    texts = [t.replace(MARK, "") for t in texts]
    prose = [t for t in texts if len(t) >= PROSE_CHARS] or ["A sentence that stands in for one. " * 4]
    short = [t for t in texts if 0 < len(t) < PROSE_CHARS] or ["Some words"]
    rng = random.Random(seed)
    return [Layout(rng, prose, short).page() for _ in range(count)]
