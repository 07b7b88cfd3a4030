"""Labelled pages to train the extraction model: layouts whose parts carry their label.

``data-y`` is M for parts that hold article and other parts, C for content, O for other; a part without
one has its parent's. Texts are invented; their lengths overlap on purpose (short paragraphs in
articles, long texts in comments, notices and adverts), so that structure has to decide.
"""

from __future__ import annotations

import random

# Names in use on the web for parts of pages.
CONTENT_NAMES = ("content article post entry story main-content article-body post-content entry-content body-text "
                 "page-content single text article-text story-body main").split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation topnav main-menu site-nav breadcrumb breadcrumbs tabs pagination toc".split(),
    "header": "header masthead site-header top banner topbar branding logo page-header".split(),
    "footer": "footer site-footer bottom copyright legal colophon imprint foot".split(),
    "sidebar": "sidebar aside widget rail side-column related recommended popular more-stories trending".split(),
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal newsletter subscribe paywall disclaimer".split(),
    "advert": "ad ads advert advertisement sponsored promo adsense ad-slot banner-ad commercial sponsor".split(),
    "share": "share social share-buttons social-links follow tools toolbar meta byline-links tags".split(),
    "form": "form search login signup contact-form search-box poll".split(),
    "comments": "comments comment-list comment reader-comments discussion replies responses disqus reply".split(),
}
PLAIN = "wrapper container row col inner outer layout page site grid box block".split()


class _Writer:
    def __init__(self, rng: random.Random):
        self.r = rng

    def word(self) -> str:
        r = self.r
        return "".join(r.choice("bcdfghlmnprstvw") + r.choice(["a", "e", "i", "o", "u", "ie", "ou", "é", "ö"])
                       for _ in range(r.choice([1, 1, 2, 2, 3]))) + r.choice(["", "", "n", "s", "r"])

    def sentence(self) -> str:
        n = max(1, int(self.r.lognormvariate(1.9, 0.8)))
        words = [self.word() + ("," if self.r.random() < 0.08 else "") for _ in range(n)]
        return " ".join(words).capitalize().rstrip(",") + self.r.choice([".", ".", ".", ".", "?", "!"])

    def odd(self) -> str:
        """Text that is no prose: repeated words, lists with bars, shouting, words with signs."""
        r = self.r
        words = [self.word() + r.choice(["", "", ",", "."]) for _ in range(int(min(600, 1 + r.paretovariate(0.7) * 5)))]
        kind = r.randrange(5)
        if kind == 0:
            return " ".join(w for w in words[:12] for _ in range(r.randint(3, 30)))
        if kind == 1:
            return " | ".join(words)
        if kind == 2:
            return "!! ".join(words).upper()
        if kind == 3:
            return " ".join(w + r.choice(["$$$", "%%%", "***", "&amp;&amp;&amp;"]) for w in words)
        return ", ".join(words)

    def text(self, mean: float) -> str:
        if self.r.random() < 0.06:
            return self.odd()
        return " ".join(self.sentence() for _ in range(max(1, int(self.r.expovariate(1 / mean) + 0.5))))

    def phrase(self) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(1, 9))).capitalize()

    def attr(self, name: str) -> str:
        kind = self.r.random()
        extra = " " + self.r.choice(PLAIN) if self.r.random() < 0.2 else ""
        return f' class="{name}{extra}"' if kind < 0.7 else f' id="{name}"'

    def links(self, n: int, listed: bool = True) -> str:
        items = [f'<a href="/{self.word()}">{self.phrase() if self.r.random() < .5 else self.word()}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if listed else " | ".join(items)

    # -- parts that are not content

    def other(self, kind: str, named: bool = True) -> str:
        r = self.r
        tags = {"menu": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"],
                "footer": ["footer", "footer", "div"], "sidebar": ["aside", "aside", "div", "section"],
                "notice": ["div", "div", "section", "p"], "advert": ["div", "div", "aside", "section", "p"],
                "share": ["div", "ul", "p"], "form": ["form", "form", "div"], "comments": ["section", "div", "div", "ol"]}
        tag = r.choice(tags[kind])
        plain = tag in ("nav", "header", "footer", "aside", "form") and r.random() < 0.6
        name = "" if plain or not named else self.attr(r.choice(OTHER_NAMES[kind]))
        if not name and kind in ("notice", "advert", "comments", "share", "sidebar") and tag in ("div", "p", "section", "ol", "ul"):
            name = self.attr(r.choice(OTHER_NAMES[kind]))
        if kind == "menu":
            body = self.links(r.randint(2, 10), tag != "ul" and r.random() < 0.8)
            if tag == "ul":
                body = "".join(f'<li><a href="#">{self.word()}</a></li>' for _ in range(r.randint(2, 8)))
        elif kind == "header":
            body = r.choice([f"<h1>{self.phrase()}</h1>", f"<p>{self.phrase()}</p>", self.phrase(),
                             f"<h1>{self.phrase()}</h1><p>{self.text(1)}</p>" + self.links(3)])
        elif kind == "footer":
            body = r.choice([f"&copy; {self.word()}.example &middot; {self.text(2)}", f"<p>&copy; {self.phrase()}</p>",
                             self.links(4) + f"<p>{self.text(1)}</p>", self.text(3)])
        elif kind == "sidebar":
            body = f"<h3>{self.phrase()}</h3>" + r.choice([self.links(r.randint(2, 6)), f"<p>{self.text(3)}</p>",
                                                           f"<p>{self.text(2)}</p>" * 2 + self.links(2)])
        elif kind in ("notice", "advert"):
            body = self.text(r.choice([1, 2, 4]))
            if tag != "p" and r.random() < 0.6:
                body = f"<p>{body}</p>" + (f"<p>{self.text(2)}</p>" if r.random() < 0.3 else "")
            if r.random() < 0.4:
                body += f'<a href="#">{self.word()}</a>' if tag == "p" else f"<button>{self.word()}</button>"
        elif kind == "share":
            body = self.links(r.randint(2, 5), False) if tag == "p" else "".join(
                f'<{"li" if tag == "ul" else "span"}><a href="#">{self.word()}</a></{"li" if tag == "ul" else "span"}>'
                for _ in range(r.randint(2, 5)))
        elif kind == "form":
            body = f'<label>{self.phrase()}</label><input type="text"><button>{self.word()}</button>'
            if r.random() < 0.4:
                body += f"<p>{self.text(2)}</p><select><option>{self.word()}</option><option>{self.word()}</option></select>"
        else:
            inner = r.choice(["div", "li", "p", "div", "li", "p", "div", "article"]) if tag != "ol" else "li"
            one = lambda: (f"<p>{self.phrase()}</p>" if r.random() < .5 else "") + f"<p>{self.text(r.choice([1, 3, 6]))}</p>"
            cls = self.attr(r.choice(OTHER_NAMES["comments"])) if r.random() < 0.6 else ""
            body = (f"<h3>{self.phrase()}</h3>" if r.random() < 0.6 and tag != "ol" else "") + "".join(
                f"<{inner}{cls}>{self.text(3) if inner == 'p' else one()}</{inner}>" for _ in range(r.randint(1, 5)))
        return f'<{tag}{name} data-y="O">{body}</{tag}>'

    # -- content

    def paragraph(self) -> str:
        r = self.r
        text = self.text(r.choice([0.5, 2, 4, 8, 8, 20]))
        if r.random() < 0.15:
            text += f' <a href="#">{self.phrase()}</a> {self.text(1)}'
        if r.random() < 0.15:
            text = f"<b>{text}<br>" if r.random() < 0.5 else f"<b>{text}</b>"
            return f"<p>{text}"
        return f"<p>{text}" + ("</p>" if r.random() < 0.93 else "")

    def blocks(self) -> str:
        r = self.r
        out = [f"<h1>{self.phrase()}</h1>"] if r.random() < 0.75 else []
        if r.random() < 0.12:                   # verse, lists of short lines, lines that repeat
            lines = [self.sentence() for _ in range(r.randint(1, 6))]
            return "".join(out) + "".join(f"<p>{r.choice(lines)}</p>" for _ in range(r.randint(4, 60)))
        for _ in range(1 + int(r.expovariate(1 / 6))):
            x = r.random()
            if x < 0.8:
                out.append(self.paragraph())
            elif x < 0.86:
                out.append(f"<h2>{self.phrase()}</h2>")
            elif x < 0.9:
                out.append("<ul>" + "".join(f"<li>{self.text(1)}</li>" for _ in range(r.randint(2, 4))) + "</ul>")
            elif x < 0.93:
                out.append(f"<blockquote><p>{self.text(2)}</p></blockquote>")
            elif x < 0.95:
                out.append(f"<table><tr><td>{self.word()}</td><td>{self.phrase()}</td></tr></table>")
            elif x < 0.96:
                out.append(f"<pre>{self.text(2)}</pre>")
            else:
                out.append(self.other(r.choice(["advert", "share", "notice", "form", "sidebar"])))
        return "".join(out)

    def article(self) -> str:
        r = self.r
        x = r.random()
        if x < 0.5:
            name = self.attr(r.choice(CONTENT_NAMES)) if r.random() < 0.3 else ""
            tag, inner = r.choice(["article", "article", "main"]), self.blocks()
            if r.random() < 0.15:
                inner = f'<div{self.attr(r.choice(CONTENT_NAMES))}>{inner}</div>'
            return f'<{tag}{name} data-y="C">{inner}</{tag}>'
        if x < 0.85:
            return f'<{r.choice(["div", "section"])}{self.attr(r.choice(CONTENT_NAMES))} data-y="C">{self.blocks()}</div>'
        name = self.attr(r.choice(PLAIN)) if r.random() < 0.5 else ""
        return f'<div{name} data-y="C">{self.blocks()}{self.paragraph()}</p><p>{self.text(6)}</p></div>'

    def page(self) -> str:
        r = self.r
        some = lambda kinds, most: [self.other(r.choice(kinds), r.random() < 0.9) for _ in range(r.randint(0, most))]
        parts = []
        if r.random() < 0.8:
            parts.append(self.other("menu"))
        parts += some(["header", "notice", "advert", "form", "menu", "share"], 2)
        r.shuffle(parts)
        middle = [self.article()]
        middle += some(["sidebar", "comments", "advert", "share", "form", "notice"], 2)
        if r.random() < 0.25:
            middle.insert(0, self.other(r.choice(["sidebar", "menu", "advert"])))
        body = "".join(middle)
        if r.random() < 0.4:
            tag, name = r.choice([("div", self.attr(r.choice(PLAIN))), ("main", ""), ("div", "")])
            body = f'<{tag}{name} data-y="M">{body}</{tag}>'
        tail = some(["comments", "sidebar", "notice", "advert", "menu"], 2)
        if r.random() < 0.8:
            tail.append(self.other("footer"))
        text = "".join(parts) + body + "".join(tail)
        if r.random() < 0.03:
            text = "".join(parts) + "".join(tail)
        if r.random() < 0.25:
            text = f'<div{self.attr(r.choice(PLAIN))} data-y="M">{text}</div>'
        page = f'<!DOCTYPE html><html data-y="M"><head><title>{self.phrase()}</title></head><body data-y="M">{text}'
        return page + ("</body></html>" if r.random() < 0.9 else "")


def training_pages(n: int = 1200, seed: int = 11) -> list[str]:
    """``n`` labelled pages; the same ones for the same seed."""
    writer = _Writer(random.Random(seed))
    return [writer.page() for _ in range(n)]
