"""A seeded table of labelled pages to train the extraction of main text from.

Pages differ in which parts they have, in their order, markup and names. Every part
carries its label: ``keep`` for main text, ``drop`` for the rest and ``mixed`` for
elements that only hold both. Elements without a label have that of their parent.
"""

from __future__ import annotations

import numpy as np

# How pages name their parts.
NAMES = {
    "menu": "nav menu navigation navbar topnav mainmenu breadcrumbs breadcrumb links toc tabs pager pagination",
    "head": "header masthead top banner branding site-header page-header logo topbar",
    "foot": "footer site-footer bottom copyright colophon page-footer foot legal footnote-bar",
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion ad-slot adsbygoogle banner-ad dfp commercial adbox",
    "side": "sidebar side aside widget widgets rail col-right related recommended trending popular more-stories",
    "note": "cookie cookie-banner consent notice alert gdpr privacy-notice message popup modal overlay warning toast",
    "form": "form search searchform newsletter subscribe signup login contact-form",
    "talk": "comments comment comment-list responses discussion replies disqus reader-comments feedback reply",
    "share": "share sharing social social-links share-buttons tools tags meta byline author-box",
    "main": "content main post article entry entry-content article-body story post-content page-content text body-text article-text maincontent",
    "wrap": "wrapper container page row layout outer inner site wrap section grid",
}
NAMES = {kind: names.split() for kind, names in NAMES.items()}
_SYLLABLES = "the er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve lich ung sch ei und der ción para los que les eau é ñ ü".split()


class LayoutWriter:
    """Writes one page after the other from one seed."""

    def __init__(self, seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        sizes = self.rng.integers(1, 5, 4000)
        syllables = np.array(_SYLLABLES)[self.rng.integers(0, len(_SYLLABLES), int(sizes.sum()))]
        self.vocabulary = ["".join(x) for x in np.split(syllables, np.cumsum(sizes)[:-1])]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, values):
        return values[int(self.rng.integers(len(values)))]

    def words(self, n: int) -> str:
        return " ".join([self.vocabulary[i] for i in self.rng.integers(0, len(self.vocabulary), n).tolist()])

    def sentences(self, n: int) -> str:
        made = []
        for _ in range(n):
            text = self.words(int(self.rng.integers(1, 18))).capitalize()
            made.append(text.replace(" ", ", ", 1) + "." if self.chance(0.2) else text + ".")
        return " ".join(made)

    def attributes(self, kind: str, p: float = 0.85) -> str:
        names = [self.pick(NAMES[kind])] if self.chance(p) else []
        if self.chance(0.15):
            names.append(self.pick(["x1", "clearfix", "col-12", "block", "box", "js-item", "left"]))
        if not names:
            return ""
        return f' {self.pick(["class", "class", "id"])}="{" ".join(names)}"'

    def part(self, kind: str, body: str, tags: str, label: str = "drop", named: float = 0.85) -> str:
        tag = self.pick(tags.split())
        plain = {"nav", "aside", "footer", "header", "article", "main", "form"}
        return f'<{tag}{self.attributes(kind, 0.35 if tag in plain else named)} data-label="{label}">{body}</{tag}>'

    def links(self, n: int) -> str:
        items = [f'<a href="/{i}">{self.words(int(self.rng.integers(1, 4)))}</a>' for i in range(n)]
        form = self.rng.integers(3)
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if form == 0 else " | ".join(items) if form == 1 else "".join(f"<div>{i}</div>" for i in items)

    def menu(self) -> str:
        return self.part("menu", self.links(int(self.rng.integers(2, 12))), "nav nav div ul", named=1)

    def ad(self) -> str:
        body = self.pick([self.sentences(int(self.rng.integers(1, 4))), f'<a href="/buy">{self.words(4)}</a>', f"<p>{self.sentences(1)}</p>", f'<img src="a.png"><p><a href="#">{self.words(3)}</a></p>'])
        return self.part("ad", body, "div div section aside ins", named=1)

    def form(self) -> str:
        return self.part("form", f'<label>{self.words(2)}</label><input name="q"><p>{self.sentences(1)}</p><button>{self.words(1)}</button>', "form form div")

    def side(self) -> str:
        body = "".join(f"<h3>{self.words(2)}</h3>" + self.pick([self.links(5), f"<p>{self.sentences(2)}</p>"]) for _ in range(int(self.rng.integers(1, 4))))
        return self.part("side", body, "aside aside div section", named=1)

    def head(self) -> str:
        body = self.pick([f"<h1>{self.words(2)}</h1>", f'<a href="/">{self.words(1)}</a>', f"<p>{self.sentences(1)}</p>", ""]) + (self.menu() if self.chance(0.6) else "") + (self.form() if self.chance(0.2) else "")
        return self.part("head", body, "header header div", named=1)

    def note(self) -> str:
        body = self.pick([self.sentences(2), f"<p>{self.sentences(2)}</p>"]) + self.pick(["", f"<button>{self.words(1)}</button>", f'<a href="/policy">{self.words(2)}</a>'])
        return self.part("note", body, "div div section aside", named=1)

    def foot(self) -> str:
        body = self.pick(["&copy; ", "&copy; 2024 ", "Copyright ", ""]) + self.words(1) + self.pick([".example.com &middot; ", ". ", " | "]) + self.sentences(int(self.rng.integers(1, 4)))
        body = self.pick([body, f"<p>{body}</p>", body + self.links(4), f"<div>{body}</div>"])
        return self.part("foot", body, "footer footer footer div", named=1)

    def talk(self) -> str:
        said = "".join(
            f'<{tag}{self.attributes("talk", 0.6)}><p>{self.sentences(int(self.rng.integers(1, 6)))}</p></{tag}>'
            for tag in [self.pick(["div", "li", "article"])] for _ in range(int(self.rng.integers(1, 7)))
        )
        return self.part("talk", f"<h3>{self.words(2)}</h3>{said}" + (self.form() if self.chance(0.4) else ""), "section div ol", named=1)

    def share(self) -> str:
        return self.part("share", self.links(int(self.rng.integers(2, 5))), "div ul p", named=1)

    def paragraph(self) -> str:
        text = self.sentences(int(self.rng.choice([1, 1, 2, 4, 8, 15])))
        if self.chance(0.25):
            cut = len(text) // 2
            tag = self.pick(["b", "em", "strong", "i", 'a href="/x"', "span"])
            text = f"{text[:cut]}<{tag}>{text[cut : cut + 12]}</{tag.split()[0]}>{text[cut + 12 :]}"
        return self.pick([f"<p>{text}</p>"] * 6 + [f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text.replace('. ', '.<br>', 1)}</p>", f"<div>{text}</div>", f'<p class="{self.pick(["lead", "intro", "t1", "para"])}">{text}</p>'])

    def passage(self) -> str:
        kind = self.rng.random()
        items = "".join(f"<li>{self.sentences(1)}</li>" for _ in range(int(self.rng.integers(2, 7))))
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.8:
            return f"<h{self.pick([2, 3])}>{self.words(4)}</h{2}>"
        if kind < 0.86:
            return self.pick([f"<ul>{items}</ul>", f"<ol>{items}</ol>"])
        if kind < 0.9:
            return f"<blockquote><p>{self.sentences(2)}</p></blockquote>"
        if kind < 0.93:
            return f'<figure><img src="f.png"><figcaption>{self.sentences(1)}</figcaption></figure>'
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{self.words(2)}</td><td>{self.words(1)}</td></tr>" for _ in range(4)) + "</table>"
        return f"<pre>{self.words(12)}</pre>"

    def article(self) -> str:
        parts = [f"<h1>{self.words(int(self.rng.integers(1, 9)))}</h1>"] if self.chance(0.8) else []
        parts += [self.passage() for _ in range(int(self.rng.choice([1, 1, 2, 4, 7, 12, 30])))]
        for make, p in ((self.ad, 0.2), (self.share, 0.2), (self.form, 0.05), (self.side, 0.05), (self.note, 0.05)):
            if self.chance(p):
                parts.insert(int(self.rng.integers(1, len(parts) + 1)), make())
        if self.chance(0.12):
            parts.append(self.talk())
        body = "".join(parts)
        if self.chance(0.2):
            body = f"<div{self.attributes('main', 0.7)}>{body}</div>"
        return self.part("main", body, "article article article main div div section", "keep", 0.75)

    def page(self) -> str:
        head = f"<!DOCTYPE html><html><head><title>{self.words(5)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
        if self.chance(0.06):
            # a page that is nothing but its text
            body = self.pick([self.sentences(6), "".join(self.paragraph() for _ in range(5))])
            return self.pick([f'{head}<body data-label="keep">{body}</body></html>', f'<div data-label="keep">{body}</div>'])
        before = [make() for make, p in ((self.note, 0.2), (self.head, 0.45), (self.menu, 0.6), (self.ad, 0.5), (self.form, 0.1), (self.side, 0.1)) if self.chance(p)]
        after = [make() for make, p in ((self.talk, 0.3), (self.side, 0.35), (self.ad, 0.2), (self.share, 0.1), (self.form, 0.1), (self.menu, 0.15), (self.note, 0.1)) if self.chance(p)]
        if self.chance(0.5):
            self.rng.shuffle(before)
        main = self.article()
        for _ in range(int(self.rng.integers(0, 3)) if self.chance(0.5) else 0):
            main = f'<{self.pick(["div", "section", "main"])}{self.attributes("wrap", 0.7)} data-label="mixed">{main}' + self.pick(["", self.side(), self.talk()]) + "</div>"
        foot = self.foot() if self.chance(0.85) else ""
        text = "<!-- x -->".join(before) + main + "".join(after) + foot
        if self.chance(0.3):
            text = f'<div{self.attributes("wrap", 0.8)} data-label="mixed">{text}</div>'
        return f'{head}<body data-label="mixed">{text}' + self.pick(["</body></html>", ""])


def labelled_pages(count: int, seed: int) -> list[str]:
    writer = LayoutWriter(seed)
    return [writer.page() for _ in range(count)]
