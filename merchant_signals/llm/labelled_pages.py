"""Labelled pages: web pages laid out around texts of the corpus, with the article's text known.

The given pages carry no labels, so pages are laid out from a bounded sample of ``documents``: one text becomes the article's
blocks, pieces of others fill menus, headers, footers, sidebars, notices, adverts, forms and comments, in the element and class
names that sites use for them.  The layout follows a page's number only, so the same corpus gives the same pages.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import arrow_map

#: Labelled pages that a model is fitted on at most (the bound of the sample).
MAX_PAGES = 3_000
#: Words of a text that a page is laid out with.
MAX_WORDS = 400

#: Names of parts of pages in markup, by what the part is.
PARTS = {
    "article": ["article", "post", "entry", "content", "main", "story", "post-content", "entry-content", "article-body", "main-content", "page-content", "text"],
    "menu": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "main-menu", "site-nav", "topnav", "pagination", "tabs", "toc"],
    "header": ["header", "site-header", "masthead", "topbar", "banner", "branding", "logo", "page-header"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright", "legal", "colophon", "credits"],
    "sidebar": ["sidebar", "aside", "widget", "related", "side", "recommended", "popular", "trending", "secondary", "more-stories", "tags", "author-box"],
    "notice": ["cookie", "cookie-banner", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "disclaimer", "subscribe-notice", "overlay"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "adsense", "ad-slot", "banner-ad", "commercial", "partner"],
    "form": ["form", "search", "login", "newsletter", "subscribe", "contact-form", "signup", "search-form", "comment-form", "feedback"],
    "comments": ["comments", "comment", "comment-list", "responses", "discussion", "replies", "reply", "disqus", "comments-area", "reader-comments"],
    "share": ["share", "social", "sharing", "social-links", "follow", "share-buttons"],
}
#: Elements of their own for a part of a page.
ELEMENTS = {"article": ["article", "main"], "menu": ["nav"], "header": ["header"], "footer": ["footer"], "sidebar": ["aside"], "form": ["form"]}


class _Layout:
    def __init__(self, number: int, fill: list[str]) -> None:
        self.rng, self.fill = random.Random(number), fill

    def some(self, low: int, high: int) -> str:
        """A few words of other texts."""
        n = self.rng.randint(low, high)
        words = self.fill or ["x"]
        start = self.rng.randrange(len(words))
        return html.escape(" ".join((words[start:] + words * (n // len(words) + 1))[:n]), quote=False)

    def part(self, kind: str, inner: str, plain: float = 0.25) -> str:
        """An element for a part of a page: one of its own, maybe named as well, or a named div or section."""
        name = self.rng.choice(PARTS[kind])
        if kind in ELEMENTS and self.rng.random() < 0.55:
            tag, named = self.rng.choice(ELEMENTS[kind]), self.rng.random() > 0.6
        else:
            tag, named = self.rng.choice(["div", "div", "section"]), True
        attribute = f' {self.rng.choice(["class", "class", "id"])}="{name}"' if named else ""
        out = f"<{tag}{attribute}>{inner}</{tag}>"
        return f"<div>{out}</div>" if self.rng.random() < plain else out

    def paragraphs(self, low: int, high: int, words: int) -> str:
        return "".join(f"<p>{self.some(3, words)}</p>" for _ in range(self.rng.randint(low, high)))

    def menu(self) -> str:
        items = [f'<a href="/{i}">{self.some(1, 2)}</a>' for i in range(self.rng.randint(2, 9))]
        if self.rng.random() < 0.75:
            return self.part("menu", "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
        return self.part("menu", " ".join(items))

    def header(self) -> str:
        inner = f'<a href="/">{self.some(1, 3)}</a>' if self.rng.random() < 0.5 else f"<p>{self.some(1, 6)}</p>"
        return self.part("header", inner + (self.menu() if self.rng.random() < 0.5 else ""))

    def footer(self) -> str:
        kinds = [f"&copy; {self.some(1, 3)} &middot; {self.some(3, 12)}", self.paragraphs(1, 2, 14), self.menu()]
        return self.part("footer", self.rng.choice(kinds))

    def sidebar(self) -> str:
        links = "".join(f'<li><a href="/r{i}">{self.some(3, 9)}</a></li>' for i in range(self.rng.randint(2, 6)))
        return self.part("sidebar", f"<h3>{self.some(1, 3)}</h3>" + self.rng.choice([f"<ul>{links}</ul>", self.paragraphs(1, 3, 25)]))

    def notice(self) -> str:
        return self.part("notice", self.rng.choice([f"<p>{self.some(6, 25)}</p>", self.some(6, 25)]))

    def advert(self) -> str:
        return self.part("advert", self.rng.choice([f"<p>{self.some(4, 20)}</p>", self.some(4, 20), f'<a href="/x">{self.some(3, 9)}</a>']))

    def form(self) -> str:
        inner = f"<label>{self.some(1, 3)}</label><input type=text><button>{self.some(1, 2)}</button>"
        inner = inner if self.rng.random() < 0.5 else f"<p>{self.some(3, 12)}</p>{inner}"
        return f"<form>{inner}</form>" if self.rng.random() < 0.5 else self.part("form", f"<form>{inner}</form>")

    def comments(self) -> str:
        one = lambda: self.rng.choice(["<li>{0}</li>", '<div class="comment">{0}</div>', "<article>{0}</article>", "<div>{0}</div>"]).format(
            f"<p>{self.some(1, 3)}</p><p>{self.some(4, 40)}</p>")
        return self.part("comments", f"<h3>{self.some(1, 3)}</h3>" + "".join(one() for _ in range(self.rng.randint(1, 6))))

    def share(self) -> str:
        return self.part("share", "".join(f'<a href="/s{i}">{self.some(1, 1)}</a> ' for i in range(self.rng.randint(2, 4))))

    def article(self, blocks: list[str]) -> tuple[str, list[str]]:
        """The article's markup and its blocks, in order; sometimes with foreign parts between and after them."""
        out, said = [], []
        for i, b in enumerate(blocks):
            marked = html.escape(b, quote=False)
            kind = self.rng.random()
            if i == 0:
                out.append(f"<h1>{marked}</h1>")
            elif kind < 0.08:
                out.append(f"<h2>{marked}</h2>")
            elif kind < 0.14:
                out.append(f"<blockquote><p>{marked}</p></blockquote>")
            elif kind < 0.2:
                out.append(f"<ul><li>{marked}</li></ul>")
            elif kind < 0.26:
                out.append(f"<p><b>{marked}<br><p>")
            elif kind < 0.32:
                words = marked.split(" ")
                cut = self.rng.randrange(len(words))
                out.append("<p>" + " ".join(words[:cut]) + f' <a href="/l">{words[cut]}</a> ' + " ".join(words[cut + 1:]) + "</p>")
            elif kind < 0.35:
                out.append(f"<div>{marked}</div>")
            elif kind < 0.38:
                out.append(f"<table><tr><td>{marked}</td></tr></table>")
            else:
                out.append(f"<p>{marked}</p>")
            said.append(b)
            if self.rng.random() < 0.07:
                out.append(self.rng.choice([self.advert, self.share, self.sidebar, self.notice, self.form])())
        inner = "".join(out)
        if self.rng.random() < 0.2:
            inner = f'<div class="{self.rng.choice(["body", "text", "post-body", "content"])}">{inner}</div>'
        if self.rng.random() < 0.2:
            inner += self.rng.choice([self.comments, self.share, self.sidebar])()
        return self.part("article", inner), said

    def page(self, title: str, blocks: list[str]) -> tuple[str, list[str]]:
        article, said = self.article(blocks)
        chance = lambda p, f: f() if self.rng.random() < p else ""
        before = chance(0.4, self.notice) + chance(0.5, self.header) + chance(0.7, self.menu) + chance(0.4, self.advert) + chance(0.2, self.form) + chance(0.2, self.sidebar)
        after = chance(0.15, self.share) + chance(0.35, self.comments) + chance(0.4, self.sidebar) + chance(0.3, self.advert) + chance(0.25, self.form) + chance(0.75, self.footer)
        if self.rng.random() < 0.3:
            article = f"<div>{article}</div>"
        end = "" if self.rng.random() < 0.15 else "</body></html>"
        return (f"<!DOCTYPE html><html><head><title>{html.escape(title)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head><body>"
                f"<!-- {self.rng.random()} -->{before}{article}{after}{end}"), said


def lay_out(number: int, text: str, other: str) -> tuple[str, list[str]]:
    """A page's markup and the blocks of its article, for a text and another one that fills the rest."""
    words = text.split()[:MAX_WORDS]
    rng = random.Random(number + 1)
    blocks, at = [], 0
    while at < len(words):
        n = rng.randint(2, 9) if not blocks else rng.choice([1, 3, 15, 30, 60, 90])
        blocks.append(" ".join(words[at:at + n]))
        at += n
    return _Layout(number, other.split()[:2000]).page(" ".join(words[:8]), blocks or ["x"])


def labelled_pages(docs: DataFrame, max_pages: int = MAX_PAGES, text_col: str = "text") -> DataFrame:
    """docs -> html, blocks (the article's, in order) of about ``max_pages`` pages (never over twice as many): those of the distinct
    texts whose digests are the smallest of all, told by a bound that the number of distinct texts gives."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.length(F.trim("text")) > 0)
    keyed = texts.withColumn("key", F.xxhash64("text"))
    n = keyed.agg(F.approx_count_distinct("key").alias("n")).first()["n"]
    bound = (1 << 63) - 1 if n <= max_pages else int((max_pages / n) * (1 << 64)) - (1 << 63)
    taken = (keyed.where(F.col("key") <= F.lit(bound)).groupBy("key").agg(F.min(F.substring("text", 1, 12 * MAX_WORDS)).alias("text"))
             .limit(2 * max_pages))

    def run(batches: pa.RecordBatch) -> pa.RecordBatch:
        own = batches.column("text").to_pylist()
        keys = batches.column("key").to_pylist()
        made = [lay_out(k, t, own[i - 1]) for i, (k, t) in enumerate(zip(keys, own))]
        return pa.RecordBatch.from_arrays([pa.array([m for m, _ in made], pa.string()), pa.array([b for _, b in made], pa.list_(pa.string()))],
                                          names=["html", "blocks"])

    return arrow_map(taken, run, "html string, blocks array<string>")


def blocks_said(blocks: list[str]) -> Iterator[str]:
    """Blocks as extraction gives them: one space for each run of white space."""
    for b in blocks:
        if b := " ".join(b.split()):
            yield b
