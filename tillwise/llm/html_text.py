"""Main text of web pages: boosted trees over the nodes of the document tree.

A page becomes a tree of its block elements. Trees of a gradient boosting rate each node by the
density of its subtree, the tokens of its attributes and of those around it, its depth and its
siblings. The most likely consistent choice of whole subtrees is kept (``dom.decide``), so an
element is never kept inside one that is dropped, or dropped inside one that is kept.

The trees are trained on at most ``TRAIN_PAGES`` pages, those whose ids hash lowest, of at most
``TRAIN_CHARS`` characters. Their marked-up articles and surroundings give labels, and the blocks
of both are laid out anew in ``LAYOUTS`` random pages with other elements, class names, comments,
forms, notices and adverts, headings in headers, links and lists of links in the text, and footers in bare
elements and tables, so that the model does not rest on one layout. Every page is
extracted from its whole text.

Results: null and empty pages give an empty text; malformed markup is read as far as it goes;
repeated rows each come out; null ids and urls are kept; an empty table gives no rows; further
columns of the input are ignored.
"""

import random
import re
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import boosting
from tillwise.llm.dom import ABOUT_REST, Page, decide, features, text_of
from tillwise.llm.tables import table

TRAIN_PAGES, TRAIN_CHARS, LAYOUTS = 150, 200_000, 500
_SEED = 1

# ---- labelled nodes -------------------------------------------------------------------


def known_nodes(page: Page) -> list[float | None]:
    """1 for main text, 0 for what is around it, None where unknown, from the elements
    and attributes that say so. Marks are read from made pages only (``_inherited``)."""
    known: list[float | None] = []
    for i, (tag, parent) in enumerate(zip(page.tags, page.parents, strict=True)):
        above = known[parent] if i else None
        if above == 0.0 or tag in ("nav", "aside", "footer", "form") or any(
                t in ABOUT_REST for t in page.tokens[i]):
            known.append(0.0)
        else:
            known.append(1.0 if above == 1.0 or tag in ("article", "main") else None)
    return known


def blocks_of(page: Page, known: list[float | None], kind: float) -> list[str]:
    return [b for b in text_of(page, np.array([k == kind for k in known])).split("\n") if b]


class Layouts:
    """Random pages from given blocks of main text and of other text."""

    def __init__(self, main: list[list[str]], rest: list[str]):
        self.random = random.Random(_SEED)
        self.main, self.rest = main, rest

    def _words(self, low: int, high: int) -> str:
        words = self.random.choice(self.rest).split() or ["more"]
        n = self.random.randint(low, high)
        return " ".join((words * (n // len(words) + 1))[:n])

    def _element(self, tags: str, names: str, inner: str, mark: int | None = None) -> str:
        r = self.random
        tag = r.choice(tags.split())
        name = r.choice(names.split()) if names else ""
        if name and tag in ("nav", "aside", "header", "footer", "form", "article", "main"):
            name = r.choice(["", name])
        if name and r.random() < 0.3:
            name += r.choice(["-wrapper", " clearfix", "-inner", " block", "_1", "-box"])
        kind = r.choice(["class", "class", "class", "id"])
        attribute = f' {kind}="{name}"' if name else ""
        marked = "" if mark is None else f' data-main="{mark}"'
        return f"<{tag}{attribute}{marked}>{inner}</{tag}>"

    def _links(self, n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{self._words(1, 4)}</a></li>'
                                for _ in range(n)) + "</ul>"

    def _prose(self, low: int, high: int) -> str:
        """Paragraphs of ordinary text, as in main text."""
        blocks = self.random.choice(self.main)
        return "".join(f"<p>{self.random.choice(blocks)}</p>"
                       for _ in range(self.random.randint(low, high)))

    def _around(self, kind: str) -> str:
        made = self._plain_around(kind)
        if kind != "foot" and self.random.random() < 0.04:
            hide = self.random.choice([" hidden", ' style="display: none"'])
            made = re.sub(r"^<\w+", lambda m: m[0] + hide, made)
        return made

    def _plain_around(self, kind: str) -> str:
        r, e = self.random, self._element
        if kind == "head":
            return e("header div", "header masthead site-header topbar banner top", e(
                "h1 div h2 p", "logo title brand site-title", self._words(1, 5)) + r.choice(
                    ["", f"<p>{self._words(3, 10)}</p>"]), 0)
        if kind == "menu":
            return e("nav nav div ul", "menu navbar nav main-menu navigation breadcrumb topnav",
                     self._links(r.randint(3, 9)), 0)
        if kind == "notice":
            return e("div section aside p", "notice cookie cookies consent alert banner gdpr "
                     "cookie-notice privacy-notice popup modal", r.choice(
                         [f"<p>{self._words(5, 30)}</p>", self._words(5, 30)])
                     + r.choice(["", "<button>OK</button>"]), 0)
        if kind == "advert":
            return e("div aside section p", "ad ads advert advertisement sponsored promo promoted "
                     "banner-ad ad-slot sponsor", r.choice(
                         [self._words(3, 25), f"<p>{self._words(3, 25)}</p>", self._prose(1, 1)]), 0)
        if kind == "side":
            return e("aside aside div section", "sidebar widget widget-area side rail related "
                     "recommended secondary", f"<h3>{self._words(1, 4)}</h3>" + r.choice(
                         [self._links(r.randint(3, 8)), f"<p>{self._words(10, 40)}</p>",
                          self._prose(1, 2)]), 0)
        if kind == "form":
            return e("form form div", "newsletter subscribe search signup login contact",
                     f"<label>{self._words(1, 4)}</label><input name=q><p>{self._words(2, 15)}</p>"
                     "<button>Go</button>", 0)
        if kind == "share":
            return e("div ul p", "share social sharing meta byline tags post-meta author",
                     self._words(2, 8), 0)
        if kind == "comments":
            each = "".join(e("div li article", "comment reply response", e(
                "span div p", "author meta", self._words(1, 3)) + self._prose(1, 2))
                for _ in range(r.randint(1, 6)))
            return e("section div div ol", "comments comment-list replies discussion responses "
                     "disqus feedback reader-comments", f"<h3>{self._words(1, 3)}</h3>" + each, 0)
        line = r.choice(["&copy; {}", "&copy; 2020 {}", "Copyright {}", "Copyright &copy; {} All rights reserved.",
                         "{} All rights reserved."]).format(self._words(2, 12))
        if r.random() < 0.35:  # no name and no footer element says what it is
            return e("div p center section div", "", line, 0) if r.random() < 0.6 else (
                f'<table data-main="0"><tr><td>{line}</td></tr></table>')
        return e("footer footer div", "footer site-footer bottom copyright colophon",
                 f"<p>{line}</p>" + r.choice(["", self._links(r.randint(2, 6))]), 0)

    def _linked(self, block: str) -> str:
        """A block of text with some of its words in links."""
        words = block.split(" ")
        for _ in range(self.random.randint(1, 3)):
            low = self.random.randrange(len(words))
            high = min(len(words), low + self.random.randint(1, 8))
            if "<" not in "".join(words[low:high]):
                words[low:high] = ['<a href="/y">' + " ".join(words[low:high]) + "</a>"]
        return " ".join(words)

    def page(self) -> str:
        r, e = self.random, self._element
        body = []
        bare = r.random() < 0.15  # main text that no element of its own holds
        mark = ' data-main="1"' if bare else ""
        blocks = r.choice(self.main)[:r.randint(1, 30)]
        if r.random() < 0.06:  # a long page
            blocks = blocks * (r.randint(50, 500) // len(blocks) + 1)
        linked, headed = r.random() < 0.5, r.random() < 0.2
        for k, block in enumerate(blocks):
            tag = "h1" if k == 0 and r.random() < 0.7 else r.choices(
                ["p", "h2", "blockquote", "ul", "pre", "div", "table"], [30, 2, 2, 2, 1, 3, 1])[0]
            if tag == "ul" and r.random() < 0.4:  # links that belong to the text
                block = "".join(f'<li><a href="/z">{b}</a></li>' for b in block.split(". ")[:r.randint(2, 6)])
            elif tag == "ul":
                block = "".join(f"<li>{b}</li>" for b in block.split(". "))
            elif tag in ("p", "div", "blockquote") and linked and r.random() < 0.4:
                block = self._linked(block)
            elif k == 0 and headed:
                parts = r.choice(["", "", self._plain_around("share")])
                body.append(f"<header{mark or ' data-main="1"'}><h1>{block}</h1>{parts}</header>")
                continue
            if tag == "table":
                block = "".join(f"<tr><td>{b}</td></tr>" for b in block.split(". "))
            body.append(f"<{tag}{mark}>{block}</{tag}>")
            if r.random() < 0.06:
                body.append(self._around(r.choice(["advert", "share", "notice", "form"])))
        main = "".join(body)
        for _ in range(r.choice([0, 0, 1])):
            main = f"<div>{main}</div>"
        main = main if bare else e("article article main div div section", "content post entry article article-body "
                 "story text post-content entry-content main page-content", main, 1)
        if r.random() < 0.4:
            main += self._around("comments")
        if r.random() < 0.2:
            main += self._around("share")
        if r.random() < 0.4:
            main = e("div main section", "wrapper container page layout main row columns",
                     r.choice([self._around("side"), ""]) + main + r.choice(
                         [self._around("side"), self._around("advert"), ""]))
        before = [self._around(k) for k in ("head", "menu", "notice", "advert", "form", "side")
                  if r.random() < 0.45]
        after = [self._around(k) for k in ("side", "comments", "form", "advert", "share", "notice",
                                           "menu", "foot") if r.random() < 0.35]
        r.shuffle(before)
        return ("<html><head><title>x</title></head><body>" + "".join(before) + main
                + "".join(after) + "</body></html>")


def train(pages: list[str]) -> boosting.Trees:
    """Trees from sample pages and new layouts of their blocks."""
    rows, truth, weight = [], [], []
    main, rest = [], []

    def learn(page: Page, known: list[float | None]) -> None:
        found = features(page)
        of = [i for i, k in enumerate(known) if k is not None]
        rows.append(found[of])
        truth.append(np.array([known[i] for i in of]))
        weight.append(np.full(len(of), 1 / max(len(of), 1) ** 0.5))

    for html in pages:
        page = Page(html)
        known = known_nodes(page)
        learn(page, known)
        main.append([escape(b) for b in blocks_of(page, known, 1.0)])
        rest += [escape(b) for b in blocks_of(page, known, 0.0)]
    main = [m for m in main if m] or [["Words of a text follow one another, and make lines. " * 5] * 5]
    made = Layouts(main, rest or ["home news about contact more"])
    for _ in range(LAYOUTS):
        page = Page(made.page())
        learn(page, _inherited(page))
    w = np.concatenate(weight)
    return boosting.fit(np.concatenate(rows), np.concatenate(truth), w / w.mean())


def _inherited(page: Page) -> list[float | None]:
    known: list[float | None] = []
    for i, parent in enumerate(page.parents):
        mark = page.marks[i]
        known.append(float(mark) if mark is not None else known[parent] if i else None)
    return known

# ---- extraction -----------------------------------------------------------------------


def extract(html: list[str], trees: boosting.Trees, nodes_at_once: int = 20_000) -> list[str]:
    out: list[str] = []
    waiting: list[tuple[Page, np.ndarray]] = []

    def flush() -> None:
        if waiting:
            chance = trees.chance(np.concatenate([rows for _, rows in waiting]))
            at = 0
            for page, rows in waiting:
                out.append(text_of(page, decide(page, chance[at:at + len(rows)])))
                at += len(rows)
            waiting.clear()

    nodes = 0
    for text in html:
        page = Page(text)
        waiting.append((page, features(page)))
        nodes += len(page.tags)
        if nodes >= nodes_at_once:
            flush()
            nodes = 0
    flush()
    return out


def sample(pages: DataFrame, size: int = TRAIN_PAGES) -> list[str]:
    """The ``size`` pages whose ids hash lowest. Tasks send hashes first, and pages only then."""
    rows = (pages.where(F.col("html").isNotNull() & (F.length("html") <= TRAIN_CHARS))
            .select("html", F.xxhash64("page_id", "html").alias("h")))
    last = rows.select("h").orderBy("h").limit(size).agg(F.max("h")).first()[0]
    if last is None:
        return []
    return [r["html"] for r in rows.where(F.col("h") <= last).orderBy("h").limit(size).collect()]


def main_text(pages: DataFrame, size: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    trees = pages.sparkSession.sparkContext.broadcast(train(sample(pages, size)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = extract([x.as_py() or "" for x in batch.column("html")], trees.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        read, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
