import html
import re

import numpy as np
import pytest

from conftest_llm import SF, rows_of
from tillwise.llm import boosting, dom, html_text
from tillwise.llm.tables import table


def article(page):
    """What the articles of these pages say, by plain replacement."""
    inner = re.search("<article>(.*?)</article>", page, re.DOTALL)[1]
    inner = re.sub(r"</?(p|h1)>", "\0", inner).replace("<br>", " ")
    blocks = (" ".join(html.unescape(b).split()) for b in re.sub("<[^>]*>", "", inner).split("\0"))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.train(html_text.sample(table(spark, SF, "pages")))


def test_every_page_gives_its_article(spark):
    pages = table(spark, SF, "pages")
    found = html_text.op1_html_extraction(spark, SF)
    want = []
    for r in pages.collect():
        text = article(r["html"])
        want.append((r["page_id"], r["url"], text, len(text)))
    assert rows_of(found, "page_id", "url", "text", "n_chars") == sorted(want, key=repr)


def test_pages_of_other_layouts(trees):
    blocks = [[f"Sentence {i} of the text, with some words {k} in it. " * 3 for i in range(12)]
              for k in range(20)]
    made = html_text.Layouts(blocks, ["Home and news", "terms of use, about us"])
    made.random.seed(77)
    shares = []
    for _ in range(200):
        source = made.page()
        page = dom.Page(source)
        main = np.array([k == 1 for k in html_text._inherited(page)])
        want = set(dom.text_of(page, main).split("\n"))
        got = set(html_text.extract([source], trees)[0].split("\n"))
        shares.append(2 * len(want & got) / (len(want) + len(got)))
    assert np.mean(shares) > 0.9


def test_a_page_with_everything_around_its_text(trees):
    source = (
        "<html><head><title>t</title><script>var a='<p>no</p>'</script><style>p{}</style></head><body>"
        "<div id=menu><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div>"
        "<div class='cookie-notice'>We use cookies here</div>"
        "<div class=content><h1>A &lt;title&gt; &amp; more</h1><p>First   paragraph,\nwith <b>words</b> in "
        "it&#33;<br>And a line.<div class=ad>Buy this now</div><p>Second paragraph &copy, "
        "of some length.</div><!-- <p>no</p> --><form><label>Mail</label><input></form>"
        "<div id=comments><h3>Comments</h3><p>I liked this text a lot, thank you for it.</p></div>"
        "<aside><p>Read this other text too</p></aside><footer>&copy; someone</footer></body></html>")
    assert html_text.extract([source], trees) == [
        "A <title> & more\nFirst paragraph, with words in it! And a line.\n"
        "Second paragraph ©, of some length."]


def test_choices_never_contradict(trees):
    rng = np.random.default_rng(0)
    page = dom.Page("<body>" + "<div><p>a b c</p><div>x<p>y</p></div></div>" * 5 + "</body>")
    for _ in range(50):
        chance = rng.uniform(size=len(page.tags))
        kept = dom.decide(page, chance)
        below = [[j for j, p in enumerate(page.parents) if p == i] for i in range(len(page.tags))]

        def inside(i):
            return [i] + [k for j in below[i] for k in inside(j)]
        for i in range(1, len(page.tags)):
            # an element that goes the way of its parent's whole subtree has no say of its own: where
            # a kept element holds a dropped one, or the other way round, no element above is closed
            if len({bool(kept[j]) for j in inside(i)}) == 2:
                likely = np.clip(chance[inside(i)], 1e-3, 1 - 1e-3)
                size = np.array([1 + sum(np.log1p(len(e[1].split())) for e in page.events if e and e[0] == j)
                                 for j in inside(i)])
                whole = max((size * np.log(likely)).sum(), (size * np.log(1 - likely)).sum())
                chosen = (size * np.log(np.where(kept[inside(i)], likely, 1 - likely))).sum()
                assert chosen > whole  # splitting pays, else the element would be closed
    assert not dom.decide(page, np.full(len(page.tags), 0.01)).any()
    assert dom.decide(page, np.full(len(page.tags), 0.99))[2:].all()


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain text &amp; more &am"), (4, "u", "<"),
            (5, "u", "<p>" * 3000 + "deep " + "<div>" * 3000), (6, "u", "</p></div><p>x"),
            (6, "u", "</p></div><p>x"), (7, "u", "<article>" + "<p>Some words follow here, and a few more of them do so too.</p>" * 20_000),
            (8, "u", "<div hidden><p>no</div><article><p>Yes, this is text.</article>")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows],
                                  "page_id long, url string, html string, text string, n_chars int")
    found = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert html_text.main_text(pages).count() == len(rows)
    assert found[1] == found[2] == ""
    assert found[None] == "plain text & more &am"
    assert found[7].count("\n") == 19_999
    assert found[8] == "Yes, this is text."
    assert html_text.main_text(pages.where("page_id > 99")).count() == 0


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)
    trees = boosting.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((trees.chance(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_a_head_ends_without_its_end_tag(trees):
    article = "<article><h1>A title</h1><p>Words of the text follow, and some more of them do.</p></article>"
    want = "A title\nWords of the text follow, and some more of them do."
    for source in (f"<html><head><title>x</title><body>{article}</body></html>",
                   f"<html><head><title>x</title>{article}</html>",
                   f"<head><meta charset=utf-8><script>var a = 1</script>\n{article}",
                   f"<html><head><title>x<body>{article}",
                   f"<html><head><noscript><p>no</p></noscript><title>x</title></head><body>{article}"):
        assert html_text.extract([source], trees) == [want]
    page = dom.Page("<html><head><title>x</title>bare text")
    assert dom.text_of(page, np.ones(len(page.tags), bool)) == "bare text"


def test_input_pages_give_no_marks():
    """``data-main`` of an input page is an attribute like any other."""
    plain = "<html><body><nav><p>Home</p></nav><article><p>Words of the text.</p></article></body></html>"
    for mark in ("scripts/main", "0", "1"):
        marked = plain.replace("<nav>", f"<script data-main='{mark}'></script><nav data-main='{mark}'>").replace(
            "<article>", f"<article data-main='{mark}'>")
        page = dom.Page(marked)
        known = html_text.known_nodes(page)
        assert html_text.blocks_of(page, known, 1.0) == ["Words of the text."]
        assert html_text.blocks_of(page, known, 0.0) == ["Home"]


PROSE = ("The ferry leaves the harbour at seven in the morning, and the crossing takes about two hours. "
         "Most people stay on deck, since the view of the islands is the reason why they came.")


def test_elements_the_contract_does_not_name_are_kept(trees):
    body = f"<article><h1>A title</h1><p>{PROSE}</p><p>Energy is <math><mi>E</mi><mo>=</mo><mi>mc</mi></math> for all bodies at rest, as was found out long ago.</p></article>"
    assert html_text.extract([f"<html><body>{body}</body></html>"], trees) == [
        f"A title\n{PROSE}\nEnergy is E=mc for all bodies at rest, as was found out long ago."]


def test_headings_links_and_lists_inside_an_article(trees):
    linked = PROSE.replace("two hours", "<a href=/x>two hours</a>")
    more = "<li><a href=/1>How to find a place on the early ferry</a></li><li><a href=/2>What the islands were like before</a></li>"
    menu = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
    want = ["Real title", PROSE, PROSE]
    for source in (
            f"{menu}<article><header><h1>Real title</h1></header><p>{PROSE}</p><p>{PROSE}</p></article>",
            f"{menu}<article><header><h1>Real title</h1></header><p>{linked}</p><p>{linked}</p></article>",
            f"{menu}<div class=entry><h1>Real title</h1><p>{linked}</p><p>{PROSE}</p></div>"):
        got = html_text.extract([f"<html><head><title>x</title></head><body>{source}</body></html>"], trees)[0]
        assert got.split("\n") == want, source
    got = html_text.extract([f"<html><body>{menu}<div class=entry><h1>Real title</h1><p>{linked}</p><ul>{more}</ul></div>"
                             "</body></html>"], trees)[0].split("\n")
    assert got[:2] == ["Real title", PROSE]


def test_copyright_lines_in_bare_elements(trees):
    for foot in ("<div>&copy; 2020 The Ferry Company. All rights reserved.</div>",
                 "<table><tr><td>Copyright &copy; The Ferry Company</td></tr></table>"):
        got = html_text.extract([f"<html><body><article><h1>Real title</h1><p>{PROSE}</p><p>{PROSE}</p></article>{foot}</body></html>"],
                                trees)
        assert got == [f"Real title\n{PROSE}\n{PROSE}"], foot


def test_parsing_is_linear_in_unclosed_elements():
    import time
    for inner in ("<font>", "<b><p>", "<p><font>", "<li><i>", "</i><u>"):
        started = time.perf_counter()
        dom.Page(inner * 20_000)
        assert time.perf_counter() - started < 5, inner
