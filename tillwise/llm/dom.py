"""A small document tree of an HTML page, and statistics of its nodes."""

import math
import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np

BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu
nav ol p pre search section summary table tbody tfoot thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements whose text is dropped unasked: head, scripts, styles and form controls. The trees decide on all others
UNSEEN = frozenset("head script style template title select option optgroup datalist textarea button".split())
# what may stand in a head: any other element, and text, ends it
_IN_HEAD = frozenset("""html head base basefont bgsound link meta title style script noscript noframes
template""".split())
# inline elements that are no nodes of their own: their text belongs to the element around
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark
q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input
math mfenced mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr
munder munderover semantics""".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
         "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"},
         "tfoot": {"tr", "td", "th", "tbody"}}
_SCOPE = frozenset("table ul ol dl div section article aside nav body html td th".split())
_RIGHTS = re.compile("©|copyright|rights reserved", re.IGNORECASE)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TAGS = ("p", "div", "section", "article", "main", "nav", "aside", "header", "footer", "form", "ul",
         "ol", "li", "table", "tr", "td", "figure", "blockquote", "pre", "h1", "h2", "h3", "body")
ABOUT_TEXT = frozenset("""article articlebody body content contents copy detail entry main page post prose
read single story text""".split())
ABOUT_REST = frozenset("""ad ads advert advertisement alert author banner bar bottom breadcrumb breadcrumbs
byline comment comments complementary consent contact contentinfo cookie cookies copyright
discuss discussion disqus feedback foot footer form gdpr head header hidden login masthead menu meta
modal nav navbar navigation newsletter notice pager pagination popup privacy promo promoted recommended
related replies reply respond response reviews rail search share shares sharing side sidebar signup
skip social sponsor sponsored subscribe tags teaser toc tool toolbar top widget widgets""".split())
HASHED = 24


class Page(HTMLParser):
    """Nodes in page order, each with its parent, and the text events of the page in order:
    (node, text, is link) or None where a block begins or ends."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.tokens = ["#root"], [-1], [()]
        self.marks: list[str | None] = [None]  # of made pages: whether a node is main text
        self.events: list[tuple[int, str, bool] | None] = []
        self.open: list[tuple[str, int, bool]] = [("#root", 0, False)]  # tag, node, link
        self.places: dict[str, list[int]] = defaultdict(list)  # of a tag among the open elements
        self.open_blocks: list[int] = []
        self.unseen = 0
        self.feed(html)
        self.close()

    def _push(self, tag: str, node: int, link: bool) -> None:
        self.places[tag].append(len(self.open))
        if tag in BLOCKS:
            self.open_blocks.append(len(self.open))
        self.open.append((tag, node, link))

    def _pop_to(self, at: int) -> None:
        for tag, _, _ in reversed(self.open[at:]):
            self.places[tag].pop()
            if tag in BLOCKS:
                self.events.append(None)
                self.open_blocks.pop()
            self.unseen -= tag in UNSEEN
        del self.open[at:]

    def _last(self, tags) -> int:
        """Where the innermost open element with one of these tags is, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _end_open(self, ends, scope) -> None:
        at = self._last(ends)
        if at and at >= self._last(scope):
            self._pop_to(at)

    def _end_head(self) -> None:
        self._pop_to(self.places["head"][0])

    def handle_starttag(self, tag, attrs):
        if (self.open[-1][0] == "head" and tag not in _IN_HEAD) or (
                tag == "body" and self.places.get("head")):
            self._end_head()
        if tag in BLOCKS:
            self.events.append(None)
            self._end_open({"p"}, _SCOPE)
        if tag in _ENDS:
            self._end_open(_ENDS[tag], {"ul", "ol", "dl", "table"})
        node, link = self.open[-1][1], self.open[-1][2] or tag == "a"
        values = dict(attrs)
        kept = " ".join(filter(None, (values.get(k) for k in ("class", "id", "role", "itemprop"))))
        if "hidden" in values or "display:none" in (values.get("style") or "").replace(" ", ""):
            kept += " hidden"
        if tag not in INLINE or (kept and tag == "span"):
            self.tags.append(tag)
            self.parents.append(node)
            self.tokens.append(tuple(t.lower() for t in _TOKEN.findall(kept)))
            self.marks.append(values.get("data-main"))
            node = len(self.tags) - 1
        if tag in VOID:
            if tag in ("br", "hr", "img", "input") and not self.unseen:
                self.events.append((self.open[-1][1], " ", False))
            return
        if tag in UNSEEN:
            self.unseen += 1
        self._push(tag, node, link)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = self._last((tag,))
        if at and not (tag in INLINE and self.open_blocks and self.open_blocks[-1] > at):
            self._pop_to(at)

    def handle_data(self, data):
        if self.open[-1][0] == "head" and not data.isspace():
            self._end_head()
        if not self.unseen:
            tag, node, link = self.open[-1]
            if tag in ("td", "th"):
                data = f" {data} "
            self.events.append((node, data, link))


FEATURES = (["depth", "children", "place", "like_siblings", "text", "words", "own_words", "link_share",
             "words_per_block", "stops", "symbols", "text_of_page", "text_of_parent", "text_of_siblings",
             "blocks", "starts_at", "about_text", "about_rest", "about_text_above", "about_rest_above",
             "inside_article", "inside_list", "rights", "rights_per_block"]
            + [f"tag_{t}" for t in _TAGS] + [f"attr_{i}" for i in range(HASHED)])


def _bucket(token: str) -> int:
    value = 2166136261
    for c in token.encode():
        value = (value ^ c) * 16777619 & 0xFFFFFFFF
    return value % HASHED


def features(page: Page) -> np.ndarray:
    """One row per node: densities of its subtree, its depth, its place among its siblings, and the
    tokens of its attributes and of those around it."""
    n, parents = len(page.tags), page.parents
    own = np.zeros((n, 7))  # characters, words, words in links, stops, symbols, blocks, copyright marks
    first = np.full(n, len(page.events))
    new_block = True
    for at, event in enumerate(page.events):
        if event is None:
            new_block = True
            continue
        node, text, link = event
        words = len(text.split())
        if not words:
            continue
        own[node] += (len(text), words, words * link, text.count(".") + text.count(",")
                      + text.count("!") + text.count("?"),
                      sum(map(text.count, "#$%&*|@{}<>=")), new_block, len(_RIGHTS.findall(text)))
        first[node] = min(first[node], at)
        new_block = False
    total = own.copy()
    children, depth = np.zeros(n), np.zeros(n)
    place, same = np.zeros(n), np.zeros(n)
    count_by: dict[tuple[int, str], int] = {}
    good, bad = np.zeros(n), np.zeros(n)
    good_above, bad_above, article, in_list = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    rows = np.zeros((n, len(FEATURES)))
    tag_at, attr_at = len(FEATURES) - HASHED - len(_TAGS), len(FEATURES) - HASHED
    for i in range(1, n):
        p, tag = parents[i], page.tags[i]
        depth[i] = depth[p] + 1
        place[i] = children[p]
        children[p] += 1
        count_by[p, tag] = count_by.get((p, tag), 0) + 1
        good[i] = sum(t in ABOUT_TEXT for t in page.tokens[i]) + (tag in ("article", "main"))
        bad[i] = sum(t in ABOUT_REST for t in page.tokens[i]) + (
            tag in ("nav", "aside", "header", "footer", "form"))
        good_above[i] = good_above[p] + good[p]
        bad_above[i] = bad_above[p] + bad[p]
        article[i] = article[p] + (page.tags[p] in ("article", "main"))
        in_list[i] = in_list[p] + (page.tags[p] in ("ul", "ol", "dl"))
        if tag in _TAGS:
            rows[i, tag_at + _TAGS.index(tag)] = 1
        for t in page.tokens[i]:
            rows[i, attr_at + _bucket(t)] += 1
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
        first[parents[i]] = min(first[parents[i]], first[i])
    up = np.array(parents)
    up[0] = 0
    for i in range(1, n):
        same[i] = count_by[up[i], page.tags[i]]
    words = total[:, 1]
    siblings = np.maximum(children[up], 1)
    rows[:, :tag_at] = np.stack([
        depth, np.log1p(children), place / siblings, same / siblings, np.log1p(total[:, 0]),
        np.log1p(words), np.log1p(own[:, 1]), total[:, 2] / np.maximum(words, 1),
        np.log1p(words / np.maximum(total[:, 5], 1)), total[:, 3] / np.maximum(words, 1),
        total[:, 4] / np.maximum(total[:, 0], 1), words / max(words[0], 1),
        words / np.maximum(words[up], 1), np.log((words + 1) / (words[up] / siblings + 1)),
        np.log1p(total[:, 5]), first / max(len(page.events), 1), good, bad, good_above, bad_above,
        article, in_list, np.log1p(total[:, 6]), total[:, 6] / np.maximum(total[:, 5], 1)], 1)
    return rows


def decide(page: Page, chance: np.ndarray) -> np.ndarray:
    """Which nodes are main text. A node is kept whole, dropped whole or open; below a kept or
    dropped node everything follows it, and children of an open node are decided on their own.
    Of all such choices the one of highest likelihood under ``chance`` is taken."""
    n, parents = len(page.tags), page.parents
    chance = np.clip(chance, 1e-3, 1 - 1e-3)
    own = np.ones(n)
    for event in page.events:
        if event is not None:
            own[event[0]] += math.log1p(len(event[1].split()))
    keep, drop = np.log(chance) * own, np.log(1 - chance) * own
    keep[0] = drop[0] = 0.0
    opened = np.full(n, math.log(0.5)) * np.minimum(own, 1)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        keep[p] += keep[i]
        drop[p] += drop[i]
        opened[p] += max(keep[i], drop[i], opened[i])
    kept = np.zeros(n, bool)
    holders = {e[0] for e in page.events if e is not None and not e[1].isspace()}
    if all(page.tags[i] in ("#root", "html", "body") for i in holders):
        kept[list(holders)] = True  # a page without elements is text throughout
        return kept
    state = ["open"] * n
    for i in range(n):
        above = state[parents[i]] if i else "open"
        if above == "open":
            best = max(keep[i], drop[i], opened[i])
            # text right in an open node goes with the likelier side of that node
            state[i] = "open" if i == 0 or best == opened[i] > max(keep[i], drop[i]) else (
                "keep" if best == keep[i] else "drop")
            kept[i] = state[i] == "keep" or (state[i] == "open" and i > 0 and chance[i] > 0.5)
        else:
            state[i], kept[i] = above, above == "keep"
    return kept


def text_of(page: Page, kept: np.ndarray) -> str:
    """The text of kept nodes: white space in a block as one space, blocks joined by a line feed."""
    blocks, current = [], []
    for event in [*page.events, None]:
        if event is None:
            block = " ".join("".join(current).split())
            if block:
                blocks.append(block)
            current = []
        elif kept[event[0]]:
            current.append(event[1])
        else:
            current.append(" ")
    return "\n".join(blocks)
