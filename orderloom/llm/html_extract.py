"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block of a page is a node that is content or not. A node's potential comes from its tag, its class and id words,
and the text and links below it; a potential between parent and child says how readily a part of the page changes from
one to the other. Sum-product messages go up from the leaves and down from the root, which gives each node's
exact probability of being content. The weights are fitted by the same messages to the likelihood of labelled
pages, which ``labelled_pages`` composes from the parts that web pages are made of.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp template".split())
UNCLOSED = frozenset("noscript template".split())  # of RAW, those that are ordinary elements where their end is missing
UNREAD = frozenset("button select svg".split())  # their text is not part of a page's text
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
# an element of the first kind ends open ones of the second kind, up to one of the third
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# What the words in class, id and role attributes tell
CUES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip toolbar",
    "header": "header masthead topbar banner logo branding",
    "footer": "footer bottom copyright legal colophon contentinfo",
    "side": "sidebar aside side rail widget complementary related recommended recommend more trending popular",
    "advert": "ad ads adv advert adverts advertisement advertising promo promotion sponsor sponsored adsense commercial outbrain taboola",
    "notice": "notice cookie cookies consent gdpr popup modal overlay alert message announcement paywall disclaimer",
    "form": "form login signin signup subscribe subscription newsletter search contact register",
    "comment": "comment comments commentlist reply replies respond response responses discussion disqus feedback review reviews guestbook",
    "share": "share sharing social tags tag meta byline author rating print tools",
    "content": "article content post entry story text body main page blog news paragraph maincontent articlebody",
    "wrapper": "wrapper container wrap outer inner layout site row column col grid",
}
_CUE_OF = {word: cue for cue, words in CUES.items() for word in words.split()}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNREAD_END = {
    name: re.compile(rf"<(?:(/){name}|{name}|article|main|section|header|footer|nav|aside|form|dialog|body)(?=[\s/>])", re.I) for name in UNREAD
}
CONTENT, OTHER = 1, 0


@dataclass
class Page:
    """The nodes of a page in document order (a parent comes before its children), and its text in pieces."""

    tags: list[str] = field(default_factory=lambda: ["html"])
    parents: list[int] = field(default_factory=lambda: [-1])
    cues: list[frozenset] = field(default_factory=lambda: [frozenset()])
    chars: list[int] = field(default_factory=lambda: [0])
    link_chars: list[int] = field(default_factory=lambda: [0])
    labels: list[int] = field(default_factory=lambda: [CONTENT])
    pieces: list[tuple[int, str]] = field(default_factory=list)


def _cues(attributes: str) -> frozenset:
    found = set()
    if "=" in attributes:
        for _, a, b, c in _ATTRIBUTE.findall(attributes):
            for word in _WORD.findall(a or b or c):
                if cue := _CUE_OF.get(word.lower()):
                    found.add(cue)
    return frozenset(found)


def parse(source: str) -> Page:
    """The nodes and text of a page. Unclosed and stray tags are taken as browsers do for the common cases."""
    page = Page()
    stack = [("html", 0)]  # open elements with their nodes
    opened: dict[str, int] = defaultdict(int)  # their names, so that an end without a start is not looked for
    open_p = links = 0
    endless: set[str] = set()  # names of UNCLOSED whose end does not come any more
    unread, closed = 0, False  # the depth of an open element of UNREAD, and whether its end was seen ahead
    at, end = 0, len(source)
    tags, parents, cues, chars, link_chars, labels, pieces = (
        page.tags, page.parents, page.cues, page.chars, page.link_chars, page.labels, page.pieces
    )

    def text(raw: str) -> None:
        if unread:
            return
        node = stack[-1][1]
        if "&" in raw:
            raw = html.unescape(raw)
        pieces.append((node, raw))
        size = len(raw.strip())
        chars[node] += size
        if links:
            link_chars[node] += size

    def pop_to(depth: int) -> None:
        nonlocal open_p, links, unread
        if depth <= unread:
            unread = 0
        while len(stack) > depth:
            name = stack.pop()[0]
            opened[name] -= 1
            if name == "p":
                open_p -= 1
            elif name == "a":
                links -= 1

    while at < end:
        start = source.find("<", at)
        if start < 0:
            text(source[at:])
            break
        match = _TAG.match(source, start)
        if not match:
            # a sign that opens no tag is text
            stop = source.find("<", start + 1)
            stop = end if stop < 0 else stop
            text(source[at:stop])
            at = stop
            continue
        if start > at:
            text(source[at:start])
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        closing, name, attributes = match[1] or match[4], name.lower(), match[3] or match[6] or ""
        block = name not in INLINE
        if block:
            pieces.append((-1, " "))
        if closing:
            if not opened[name]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    pop_to(depth)
                    break
            continue
        if name in RAW and not (name in UNCLOSED and name in endless):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            if close or name not in UNCLOSED:
                if not attributes.rstrip().endswith("/"):
                    at = close.end() if close else end
                continue
            endless.add(name)
        if name in VOID or name in UNREAD and attributes.rstrip().endswith("/"):
            continue
        if unread and not closed and (name in CLOSES_P or name in DIVIDING or name in IMPLIED_ENDS and name != "option" or name == "button"):
            # nothing that is left open holds blocks
            pop_to(unread)
        if name in UNREAD and not unread:
            unread, ahead = len(stack), _UNREAD_END[name].search(source, at)
            closed = bool(ahead and ahead[1])
        if open_p and name in CLOSES_P and not unread:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    pop_to(depth)
                    break
        if name in IMPLIED_ENDS:
            ended, limits = IMPLIED_ENDS[name]
            for depth in range(len(stack) - 1, 0, -1) if any(map(opened.get, ended)) else ():
                if stack[depth][0] in limits:
                    break
                if stack[depth][0] in ended:
                    pop_to(depth)
                    break
        if name in ("html", "body") and (name == "html" or opened[name]):
            continue
        node, found = stack[-1][1], _cues(attributes)
        if (block or found) and not unread:
            tags.append(name)
            parents.append(node)
            cues.append(found)
            chars.append(0)
            link_chars.append(0)
            labels.append(CONTENT if 'data-main="1"' in attributes else OTHER)
            node = len(tags) - 1
        stack.append((name, node))
        opened[name] += 1
        if name == "p":
            open_p += 1
        elif name == "a":
            links += 1
    return page


# elements that divide a page
DIVIDING = frozenset("article main section header footer nav aside form dialog html head body".split())


def is_telling(page: Page, node: int) -> bool:
    """Whether a node says something of its own. The others go with their parent, unless they are mostly links."""
    return page.tags[node] in DIVIDING or bool(page.cues[node] - {"wrapper"})


def features(page: Page) -> list[list[str]]:
    """The names of each node's features; sizes and link shares are those of the whole subtree."""
    count = len(page.tags)
    chars, links = page.chars[:], page.link_chars[:]
    for node in range(count - 1, 0, -1):
        parent = page.parents[node]
        chars[parent] += chars[node]
        links[parent] += links[node]
    out = []
    for node in range(count):
        share = links[node] / chars[node] if chars[node] else 0.0
        if is_telling(page, node):
            tag = page.tags[node]
            row = ["tag=" + (tag if tag in DIVIDING else "other"), f"size={min(chars[node].bit_length(), 9)}", f"links={int(share * 4)}"]
            out.append(row + ["cue=" + cue for cue in page.cues[node]])
        else:
            out.append(["plain links"] if share > 0.6 else [])
    return out


def _table(pair: dict, kind: str) -> tuple[float, float, float, float]:
    """The probabilities of a child's state by its parent's: (0, 0), (0, 1), (1, 0), (1, 1)."""
    table = []
    for parent in (0, 1):
        odds = math.exp(pair.get((kind, parent, 1), 0.0) - pair.get((kind, parent, 0), 0.0))
        table += [1 / (1 + odds), odds / (1 + odds)]
    return tuple(table)


@dataclass
class TreeModel:
    """Weights of node features for content, and of a child's state by its parent's, for plain and telling nodes.

    The potential of a pair is a conditional probability: a child without features of its own tells its parent
    nothing, however many of them there are.
    """

    node: dict[str, float] = field(default_factory=dict)
    pair: dict[tuple[str, int, int], float] = field(default_factory=dict)

    def messages(self, page: Page) -> tuple[list[float], list[tuple[float, float, float, float]]]:
        """Each node's probability of being content, and of the four states of its parent and it."""
        count, weight = len(page.tags), self.node
        tables = {kind: _table(self.pair, kind) for kind in ("plain", "telling")}
        own_table = [tables["telling" if is_telling(page, n) else "plain"] for n in range(count)]
        # beliefs as a pair that sums to one, so that long pages do not underflow
        up = []
        for row in features(page):
            e = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum([weight.get(f, 0.0) for f in row])))))
            up.append([1 - e, e])
        to_parent: list[tuple[float, float]] = [(0.5, 0.5)] * count
        for n in range(count - 1, 0, -1):
            t, (x, y) = own_table[n], up[n]
            m_0, m_1 = t[0] * x + t[1] * y, t[2] * x + t[3] * y
            total = m_0 + m_1
            to_parent[n] = (m_0 / total, m_1 / total)
            belief = up[page.parents[n]]
            x, y = belief[0] * to_parent[n][0], belief[1] * to_parent[n][1]
            total = x + y
            belief[0], belief[1] = (x / total, y / total) if total else (0.5, 0.5)
        marginal: list[tuple[float, float]] = [(0.5, 0.5)] * count
        pairs = [(0.0, 0.0, 0.0, 0.0)] * count
        marginal[0] = (up[0][0], up[0][1])
        for n in range(1, count):
            m, back, t, own = marginal[page.parents[n]], to_parent[n], own_table[n], up[n]
            x, y = m[0] / max(back[0], 1e-300), m[1] / max(back[1], 1e-300)  # without what this child said
            states = (x * t[0] * own[0], x * t[1] * own[1], y * t[2] * own[0], y * t[3] * own[1])
            total = sum(states) or 1.0
            pairs[n] = tuple([s / total for s in states])
            marginal[n] = (pairs[n][0] + pairs[n][2], pairs[n][1] + pairs[n][3])
        return [m[1] for m in marginal], pairs

    def fit(self, pages: list[Page], steps: int = 60, rate: float = 1.0, l2: float = 0.0002) -> "TreeModel":
        """Adagrad on the likelihood of the labels: what is seen less what the messages expect."""
        rows = [features(page) for page in pages]
        kinds = [["telling" if is_telling(page, n) else "plain" for n in range(len(page.tags))] for page in pages]
        seen: dict = {}
        for _ in range(steps):
            grad: dict = {}
            tables = {kind: _table(self.pair, kind) for kind in ("plain", "telling")}
            for page, named, kind in zip(pages, rows, kinds):
                content, pairs = self.messages(page)
                for n, label in enumerate(page.labels):
                    gap = label - content[n]
                    for name in named[n]:
                        grad[name] = grad.get(name, 0.0) + gap
                    if n:
                        above = page.labels[page.parents[n]]
                        for parent in (0, 1):
                            gaps = [((above, label) == (parent, child)) - pairs[n][2 * parent + child] for child in (0, 1)]
                            for child in (0, 1):
                                key = (kind[n], parent, child)
                                share = tables[kind[n]][2 * parent + child]
                                grad[key] = grad.get(key, 0.0) + gaps[child] - share * sum(gaps)
            for key, value in grad.items():
                weights = self.pair if isinstance(key, tuple) else self.node
                value = value / len(pages) - l2 * weights.get(key, 0.0)
                seen[key] = seen.get(key, 1e-6) + value * value
                weights[key] = weights.get(key, 0.0) + rate * value / math.sqrt(seen[key])
        return self


LENGTHS = [3, 10, 30, 90]


def _words(rng: random.Random, least: int, most: int) -> str:
    letters = ["ka", "lo", "mi", "ter", "on", "sa", "ve", "du", "rin", "pe"]
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most)))


def _element(tag: str, inner: str, main: bool, attributes: str = "") -> str:
    return f"<{tag}{' ' + attributes if attributes else ''}{' data-main=\"1\"' if main else ''}>{inner}</{tag}>"


def _links(rng: random.Random) -> str:
    items = "".join(_element("li", f'<a href="#">{_words(rng, 1, 3)}</a>', False) for _ in range(rng.randint(2, 8)))
    return _element(rng.choice(["ul", "ol", "ul"]), items, False)


def _other_part(rng: random.Random, inside: bool) -> str:
    """Something that is not content: its kind by a tag, by a word in its class or id, or by both."""
    short, longer = _words(rng, 2, 12), _words(rng, 8, 60)
    most = rng.choice(LENGTHS)  # how long a text is says little about what it is
    paragraphs = "".join(_element("p", _words(rng, 1, most), False) for _ in range(rng.choice([1, 1, 2, 3, 10])))
    kinds = {
        "menu": ("nav", _links(rng)), "advert": (None, rng.choice([short, paragraphs])),
        "notice": (None, rng.choice([short, paragraphs])), "side": ("aside", rng.choice([_links(rng), paragraphs, longer])),
        "form": ("form", f"{short} <input> {_element('p', short, False)}"), "share": (None, _links(rng)),
        "comment": ("section", "".join(_element("div", f"{_element('h4', short, False)}{paragraphs}", False, rng.choice(["", 'class="comment"'])) for _ in range(rng.randint(1, 4)))),
    }
    if not inside:
        kinds["header"] = ("header", rng.choice([_element("h1", short, False), short]) + rng.choice(["", _links(rng)]))
        kinds["footer"] = ("footer", rng.choice([f"&copy; {short}", paragraphs, _links(rng)]))
    kind = rng.choice(sorted(kinds))
    tag, inner = kinds[kind]
    named = tag is None or kind == "comment" or rng.random() < 0.4
    attributes = f'{rng.choice(["class", "id"])}="{rng.choice(CUES[kind].split())}"' if named else ""
    if tag is None or (named and rng.random() < 0.5):
        tag = rng.choice(["div", "div", "section", "aside"])
    return _element(tag, inner, False, attributes)


def _content_part(rng: random.Random, most: int) -> str:
    kind = rng.random()
    if kind < 0.7:
        return _element("p", _words(rng, 1, most) + rng.choice(["", "", f' <a href="#">{_words(rng, 1, 3)}</a>']), True)
    if kind < 0.8:
        return _element(rng.choice(["h2", "h3"]), _words(rng, 1, 8), True)
    if kind < 0.88:
        return _element(rng.choice(["ul", "ol"]), "".join(_element("li", _words(rng, 1, 25), True) for _ in range(rng.randint(1, 5))), True)
    if kind < 0.94:
        return _element("blockquote", _element("p", _words(rng, 5, 40), True), True)
    if kind < 0.97:
        cells = "".join(_element("td", _words(rng, 1, 6), True) for _ in range(3))
        return _element("table", _element("tr", cells, True), True)
    return _element("div", _words(rng, 5, 60), True)


def labelled_pages(count: int, seed: int = 0) -> list[str]:
    """Pages in which every element of the main text, and every one around it, is marked ``data-main="1"``."""
    pages = []
    for number in range(count):
        rng = random.Random(seed * 100_003 + number)
        most = rng.choice(LENGTHS)
        parts = [_element("h1", _words(rng, 2, 10), True)] if rng.random() < 0.9 else []
        for _ in range(rng.choice([1, 2, 4, 8, 16, 32])):
            parts.append(_content_part(rng, most))
            if rng.random() < 0.1:
                parts.append(_other_part(rng, True))
        tag, attributes = rng.choice([
            ("article", ""), ("article", ""), ("article", 'class="post"'), ("main", ""), ("div", 'class="content"'), ("div", 'id="main"'),
            ("div", 'class="entry-content"'), ("section", 'class="story"'), ("div", ""),
        ])
        body = _element(tag, "".join(parts), True, attributes)
        before = "".join(_other_part(rng, False) for _ in range(rng.randint(0, 4)))
        after = "".join(_other_part(rng, False) for _ in range(rng.randint(0, 4)))
        inner = before + body + after
        if rng.random() < 0.3:
            inner = before + _element("div", body + after, True, rng.choice(['class="wrapper"', 'id="page"', "", 'class="container"']))
        pages.append(f"<!DOCTYPE html><html><head><title>{_words(rng, 2, 6)}</title></head>{_element('body', inner, True)}</html>")
    return pages


def train(pages: list[str] | None = None, count: int = 160) -> TreeModel:
    parsed = [parse(source) for source in (labelled_pages(count) if pages is None else pages)]
    for page in parsed:
        for node, tag in enumerate(page.tags):
            if tag == "head":
                page.labels[node] = OTHER
    return TreeModel().fit(parsed)


def main_text(source: str | None, model: TreeModel) -> str:
    """The text of all nodes that are content, in page order, with single spaces."""
    if not source:
        return ""
    page = parse(source)
    content, _ = model.messages(page)
    return " ".join("".join([text if node < 0 or content[node] >= 0.5 else " " for node, text in page.pieces]).split())


def extract_pages(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """One row per page: page_id, url, text (empty if there is none), n_chars (its code points).

    A null or empty page has no text. Repeated pages give a row each, and null ids and urls stay null. Markup that cannot be read is
    taken as text, and a page that is text alone is all content. An empty table gives an empty result. Other columns are not looked at.
    """
    model = model or train()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [main_text(source, model) for source in part.column("html").to_pylist()]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
